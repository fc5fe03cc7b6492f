"""The word run join against all pairs."""

import re
from itertools import combinations

import numpy as np
import pytest

from slotline.llm import ngram_join
from slotline.llm.ngram_join import RunCounts, joined, prefix, run_set

NONE = (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def lowered(text):
    return re.sub("[A-Z]", lambda x: x[0].lower(), text or "")


def all_pairs(rows):
    words = [re.findall(r"[^\x20\x09-\x0D]+", lowered(text)) for _, text in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set() for w in words]
    reach = [{i} for i in range(len(rows))]
    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and reach[a] is not reach[b]:
            reach[a] |= reach[b]
            for x in reach[b]:
                reach[x] = reach[a]
    ids = lambda held: min((rows[x][0] for x in held if rows[x][0] is not None), default=None)
    return sorted(((rows[i][0], len(sets[i]), ids(reach[i])) for i in range(len(rows))), key=str)


def result(frame):
    return sorted((tuple(row) for row in frame.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def group_of_copies(prose):
    """Near copies that drift, texts that share a passage, and short ones."""
    base, passage, rows = prose(100, 120).split(), prose(101, 60), []
    for at in range(40):
        changed = list(base)
        for place in range(at // 4):
            changed[(place * 29 + at) % 120] = f"word{at}x{place}"
        rows.append((100 + at, " ".join(changed).title() if at % 3 else " ".join(changed)))
    rows += [(200 + at, passage + " " + prose(300 + at, 12 + at)) for at in range(40)]
    rows += [(300 + at, " ".join(prose(7, 4 + at % 4).split())) for at in range(8)]
    return rows


@pytest.mark.parametrize("common", [None, NONE])
def test_same_as_all_pairs(make_documents, prose, odd_rows, common):
    rows = odd_rows + group_of_copies(prose)
    assert result(joined(make_documents(*rows), common)) == all_pairs(rows)


def test_any_number_of_matches_gives_the_same(make_documents, prose, monkeypatch):
    rows = group_of_copies(prose)
    for most, rounds, hot in ((1, 0, 2), (4, 1, 8), (200, 0, 64)):
        monkeypatch.setattr(ngram_join, "MOST_MATCHES", most)
        monkeypatch.setattr(ngram_join, "HOT", hot)
        monkeypatch.setattr(ngram_join, "ROUNDS", rounds)
        assert result(joined(make_documents(*rows))) == all_pairs(rows)


def test_common_runs_lengthen_the_prefix(prose):
    runs = run_set(prose(1, 104))
    asked, first, _ = prefix(runs, *NONE)
    assert (asked, len(first)) == (1, 100 - 80 + 1)
    asked, first, cool = prefix(runs, runs, np.full(100, 1000))
    assert cool == 0 and asked > 1 and len(first) == 100 - 80 + asked
    # Runs that are common stand behind the others.
    asked, first, _ = prefix(runs, runs[:70], np.full(70, 1000))
    assert set(first[:21].tolist()) <= set(runs[70:].tolist())


def test_counting_keeps_frequent_runs_when_full():
    counts = RunCounts(bound=1000)
    for at in range(50):
        counts.add(np.unique(np.append(np.arange(5, dtype=np.uint64), np.arange(100, 400, dtype=np.uint64) + np.uint64(1000 * at))))
    runs, held = counts.common(3)
    assert set(runs.tolist()) <= {0, 1, 2, 3, 4} and (held >= 45).all()
    assert len(counts.runs) <= 2000


def test_empty_table(make_documents):
    assert result(joined(make_documents())) == []
