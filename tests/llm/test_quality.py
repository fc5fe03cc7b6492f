import re
from collections import Counter

import numpy as np

from slotline.llm import quality_labels, quality_rules
from slotline.llm.textstats import rule_statistics

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    """The five base statistics, counted plainly."""
    text = text or ""
    words = WORD.findall(text)
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(triples)
    covered = {i + k for i, t in enumerate(triples) if often[t] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
    )


def junk(prose, kind, seed):
    words = prose(seed, 120).split()
    if kind == 0:
        return " ".join(w + "###" for w in words)
    if kind == 1:
        return " | ".join(words)
    return " ".join(w.upper() + "!!" for w in words)


def corpus(prose):
    good = [(i, prose(i, 100 + i % 40) + ".") for i in range(240)]
    return good, [(1000 + i, junk(prose, i % 3, i)) for i in range(45)]


def test_statistics_are_those_counted_by_hand(prose, odd_rows):
    texts = [t for _, t in odd_rows] + ["a b c a b c\nq\nq\n\n  \nq r", "a\x1cb c", "\n".join(["same line"] * 5), "a a a a"]
    for text in texts:
        assert rule_statistics(text)[:5] == by_hand(text), text


def test_paths_of_an_outlier_are_shorter():
    points = np.random.default_rng(1).normal(size=(256, 3))
    forest = quality_rules.Forest.grown([points] * 50)
    usual, far = forest.scores(np.array([[0.0, 0, 0], [9.0, 9, 9]]))
    assert far > 0.6 > usual


def test_rules_keep_good_and_refuse_junk(make_documents, make_labels, prose):
    good, bad = corpus(prose)
    labels = make_labels(*[(i, 1, 0) for i, _ in good[::2]], *[(i, 0, 0) for i, _ in bad[::2]])
    rows = quality_rules.judge(make_documents(*good, *bad), labels).collect()
    kept = {r["doc_id"] for r in rows if r["kept"]}
    assert len(kept & {i for i, _ in good}) >= 0.97 * len(good)
    assert not kept & {i for i, _ in bad}
    assert not any(r["base_failed"] for r in rows if r["doc_id"] < 1000)


def test_rules_have_a_result_for_odd_rows(make_documents, make_labels, odd_rows):
    labels = make_labels((5, 1, 0), (None, 1, 1), (7, None, None))
    rows = quality_rules.judge(make_documents(*odd_rows), labels).collect()
    assert len(rows) == len(odd_rows)
    for row in rows:
        text = dict(odd_rows)[row["doc_id"]]
        assert tuple(row[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == by_hand(text)
        assert row["base_failed"] == (row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"])
        assert not (row["base_failed"] and row["kept"])


def test_rules_on_empty_tables(make_documents, make_labels):
    assert quality_rules.judge(make_documents(), make_labels()).count() == 0


def test_expectation_maximisation_finds_the_bad_patterns():
    size = len(quality_labels.labellers())
    fine, symbols, shouting = 0b11, 1 << (size - 1), 1 << (size - 3) | 1 << (size - 4)
    belief = quality_labels.posteriors({fine: 900, symbols | 1: 60, shouting | 1: 40, 0: 3})
    assert belief[fine] > 0.99 and belief[symbols | 1] < 0.05 and belief[shouting | 1] < 0.05


def test_classifier_tells_junk_without_labels(make_documents, prose):
    good, bad = corpus(prose)
    rows = quality_labels.classify(make_documents(*good, *bad)).collect()
    kept = {r["doc_id"] for r in rows if r["kept"]}
    assert len(kept & {i for i, _ in good}) >= 0.97 * len(good)
    assert len(kept & {i for i, _ in bad}) <= 1


def test_classifier_has_a_result_for_odd_rows(make_documents, odd_rows):
    rows = quality_labels.classify(make_documents(*odd_rows)).collect()
    assert len(rows) == len(odd_rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert not any(r["kept"] for r in rows if r["doc_id"] in (1, 2, 3))
    same = {r["score"] for r in rows if r["doc_id"] in (5, 6)}
    assert len(same) == 1
    assert quality_labels.classify(make_documents()).count() == 0


def test_only_good_keeps_all_columns(make_documents, prose):
    good, bad = corpus(prose)
    documents = make_documents(*good, *bad)
    assert quality_labels.only_good(documents).columns == documents.columns
