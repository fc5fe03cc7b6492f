"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from slotline.llm import spelling_variants
from slotline.llm.spelling_variants import near_pairs, variants


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def plain(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda x: x[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {word: n for word, n in counts.items() if len(word) >= 7 and n >= 2}
    near = {word: [] for word in words}
    for a, b in combinations(words, 2):
        if one_apart(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[word] = best if best and words[best] >= 10 * words[word] else None
    out = {}
    for word, n in words.items():
        root = word
        while form[root]:
            root = form[root]
        out[word] = (form[word], root, n, len(near[word]), form[word] and words[form[word]])
    return out


def spelled(seed):
    """Documents of words with misspelled forms, in chains of ten times each other's number."""
    chosen = random.Random(seed)
    letters = "abcÉéÀßÿ×x"
    base = ["".join(chosen.choices(letters, k=chosen.randint(6, 10))) for _ in range(25)] + ["aaaaaaaa", "abababab", "aaaaaaa"]
    counted = Counter()
    for word in base:
        counted[word] += chosen.choice([1, 2, 30, 300])
        for _ in range(12):
            at = chosen.randrange(len(word) + 1)
            kind = chosen.randrange(3)
            other = word[:at] + (chosen.choice(letters) if kind < 2 else "") + word[at + (kind > 0) :]
            counted[other] += chosen.choice([1, 2, 3, 20])
    listed = [word for word, n in counted.items() for _ in range(n)]
    chosen.shuffle(listed)
    return [(at, "-".join(listed[at::40])) for at in range(40)]


@pytest.mark.parametrize("most", [spelling_variants.MOST_WORDS, 6, 1])
def test_same_as_all_pairs(make_documents, monkeypatch, odd_rows, most):
    rows = spelled(1) + odd_rows + [(77, "Verylong" * 5000), (78, "verylong" * 5000 + " " + "verylong" * 4999 + "verylon1"), (78, "verylong" * 5000)]
    monkeypatch.setattr(spelling_variants.near_pairs, "__defaults__", (most,))
    got = {row[0]: tuple(row[1:]) for row in variants(make_documents(*rows)).collect()}
    want = plain(rows)
    assert any(x[1] != word for word, x in want.items()) and got == want


def test_small_tables_of_scanned_words(spark, monkeypatch):
    words = sorted({"".join(x) for x in random.Random(4).choices(["abc", "abd", "bbc", "cab", "dad", "aaa", "bcd"], k=7)} | {"".join(random.Random(i).choices("ab", k=7 + i % 3)) for i in range(150)})
    frame = spark.createDataFrame([(word, i + 2) for i, word in enumerate(words) if len(word) >= 7], "word string, n long")
    listed = [row.word for row in frame.collect()]
    want = {(a, b) for a in listed for b in listed if one_apart(a, b)}
    got = [(row.word, row.near) for row in near_pairs(frame).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_chain_leads_to_root(make_documents):
    rows = [(0, " ".join(["colouring"] * 300 + ["coloring"] * 30 + ["colring"] * 3))]
    frame = variants(make_documents(*rows))
    assert {row.word: (row.form, row.root) for row in frame.collect()} == {word: x[:2] for word, x in plain(rows).items()}


def test_empty_table(make_documents):
    assert variants(make_documents()).collect() == []
    assert variants(make_documents((1, None), (None, ""))).select(F.col("word")).collect() == []
