import hashlib
import re

import pytest

from slotline.llm import phrase_index

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def by_hand(documents, items):
    phrases = {}
    for item_id, text in items:
        w = words(text)
        for at in range(max(len(w) - 9, 1) if w else 0):
            phrases.setdefault(tuple(w[at : at + 10]), set()).add(item_id or "")
    out = []
    for doc_id, text in documents:
        w, hit, found = words(text), set(), set()
        for size in {len(p) for p in phrases}:
            for at in range(len(w) - size + 1):
                which = phrases.get(tuple(w[at : at + size]), ())
                found.update(which)
                hit.update(range(at, at + size) if which else ())
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=str)


@pytest.fixture
def make_items(spark):
    return lambda *rows: spark.createDataFrame([(*r, None, None) for r in rows], "item_id string, text string, phrase string, doc string")


def found(documents, items):
    return sorted((tuple(r) for r in phrase_index.report(documents, items).collect()), key=str)


def test_hits_are_those_found_by_hand(make_documents, make_items, prose, odd_rows):
    items = [(f"i{k}", prose(500 + k, 15 + k)) for k in range(8)]
    items += [("short", "Zum Beispiel, é!"), ("same", prose(500, 15)), ("word", "lonely"), (None, prose(600, 12)), ("none", None), ("blank", " .. ")]
    items += [("loop", "a b " * 9), ("tie", "a a a a a a a a a a a")]
    documents = list(odd_rows)
    for k in range(60):
        w = prose(k, 80).split()
        if k % 3 == 0:
            w[20:20] = re.sub(" ", ", ", items[k % 8][1]).upper().split(" ")
        if k % 4 == 0:
            w[50:50] = ["ZUM", "beispiel", "é", "lonely"]
        if k % 5 == 0:
            w[5:5] = items[k % 8][1].split()[:9]
        if k % 7 == 0:
            w += ["a", "b"] * 12 + ["a"] * 15
        documents.append((100 + k, " ".join(w)))
    documents += documents[-3:] + [(100, "another text of that id " + prose(601, 5))]
    assert found(make_documents(*documents), make_items(*items)) == by_hand(documents, items)


def test_nothing_to_find_or_to_look_in(make_documents, make_items, odd_rows):
    items = make_items(("a", "river stone"))
    assert found(make_documents(), items) == []
    assert found(make_documents(*odd_rows), make_items()) == by_hand(odd_rows, [])


def test_clean_drops_the_documents_hit(make_documents, make_items, prose):
    leak = prose(900, 12)
    documents = make_documents((1, prose(1, 30)), (2, "so " + leak + " so"), (None, leak), (3, None))
    kept = phrase_index.clean(documents, make_items(("a", leak)))
    assert kept.columns == documents.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 3]


def test_terms_near_each_other(make_documents, spark):
    documents = make_documents((1, "x a b c y a"), (2, "y x"), (3, "x " + "z " * 20 + "y"))
    rows = documents.select(phrase_index._key().alias("doc"), phrase_index.words().alias("words"))
    index = phrase_index.postings(rows, spark.createDataFrame([("x", True), ("y", False)], "term string, wide boolean"))
    near = phrase_index.near(index, "x", "y", 4).select("doc.doc_id", "first_at", "second_at")
    assert sorted(map(tuple, near.collect())) == [(1, 0, 4), (2, 1, 0)]


def near_by_hand(documents, pairs, within):
    out = set()
    for doc_id, text in set(documents):
        w = words(text)
        for pair, first, second in pairs:
            for i, x in enumerate(w):
                for j in range(max(i - within, 0), min(i + within + 1, len(w))):
                    if x == first and w[j] == second and i != j:
                        out.add((doc_id, text, pair, i, j))
    return sorted((x[:1] + x[2:] for x in out), key=str)


def test_pairs_near_each_other_are_those_found_by_hand(make_documents, spark, prose, odd_rows):
    documents = list(odd_rows) + [(100 + k, prose(k % 9, 60)) for k in range(20)] + [(300, "a b " * 40), (301, "a a a"), (300, "b A")]
    documents += documents[-2:]
    common = prose(3, 60).lower().split()
    pairs = [("p1", "a", "b"), ("p2", "a", "a"), ("p3", common[0], common[5]), ("p3", common[2], common[9]), (None, "b", "a"), ("p4", "nowhere", "a"), ("p5", None, "a")]
    frame = spark.createDataFrame(pairs + pairs[:2], "pair string, first string, second string")
    for within in (1, 4, 25):
        got = phrase_index.proximity(make_documents(*documents), frame, within).collect()
        assert sorted(map(tuple, got), key=str) == near_by_hand(documents, pairs, within)
    with pytest.raises(ValueError):
        phrase_index.proximity(make_documents(*documents), frame, 0)


def test_items_are_found_by_their_rarest_terms(make_documents, make_items):
    documents = [(1, "the heron, so to say, waits. the reed"), (2, "reed the the the heron"), (3, "heron " + "the " * 20 + "reed"), (4, None)]
    items = make_items(("i", "The reed and the heron"), ("none", "unheard of"), ("short", "heron"), (None, "the, waits"))
    got = phrase_index.items_near(make_documents(*documents), items, 6).select("doc_id", "item_id", "first_at", "second_at")
    # heron and reed are held three times each, so heron, the lesser text, comes first.
    assert sorted(map(tuple, got.collect())) == [(1, "", 5, 0), (1, "", 5, 6), (1, "i", 1, 7), (2, "i", 4, 0)]


def test_no_pairs_and_no_documents(make_documents, spark):
    none = spark.createDataFrame([], "pair string, first string, second string")
    assert phrase_index.proximity(make_documents((1, "a b")), none, 3).isEmpty()
    assert phrase_index.proximity(make_documents(), spark.createDataFrame([("p", "a", "b")], none.schema), 3).isEmpty()


def test_plan_has_no_python(make_documents, make_items):
    plan = phrase_index.report(make_documents((1, "a b")), make_items(("a", "a b")))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
