import numpy as np
import pytest

from slotline.llm import order_minhash


def changed(text, seed, share):
    """The text with a share of its words replaced."""
    random = np.random.default_rng(seed)
    words = text.split()
    for at in random.choice(len(words), max(1, int(share * len(words))), replace=False):
        words[at] = f"new{seed}x{at}"
    return " ".join(words)


def by_runs(one, two):
    """Similarity by labelled runs of five words in place of words."""
    return order_minhash.similarity(order_minhash.labelled_kmers(one), order_minhash.labelled_kmers(two))


def by_hand(rows, similarity=order_minhash.similarity):
    """Classes by comparing all pairs."""
    nodes = {}
    for i, text in rows:
        digest, hashes = order_minhash.word_hashes(text or "")
        if len(hashes):
            nodes.setdefault(digest, hashes)
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = list(nodes)
    for at, a in enumerate(keys):
        for b in keys[:at]:
            if similarity(nodes[a], nodes[b]) >= order_minhash.SIMILARITY:
                x, y = root(a), root(b)
                parent[x] = y
    least = {}
    for i, text in rows:
        digest, labelled = order_minhash.word_hashes(text or "")
        if len(labelled):
            x = root(digest)
            least[x] = min(filter(lambda v: v is not None, (i, least.get(x))), default=None)
    of = lambda i, t: (lambda d, k: least[root(d)] if len(k) else i)(*order_minhash.kmers(t or ""))
    return sorted(((i, of(i, t)) for i, t in rows), key=str)


def found(documents):
    return sorted(map(tuple, order_minhash.classes(documents).collect()), key=str)


def holds(classes, whole, least):
    """No class joins what all pairs keep apart, and none parts what runs of five words join."""
    assert [i for i, _ in classes] == [i for i, _ in whole] == [i for i, _ in least]
    inside = {}
    for (_, name), (_, whole_name), (_, least_name) in zip(classes, whole, least):
        assert inside.setdefault(("class", name), whole_name) == whole_name
        assert inside.setdefault(("runs", least_name), name) == name


def test_classes_are_those_of_all_pairs(make_documents, prose, odd_rows):
    rows = list(odd_rows)
    for k in range(12):
        base = prose(100 + k, 60 + 20 * k)
        rows += [(1000 * k + 100, base), (1000 * k + 101, base), (1000 * k + 102, base.replace(" ", "  "))]
        rows += [(1000 * k + 103 + j, changed(base, 50 * k + j, 0.01 + 0.012 * j)) for j in range(6)]
    rows += [(90_001, "a b c"), (90_002, "a b c"), (90_003, "a b"), (90_004, "a b c d e"), (90_005, "a b c d e f")]
    classes, right = found(make_documents(*rows)), by_hand(rows)
    holds(classes, right, by_hand(rows, by_runs))
    assert np.mean([x == y for x, y in zip(classes, right)]) >= 0.95


def test_a_large_group_is_one_class_where_links_lead(make_documents, prose):
    base = prose(5, 150)
    rows = [(i, changed(base, i, 0.02)) for i in range(150)] + [(500 + i, prose(300 + i, 150)) for i in range(30)]
    assert found(make_documents(*rows)) == by_hand(rows)


@pytest.mark.parametrize("share", [0.0, 0.01, 0.02, 0.05])
def test_similar_texts_share_a_sketch(prose, share):
    for seed in range(30):
        one = prose(seed, 300)
        two = changed(one, seed, share) if share else one
        a, b = order_minhash.kmers(one)[1], order_minhash.kmers(two)[1]
        if order_minhash.similarity(*(order_minhash.word_hashes(x)[1] for x in (one, two))) >= order_minhash.SIMILARITY:
            assert (order_minhash.sketches(a) == order_minhash.sketches(b)).any()


def test_order_matters(prose):
    """The same k-mers in another order are another sketch, and align badly."""
    halves = prose(1, 200).split()
    one, two = " ".join(halves), " ".join(halves[100:] + halves[:100])
    a, b = order_minhash.kmers(one)[1], order_minhash.kmers(two)[1]
    assert len(np.intersect1d(a, b)) > 180
    assert order_minhash.similarity(a, b) < 0.8
    assert (order_minhash.sketches(a) != order_minhash.sketches(b)).any()


@pytest.mark.parametrize("share", [0.08, 0.1])
def test_most_pairs_with_a_tenth_of_their_words_changed_share_a_sketch(prose, share):
    met = 0
    for seed in range(100):
        one = prose(seed, 300)
        two = changed(one, seed, share)
        assert order_minhash.similarity(*(order_minhash.word_hashes(x)[1] for x in (one, two))) >= order_minhash.SIMILARITY
        met += (order_minhash.sketches(order_minhash.kmers(one)[1]) == order_minhash.sketches(order_minhash.kmers(two)[1])).any()
    assert met >= 90


def table_alignment(one, two):
    table = np.zeros((len(one) + 1, len(two) + 1), int)
    for i in range(len(one)):
        for j in range(len(two)):
            table[i + 1, j + 1] = table[i, j] + 1 if one[i] == two[j] else max(table[i, j + 1], table[i + 1, j])
    return table[-1, -1]


@pytest.mark.parametrize("least", [0.0, 0.5, 0.8])
def test_alignment_decides_as_the_whole_table(least):
    """Repeated words, insertions and deletions, texts of several blocks; exact where the limit is reached."""
    random = np.random.default_rng(8)
    for at in range(40):
        one = random.integers(0, (2, 9, 200)[at % 3], (1, 30, 320)[at % 3 if at > 6 else at % 2]).astype(np.uint64)
        kept = one[random.random(len(one)) > random.choice([0, 0.1, 0.3])]
        two = np.insert(kept, np.sort(random.integers(0, len(kept) + 1, 5 * (at % 4))), 3)
        full = table_alignment(one, two)
        found_ = order_minhash.alignment(one, two, least)
        enough = least * (len(one) + len(two)) / (1 + least)
        assert found_ == full if full >= enough else found_ < enough or found_ == full


def test_alignment_of_long_and_monotonous_texts():
    one = np.random.default_rng(9).integers(0, 5000, 60_000).astype(np.uint64)
    two = np.delete(one, np.arange(0, 60_000, 20))
    assert order_minhash.alignment(one, two) == len(two)
    same = np.ones(30_000, np.uint64)
    assert order_minhash.alignment(same, same[:28_000]) == 28_000
    assert order_minhash.similarity(one[:7], one[1:6]) < order_minhash.SIMILARITY


def test_alignment_is_the_longest_common_run():
    random = np.random.default_rng(6)
    for _ in range(50):
        one = random.choice(40, 25, replace=False).astype(np.uint64)
        two = random.choice(40, 25, replace=False).astype(np.uint64)
        table = np.zeros((26, 26), int)
        for i in range(25):
            for j in range(25):
                table[i + 1, j + 1] = table[i, j] + 1 if one[i] == two[j] else max(table[i, j + 1], table[i + 1, j])
        assert order_minhash.alignment(one, two, 0.0) == table[25, 25]


def test_one_of_each_class_stays(make_documents, prose):
    base = prose(3, 200)
    rows = [(2, base), (1, changed(base, 1, 0.01)), (3, base), (4, prose(4, 100)), (4, prose(4, 100)), (5, None), (6, None), (None, base)]
    kept = order_minhash.without_copies(make_documents(*rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 5, 6]
    assert kept.columns == make_documents().columns


def test_no_documents(make_documents):
    assert found(make_documents()) == []
    assert found(make_documents((1, None), (2, ""), (3, " "))) == [(1, 1), (2, 2), (3, 3)]


def test_components(spark):
    edges = [(bytes([a]), bytes([b])) for a, b in [(1, 2), (3, 2), (3, 9), (5, 6), (9, 8), (8, 7), (20, 19)] + [(i, i + 1) for i in range(30, 60)]]
    found_ = order_minhash.components(spark.createDataFrame(edges, "a binary, b binary")).collect()
    groups = {}
    for row in found_:
        groups.setdefault(bytes(row["comp"])[0], set()).add(bytes(row["node"])[0])
    assert groups == {1: {1, 2, 3, 7, 8, 9}, 5: {5, 6}, 19: {19, 20}, 30: set(range(30, 61))}


def test_pairs_that_meet_in_one_large_bucket_only_are_linked(spark):
    """160 words that all texts have; of the other 60 a pair's second text has every third replaced, so that its own runs differ."""
    shared = " ".join(f"shared{i}" for i in range(160))
    rows = []
    for pair in range(150):
        own = [f"own{pair}x{i}" for i in range(60)]
        rows.append((2 * pair, f"{shared} {' '.join(own)}"))
        rows.append((2 * pair + 1, f"{shared} {' '.join(f'new{pair}x{i}' if i % 3 == 0 else word for i, word in enumerate(own))}"))
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == sorted(((i, i - i % 2) for i, _ in rows), key=str)


def test_parities_differ_by_no_more_than_the_words():
    random = np.random.default_rng(12)
    for at in range(100):
        one = random.integers(0, 2**63, 20 + 10 * at).astype(np.uint64)
        two = np.append(np.delete(one, random.choice(len(one), at // 4, replace=False)), random.integers(0, 2**63, at // 5).astype(np.uint64))
        unlike = sum(int(x).bit_count() for x in (order_minhash.parities(one) ^ order_minhash.parities(two)).view(np.uint64))
        assert unlike <= at // 4 + at // 5 and (unlike + at // 4 + at // 5) % 2 == 0
    assert not order_minhash.parities(np.repeat(one, 2)).any()


@pytest.mark.parametrize("few", [0, 32])
def test_texts_that_share_a_bucket_but_are_unlike_are_no_pairs(spark, few, monkeypatch):
    """Forty texts, of the same 120 words and 80 own ones, meet in one bucket; only two are close."""
    monkeypatch.setattr(order_minhash, "FEW", few)
    texts = {i: [f"shared{j}" for j in range(120)] + [f"own{i}x{j}" for j in range(80)] for i in range(40)}
    texts[39] = texts[38][:190] + [f"new{j}" for j in range(10)]
    rows = []
    for i, held in texts.items():
        hashes = order_minhash.word_hashes(" ".join(held))[1]
        rows.append((bytes([i]), 200, order_minhash.parities(hashes).tolist(), hashes.tobytes()))
    made = spark.createDataFrame(rows, "node binary, size int, odd array<long>, words binary")
    buckets = made.selectExpr("1L bucket", "node", "size").union(made.selectExpr("2L bucket", "node", "size"))
    pairs = order_minhash._rest_by_words(buckets, made.selectExpr("node", "node comp"), made.select("node", "odd", "words"))
    assert [(x["a"][0], x["b"][0]) for x in pairs.collect()] == [(38, 39)]


def test_kmers_of_one_class_are_not_listed(spark):
    """Thirty texts of one class and one of another share 150 words; 50 further ones only the thirty have."""
    texts = {i: [f"shared{j}" for j in range(150)] + [f"family{j}" for j in range(50)] for i in range(30)}
    texts[30] = texts[0][:150] + [f"own{j}" for j in range(25)]
    rows = [(bytes([i]), bytes([i // 30]), len(held), order_minhash.word_hashes(" ".join(held))[1].tobytes()) for i, held in texts.items()]
    made = spark.createDataFrame(rows, "node binary, comp binary, size int, words binary")
    listed = order_minhash._rarest(made.select("node", "comp", "size"), made.select("node", "words"), 1)
    shared = set(order_minhash.labelled_kmers(order_minhash.word_hashes(" ".join(texts[0][:150]))[1], 1).view(np.int64).tolist())
    assert {x["kmer"] for x in listed.collect()} <= shared
    # A text may lack a fifth of its words and one: the thirty's 50 come first and use that up, the other's 25 leave 11.
    assert sorted((x["node"][0], x["left"]) for x in listed.collect()) == [(30, left) for left in range(140, 151)]
