import zlib

import numpy as np

from slotline.llm import toxicity

RUDE = ["zorgle", "flimbast", "quorvint"]


def corpus(prose):
    rows, toxic = [], set()
    for i in range(400):
        words = prose(i, 60).split()
        if i % 5 == 0:
            words[10], words[30], words[50] = RUDE[i % 3], RUDE[(i + 1) % 3] + "er", RUDE[i % 3] + "s"
            toxic.add(i)
        rows.append((i, " ".join(words)))
    return rows, toxic


def fold(i):
    return zlib.crc32(str(i).encode()) % 3


def test_scores_of_rows_held_out(make_documents, make_labels, prose):
    rows, toxic = corpus(prose)
    labels = make_labels(*[(i, 1, int(i in toxic)) for i, _ in rows])
    found = toxicity.scored(make_documents(*rows), labels).collect()
    assert len(found) == len(rows)
    assert all(r["held_out"] == (fold(r["doc_id"]) == 1) for r in found)
    held_out = [r for r in found if r["held_out"]]
    right = [r["predicted"] == int(r["doc_id"] in toxic) for r in held_out]
    assert np.mean(right) > 0.97
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in found)


def test_labels_of_rows_held_out_are_not_learned(make_documents, make_labels, prose):
    rows, toxic = corpus(prose)
    documents = make_documents(*rows)
    score = lambda flip: {
        r["doc_id"]: r["score"]
        for r in toxicity.scored(
            documents, make_labels(*[(i, 1, int((i in toxic) != (flip and fold(i) == 1))) for i, _ in rows])
        ).collect()
    }
    assert score(False) == score(True)


def test_odd_rows_and_labels(make_documents, make_labels, prose, odd_rows):
    rows, toxic = corpus(prose)
    labels = make_labels(
        *[(i + 100, 1, int(i in toxic)) for i, _ in rows], (None, 1, 1), (1, None, None), (105, 1, 0), (100, 1, 1)
    )
    documents = make_documents(*odd_rows, *[(i + 100, t) for i, t in rows])
    found = [r for r in toxicity.scored(documents, labels).collect() if r["doc_id"] is None or r["doc_id"] < 100]
    assert len(found) == len(odd_rows)
    assert all(0 <= r["score"] < 0.7 for r in found)
    assert toxicity.without_toxic(documents, labels).columns == documents.columns


def test_without_labels_of_both_kinds(make_documents, make_labels, odd_rows):
    documents = make_documents(*odd_rows)
    assert {r["score"] < 1e-6 for r in toxicity.scored(documents, make_labels()).collect()} == {True}
    assert {r["score"] < 1e-6 for r in toxicity.scored(documents, make_labels((5, 1, 0))).collect()} == {True}
    assert toxicity.scored(make_documents(), make_labels((5, 1, 0))).count() == 0


def test_correlated_voters_count_less():
    """Two voters that always agree weigh about as much as one."""
    random = np.random.default_rng(3)
    truth = random.random(4000) < 0.3
    vote = lambda: np.where(random.random(4000) < 0.85, truth, ~truth)
    one, two = vote(), vote()
    labels = truth.astype(int)
    doubled = toxicity.LabelModel(np.column_stack([one, one, two]).astype(float), labels)
    single = toxicity.LabelModel(np.column_stack([one, two]).astype(float), labels)
    assert doubled.correlations[0, 1] > 0.8 > abs(doubled.correlations[0, 2])
    odds = doubled.log_odds(np.array([[1.0, 1, 0]])), single.log_odds(np.array([[1.0, 0]]))
    assert abs(odds[0] - odds[1]) < 0.3


def test_rows_of_one_id_are_sampled(make_documents, make_labels, prose):
    """An id on most rows sends no more than twice the stated number, and equal rows count once."""
    rows = [(11, prose(i, 20)) for i in range(900)] + [(12, prose(7, 20))] * 50 + [(8, "clean text")]
    assert 1 not in (fold(8), fold(11), fold(12))
    found = toxicity.training_rows(make_documents(*rows), make_labels((11, 1, 1), (12, 1, 0), (8, 1, 0)), 100, 100).collect()
    kept = [r["doc_id"] for r in found]
    assert 120 < kept.count(11) < 290
    assert kept.count(12) == 1
