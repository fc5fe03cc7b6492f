"""Quality classifier from weak labels.

Heuristic labellers, which overlap, each vote bad or good on some documents and abstain on others,
from exact rule statistics. Expectation-maximisation over the counts of all vote patterns of the corpus
estimates how often each labeller votes on good and on bad documents, without any given label, and gives each
pattern a posterior. A hashed linear scorer is then fitted to the posteriors of a sample and
scores every document from its words' shapes and the words themselves.

Bounds: vote patterns are at most 2^11 whatever the corpus; the scorer is fitted on about
``FIT_ROWS`` documents, chosen by hash. Pattern counts and scores cover all documents.

Null and empty texts have no words; no labeller votes good on them but for being plain, only the
length enters the score, and they are never kept. Repeated rows score alike. An empty
table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotline.llm import linear
from slotline.llm.common import hashed_sample, small_batches, staged
from slotline.llm.quality_rules import statistics
from slotline.llm.textstats import shingle_hashes, span_hashes, words

FIT_ROWS = 6000
WIDTH = 2048
ROUNDS = 100
KEPT_FROM = 0.5

#: Character classes by byte: 0 lower case, 1 upper case, 2 digit, 3 beyond ASCII, others as they are.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A], _CLASS[0x80:] = 0, 1, 2, 0


def labellers() -> dict[str, tuple[str, Column]]:
    """What each labeller votes (``bad`` or ``good``), and when; otherwise it abstains."""
    words_, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    share = lambda name, of=words_: F.col(name) / of
    length = share("word_chars")
    return {
        "symbols": ("bad", share("n_symbols") > 0.3),
        "bars": ("bad", share("n_bars") > 0.15),
        "marks": ("bad", share("n_marks") > 0.3),
        "capitals": ("bad", share("n_upper", chars) > 0.3),
        "same_next": ("bad", share("n_same_next") > 0.2),
        "repeated": ("bad", share("n_repeat_words") > 0.5),
        "few_distinct": ("bad", share("n_distinct") < 0.15),
        "same_lines": ("bad", share("n_dup_lines", lines) > 0.6),
        "odd_words": ("bad", (length < 2) | (length > 14)),
        "plain": ("good", (share("n_symbols") < 0.05) & (share("n_marks") < 0.1) & (share("n_upper", chars) < 0.15)),
        "varied": ("good", (share("n_same_next") < 0.05) & (share("n_repeat_words") < 0.4) & (F.col("n_words") > 0)),
    }


def votes(counted: DataFrame) -> DataFrame:
    """With ``pattern``: a binary digit for each labeller, 1 if it votes."""
    pattern = F.lit(0)
    for _, when in labellers().values():
        pattern = pattern * 2 + F.when(when, 1).otherwise(0)
    return counted.withColumn("pattern", pattern.cast("int"))


def posteriors(counts: dict[int, int], rounds: int = ROUNDS) -> dict[int, float]:
    """For each vote pattern the probability of good, by expectation-maximisation.

    How often a labeller votes on good and on bad documents is estimated for each, from no
    given label; it starts from votes that are mostly right and from good being the rule.
    Rates are smoothed, so that a labeller who never votes changes nothing.
    """
    says_bad = np.array([side == "bad" for side, _ in labellers().values()])
    size = len(says_bad)
    patterns = np.array(sorted(counts), np.int64)
    number = np.array([counts[x] for x in patterns], float)
    voted = ((patterns[:, None] >> np.arange(size - 1, -1, -1)) & 1).astype(float)
    share, of_bad, of_good = 0.9, np.where(says_bad, 0.25, 0.1), np.where(says_bad, 0.01, 0.9)
    start = of_bad, of_good
    belief = np.full(len(patterns), share)
    for _ in range(rounds):
        odds = np.log(share / (1 - share)) + voted @ np.log(of_good / of_bad)
        odds = odds + (1 - voted) @ np.log((1 - of_good) / (1 - of_bad))
        belief = linear.sigmoid(odds)
        share = float(np.clip((number * belief).sum() / max(number.sum(), 1), 0.01, 0.99))
        of_bad, of_good = (
            ((weight * number) @ voted + first) / ((weight * number).sum() + 1)
            for weight, first in zip((1 - belief, belief), start)
        )
    return dict(zip(patterns.tolist(), belief.tolist()))


def hashed_features(text: str | None, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Columns and values of a text: shapes of words and of pairs, words, equal neighbours, length."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    starts, ends = words(data)
    count = len(starts)
    length = np.array([count and 1 + min(int(np.log2(count)), 5)], np.uint64)
    if not count:
        return (length % np.uint64(width)).astype(int), np.ones(1)
    # A word's shape: its character classes with runs drawn together.
    classes = _CLASS[data]
    kept = np.ones(len(data), bool)
    kept[1:] = classes[1:] != classes[:-1]
    kept[starts] = True
    place = np.concatenate([[0], np.cumsum(kept)])
    shapes = span_hashes(classes[kept], place[starts], place[ends])
    plain = span_hashes(data, starts, ends)
    tokens = np.concatenate([
        shapes ^ np.uint64(1),
        shingle_hashes(shapes, 2) ^ np.uint64(2),
        plain ^ np.uint64(3),
    ])
    low = np.uint64(16)
    # Ten words more than there are: a few words say little.
    columns, number = np.unique(low + tokens % np.uint64(width - 16), return_counts=True)
    same = int((plain[1:] == plain[:-1]).sum())
    return (
        np.concatenate([columns, length, [np.uint64(15)]]).astype(int),
        np.concatenate([np.sqrt(number / (count + 10)), [0.3], [np.sqrt(same / (count + 10))]]),
    )


def fit(sample: pd.DataFrame, width: int = WIDTH) -> tuple[np.ndarray, float]:
    """Weights and intercept from rows of ``columns``, ``values`` and the posterior ``belief``."""
    sizes = [len(x) for x in sample["columns"]]
    join = lambda name, kind: np.concatenate([np.frombuffer(x, kind) for x in sample[name]])
    if not sizes:
        return np.zeros(width), 0.0
    belief = sample["belief"].to_numpy(float)
    rows = np.repeat(np.arange(len(sample)), [x // 2 for x in sizes])
    return linear.fitted(rows, join("columns", "<i2").astype(int), join("values", "<f4"), belief, width)


def scorer(documents: DataFrame) -> Column:
    """The score of ``text`` (0 to 1, higher is better) by a scorer fitted to these documents' weak labels."""
    spark = documents.sparkSession
    counted = staged(votes(statistics(documents)), "votes")
    counts = {row["pattern"]: row["count"] for row in counted.groupBy("pattern").count().collect()}
    belief = posteriors(counts)
    weak = spark.createDataFrame([(int(k), float(v)) for k, v in belief.items()], "pattern int, belief double")
    chosen = hashed_sample(counted.select("doc_id", "pattern"), ["doc_id"], FIT_ROWS, sum(counts.values()))
    # Some FIT_ROWS rows of 16 bytes, and at most 2^11 patterns: both may be broadcast.
    chosen = chosen.join(F.broadcast(weak), "pattern").groupBy("doc_id").agg(F.avg("belief").alias("belief"))

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [hashed_features(text) for text in batch["text"]]
            yield pd.DataFrame({
                "columns": [columns.astype("<i2").tobytes() for columns, _ in found],
                "values": [values.astype("<f4").tobytes() for _, values in found],
                "belief": batch["belief"],
            })

    small_batches(spark)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = texts.join(F.broadcast(chosen), "doc_id").select("text", "belief")
    rows = sample.mapInPandas(extract, "columns binary, values binary, belief double").toPandas()
    weights, intercept = fit(rows.sort_values(["belief", "columns"]))

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        out = []
        for one in text:
            columns, values = hashed_features(one)
            out.append(float(weights[columns] @ values) + intercept)
        return pd.Series(linear.sigmoid(np.array(out, float)))

    return score("text")


def _has_words() -> Column:
    return F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))


def only_good(documents: DataFrame) -> DataFrame:
    """The documents that the classifier keeps, with all their columns."""
    return documents.filter(_has_words() & (scorer(documents) >= KEPT_FROM))


def classify(documents: DataFrame) -> DataFrame:
    """doc_id, score and kept for every document."""
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), scorer(documents).alias("score"), _has_words().alias("has_words")
    )
    return rows.select("doc_id", "score", (F.col("has_words") & (F.col("score") >= KEPT_FROM)).alias("kept"))
