"""Quality rules: an isolation forest over the rule statistics of documents.

Every document gets exact rule statistics (``statistics``). A forest of random splits
is grown over statistics of documents; short mean paths mark a document as unusual. The
score above which a document is rejected is calibrated on the labelled rows: the whole
labelled table enters as a histogram of scores.

Bounds: a tree is grown over ``sample_rows`` documents and there are ``trees`` of them,
as the method has it; the sample is chosen by hash, the same on
each run. Everything else covers all rows.

Null, empty and word-free texts have all counts 0 and fail the base rule. Repeated rows
give repeated results. An empty table gives an empty result. Only ``doc_id`` and
``text`` are read, whatever other columns there are. Without labelled rows of both
kinds the customary score of 0.6 divides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotline.llm.common import hashed_sample, small_batches, staged
from slotline.llm.textstats import STATISTICS, rule_statistics

TREES = 128
SAMPLE_ROWS = 256
BINS = 2048
#: Clean labelled rows that calibration may lose, as a share.
MOST_CLEAN_LOST = 0.01


def statistics(documents: DataFrame) -> DataFrame:
    """doc_id and the counts in ``STATISTICS`` for each document."""
    small_batches(documents.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [rule_statistics(text) for text in batch["text"]]
            out = pd.DataFrame(np.array(rows, np.int64).reshape(-1, len(STATISTICS)), columns=list(STATISTICS))
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    schema = "doc_id long, " + ", ".join(f"{name} long" for name in STATISTICS)
    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Rows of an unknown id travel as the least number, as pandas has no null integers.
    lowest = F.lit(-(2**63)).cast("long")
    counted = read.withColumn("doc_id", F.coalesce("doc_id", lowest)).mapInPandas(count, schema)
    return counted.withColumn("doc_id", F.when(F.col("doc_id") != lowest, F.col("doc_id")))


def features(rows: pd.DataFrame) -> np.ndarray:
    """The statistics as shares, one row for each document.

    Repetition is left to the base rule: a repeated line or two is common in good text,
    and would stand out as much as junk does.
    """
    words = np.maximum(rows["n_words"].to_numpy(float), 1)
    chars = np.maximum(rows["word_chars"].to_numpy(float), 1)
    share = lambda name, of: rows[name].to_numpy(float) / of
    return np.column_stack([
        share("n_symbols", words),
        share("n_same_next", words),
        share("n_upper", chars),
        share("n_marks", words),
        share("n_bars", words),
        np.log(share("word_chars", words) + 1e-9).clip(0),
    ])


FEATURES = 6


def _path_left(size: int) -> float:
    """Mean path of an unsuccessful search among so many rows."""
    return 2 * (np.log(size - 1) + np.euler_gamma) - 2 * (size - 1) / size if size > 2 else float(size == 2)


class Forest:
    """Random splits; flat arrays for each tree: feature (-1 for a leaf), cut, children, path."""

    def __init__(self, trees: list[tuple[np.ndarray, ...]], rows: int):
        self.trees, self.rows = trees, rows

    @classmethod
    def grown(cls, samples: list[np.ndarray], seed: int = 17) -> Forest:
        random = np.random.default_rng(seed)
        rows = max(map(len, samples), default=0)
        return cls([cls._tree(sample, random) for sample in samples if len(sample)], rows)

    @staticmethod
    def _tree(sample: np.ndarray, random: np.random.Generator) -> tuple[np.ndarray, ...]:
        feature, cut, left, right, path = [], [], [], [], []
        deepest = int(np.ceil(np.log2(max(len(sample), 2))))

        def grow(rows: np.ndarray, depth: int) -> int:
            at = len(feature)
            for column in (feature, cut, left, right, path):
                column.append(0)
            low, high = rows.min(axis=0), rows.max(axis=0)
            open_to_split = np.flatnonzero(high > low)
            if depth >= deepest or len(rows) < 2 or not len(open_to_split):
                feature[at], path[at] = -1, depth + _path_left(len(rows))
                return at
            chosen = int(random.choice(open_to_split))
            feature[at], cut[at] = chosen, random.uniform(low[chosen], high[chosen])
            below = rows[:, chosen] < cut[at]
            left[at] = grow(rows[below], depth + 1)
            right[at] = grow(rows[~below], depth + 1)
            return at

        grow(sample, 0)
        return np.array(feature), np.array(cut, float), np.array(left), np.array(right), np.array(path, float)

    def scores(self, points: np.ndarray) -> np.ndarray:
        """0 to 1 for each row; the higher, the shorter its paths."""
        if not self.trees or not len(points):
            return np.zeros(len(points))
        total = np.zeros(len(points))
        every = np.arange(len(points))
        for feature, cut, left, right, path in self.trees:
            node = np.zeros(len(points), int)
            while True:
                split = feature[node]
                moving = split >= 0
                if not moving.any():
                    break
                below = points[every, np.maximum(split, 0)] < cut[node]
                node = np.where(moving, np.where(below, left[node], right[node]), node)
            total += path[node]
        usual = _path_left(self.rows) or 1.0
        return 2.0 ** (-(total / len(self.trees)) / usual)


def fitted(counted: DataFrame, trees: int = TREES, sample_rows: int = SAMPLE_ROWS) -> Forest:
    """The forest over a sample of about ``trees * sample_rows`` documents, chosen by hash.

    Equal statistics count once: a document copied a million times is one point, and
    does not become what is usual.
    """
    points = counted.filter("n_words > 0").select(*STATISTICS).distinct()
    rows = hashed_sample(points, list(STATISTICS), trees * sample_rows).orderBy(*STATISTICS).toPandas()
    shuffled = np.random.default_rng(5).permutation(len(rows))
    points = features(rows)[shuffled] if len(rows) else np.zeros((0, FEATURES))
    each = max(1, min(sample_rows, len(points)))
    pick = np.random.default_rng(7)
    samples = []
    for at in range(trees if len(points) else 0):
        whole = points[at * each : (at + 1) * each]
        samples.append(whole if len(whole) == each else points[pick.choice(len(points), each, replace=False)])
    return Forest.grown(samples)


def scored(counted: DataFrame, forest: Forest) -> DataFrame:
    @F.pandas_udf("double")
    def score(rows: pd.DataFrame) -> pd.Series:
        return pd.Series(forest.scores(features(rows)))

    return counted.withColumn("anomaly", score(F.struct(*STATISTICS)))


def threshold(scores: DataFrame, labels: DataFrame, most_lost: float = MOST_CLEAN_LOST) -> float:
    """The score that divides good from bad labelled rows best while all but ``most_lost`` of
    the good stay below; the middle one of equals. From all labelled rows."""
    marked = labels.filter("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = (
        scores.filter("not base_failed").join(marked, "doc_id")
        .groupBy(F.floor(F.col("anomaly") * BINS).cast("int").alias("bin"), (F.col("quality") > 0).alias("good"))
        .count().collect()
    )
    good, bad = np.zeros(BINS + 2), np.zeros(BINS + 2)
    for row in counts:
        (good if row["good"] else bad)[row["bin"]] += row["count"]
    if not good.sum() or not bad.sum():
        return 0.6
    lost = good[::-1].cumsum()[::-1] / good.sum()
    caught = bad[::-1].cumsum()[::-1] / bad.sum()
    gain = np.where(lost <= most_lost, caught - lost, -1)
    best = np.flatnonzero(gain == gain.max())
    return float(best.mean()) / BINS


def judge(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the statistics, base_failed, anomaly and kept for every document."""
    counted = staged(statistics(documents), "rule-statistics")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scores = scored(counted, fitted(counted)).withColumn("base_failed", failed)
    cut = threshold(scores, labels)
    return scores.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < cut))
