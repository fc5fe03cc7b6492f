"""Toxicity from weak supervision.

Voters: a lexicon learned from labelled rows is divided into many voters (whole words and
beginnings of words of several lengths, by how telling they are, and by hash), beside pattern
voters (shouting, letters replaced by signs, and others). A generative label model with two classes
estimates each voter's accuracy in either class and the correlations between voters (a
shared covariance), by expectation-maximisation; the label of a row is one more piece of evidence,
right with the chance ``LABEL_RIGHT``. A linear classifier over the lexicon's hits and the patterns
is trained on the posteriors and scores every document.

Labels are learned only from rows whose ``crc32(doc_id) mod 3`` is not 1; a score depends on
the text alone. Lexicon, label model and classifier are fitted on a sample of labelled rows,
about ``TOXIC_ROWS`` toxic and ``CLEAN_ROWS`` clean ones, chosen by hash (twice as many at most where ids have several rows); the lexicon has up to
``LEXICON`` entries.

Null and empty texts have no hits, and the score of such a text. Very long texts are read whole, in memory that grows with
their length. Entries that are equally telling go by number. Repeated rows score alike; of a
``doc_id`` with several labels the highest counts. Without labels of both kinds every score
is the share of toxic labels (0 if there are none). Empty tables give empty results. Only
``doc_id`` and ``text`` of the documents are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotline.llm import linear
from slotline.llm.common import hashed_sample, small_batches, staged
from slotline.llm.textstats import mixed, span_hashes

TOXIC_ROWS = 6000
CLEAN_ROWS = 10000
LEXICON = 8192
BUCKETS = 1 << 20
#: Bytes of a word's beginning that make a lexicon entry of their own; 0 for the whole word.
BEGINNINGS = (0, 4, 5, 6, 7, 8)
KINDS = 8
MOST_TIMES = 3
LEAST_ROWS = 4
LEAST_TELLING = 0.8
SHARES = 4
LABEL_RIGHT = 0.999
#: The label model alone may say so much for or against, in log odds.
MOST_SURE = 4.0
TOXIC_FROM = 0.7

_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = _LETTER[0x30:0x3A] = _LETTER[0x80:] = True

#: The pattern voters: sign for a letter, shouting, drawn-out letters, marks in a row, addressing.
PATTERNS = (
    re.compile(r"[^\W\d_][@$*][^\W\d_]"),
    re.compile(r"\b[A-Z]{4,}\b.*\b[A-Z]{4,}\b", re.S),
    re.compile(r"([^\W\d_])\1\1\1"),
    re.compile(r"[!?]{3}"),
    re.compile(r"\byou\b.{0,40}!", re.I),
)


def entries(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of the text's words and of the beginnings of its words, and how
    often each occurs, ``MOST_TIMES`` at most."""
    data = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _LETTER[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = []
    for at, length in enumerate(BEGINNINGS):
        long = ends - starts > length
        stop = starts[long] + length if length else ends
        hashes = mixed(span_hashes(data, starts[long], stop) + np.uint64(at))
        # The kind stays readable in the lowest bits.
        found.append((hashes % np.uint64(BUCKETS // KINDS)).astype(np.int64) * KINDS + at)
    buckets, times = np.unique(np.concatenate(found), return_counts=True)
    return buckets, np.minimum(times, MOST_TIMES)


def patterns(text: str | None) -> list[int]:
    return [int(bool(x.search(text or ""))) for x in PATTERNS]


def fold() -> Column:
    """0, 1 or 2; rows of 1 are held out."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)).cast("int")


def training_rows(documents: DataFrame, labels: DataFrame, toxic_rows: int, clean_rows: int) -> DataFrame:
    """Texts and labels of the sample of labelled rows that aren't held out."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
        .filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold() != 1))
        .groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    )
    some = lambda side, rows: hashed_sample(known.filter(side), ["doc_id"], rows)
    # Ids of labelled rows: about toxic_rows + clean_rows of 9 bytes, whatever the size of the tables.
    chosen = some(F.col("toxic"), toxic_rows).unionByName(some(~F.col("toxic"), clean_rows))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    # Several rows may have one doc_id: rows are sampled too, and equal ones count once.
    held = {row["toxic"]: row["count"] for row in rows.groupBy("toxic").count().collect()}
    bound = lambda side, most: float((1 << 40) * most / max(held.get(side, 0), most))
    # An id's sample wanders by a few times its square root, which is no reason to sample again.
    limit = F.when(F.col("toxic"), bound(True, 2 * toxic_rows)).otherwise(bound(False, 2 * clean_rows))
    return rows.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) <= limit).dropDuplicates(["doc_id", "text"])


def lexicon(rows: DataFrame, size: int = LEXICON) -> tuple[np.ndarray, np.ndarray]:
    """The most telling buckets, ascending, and how telling each is: a smoothed share of toxic rows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros((2, BUCKETS), np.int32)
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                seen[int(toxic), entries(text)[0]] += 1
        bucket = np.flatnonzero(seen.any(axis=0))
        yield pd.DataFrame({"bucket": bucket, "clean": seen[0, bucket], "toxic": seen[1, bucket]})

    small_batches(rows.sparkSession)
    total = {row["toxic"]: row["count"] for row in rows.groupBy("toxic").count().collect()}
    if not total.get(True) or not total.get(False):
        return np.zeros(0, np.int64), np.zeros(0)
    found = (
        rows.select("text", "toxic").mapInPandas(count, "bucket long, clean long, toxic long")
        .groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    # Shares rather than counts, as the two sides are sampled on their own.
    toxic, clean = (F.col("toxic") + 0.0) / total[True], (F.col("clean") + 0.5) / total[False]
    telling = toxic / (toxic + clean)
    best = (
        found.filter(F.col("toxic") >= LEAST_ROWS).withColumn("telling", telling)
        .filter(F.col("telling") >= LEAST_TELLING).orderBy(F.desc("telling"), F.desc("toxic"), "bucket").limit(size)
        .toPandas().sort_values("bucket")
    )
    return best["bucket"].to_numpy(np.int64), best["telling"].to_numpy(float)


def hits_of(text: str | None, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the lexicon of what the text has, and how often."""
    own, times = entries(text)
    if not len(buckets):
        return own[:0], times[:0]
    at = np.searchsorted(buckets, own)
    at[at == len(buckets)] = 0
    known = buckets[at] == own
    return at[known], times[known]


def voters(buckets: np.ndarray, telling: np.ndarray) -> np.ndarray:
    """Which voter each entry of the lexicon belongs to: by kind, by how telling it is, and by hash."""
    kind = buckets % KINDS
    tier = (telling >= 0.95).astype(np.int64)
    return (kind * 2 + tier) * SHARES + (mixed(buckets.astype(np.uint64)) % np.uint64(SHARES)).astype(np.int64)


class LabelModel:
    """Two classes of votes with their own means and a shared covariance."""

    def __init__(self, votes: np.ndarray, labels: np.ndarray, rounds: int = 25, ridge: float = 0.02):
        count, width = votes.shape
        evidence = np.where(labels > 0, 1.0, -1.0) * np.log(LABEL_RIGHT / (1 - LABEL_RIGHT))
        belief = linear.sigmoid(evidence)
        for _ in range(rounds):
            self.share = float(np.clip(belief.mean(), 0.01, 0.99))
            self.means = [
                (weight @ votes + 0.5 * votes.mean(axis=0)) / (weight.sum() + 0.5) for weight in (1 - belief, belief)
            ]
            self.covariance = np.eye(width) * ridge
            for mean, weight in zip(self.means, (1 - belief, belief)):
                away = votes - mean
                self.covariance += (away * weight[:, None]).T @ away / count
            before, belief = belief, linear.sigmoid(self.log_odds(votes) + evidence)
            if np.abs(before - belief).max() < 1e-4:
                break
        self.belief = belief

    @property
    def correlations(self) -> np.ndarray:
        spread = np.sqrt(np.diag(self.covariance))
        return self.covariance / np.outer(spread, spread)

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        weights = np.linalg.solve(self.covariance, self.means[1] - self.means[0])
        middle = (self.means[0] + self.means[1]) / 2
        return np.clip((votes - middle) @ weights + np.log(self.share / (1 - self.share)), -MOST_SURE, MOST_SURE)


class Model:
    """The lexicon and the weights of its entries and of the patterns."""

    def __init__(self, buckets: np.ndarray, weights: np.ndarray, intercept: float):
        self.buckets, self.weights, self.intercept = buckets, weights, intercept

    def score(self, text: str | None) -> float:
        hits, times = hits_of(text, self.buckets)
        margin = self.intercept + float(self.weights[hits] @ times)
        return float(linear.sigmoid(margin + float(self.weights[len(self.buckets) :] @ np.array(patterns(text)))))


def fitted(documents: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Model:
    rows = staged(training_rows(documents, labels, toxic_rows, clean_rows), "toxicity-rows")
    buckets, telling = lexicon(rows)
    extra = len(PATTERNS)
    if not len(buckets):
        toxic = rows.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
        constant = float(np.log((toxic + 1e-9) / (1 - toxic + 1e-9)))
        return Model(buckets, np.zeros(extra), constant)

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [hits_of(text, buckets) for text in batch["text"]]
            yield pd.DataFrame({
                "toxic": batch["toxic"].astype(int),
                "hits": [hits.astype("<i2").tobytes() for hits, _ in found],
                "times": [times.astype(np.uint8).tobytes() for _, times in found],
                "flags": [bytes(patterns(text)) for text in batch["text"]],
                "doc_id": batch["doc_id"],
            })

    schema = "toxic int, hits binary, times binary, flags binary, doc_id long"
    sample = rows.mapInPandas(extract, schema).toPandas().sort_values(["doc_id", "hits"])
    hits = [np.frombuffer(x, "<i2").astype(np.int64) for x in sample["hits"]]
    flags = np.array([list(x) for x in sample["flags"]], float)
    row = np.repeat(np.arange(len(hits)), [len(x) for x in hits])
    column = np.concatenate(hits)
    times = np.frombuffer(b"".join(sample["times"]), np.uint8).astype(float)
    of = voters(buckets, telling)
    votes = np.zeros((len(hits), int(of.max()) + 1))
    votes[row, of[column]] = 1
    model = LabelModel(np.column_stack([votes[:, votes.any(axis=0)], flags]), sample["toxic"].to_numpy())
    flag_row, flag_column = np.nonzero(flags)
    toxic = sample["toxic"].to_numpy() > 0
    weights, intercept = linear.fitted(
        np.concatenate([row, flag_row]),
        np.concatenate([column, len(buckets) + flag_column]),
        np.concatenate([times, np.ones(len(flag_row))]),
        model.belief,
        len(buckets) + extra,
        np.where(toxic, 1 / max(toxic.sum(), 1), 1 / max((~toxic).sum(), 1)),
        ridge=1e-5,
    )
    return Model(buckets, weights, intercept)


def scorer(documents: DataFrame, labels: DataFrame) -> Column:
    """The score of ``text`` by a model fitted on these documents' labelled rows."""
    small_batches(documents.sparkSession)
    model = fitted(documents, labels)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series([model.score(one) for one in text], dtype=float)

    return score("text")


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that aren't predicted toxic, with all their columns."""
    return documents.filter(scorer(documents, labels) < TOXIC_FROM)


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    score = scorer(documents, labels)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), score.alias("score"))
    held_out = F.coalesce(fold() == 1, F.lit(False))
    return rows.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))
