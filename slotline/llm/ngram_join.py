"""Documents joined by the Jaccard similarity of their word runs, with prefixes of adaptive length.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A text's set holds its distinct runs of ``WIDTH`` words, or
all its words as one run where there are fewer. Two texts link when ``100 * |A and B| >= PERCENT * |A or B|``.

All runs have one global order, rare ones first. Of two sets that link each holds at least ``PERCENT`` % of the other's size in
common, so for every k their first ``size - ceil(PERCENT % of size) + k`` runs share at least k. Each document
chooses its own k: a longer prefix meets more postings, but partners must then share k runs before they are
verified. The estimated cost of a k is the postings that its prefix meets, and a verification for each k of them. A
pair uses the lesser k of the two, and of both prefixes the runs that belong to it; it is verified, exactly, if that many
are shared. The result doesn't depend on the order or on k.

The order needs counts of common runs only. Each task counts its runs within a bounded table, from which
runs seen once go when it is full; the ``COMMON`` most frequent runs of all tasks (a fixed number, so that they can
be sent to every task) are ordered by count and all others, by their hash, before them.

Texts of equal sets are one node from the start. Postings of a run may be many (a group of near copies), so its
members aren't all paired: in each of ``ROUNDS`` they meet one representative (first the one that shares most of its
runs, then others by hash) and linked nodes become one class.
Afterwards those of different classes that still share enough runs are all compared: the members outside of a run's
largest class with those of every other. No run, partner or candidate is capped or left out.

Null texts and texts without words have empty sets and are classes of their own. Texts of any length are read whole.
Repeated rows are one node; a class is named by its least doc_id, null if it has none. An empty table gives an
empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotline.llm.common import small_batches, staged
from slotline.llm.order_minhash import Classes
from slotline.llm.textstats import shingle_hashes, span_hashes, words

WIDTH = 5
PERCENT = 80
#: Bounds of the table of common runs, and of a task's table while it counts.
COMMON = 1 << 18
COUNTED = 1 << 21
REPORTED = 1 << 16
#: Longest extension of a prefix that is considered, and runs compared in the time that a posting takes.
MOST_MATCHES = 16
RUNS_PER_POSTING = 64
ROUNDS = 2
#: Sets that hold a run, from which on its postings needn't be searched for others.
HOT = 64


def run_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The text's distinct runs as ascending hashes."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    hashes = span_hashes(data, *words(data)) if len(data) else np.zeros(0, np.uint64)
    return np.unique(shingle_hashes(hashes, width)) if len(hashes) else hashes


def _least_common(size: int) -> int:
    """Runs that a set of this size has in common with any set it links to, at least."""
    return -(-size * PERCENT // 100)


class RunCounts:
    """Counts of the runs of a task's sets in a table of bounded size (lossy counting)."""

    def __init__(self, bound: int = COUNTED):
        self.bound = bound
        self.runs, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.held = 0

    def add(self, runs: np.ndarray) -> None:
        self.waiting.append(runs)
        self.held += len(runs)
        if self.held >= self.bound:
            self.settle()
            if len(self.runs) > self.bound:
                kept = self.counts > 1
                self.runs, self.counts = self.runs[kept], self.counts[kept]

    def settle(self) -> None:
        new, times = np.unique(np.concatenate([*self.waiting, np.zeros(0, np.uint64)]), return_counts=True)
        self.waiting, self.held = [], 0
        both = np.concatenate([self.runs, new])
        order = np.argsort(both, kind="stable")
        both, counts = both[order], np.concatenate([self.counts, times])[order]
        first = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if len(both) else np.zeros(0, np.int64)
        self.runs = both[first]
        self.counts = np.add.reduceat(counts, first) if len(first) else counts

    def common(self, most: int = REPORTED) -> tuple[np.ndarray, np.ndarray]:
        self.settle()
        kept = np.flatnonzero(self.counts > 1)
        if len(kept) > most:
            kept = kept[np.argpartition(-self.counts[kept], most)[:most]]
        return self.runs[kept], self.counts[kept]


def common_runs(documents: DataFrame, most: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent runs, ascending, and about how many sets hold each; ``most`` at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = RunCounts(), set()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                runs = run_set(text)
                digest = hashlib.md5(runs.tobytes()).digest()
                if digest not in seen:
                    if len(seen) < COUNTED // 16:
                        seen.add(digest)
                    counts.add(runs)
        runs, held = counts.common()
        yield pa.RecordBatch.from_arrays([pa.array(runs.view(np.int64)), pa.array(held)], names=["run", "held"])

    small_batches(documents.sparkSession, 500)
    found = documents.select("text").filter("text is not null").mapInArrow(count, "run long, held long")
    top = found.groupBy("run").agg(F.sum("held").alias("held")).orderBy(F.desc("held"), "run").limit(most).toArrow()
    runs, held = top["run"].to_numpy().view(np.uint64), top["held"].to_numpy()
    order = np.argsort(runs)
    return runs[order], held[order]


def prefix(runs: np.ndarray, common: np.ndarray, held: np.ndarray) -> tuple[int, np.ndarray, int]:
    """How many matches the set asks for, its prefix for that, rarest runs first, and how many of these aren't hot."""
    size = len(runs)
    at = np.minimum(np.searchsorted(common, runs), max(len(common) - 1, 0))
    count = np.where(common[at] == runs, held[at], 1) if len(common) else np.ones(size, np.int64)
    order = np.lexsort((runs, count))
    least = _least_common(size)
    base = size - least
    longest = min(MOST_MATCHES, least)
    met = np.cumsum(count[order[: base + longest]] - 1)[base:]
    matches = np.arange(1, longest + 1)
    cost = met + met / matches * (1 + size / RUNS_PER_POSTING)
    asked = int(np.argmin(cost)) + 1
    chosen = order[: base + asked]
    return asked, runs[chosen], int((count[chosen] < HOT).sum())


def prefixed(documents: DataFrame, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, node (a digest of the set; null if empty), size, asked (matches), its prefix and its runs that aren't hot."""
    shared = documents.sparkSession.sparkContext.broadcast(common)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, size, asked, cool, found = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                runs = run_set(text)
                node.append(hashlib.md5(runs.tobytes()).digest() if len(runs) else None)
                size.append(len(runs))
                k, first, some = prefix(runs, *shared.value) if len(runs) else (0, runs, 0)
                asked.append(k)
                cool.append(some)
                found.append(first)
            ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            values = pa.array(np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(node, pa.binary()), pa.array(size, pa.int64()), pa.array(asked, pa.int32()), pa.array(cool, pa.int32()), pa.ListArray.from_arrays(ends, values)],
                names=["doc_id", "node", "size", "asked", "cool", "prefix"],
            )

    small_batches(documents.sparkSession, 500)
    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return read.mapInArrow(each, "doc_id long, node binary, size long, asked int, cool int, prefix array<long>")


def _postings(rows: DataFrame) -> DataFrame:
    """A row per node and run of its prefix that a prefix of a node of a fitting size has as well.

    ``level`` is the least k for which the run belongs to the prefix. Of a run's postings by size, one that
    neither neighbour fits fits none. Runs known to be ``HOT`` are held by many and needn't be looked at.
    """
    nodes = rows.filter("node is not null").groupBy("node").agg(
        F.min("row").alias("id"), *[F.first(x).alias(x) for x in ("size", "asked", "cool", "prefix")]
    )
    every = nodes.select("id", "size", "asked", "cool", F.posexplode("prefix").alias("at", "run"))
    base = F.expr(f"size - (size * {PERCENT} + 99) div 100")
    every = every.select("id", "size", "asked", F.greatest(F.col("at") - base + 1, F.lit(1)).cast("int").alias("level"), "run", "at", (F.col("at") < F.col("cool")).alias("rare"))
    by_size = Window.partitionBy("run").orderBy("size")
    near = (F.lag("size").over(by_size) * 100 >= F.col("size") * PERCENT) | (F.col("size") * 100 >= F.lead("size").over(by_size) * PERCENT)
    columns = ["id", "size", "asked", "level", "run", "at"]
    met = every.filter("rare").withColumn("near", near).filter("near").select(columns)
    met = met.unionByName(every.filter("not rare").select(columns))
    # Of a node's runs only those left here can be shared; whose runs all are stands amid its group.
    own = Window.partitionBy("id")
    return staged(
        met.select(
            "id", "size", "asked", "level", "run", (F.col("size") - F.col("at")).alias("ahead"),
            (F.row_number().over(own.orderBy("at")) - 1).alias("before"), (F.count(F.lit(1)).over(own) / F.col("size")).alias("central"),
        ),
        "postings",
    )


def _as_pair(postings: DataFrame, name: str) -> DataFrame:
    return postings.select("run", *[F.col(x).alias(f"{name}_{x}") for x in ("id", "size", "asked", "level", "before", "ahead", "comp")])


def _candidates(met: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of met postings (``one_``, ``two_``) that share as many runs as the pair asks for.

    Around a run that both hold they have in common at most the lesser number of runs before it that can be
    shared and, from it on, the lesser number left; met postings with less than a link needs aren't counted.
    """
    asked = F.least("one_asked", "two_asked")
    fits = (F.least("one_size", "two_size") * 100 >= F.greatest("one_size", "two_size") * PERCENT) & (F.greatest("one_level", "two_level") <= asked)
    needed = F.expr(f"((one_size + two_size) * {PERCENT} + {99 + PERCENT}) div {100 + PERCENT}")
    possible = F.least("one_before", "two_before") + F.least("one_ahead", "two_ahead") >= needed
    pairs = met.filter(fits & possible & (F.col("one_comp") != F.col("two_comp")) & (F.col("one_id") != F.col("two_id")))
    counted = pairs.groupBy(F.least("one_id", "two_id").alias("a"), F.greatest("one_id", "two_id").alias("b")).agg(
        F.count(F.lit(1)).alias("matched"), F.min(asked).alias("asked")
    )
    return counted.filter("matched >= asked").select("a", "b")


def _with_one(postings: DataFrame, of: DataFrame, number: int) -> DataFrame:
    """Postings of each run with those of its representative of a round."""
    rows = postings.join(of.withColumnsRenamed({"node": "of"}), F.col("id") == F.col("of")).drop("of")
    chosen = rows.groupBy("run").agg(
        F.min("comp").alias("first"), F.max("comp").alias("last"),
        F.min(F.struct(
            (F.lit(0) if number else -F.col("central")).alias("far"), F.xxhash64("id", F.lit(number)).alias("rank"),
            "id", "size", "asked", "level", "before", "ahead", "comp",
        )).alias("chosen"),
    ).filter("first <> last").select("run", "chosen.*")
    return _as_pair(rows, "one").join(_as_pair(chosen, "two"), "run")


def _across(postings: DataFrame, of: DataFrame) -> DataFrame:
    """Postings of each run outside of its largest class with those of all other classes, each pair once."""
    rows = postings.join(of.withColumnsRenamed({"node": "of"}), F.col("id") == F.col("of")).drop("of")
    kinds = rows.groupBy("run", "comp").agg(F.count(F.lit(1)).alias("held"))
    main = kinds.groupBy(F.col("run").alias("of")).agg(F.max_by("comp", F.struct("held", "comp")).alias("main"), F.count(F.lit(1)).alias("kinds"))
    main = main.filter("kinds > 1").select("of", "main")
    open_ = staged(rows.join(main, F.col("run") == F.col("of")).drop("of"), "open-postings")
    outer = _as_pair(open_.filter("comp <> main"), "one")
    inner = _as_pair(open_, "two").join(main.withColumnRenamed("of", "run"), "run")
    return outer.join(inner, "run").filter((F.col("two_comp") == F.col("main")) | (F.col("one_id") < F.col("two_id")))


def _sets(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """id and runs (bytes) of the nodes, from the texts of their least documents.

    Rows of a doc_id meet in one task, or in a few where it has very many; a set that comes from several is harmless.
    """

    def read_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            ids, found = [], []
            for one, node, text in zip(*(batch.column(x).to_pylist() for x in ("id", "node", "text"))):
                if one in seen:
                    continue
                held = run_set(text).tobytes()
                # Rows that only share the doc_id have another set.
                if hashlib.md5(held).digest() == node:
                    seen.add(one)
                    ids.append(one)
                    found.append(held)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.binary())], names=["id", "runs"])

    small_batches(documents.sparkSession, 500)
    wanted = nodes.select("id", "node", F.col("least_id").alias("of"))
    texts = documents.filter("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    read = texts.join(wanted, F.equal_null("doc_id", "of")).select("id", "node", "text")
    return staged(read.mapInArrow(read_sets, "id long, runs binary"), "sets")


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets link, stored."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        view = lambda x: np.frombuffer(x.as_buffer(), np.uint64)
        for batch in batches:
            kept = []
            for one, two in zip(batch.column("one"), batch.column("two")):
                left, right = view(one), view(two)
                both = len(left) + len(right) - len(np.union1d(left, right))
                kept.append(100 * both >= PERCENT * (len(left) + len(right) - both))
            yield batch.filter(pa.array(kept, pa.bool_())).select(["a", "b"])

    one = sets.select(F.col("id").alias("a"), F.col("runs").alias("one"))
    two = sets.select(F.col("id").alias("b"), F.col("runs").alias("two"))
    small_batches(pairs.sparkSession, 200)
    return staged(pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two").mapInArrow(check, "a long, b long"), "links")


def joined(documents: DataFrame, common: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """doc_id, n_shingles and component_id of every document; ``common`` replaces the counted common runs."""
    rows = prefixed(documents, common_runs(documents) if common is None else common)
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "prefixed")
    nodes = rows.filter("node is not null").groupBy("node").agg(F.min("row").alias("id"), F.min("doc_id").alias("least_id"))
    nodes = staged(nodes, "nodes")
    postings = _postings(rows)
    met = staged(postings.select("id").distinct(), "met")
    sets = _sets(documents, nodes.join(met, "id"))

    found = Classes(met.withColumnRenamed("id", "node"))
    tested = None
    for number in range(ROUNDS + 1):
        pairs = _candidates(_with_one(postings, found.of, number) if number < ROUNDS else _across(postings, found.of))
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = staged(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        found.join(linked(pairs, sets))

    named = nodes.select("node", "least_id", "id").join(found.of.withColumnsRenamed({"node": "of"}), F.col("id") == F.col("of"), "left")
    named = named.select("node", "least_id", F.coalesce("comp", "id").alias("comp"))
    least = named.groupBy(F.col("comp").alias("of")).agg(F.min("least_id").alias("component_id"))
    by_node = staged(named.join(least, F.col("comp") == F.col("of")).select(F.col("node").alias("of"), "component_id"), "node-classes")
    out = rows.select("doc_id", "node", "size").join(by_node, F.col("node") == F.col("of"), "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("size").alias("n_shingles"), own.alias("component_id"))
