"""Words and their commoner spellings, by dynamic programming over sorted lists.

Words come from the maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` of every whole text, A-Z lower-cased. A run whose
number (the CRC-32 of ``<doc_id>:<run>``) is divisible by ``DAMAGE`` loses one code point. What is left counts as a word
with ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences. Two words are near when one inserted, deleted
or replaced code point turns one into the other. A word's form is its commonest near word, if that is
``TIMES`` times as common; its root is what its forms lead to.

Near words agree outside of a single place, so words meet in blocks: the shorter length, and the code points before
and behind a region in which the place lies. Each word enters the blocks of both halves, for its own
length and as the longer of two. The region of a pair is that of the first code point in which they differ, so each pair
is found in one block. A block of more than ``MOST_WORDS`` words is cut in two by halving its region, again and
again; a region of one place holds no more words than the alphabet allows. No word or pair is left out.

Within a block the words' regions are a sorted list. Each word scans it with the band of its edit matrix that
one edit can reach (three cells a row). Rows belong to prefixes: a prefix that neighbours share, known from their longest
common prefixes, has its row worked out once, and the whole range of words under a prefix whose row
exceeds one edit is skipped. All words of a block scan together, prefix length by prefix length.

Null texts have no words, and a null doc_id counts as empty in a run's number. Texts and words of any length are
read whole. Ties of a form are settled by code points; repeated rows count each time. An empty table gives an empty
result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotline.llm.common import small_batches, staged

LETTERS = "A-Za-z\\u00C0-\\u00FF"
DAMAGE = 31
LEAST_LENGTH = 7
LEAST_COUNT = 2
TIMES = 10
#: Words of a block before its region is halved, and cells of the code point matrix of words scanned together.
MOST_WORDS = 16_384
MOST_CELLS = 1 << 19
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(documents: DataFrame) -> DataFrame:
    """word and n, for every word of the documents."""
    runs = F.filter(F.split("text", f"[^{LETTERS}]+"), lambda x: F.length(x) >= LEAST_LENGTH)
    found = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("run"))
    found = found.select("doc", F.translate("run", _UPPER, _LOWER).alias("run"))
    number = F.crc32(F.concat("doc", F.lit(":"), "run"))
    at = F.pmod("number", F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = found.withColumn("number", number).select(F.when(F.col("number") % DAMAGE == 0, short).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


def _part(text: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` (not included, from 0)."""
    return F.substring(text, start + 1, end - start)


def _entries(words: DataFrame, regions: Column) -> DataFrame:
    """A row per word and region: the block it enters there, and its code points inside the region.

    ``regions`` is an array of ``(m, low, high)``: places of words of ``m`` or ``m + 1`` code points. The
    last region of a length ends behind its last place, where only an insertion can lie.
    """
    length = F.length("word")
    tail = F.greatest(F.col("m") - F.col("high"), F.lit(0))
    rows = words.select("word", "n", F.explode(regions).alias("region")).select("word", "n", "region.*")
    return rows.select(
        F.concat_ws(
            ":", *[F.col(x).cast("string") for x in ("m", "low", "high")], _part(F.col("word"), F.lit(0), F.col("low")), _part(F.col("word"), length - tail, length)
        ).alias("block"),
        _part(F.col("word"), F.col("low"), length - tail).alias("inside"),
        "word", "n", "m", "low", "high",
    )


def _region(m: Column, low: Column, high: Column) -> Column:
    return F.struct(m.cast("int").alias("m"), low.cast("int").alias("low"), high.cast("int").alias("high"))


def _halves() -> Column:
    def both(m: Column) -> list[Column]:
        half = F.floor(m / 2)
        return [_region(m, F.lit(0), half), _region(m, half, m + 1)]

    length = F.length("word")
    own, longer = both(length), both(length - 1)
    return F.when(length > LEAST_LENGTH, F.array(*own, *longer)).otherwise(F.array(*own))


class _Scan:
    """The near pairs of sorted blocks: index of a word of length ``m``, and of its near word."""

    def __init__(self, block: np.ndarray, inside: list[str], asks: np.ndarray):
        self.count = len(inside)
        self.length = np.fromiter(map(len, inside), np.int64, self.count)
        width = int(self.length.max()) + 2
        points = np.frombuffer("".join(inside).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.points = np.zeros((self.count, width), np.uint32)
        self.points[np.arange(width) < self.length[:, None]] = points
        # Code points that a word shares with the one before it in its block.
        differ = self.points[1:] != self.points[:-1]
        common = np.where(differ.any(1), differ.argmax(1), width)
        self.shared = np.append(-1, np.where(block[1:] == block[:-1], np.minimum(common, np.minimum(self.length[1:], self.length[:-1])), -1))
        self.asks = np.flatnonzero(asks)
        self.width = width

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(self.shared < 0)
        ends = np.append(starts[1:], self.count)
        at = np.searchsorted(starts, self.asks, "right") - 1
        ask, low, high = self.asks, starts[at], ends[at]
        # The matrix cells one place before the diagonal, on it and one behind; 2 stands for all beyond one edit.
        before, on, behind = (np.full(len(ask), x, np.int8) for x in (2, 0, 1))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for depth in range(self.width):
            # Words that end here stand first in their range.
            cell = np.select([self.length[ask] == depth - 1, self.length[ask] == depth, self.length[ask] == depth + 1], [before, on, behind], 2)
            ended = (self.length[low] == depth) & (cell <= 1)
            found.append((ask[ended], low[ended]))
            # The ranges of one more shared code point.
            edge = np.flatnonzero(self.shared <= depth)
            edge_end = np.append(edge[1:], self.count)
            longer = self.length[edge] > depth
            edge, edge_end = edge[longer], edge_end[longer]
            first, last = np.searchsorted(edge, low), np.searchsorted(edge, high)
            each = last - first
            source = np.repeat(np.arange(len(ask)), each)
            if not len(source):
                break
            child = np.arange(len(source)) - np.repeat(np.cumsum(each) - each, each) + first[source]
            ask, low, high = ask[source], edge[child], edge_end[child]
            point = self.points[low, depth]
            own = lambda place: self.points[ask, np.clip(place, 0, self.width - 1)]  # noqa: B023, E731
            old_before, old_on, old_behind = before[source], on[source], behind[source]
            # Row ``depth + 1``, columns ``depth``, ``depth + 1`` and ``depth + 2``.
            before = np.minimum(old_before + (point != own(depth - 1)) if depth else np.full(len(ask), 2, np.int8), old_on + 1)
            on = np.minimum(np.minimum(old_on + (point != own(depth)), old_behind + 1), before + 1)
            behind = np.minimum(old_behind + (point != own(depth + 1)), on + 1)
            near = np.minimum(np.minimum(before, on), behind) <= 1
            ask, low, high = ask[near], low[near], high[near]
            before, on, behind = (np.minimum(x[near], 2).astype(np.int8) for x in (before, on, behind))
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The sorted rows, cut between blocks into tables of about ``MOST_CELLS`` cells."""
    held: list[pa.RecordBatch] = []
    longest = 2
    for batch in batches:
        held.append(batch)
        longest = max(longest, 2 + (pc.max(pc.utf8_length(batch["inside"])).as_py() or 0))
        if sum(x.num_rows for x in held) * longest < MOST_CELLS:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        block = table["block"].to_numpy(zero_copy_only=False)
        change = np.flatnonzero(block[1:] != block[:-1])
        if len(change):
            cut = int(change[-1]) + 1
            yield table.slice(0, cut)
            held, longest = table.slice(cut).combine_chunks().to_batches(), 2
    if held:
        yield pa.Table.from_batches(held)


def scan_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n, near, near_n`` both ways round for each near pair of the blocks, sorted by block and inside."""
    for table in _whole_blocks(batches):
        if not table.num_rows:
            continue
        block = table["block"].to_numpy(zero_copy_only=False)
        word, n = table["word"].to_numpy(zero_copy_only=False), table["n"].to_numpy()
        m, low, high = (table[x].to_numpy() for x in ("m", "low", "high"))
        length = np.fromiter(map(len, word), np.int64, len(word))
        scan = _Scan(block, table["inside"].to_pylist(), length == m)
        one, two = scan.pairs()
        same = length[two] == m[two]
        # Words of equal length see each other; a place at the region's end is the next region's.
        shorter_first = np.where(same, one < two, True)
        inner = (high - low)[one]
        shares = (scan.points[one] == scan.points[two]) | (np.arange(scan.width) >= inner[:, None])
        elsewhere = ~same & (high[one] <= m[one]) & shares.all(1)
        kept = shorter_first & ~elsewhere
        one, two = one[kept], two[kept]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x)) for x in ((word[one], word[two]), (n[one], n[two]), (word[two], word[one]), (n[two], n[one]))],
            schema=pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())]),
        )


def near_pairs(words: DataFrame, most: int = MOST_WORDS) -> DataFrame:
    """``word, n, near, near_n`` for all near words of ``words`` (word, n)."""
    spark = words.sparkSession
    small_batches(spark, 10_000)
    regions = _halves()
    parts = []
    while True:
        entries = _entries(words, regions)
        sizes = entries.groupBy("block").agg(F.count(F.lit(1)).alias("held"), F.min(F.length("word")).alias("least"), F.first("m").alias("least_m"))
        sizes = sizes.filter("held > 1 and least = least_m").select(F.col("block").alias("of"), "held")
        met = staged(entries.join(sizes, F.col("block") == F.col("of")).drop("of"), "blocks")
        large = (F.col("held") > most) & (F.col("high") - F.col("low") > 1)
        ready = met.filter(~large).select("block", "inside", "word", "n", "m", "low", "high")
        parts.append(
            ready.repartition("block").sortWithinPartitions("block", "inside")
            .mapInArrow(scan_blocks, "word string, n long, near string, near_n long")
        )
        words = met.filter(large).select("word", "n", "m", "low", "high")
        if words.isEmpty():
            break
        middle = F.floor((F.col("low") + F.least("high", "m")) / 2)
        middle = F.greatest(middle, F.col("low") + 1)
        regions = F.array(_region(F.col("m"), F.col("low"), middle), _region(F.col("m"), middle, F.col("high")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def variants(documents: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n for every word of the documents."""
    words = staged(vocabulary(documents), "vocabulary")
    by_word = near_pairs(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best")
    )
    best = by_word.select(F.col("word").alias("of"), "n_near", F.col("best.near").alias("near"), (-F.col("best.rank")).alias("near_n"))
    common = F.col("near_n") >= TIMES * F.col("n")
    found = words.join(best, F.col("word") == F.col("of"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(common, F.col("near")).alias("form"), F.when(common, F.col("near_n")).alias("form_n"),
    )
    found = staged(found, "forms")
    # A form is TIMES as common as its word, so a chain is short; each round doubles the steps taken.
    steps = found.filter("form is not null").select(F.col("word").alias("at"), F.col("form").alias("to"))
    while True:
        ahead = steps.select(F.col("at").alias("next_at"), F.col("to").alias("next_to"))
        further = steps.join(ahead, F.col("to") == F.col("next_at"), "left")
        further = staged(further.select("at", F.coalesce("next_to", "to").alias("to"), F.col("next_to").isNotNull().alias("moved")), "roots")
        steps = further.select("at", "to")
        if further.filter("moved").isEmpty():
            break
    return found.join(steps, F.col("word") == F.col("at"), "left").select(
        "word", "form", F.coalesce("to", "word").alias("root"), "n", "n_near", "form_n"
    )
