"""Packing documents into sequences of a fixed length by non-negative least squares.

1. A document (its ids and an end id) is cut into whole windows and a rest, so that only
   rests need partners.
2. All ways to fill a window with up to ``DEPTH`` rests are listed over classes of ``UNIT``
   tokens (a rest counts as the top of its class). Repeat counts for them are solved by
   non-negative least squares against the histogram of the rests of all documents, and
   rounded.
3. What rounding leaves is packed greedily, longest first, into the gaps and into further
   windows; rests that would leave more than ``GAP`` tokens empty are laid end to end over
   windows and cut where a window ends.

Only histograms (a number for each length up to the window) reach the driver. The
place of a rest follows from its length and its rank among rests of that length; ranks come
from running numbers in each task and sums over tasks, so that no length, however common,
is gathered anywhere.

Null and empty texts are documents of one token, the end id. Repeated rows are documents of
their own. An empty table gives no sequences. Other columns than ``doc_id`` and ``text`` are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotline.llm.common import small_batches, staged, text_of
from slotline.llm.token_ids import Encoder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 1
WINDOW = 2048
UNIT = 8
DEPTH = 3
GAP = 16


def pieces(documents: DataFrame, vocabulary: str = VOCABULARY, kind: str = "bytes", end_id: int = END_ID,
           window: int = WINDOW) -> DataFrame:
    """Documents cut into windows and rests, with ids as little-endian unsigned 32-bit bytes.

    ``part`` is the task and ``nth`` the number of pieces of equal length before it there.
    """
    small_batches(documents.sparkSession, 500)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = Encoder.of(kind, vocabulary), np.zeros(window + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            doc, start, length, total, ids, nth = [], [], [], [], [], []
            values, bounds = encoder.ids(batch.column("text").to_pylist())
            every = np.insert(values.astype("<u4"), bounds[1:], end_id).tobytes()
            for row, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                first, last = (int(bounds[x]) + x for x in (row, row + 1))
                found, tokens = every[4 * first : 4 * last], last - first
                for at in range(0, tokens, window):
                    size = min(window, tokens - at)
                    doc.append(doc_id)
                    start.append(at)
                    length.append(size)
                    total.append(tokens)
                    ids.append(found[4 * at : 4 * (at + size)])
                    nth.append(int(seen[size]))
                    seen[size] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int32()),
                    pa.array(total, pa.int64()), pa.array([part] * len(doc), pa.int32()), pa.array(nth, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "start", "length", "doc_tokens", "part", "nth", "ids"],
            )

    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return read.mapInArrow(
        cut, "doc_id long, start long, length int, doc_tokens long, part int, nth long, ids binary"
    )


def least_squares(columns: np.ndarray, target: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """x >= 0 with the least ``|columns @ x - target|``, by the active-set method."""
    count = columns.shape[1]
    x, active = np.zeros(count), np.zeros(count, bool)
    limit = tolerance * max(1.0, np.abs(columns.T @ target).max(initial=0))
    for _ in range(3 * len(target) + 10):
        slope = columns.T @ (target - columns @ x)
        slope[active] = -np.inf
        best = int(np.argmax(slope)) if count else -1
        if best < 0 or slope[best] <= limit:
            break
        active[best] = True
        while True:
            chosen = np.flatnonzero(active)
            own = columns[:, chosen]
            solved = np.linalg.solve(own.T @ own + 1e-9 * np.eye(len(chosen)), own.T @ target)
            if (solved > 0).all():
                x[:] = 0
                x[chosen] = solved
                break
            bad = solved <= 0
            step = (x[chosen][bad] / (x[chosen][bad] - solved[bad])).min()
            x[chosen] += step * (solved - x[chosen])
            active[chosen[x[chosen] <= 1e-12]] = False
            x[~active] = 0
    return x


def combinations(classes: int, depth: int) -> list[tuple[int, ...]]:
    """Multisets of up to ``depth`` classes that fill a window of so many classes."""
    found: list[tuple[int, ...]] = []

    def fill(chosen: tuple[int, ...], left: int, most: int) -> None:
        if not left:
            found.append(chosen)
        elif len(chosen) < depth:
            for size in range(min(left, most), 0, -1):
                if size * (depth - len(chosen)) >= left:
                    fill((*chosen, size), left - size, size)

    fill((), classes, classes)
    return found


@dataclass
class Recipe:
    """So many sequences, each of these exact lengths in this order."""

    lengths: tuple[int, ...]
    count: int


def recipes(histogram: np.ndarray, window: int = WINDOW, unit: int = UNIT, depth: int = DEPTH,
            gap: int = GAP) -> tuple[list[Recipe], np.ndarray]:
    """Recipes for the pieces counted by length, and the counts that are left to lay end to end."""
    left = histogram.astype(np.int64).copy()
    made: list[Recipe] = [Recipe((window,), int(left[window]))] if left[window] else []
    left[window] = 0
    classes = -(-window // unit)
    top = -(-np.arange(window + 1) // unit)
    # Solve repeat counts of the combinations for the rests by class.
    ways = [way for way in combinations(classes, depth) if len(way) > 1]
    wanted = np.bincount(top, weights=left, minlength=classes + 1)
    if wanted.sum():
        columns = np.zeros((classes + 1, len(ways)))
        for at, way in enumerate(ways):
            np.add.at(columns[:, at], list(way), 1)
        # Short rests are easy to place later: they weigh less.
        weight = np.minimum(1.0, 0.1 + np.arange(classes + 1) / (classes / 2))
        solved = least_squares(columns * weight[:, None], wanted * weight)
        stock: list[list[list[int]]] = [[] for _ in range(classes + 1)]
        for length in np.flatnonzero(left)[::-1]:
            stock[top[length]].append([int(length), int(left[length])])
        for at in np.argsort(-solved, kind="stable"):
            repeats = round(solved[at])
            if repeats < 1:
                break
            while repeats > 0:
                taken: list[list[int]] = []
                for size in ways[at]:
                    options = [x for x in stock[size] if x[1] > sum(y is x for y in taken)]
                    if not options:
                        break
                    taken.append(options[0])
                if len(taken) < len(ways[at]):
                    break
                times = min(repeats, *(x[1] // sum(y is x for y in taken) for x in taken))
                for x in taken:
                    x[1] -= times
                    left[x[0]] -= times
                made.append(Recipe(tuple(x[0] for x in taken), times))
                repeats -= times
    # Fill gaps with the rests that are left, longest first.
    filled: list[Recipe] = []
    for recipe in made:
        while recipe.count:
            room, lengths = window - sum(recipe.lengths), list(recipe.lengths)
            times = recipe.count
            while room and left[1 : room + 1].any():
                length = int(np.flatnonzero(left[1 : room + 1])[-1]) + 1
                if left[length] < times:
                    times = int(left[length]) if len(lengths) == len(recipe.lengths) else times
                    if left[length] < times:
                        break
                left[length] -= times
                lengths.append(length)
                room -= length
            filled.append(Recipe(tuple(lengths), times))
            recipe.count -= times
    # Greedily more windows; those with too large a gap are undone and laid end to end.
    refused = np.zeros_like(left)
    while left.any():
        lengths, room = [], window
        rest = left.copy()
        while room and rest[1 : room + 1].any():
            length = int(np.flatnonzero(rest[1 : room + 1])[-1]) + 1
            fits = min(room // length, int(rest[length]))
            rest[length] -= fits
            lengths += [length] * fits
            room -= fits * length
        sizes, counts = np.unique(lengths, return_counts=True)
        if room > gap:
            longest = int(sizes[-1])
            refused[longest], left[longest] = refused[longest] + left[longest], 0
            continue
        times = int((left[sizes] // counts).min())
        left[sizes] -= times * counts
        filled.append(Recipe(tuple(lengths), times))
    return [x for x in filled if x.count], refused


def pack(cut: DataFrame, window: int = WINDOW, unit: int = UNIT, depth: int = DEPTH, gap: int = GAP) -> DataFrame:
    """The pieces in their sequences: doc_id, start, length, doc_tokens, ids, sequence_id, offset.

    ``cut`` must be stored, as ``part`` and ``nth`` have to stay what they are.
    """
    small_batches(cut.sparkSession, 500)
    counts = staged(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("count")), "piece-counts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    histogram = np.zeros(window + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("count").alias("count")).collect():
        histogram[row["length"]] = row["count"]
    made, streamed = recipes(histogram, window, unit, depth, gap)

    # For each length: from which rank on which recipe's which slot takes the pieces.
    used = np.zeros(window + 1, np.int64)
    slots: list[tuple[int, int, int, int]] = []  # length, first rank, first sequence, offset there
    sequences = 0
    for recipe in made:
        offset = 0
        for length in recipe.lengths:
            slots.append((length, int(used[length]), sequences, offset))
            used[length] += recipe.count
            offset += length
        sequences += recipe.count
    # Then the pieces that are laid end to end, by their place in that stream.
    stream, laid = [-1] * (window + 1), 0
    for length in np.flatnonzero(streamed):
        stream[length] = laid
        laid += int(length * streamed[length])
    slots.sort()
    key = np.array([x[0] for x in slots], np.int64)
    rank, sequence, place = (np.array([x[i] for x in slots], np.int64) for i in (1, 2, 3))
    spans = np.searchsorted(key, np.arange(window + 2))
    stream_at, reserved = np.array(stream, np.int64), sequences

    def lay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, start, length, total, ids, nth, lower in batch.itertuples(index=False):
                own = int(nth + lower)
                if own < used[length]:
                    a, b = spans[length], spans[length + 1]
                    at = a + int(np.searchsorted(rank[a:b], own, side="right")) - 1
                    rows.append((doc, start, length, total, ids, int(sequence[at] + own - rank[at]), int(place[at])))
                    continue
                position, done = int(stream_at[length] + (own - used[length]) * length), 0
                while done < length:
                    offset = (position + done) % window
                    size = min(length - done, window - offset)
                    target = reserved + (position + done) // window
                    rows.append((doc, start + done, size, total, ids[4 * done : 4 * (done + size)], target, offset))
                    done += size
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset"])

    # Rows of an unknown id travel as the least number, as pandas has no null integers.
    lowest = F.lit(-(2**63)).cast("long")
    placed = (
        cut.join(first, ["part", "length"])
        .select(F.coalesce("doc_id", lowest).alias("doc_id"), "start", "length", "doc_tokens", "ids", "nth", "first")
        .mapInPandas(lay, "doc_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long")
    )
    return placed.withColumn("doc_id", F.when(F.col("doc_id") != lowest, F.col("doc_id")))


def packed(documents: DataFrame) -> DataFrame:
    """Every document's pieces in sequences of ``WINDOW`` tokens, with their ids."""
    return pack(staged(pieces(documents), "pieces", compression="zstd"))
