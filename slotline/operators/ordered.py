"""Order-dependent values over groups of any size.

A plain window over a large group sorts it in one task.  Here rows are cut into
pieces by the whole number they are ordered by: 2^20 neighbouring numbers are a
piece, 2^20 neighbouring pieces a block.  A value that needs earlier rows is worked
out within its piece and completed from a row per earlier piece of the block and
a row per earlier block.  The cut is a function of the row alone: nothing is
sampled, stored or counted beforehand, and a second run cuts alike.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE_BITS = 20


def in_pieces(frame: DataFrame, number: str) -> DataFrame:
    """``frame`` with ``piece`` and ``block``, by the whole number rows are ordered by."""
    return frame.withColumns(
        {"piece": F.shiftright(number, PIECE_BITS), "block": F.shiftright(number, 2 * PIECE_BITS)}
    )


def _earlier(group: list[str], order: str):
    return Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def sums_before_pieces(ordered: DataFrame, group: list[str], sums: dict[str, Column], totals: bool = False) -> DataFrame:
    """For each piece the sums over the group's rows in earlier pieces; ``sums`` are aggregates by name.

    With ``totals`` also the sums over all rows of the group, as ``total_`` and the name; NULL where
    there was nothing to add up.
    """
    pieces = ordered.groupBy(*group, "block", "piece").agg(*[value.alias(name) for name, value in sums.items()])
    blocks = pieces.groupBy(*group, F.col("block").alias("in_block")).agg(*[F.sum(name).alias(name) for name in sums])
    none = lambda column: F.coalesce(column, F.lit(0))
    blocks = blocks.select(
        *[F.col(name).alias(f"of_{name}") for name in group], "in_block",
        *[none(F.sum(name).over(_earlier(group, "in_block"))).alias(f"block_{name}") for name in sums],
        *[F.sum(name).over(Window.partitionBy(*group)).alias(f"total_{name}") for name in sums if totals],
    )
    within = pieces.select(
        *group, "block", "piece",
        *[none(F.sum(name).over(_earlier([*group, "block"], "piece"))).alias(name) for name in sums],
    )
    joined = within.join(blocks, same(group, [f"of_{name}" for name in group]) & (F.col("block") == F.col("in_block")))
    return joined.select(
        *group, "piece", *[(F.col(name) + F.col(f"block_{name}")).alias(name) for name in sums],
        *[f"total_{name}" for name in sums if totals],
    )


def same(left: list[str], right: list[str]) -> Column:
    """Equality of columns in which NULL equals NULL."""
    return reduce(lambda a, b: a & b, [F.equal_null(a, b) for a, b in zip(left, right)])


def _with_pieces(ordered: DataFrame, pieces: DataFrame, group: list[str]) -> DataFrame:
    """Rows joined with what their piece has; groups may be NULL, pieces as well."""
    keys = [*group, "piece"]
    other = pieces.select(*[F.col(name).alias(f"of_{name}") for name in keys], *[x for x in pieces.columns if x not in keys])
    return ordered.join(other, same(keys, [f"of_{name}" for name in keys])).drop(*[f"of_{name}" for name in keys])


def previous_value(frame: DataFrame, group: list[str], order: list[str], column: str, name: str) -> DataFrame:
    """``column`` of the row before in the group; NULL on the group's first row.

    The first of ``order`` is a whole number.
    """
    ordered = in_pieces(frame, order[0])
    tails = ordered.groupBy(*group, "piece").agg(F.max_by(column, F.struct(*order)).alias("tail"))
    before = Window.partitionBy(*group).orderBy("piece")
    carried = tails.select(*group, "piece", F.lag("tail").over(before).alias("carried"))
    within = Window.partitionBy(*group, "piece").orderBy(*order)
    return (
        _with_pieces(ordered.withColumn(name, F.lag(column).over(within)), carried, group)
        .withColumn(name, F.coalesce(name, "carried"))
        .drop("carried", "piece", "block")
    )


def sum_before(frame: DataFrame, group: list[str], order: list[str], column: str, name: str) -> DataFrame:
    """Sum of ``column`` over the group's rows before this one, 0 on the first."""
    ordered = in_pieces(frame, order[0])
    carried = sums_before_pieces(ordered, group, {"carried": F.sum(column)})
    within = (
        Window.partitionBy(*group, "piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        _with_pieces(ordered.withColumn(name, F.sum(column).over(within)), carried, group)
        .withColumn(name, F.coalesce(name, F.lit(0)) + F.coalesce("carried", F.lit(0)))
        .drop("carried", "piece", "block")
    )


def dealt_once(rows: DataFrame) -> DataFrame:
    """``rows`` behind a shuffle that is done once an action, however many steps of it start from them.

    Spark runs equal shuffles once. To stay equal, each has whole rows: packed, so that no step's choice of columns or
    filter gets below it.
    """
    packed = rows.select(F.array(F.struct(*rows.columns)).alias("packed"))
    return packed.repartition("packed").select(F.inline("packed"))
