"""Dense claim numbers per file, without one task per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotline.operators.ordered import in_pieces, sums_before_pieces
from slotline.operators.selection import FILE


def number_claims(phased: DataFrame, strict_nulls: bool = False) -> DataFrame:
    """Adds ``claim_sequence`` (by id), ``records_before`` and the totals of the claim's file.

    A claim's number is its place among the claims of its file whose ids are near,
    plus the claims of its file with smaller ids, summed up piece by piece.
    ``records_before`` counts the headers and lines of the claims before it.
    """
    rows = in_pieces(phased, "id")
    lines = F.coalesce("line_count", F.lit(0))
    near = Window.partitionBy(*FILE, "piece").orderBy("id")
    within = rows.withColumns(
        {
            "place": F.row_number().over(near).cast("bigint"),
            "lines_within": F.coalesce(F.sum(lines).over(near.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        }
    )
    # One aggregate of narrow rows gives the sums before each piece and the totals of the file.
    sums = {"claims": F.count(F.lit(1)), "lines": F.sum("line_count")}
    before = sums_before_pieces(rows.select(*FILE, "block", "piece", "line_count"), FILE, sums, totals=True)
    number = F.col("claims") + F.col("place")
    total_lines = F.col("total_lines") if strict_nulls else F.coalesce("total_lines", F.lit(0))
    return within.join(before, [*FILE, "piece"]).select(
        *phased.columns,
        number.alias("claim_sequence"),
        (number - 1 + F.col("lines") + F.col("lines_within")).alias("records_before"),
        F.col("total_claims").alias("total_claim_headers"),
        total_lines.alias("total_claim_lines"),
    )
