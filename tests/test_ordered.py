"""Values across pieces against a plain window, with one large group."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from slotline.operators import ordered as ordered_module
from slotline.operators.numbering import number_claims
from slotline.operators.ordered import previous_value, sum_before



@pytest.fixture(autouse=True)
def many_pieces(monkeypatch):
    """Pieces of 64 numbers and blocks of 64 pieces."""
    monkeypatch.setattr(ordered_module, "PIECE_BITS", 6)


def skewed(spark):
    """Two thirds of the rows in one group, the rest spread; order keys unique."""
    return spark.range(20_000).select(
        F.when(F.col("id") % 3 != 0, "large").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        (F.col("id") * 7919 % 20_011).alias("k"),
        (F.col("id") % 13).alias("v"),
    )


def same(left, right):
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_previous_value_and_sum_before(spark):
    frame = skewed(spark)
    plain = Window.partitionBy("g").orderBy("k")
    same(
        previous_value(frame, ["g"], ["k"], "v", "p").select("g", "k", "p"),
        frame.select("g", "k", F.lag("v").over(plain).alias("p")),
    )
    before = plain.rowsBetween(Window.unboundedPreceding, -1)
    same(
        sum_before(frame, ["g"], ["k"], "v", "s").select("g", "k", "s"),
        frame.select("g", "k", F.coalesce(F.sum("v").over(before), F.lit(0)).alias("s")),
    )


def test_numbering_of_a_large_file(spark):
    keys = skewed(spark).select(
        F.lit("2025-12-12").cast("date").alias("extract_date"),
        F.col("g").alias("mac_id"),
        F.lit("P2").alias("phase"),
        F.col("k").alias("id"),
        F.when(F.col("v") > 0, F.col("v")).alias("line_count"),
    )
    keys = keys.where("mac_id IS NOT NULL")
    got = number_claims(keys)
    assert got.count() == keys.count()
    plain = Window.partitionBy("mac_id")
    want = keys.select(
        "mac_id",
        "id",
        F.row_number().over(plain.orderBy("id")).cast("bigint").alias("claim_sequence"),
        F.count(F.lit(1)).over(plain).alias("total_claim_headers"),
        F.coalesce(F.sum("line_count").over(plain), F.lit(0)).alias("total_claim_lines"),
    )
    same(got.select(*want.columns), want)
