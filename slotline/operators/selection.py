"""Selecting a day's claims, their phase, and per-file totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotline.functions.text import left_pad

FILE = ["extract_date", "mac_id", "phase"]


def day_text() -> Column:
    """The extract date as claims have it."""
    return F.date_format("extract_date", "yyyy-MM-dd")


def claims_on_date(keys: DataFrame, parameters: DataFrame) -> DataFrame:
    """Claims with a contractor whose receipt date is one of the extract dates.

    ``keys`` has ``mac_id`` and ``receipt_date``; both are compared as text.
    """
    days = parameters.select("extract_date", day_text().alias("receipt_date"))
    return keys.where(F.col("mac_id").isNotNull()).join(days, "receipt_date")


def each_once(selected: DataFrame) -> DataFrame:
    """The selected claims; a claim id that comes twice ends the run, as its records would come twice as well."""
    columns = [name for name in selected.columns if name != "id"]
    counted = selected.groupBy("id").agg(F.count(F.lit(1)).alias("held"), *[F.first(name).alias(name) for name in columns])
    twice = F.raise_error(F.concat(F.lit("claim comes more than once: "), F.col("id").cast("string")))
    return counted.where(F.when(F.col("held") > 1, twice.cast("boolean")).otherwise(F.lit(True))).select(*selected.columns)


def with_phase(selected: DataFrame, payments: DataFrame) -> DataFrame:
    """``P3`` where any payment response exists for the claim, else ``P2``.

    Only existence counts here: of the responses nothing but the claim ids is read,
    which shrink to distinct ids before they are shuffled.
    """
    paid = payments.select(F.col("claim_id").alias("id"), F.lit(True).alias("is_paid")).distinct()
    return selected.join(paid, "id", "left").select(
        *selected.columns, F.when(F.col("is_paid"), "P3").otherwise("P2").alias("phase")
    )


def mac_dimension(phased: DataFrame) -> DataFrame:
    return phased.select(*FILE).distinct()


def mac_totals(phased: DataFrame, strict_nulls: bool = False) -> DataFrame:
    """Claims and service lines per file.

    The sum is NULL where no claim of a file has lines; that NULL is kept only
    in strict mode and would leave the file without a usable trailer.
    """
    lines = F.sum("line_count")
    return phased.groupBy(*FILE).agg(
        F.count(F.lit(1)).alias("total_claim_headers"),
        (lines if strict_nulls else F.coalesce(lines, F.lit(0))).cast("bigint").alias("total_claim_lines"),
    )


def claim_key(phased: DataFrame, parsed: DataFrame) -> DataFrame:
    """Padded plan and control number of every selected claim."""
    return phased.join(parsed, "id").select(
        *FILE,
        F.col("id").alias("claim_id"),
        left_pad(F.coalesce("claim.planCode", F.lit("0")), 2, "0").alias("idr_plan"),
        left_pad(F.coalesce("claim.internalControlNumber", F.lit("0")), 13, "0").alias("idr_icn"),
    )


def with_claim_key(claims: DataFrame, keys: DataFrame) -> DataFrame:
    """Keep the claims that have a key row; a semi join, as no key column is used."""
    return claims.join(keys.select(F.col("claim_id").alias("id")), "id", "left_semi")
