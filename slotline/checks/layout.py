"""Checks of layout tables.

A layout table has ``record_type, field_name, start, end, pad_side, pad_len,
pad_char, line``.  Record types are checked apart from each other, as every one
of them starts again at position 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotline.operators.ordered import previous_value, sum_before

TYPE = ["record_type"]


def dedupe(layout: DataFrame) -> DataFrame:
    """One row per (positions, name): the one that comes first."""
    same = Window.partitionBy("record_type", "start", "end", "field_name").orderBy("line")
    return layout.withColumn("copy", F.row_number().over(same)).where("copy = 1").drop("copy")


def _issue(kind: Column, severity: str, first: Column, last: Column, size: Column) -> tuple:
    return (
        "record_type",
        "line",
        kind.alias("issue"),
        "field_name",
        first.cast("bigint").alias("first_position"),
        last.cast("bigint").alias("last_position"),
        size.cast("bigint").alias("size"),
        F.lit(severity).alias("severity"),
    )


def length_mismatches(layout: DataFrame) -> DataFrame:
    """Fields padded to another length than their positions span."""
    start, end, pad = F.col("start"), F.col("end"), F.col("pad_len")
    return layout.where(pad != end - start + 1).select(
        *_issue(F.lit("LENGTH_MISMATCH"), "ERROR", start, end, pad - (end - start + 1))
    )


def gaps_and_overlaps(layout: DataFrame) -> DataFrame:
    """Fields that do not start right after the field before them."""
    start, before = F.col("start"), F.col("previous_end")
    step = start - before - 1
    kind = F.when(step > 0, "GAP").otherwise("OVERLAP")
    return previous_value(layout, TYPE, ["start", "line"], "end", "previous_end").where(step != 0).select(
        *_issue(
            kind,
            "ERROR",
            F.when(step > 0, before + 1).otherwise(start),
            F.when(step > 0, start - 1).otherwise(before),
            F.abs(step),
        )
    )


def padding_warnings(layout: DataFrame) -> DataFrame:
    """Fields named like amounts, dates or numbers that are not left-padded with 0."""
    numeric = F.col("field_name").rlike("EOMB-AMT|DATE|NUM")
    zero_padded = (F.col("pad_side") == "LPAD") & (F.col("pad_char") == "0")
    return layout.where(numeric & ~zero_padded).select(
        *_issue(F.lit("PADDING_TYPE"), "WARNING", F.col("start"), F.col("end"), F.col("pad_len"))
    )


def issues(layout: DataFrame) -> DataFrame:
    """Every finding on a layout without repeats."""
    return (
        length_mismatches(layout)
        .unionByName(gaps_and_overlaps(layout))
        .unionByName(padding_warnings(layout))
    )


def summary(layout: DataFrame) -> DataFrame:
    """One row per record type: fields, findings, span, widths and the verdict.

    The last position is that of the field that starts last, as the reader of a
    layout meets it.
    """
    fields = dedupe(layout)
    found = issues(fields).groupBy(*TYPE).agg(
        F.count_if(F.col("severity") == "ERROR").alias("errors"),
        F.count_if(F.col("severity") == "WARNING").alias("warnings"),
    )
    spans = fields.groupBy(*TYPE).agg(
        F.count(F.lit(1)).alias("fields"),
        F.min("start").alias("first_position"),
        F.max(F.struct("start", "line", "end"))["end"].alias("last_position"),
        F.sum("pad_len").alias("total_length"),
    )
    expected = (F.col("last_position") - F.col("first_position") + 1).cast("bigint")
    errors = F.coalesce("errors", F.lit(0))
    return spans.join(found, TYPE, "left").select(
        *TYPE,
        "fields",
        errors.alias("errors"),
        F.coalesce("warnings", F.lit(0)).alias("warnings"),
        "first_position",
        "last_position",
        "total_length",
        expected.alias("expected_length"),
        (F.col("total_length") - expected).alias("length_difference"),
        (errors == 0).alias("passed"),
    )


def width_drift(layout: DataFrame) -> DataFrame:
    """Where each field really lands when pads differ from stated positions."""
    return sum_before(layout, TYPE, ["start", "line"], "pad_len", "before").select(
        *TYPE,
        "field_name",
        "line",
        "start",
        (F.col("pad_len") - (F.col("end") - F.col("start") + 1)).alias("mismatch"),
        (F.col("before") + 1 - F.col("start")).cast("bigint").alias("shift"),
    )
