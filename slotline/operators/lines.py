"""Service lines of a claim, ordered and numbered inside the document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotline.functions.json_text import LINE_SCHEMA
from slotline.functions.text import required, whole_number

# The place of each record kind within a file.
SECTION_RANK = {"FILE_HEADER": 0, "CLAIM_HEADER": 1, "CLAIM_LINE": 1, "FILE_TRAILER": 2}

CLAIM_STEP = 1000
HEADER_SEQUENCE = 1
TRAILER_SEQUENCE = 999999


def numbered_lines(lines: Column, strict: bool = False) -> Column:
    """Array of ``(line_sequence, line)``, by line number, then array position.

    The lines of a claim arrive together in its document, so ordering the array
    replaces a shuffle and sort of all service lines.  Missing numbers come last; with
    ``strict`` a number that cannot be read is an error.
    """

    def number(line: Column) -> Column:
        text = line["serviceLineNumber"]
        return required(whole_number(text), text, "line number") if strict else whole_number(text)

    keyed = F.transform(
        lines,
        lambda line, at: F.struct(
            number(line).isNull().alias("unnumbered"),
            number(line).alias("number"),
            at.alias("at"),
            line.alias("line"),
        ),
    )
    return F.transform(
        F.sort_array(keyed),
        lambda entry, at: F.struct((at + 1).cast("bigint").alias("line_sequence"), entry["line"].alias("line")),
    )


def service_lines(parsed: DataFrame) -> DataFrame:
    """One row per line, in array order; a claim without lines gives none."""
    return parsed.select("id", F.posexplode("claim.serviceLines").alias("position", "line"))


def line_sequences(numbered: DataFrame, parsed: DataFrame) -> DataFrame:
    """Line numbers and record sequences of every line of the numbered claims."""
    return (
        numbered.join(parsed, "id")
        .select(
            "extract_date", "mac_id", "phase", F.col("id").alias("claim_id"), "claim_sequence",
            F.explode(numbered_lines(F.col("claim.serviceLines"))).alias("entry"),
        )
        .select(
            "extract_date", "mac_id", "phase", "claim_id", "claim_sequence",
            F.col("entry.line_sequence").alias("line_sequence"),
            (claim_record_sequence(F.col("claim_sequence")) + F.col("entry.line_sequence")).alias("record_sequence"),
            F.col("entry.line").alias("line"),
        )
    )


def claim_record_sequence(claim_sequence: Column) -> Column:
    return claim_sequence * CLAIM_STEP + CLAIM_STEP


def empty_line() -> Column:
    return F.lit(None).cast(LINE_SCHEMA)
