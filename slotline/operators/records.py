"""Records of claims, as text or in compact form.

Padding turns some forty short values into 2,332 or 5,651 characters.  So claims
are shuffled, not records, and where records must be sorted they are compact: one
array of unpadded values each, which becomes text only after the sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotline.functions.json_text import LINE_SCHEMA, parse_claim_values, parse_payment, spaced_json
from slotline.functions.text import (
    date_text,
    flag,
    number_text,
    required,
    type_by_length,
    type_by_letter,
    whole_number,
    yes_no,
)
from slotline.layouts.model import Layout, Slot
from slotline.layouts.records import CLAIM_HEADER, CLAIM_LINE, FILE_HEADER, FILE_TRAILER, LAYOUTS
from slotline.operators.lines import (
    HEADER_SEQUENCE,
    SECTION_RANK,
    TRAILER_SEQUENCE,
    claim_record_sequence,
    empty_line,
    numbered_lines,
)
from slotline.operators.naming import file_name
from slotline.operators.payments import latest_payment
from slotline.operators.selection import day_text

RECORD_COLUMNS = (
    "file_name", "mac_id", "phase", "record_type",
    "record_sequence", "claim_sequence", "line_sequence",
)


def _source(slot: Slot, computed: dict[str, Column]) -> Column:
    kind, _, key = slot.source.partition(".")
    if kind.startswith("@"):
        return computed[kind[1:]]
    if kind == "line":
        return F.coalesce(F.col(f"line.{key}"), F.col(f"claim.{key}"))
    return F.col(slot.source)


def _value(slot: Slot, computed: dict[str, Column], strict: bool) -> Column:
    raw = _source(slot, computed)
    read = lambda value, what: required(value, raw, what) if strict else value
    if slot.default is None:
        return raw.cast("string")
    default = F.lit(slot.default)
    match slot.form:
        case "date":
            return date_text(F.coalesce(raw, default))
        case "spaced date":
            return date_text(F.coalesce(raw, default), " ")
        case "number":
            return F.coalesce(computed[f"number {slot.start}"], default)
        case "whole":
            return F.coalesce(read(whole_number(raw), "whole number").cast("string"), default)
        case "json":
            return F.coalesce(spaced_json(raw), default)
        case "yes":
            return yes_no(read(flag(raw), "flag"), "Y", slot.default)
        case _:
            return F.coalesce(raw.cast("string"), default)


# What a claim header takes from the claim.
HEADER_KEYS = tuple(
    sorted({slot.source.removeprefix("claim.") for slot in CLAIM_HEADER.slots if slot.source.startswith("claim.")} | {"diagnosisCodes"})
)


def header_numbers(strict: bool) -> Column:
    """The texts of the claim header's numbers, in the order of its slots.

    Reading one takes a large expression.  Over an array it is there once and not once per number, which
    keeps the code of a record within what the JVM compiles.
    """
    raw = [F.col(slot.source) for slot in CLAIM_HEADER.slots if slot.form == "number"]
    read = lambda text: required(number_text(text), text, "number") if strict else number_text(text)
    return F.transform(F.array(*raw), read)


def slot_values(layout: Layout, computed: dict[str, Column], strict: bool = False) -> list[Column]:
    return [_value(slot, computed, strict) for slot in layout.slots]


def file_values(layout: Layout) -> list[Column]:
    """Slots of a file header or trailer, from the columns of a file's totals."""
    headers, lines = F.col("total_claim_headers"), F.col("total_claim_lines")
    return slot_values(
        layout,
        {
            "phase": F.col("phase"),
            "mac_id": F.col("mac_id"),
            "cycle_date": F.date_format("extract_date", "yyyyMMdd"),
            "total_records": F.lit(1) + headers + lines + F.lit(1),
            "total_claim_headers": headers,
            "total_claim_lines": lines,
        },
    )


def claim_values(strict: bool = False) -> list[Column]:
    diagnosis = F.get("claim.diagnosisCodes", F.lit(0))
    numbers = [slot for slot in CLAIM_HEADER.slots if slot.form == "number"]
    return slot_values(
        CLAIM_HEADER,
        {
            **{f"number {slot.start}": F.get("numbers", F.lit(at)) for at, slot in enumerate(numbers)},
            "phase": F.col("phase"),
            "line_count": F.col("line_count"),
            "claim_diagnosis": diagnosis,
            "type_by_letter": type_by_letter(diagnosis),
            "type_by_length": type_by_length(diagnosis),
        },
        strict,
    )


def line_values(strict: bool = False) -> list[Column]:
    """The line's flag looks for a code on either, but its code is the claim's."""
    diagnosis = F.get("claim.diagnosisCodes", F.lit(0))
    participation = flag(F.col("claim.isParticipatingProvider"))
    if strict:
        participation = required(participation, F.col("claim.isParticipatingProvider"), "flag")
    any_diagnosis = F.coalesce(diagnosis, F.get("line.diagnosisCodes", F.lit(0)))
    return slot_values(
        CLAIM_LINE,
        {
            "line_sequence": F.col("line_sequence"),
            "claim_diagnosis": diagnosis,
            "line_type_by_letter": type_by_letter(diagnosis, any_diagnosis),
            "participation": yes_no(participation, "P", "N"),
        },
        strict,
    )


def file_records(totals: DataFrame, layout: Layout) -> DataFrame:
    """File headers or trailers as records with text, one per row of totals."""
    sequence = HEADER_SEQUENCE if layout is FILE_HEADER else TRAILER_SEQUENCE
    values = file_values(layout)
    return totals.select(
        "extract_date",
        "mac_id",
        "phase",
        F.lit(layout.record_type).alias("record_type"),
        F.lit(sequence).cast("bigint").alias("record_sequence"),
        F.lit(None).cast("bigint").alias("claim_sequence"),
        F.lit(None).cast("bigint").alias("line_sequence"),
        layout.render(values.__getitem__).alias("record_content"),
    )


def named(numbered: DataFrame, parameters: DataFrame) -> DataFrame:
    """File names added; the parameters hold one row per day."""
    return numbered.join(parameters, "extract_date").withColumn(
        "file_name", file_name(F.col("phase"), F.col("mac_id"), F.col("run_ts"))
    )


def claim_rows(numbered: DataFrame, claims: DataFrame, payments: DataFrame) -> DataFrame:
    """Numbered claims with their document and latest response.

    Documents given as text are parsed after the last shuffle: as text they are
    no larger, and a sort that samples its input does not parse them twice.  Responses
    join the narrow rows first, so that documents are shuffled once, and not at all where they lie by id.
    """
    latest = latest_payment(payments).select(F.col("claim_id").alias("id"), "payment_response_json")
    answered = numbered.join(latest, "id", "left")
    if "claim" in claims.columns:
        return claims.select("id", "receipt_date", "claim").join(answered, ["id", "receipt_date"])
    # The day isn't written as an equality: Spark would deal the documents again by both.
    of_day = (F.col("received") <= day_text()) & (F.col("received") >= day_text())
    documents = claims.select("id", F.col("receipt_date").alias("received"), "claim_jsonb")
    answered = answered.drop("receipt_date").withColumnRenamed("id", "of_id")
    rows = documents.join(answered, (F.col("id") == F.col("of_id")) & of_day)
    return rows.drop("of_id").withColumnRenamed("received", "receipt_date")


def _keys_of(sections) -> tuple[list[str], list[str]]:
    """What records of ``sections`` take from a claim and from its lines; a line's value may sit on the claim."""
    header = HEADER_KEYS if "CLAIM_HEADER" in sections else ()
    line = LINE_SCHEMA.names if "CLAIM_LINE" in sections else []
    return sorted({*header, *line, "diagnosisCodes", "isParticipatingProvider"}), line


def records_of(
    rows: DataFrame, sections=tuple(SECTION_RANK), compact: bool = False, strict_values: bool = False
) -> DataFrame:
    """Each claim becomes its header and its lines; the first and the last claim
    of a file also bring the file's header and trailer.

    So one pass over the claims gives every record, already next to its
    neighbours, and no union of four separate scans is needed.  Records keep the
    order of ``rows``, and the records of one claim come in file order.

    The text is ``record_content``.  For records that still have to be sorted,
    ``compact`` gives their unpadded values as ``slots`` instead.  With
    ``strict_values`` a number or flag that cannot be read is an error.
    """
    claim = F.col("claim") if "claim" in rows.columns else parse_claim_values(F.col("claim_jsonb"), *_keys_of(sections))
    rows = rows.withColumns({"claim": claim, "payment": parse_payment(F.col("payment_response_json"))})
    if "CLAIM_HEADER" in sections:
        rows = rows.withColumn("numbers", header_numbers(strict_values))
    single = lambda kind: F.array(
        F.struct(
            F.lit(kind).alias("record_type"),
            F.lit(None).cast("bigint").alias("line_sequence"),
            empty_line().alias("line"),
        )
    )
    nothing = F.slice(single("CLAIM_LINE"), 1, 0)
    lines = F.transform(
        numbered_lines(F.col("claim.serviceLines"), strict_values),
        lambda entry: F.struct(F.lit("CLAIM_LINE").alias("record_type"), entry["line_sequence"], entry["line"]),
    )
    parts = {
        "FILE_HEADER": F.when(F.col("claim_sequence") == 1, single("FILE_HEADER")).otherwise(nothing),
        "CLAIM_HEADER": single("CLAIM_HEADER"),
        "CLAIM_LINE": F.coalesce(lines, nothing),
        "FILE_TRAILER": F.when(
            F.col("claim_sequence") == F.col("total_claim_headers"), single("FILE_TRAILER")
        ).otherwise(nothing),
    }
    exploded = rows.withColumn("entry", F.explode(F.concat(*[parts[name] for name in sections]))).select(
        "*", "entry.record_type", "entry.line_sequence", "entry.line"
    )
    kind, number = F.col("record_type"), F.col("claim_sequence")
    is_body = kind.isin("CLAIM_HEADER", "CLAIM_LINE")
    values = {
        "FILE_HEADER": lambda strict: file_values(FILE_HEADER),
        "CLAIM_HEADER": claim_values,
        "CLAIM_LINE": line_values,
        "FILE_TRAILER": lambda strict: file_values(FILE_TRAILER),
    }

    def content(layout: Layout) -> Column:
        columns = values[layout.record_type](strict_values)
        return F.array(*columns) if compact else layout.render(columns.__getitem__)

    contents = {layout.record_type: content(layout) for layout in LAYOUTS if layout.record_type in sections}
    sequences = {
        "FILE_HEADER": F.lit(HEADER_SEQUENCE).cast("bigint"),
        "CLAIM_HEADER": claim_record_sequence(number),
        "CLAIM_LINE": claim_record_sequence(number) + F.col("line_sequence"),
        "FILE_TRAILER": F.lit(TRAILER_SEQUENCE).cast("bigint"),
    }
    extra = [name for name in ("part",) if name in rows.columns]
    return exploded.select(
        "extract_date",
        "file_name",
        "mac_id",
        "phase",
        "record_type",
        _by_kind(kind, {name: sequences[name] for name in sections}).alias("record_sequence"),
        F.when(is_body, number).alias("claim_sequence"),
        "line_sequence",
        F.col("id").alias("claim_id"),
        *extra,
        _by_kind(kind, {name: contents[name] for name in sections}).alias("slots" if compact else "record_content"),
    )


def _by_kind(kind: Column, choices: dict[str, Column]) -> Column:
    if len(choices) == 1:
        return next(iter(choices.values()))
    (first, value), *others = choices.items()
    out = F.when(kind == first, value)
    for name, other in others:
        out = out.when(kind == name, other)
    return out


def section_rank() -> Column:
    """Records of unknown types belong to the body."""
    known = {name: F.lit(rank) for name, rank in SECTION_RANK.items()}
    return F.coalesce(_by_kind(F.col("record_type"), known), F.lit(SECTION_RANK["CLAIM_LINE"]))


def record_order(strict_sequence: bool = False) -> list[Column]:
    """Order of records within a file.

    ``record_sequence`` alone puts the trailer before the 999th claim; the order
    by section does not.  Strict mode keeps the order by ``record_sequence``.
    """
    order = [section_rank(), F.col("claim_sequence"), F.col("line_sequence").asc_nulls_first()]
    return [F.col("record_sequence"), *order] if strict_sequence else order


def text_of_slots() -> Column:
    """The padded text of a compact record."""
    texts = {layout.record_type: layout.render(lambda i: F.get("slots", F.lit(i))) for layout in LAYOUTS}
    return _by_kind(F.col("record_type"), texts)
