"""Every registered query: a name and a function of (session, data folder)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone
from functools import wraps

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotline import testbed
from slotline.checks import layout as layout_checks
from slotline.checks import records as record_checks
from slotline.functions import json_text, text
from slotline.operators import adhoc, lines, payments, records, selection
from slotline.plans import Extract
from slotline.session import finer_tasks, scratch_path
from slotline.sinks import clip_records, positions, read_files, read_relation, split_result
from slotline.sinks.files import read_whole
from slotline.sources import claim_keys, extract_parameters, narrow_claims, parse_result_lines, parsed_claims, read_claims
from slotline.sources import read_result_table, read_staged_claims, stage_claims
from slotline.sources.result_table import accepted, rejected

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

RUN = datetime(2025, 12, 13, 3, 4, 5, tzinfo=timezone.utc)
ONE_DAY = date(1997, 7, 1)


def query(function):
    """Register under the function's name; dates and decimals are given as text,
    which every engine prints alike."""

    @wraps(function)
    def run(spark, sf_dir):
        frame = function(spark, sf_dir)
        return frame.select(
            *[
                F.col(field.name).cast("string").alias(field.name)
                if isinstance(field.dataType, (T.DateType, T.DecimalType))
                else F.col(field.name)
                for field in frame.schema
            ]
        )

    QUERIES[function.__name__.rstrip("_")] = run
    return function


# Part keys of a claim as the first form of the SQL has them: 2^20, so that a claim has its order's lines.
WHOLE_ORDERS = 20


def extract(spark, sf_dir, part_bits=None, **options) -> Extract:
    return Extract(
        testbed.claims(spark, sf_dir, part_bits), testbed.payments(spark, sf_dir), testbed.parameters(spark, sf_dir), **options
    )


def parsed(spark, sf_dir, keys, line_keys=(), part_bits=None, by_id=False) -> DataFrame:
    """The claims with the values that a query names."""
    return parsed_claims(testbed.claims(spark, sf_dir, part_bits, by_id), keys, line_keys)


def narrow(spark, sf_dir, keys=(), line_keys=()) -> Extract:
    """An extract over the claims with few of their values, stored: the documents are made and parsed once."""
    claims = narrow_claims(testbed.claims(spark, sf_dir), keys, line_keys).persist(StorageLevel.MEMORY_AND_DISK)
    return Extract(claims, testbed.payments(spark, sf_dir), testbed.parameters(spark, sf_dir))


def checksum(content) -> F.Column:
    """A number from all 32 digits of the text's hash; sums of it compare sets of texts."""
    eight = lambda at: F.conv(F.substring(F.md5(content), at, 8), 16, 10).cast("bigint")
    return eight(1) + eight(9) * 3 + eight(17) * 5 + eight(25) * 7


# Scans and parameters


@query
def scan_claims(spark, sf_dir):
    keys = ("macId", "receiptDate", "planCode", "internalControlNumber", "totalBilledAmount")
    return parsed(spark, sf_dir, keys).select(
        "id",
        F.col("claim.macId").alias("mac_id"),
        F.col("claim.receiptDate").alias("receipt_date"),
        F.col("claim.planCode").alias("plan_code"),
        F.col("claim.internalControlNumber").alias("icn"),
        F.col("claim.totalBilledAmount").alias("total_billed"),
    )


@query
def scan_payments(spark, sf_dir):
    return payments.parsed_payments(testbed.payments(spark, sf_dir)).select(
        "claim_id",
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("created_at"),
        F.col("payment.interestRate").alias("interest_rate"),
        F.col("payment.interestDaysOver").alias("interest_days_over"),
    )


@query
def extract_parameters_list(spark, sf_dir):
    """A list of days given by the caller, joined with the orders received then."""
    days = extract_parameters(spark, [ONE_DAY, date(1998, 1, 1), date(1998, 10, 1)], RUN)
    keys = claim_keys(testbed.claims(spark, sf_dir))
    return (
        selection.claims_on_date(keys, days)
        .groupBy("extract_date")
        .agg(F.count(F.lit(1)).alias("claims"))
        .join(days, "extract_date")
        .select("extract_date", F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss").alias("run_at"), "claims")
    )


@query
def extract_parameters_(spark, sf_dir):
    return testbed.parameters(spark, sf_dir).select(
        "extract_date", F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss").alias("run_at")
    )


# Selection, phase, totals


@query
def claims_on_date(spark, sf_dir):
    days = extract_parameters(spark, ONE_DAY, RUN)
    return selection.claims_on_date(claim_keys(testbed.claims(spark, sf_dir)), days).select(
        "extract_date", "id", "mac_id", "line_count"
    )


@query
def claim_phase(spark, sf_dir):
    return extract(spark, sf_dir).phased.select("extract_date", "mac_id", "phase", F.col("id").alias("claim_id"))


@query
def claim_key(spark, sf_dir):
    run = narrow(spark, sf_dir, ("planCode", "internalControlNumber"))
    return selection.claim_key(run.phased, parsed_claims(run.claims))


@query
def claim_key_semi(spark, sf_dir):
    run = narrow(spark, sf_dir, ("planCode",))
    all_claims = parsed_claims(run.claims).select("id", F.col("claim.planCode").alias("plan_code"))
    return selection.with_claim_key(all_claims, run.phased.select(F.col("id").alias("claim_id")))


@query
def mac_dimension(spark, sf_dir):
    return extract(spark, sf_dir).mac_dimension()


@query
def mac_totals(spark, sf_dir):
    return extract(spark, sf_dir).mac_totals()


@query
def mac_totals_strict(spark, sf_dir):
    return extract(spark, sf_dir, strict_nulls=True).mac_totals()


# Payments


@query
def payment_flat(spark, sf_dir):
    return payments.payment_flat(testbed.payments(spark, sf_dir))


def _latest_columns(frame):
    paid = json_text.parse_payment(F.col("payment_response_json"))
    return frame.withColumn("payment", paid).select(
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("created_at"),
        F.col("payment.beneCheck.claimAmount").alias("bene_amount"),
        F.col("payment.providerCheck.checkNumber").alias("provider_check"),
        *[name for name in ("claim_id", "id") if name in frame.columns],
    )


@query
def latest_payment(spark, sf_dir):
    return _latest_columns(payments.latest_payment(testbed.payments(spark, sf_dir)))


@query
def latest_payment_lateral(spark, sf_dir):
    claims = testbed.claims(spark, sf_dir).select("id")
    return _latest_columns(payments.latest_payment_lateral(claims, testbed.payments(spark, sf_dir)))


# Sequences and lines


@query
def claim_sequence(spark, sf_dir):
    return extract(spark, sf_dir).numbered.select(
        "extract_date", "mac_id", "phase", F.col("id").alias("claim_id"), "claim_sequence",
        lines.claim_record_sequence(F.col("claim_sequence")).alias("record_sequence"),
    )


@query
def service_lines(spark, sf_dir):
    line_keys = ("serviceLineNumber", "billedAmount", "cmsServiceDate")
    return lines.service_lines(parsed(spark, sf_dir, (), line_keys)).select(
        "id",
        F.col("position").cast("bigint").alias("position"),
        F.col("line.serviceLineNumber").alias("line_number"),
        F.col("line.billedAmount").alias("billed"),
        F.col("line.cmsServiceDate").alias("service_date"),
    )


@query
def line_sequence(spark, sf_dir):
    run = narrow(spark, sf_dir, line_keys=("serviceLineNumber", "providerServiceLineId"))
    return lines.line_sequences(run.numbered, parsed_claims(run.claims)).select(
        "extract_date", "mac_id", "phase", "claim_id", "claim_sequence", "line_sequence", "record_sequence",
        F.col("line.serviceLineNumber").alias("line_number"),
        F.col("line.providerServiceLineId").alias("line_id"),
    )


# Scalar functions


@query
def json_text_(spark, sf_dir):
    keys = (
        "beneficiaryLastName", "billingProviderNpi", "totalCoinsuranceAmount", "regularDeductibleAmountMet", "isParticipatingProvider",
    )
    return parsed(spark, sf_dir, keys, part_bits=WHOLE_ORDERS).select(
        "id",
        F.col("claim.beneficiaryLastName").alias("last_name"),
        F.col("claim.billingProviderNpi").alias("npi"),
        F.col("claim.totalCoinsuranceAmount").alias("coinsurance"),
        F.col("claim.regularDeductibleAmountMet").alias("deductible_met"),
        F.col("claim.isParticipatingProvider").alias("participating"),
    )


@query
def json_nested(spark, sf_dir):
    return payments.parsed_payments(testbed.payments(spark, sf_dir)).select(
        "claim_id",
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("created_at"),
        F.col("payment.beneCheck.checkNumber").alias("bene_check"),
        F.col("payment.beneCheck.couldNotBeForwarded").alias("bene_not_forwarded"),
        F.col("payment.providerCheck.higlasClaimCheckNumber").alias("provider_eob"),
    )


@query
def json_index(spark, sf_dir):
    codes = F.col("claim.diagnosisCodes")
    return parsed(spark, sf_dir, ("diagnosisCodes",)).select(
        "id", F.get(codes, F.lit(0)).alias("first_code"), F.get(codes, F.lit(2)).alias("third_code")
    )


@query
def json_array_len(spark, sf_dir):
    return claim_keys(testbed.claims(spark, sf_dir, WHOLE_ORDERS)).select("id", "line_count")


@query
def json_array_text(spark, sf_dir):
    line_keys = ("cutbackAmounts", "healthcareCommonProcedureCodeModifiers")
    return lines.service_lines(parsed(spark, sf_dir, (), line_keys)).select(
        "id",
        F.col("position").cast("bigint").alias("position"),
        json_text.spaced_json(F.col("line.cutbackAmounts")).alias("cutbacks"),
        json_text.spaced_json(F.col("line.healthcareCommonProcedureCodeModifiers")).alias("modifiers"),
    )


@query
def json_nested_digits(spark, sf_dir):
    """Objects and mixed arrays read as text, from documents made of the line items."""
    price, share = (F.col(x).cast("decimal(12,2)").cast("string") for x in ("l_extendedprice", "l_discount"))
    document = F.format_string(
        '{"macId":"1","cutbackAmounts":{"paid":%s,"steps":["%s",%s,[%s]]},"serviceLines":[{"cutbackAmounts":[ %s, "%s" ]}]}',
        price, "l_returnflag", share, price, share, "l_linestatus",
    )
    lines_ = testbed.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", json_text.parse_claim(document).alias("claim")
    )
    return lines_.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        json_text.spaced_json(F.col("claim.cutbackAmounts")).alias("cutbacks"),
        json_text.spaced_json(F.col("claim.serviceLines")[0]["cutbackAmounts"]).alias("line_cutbacks"),
    )


@query
def pad_scalars(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    return testbed.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.left_pad(key, 3, "0").alias("short_left"),
        text.left_pad(key, 13, "0").alias("long_left"),
        text.left_pad(price, 7, " ").alias("price_left"),
        text.right_pad(price, 12).alias("price_right"),
        text.right_pad(F.col("o_orderpriority"), 6).alias("priority"),
        text.right_pad(F.lit(""), 4).alias("blank"),
        text.left_pad(F.lit(""), 4, "0").alias("zeros"),
    )


@query
def coalesce_fallback(spark, sf_dir):
    keys = ("internalControlNumber", "billedAmount", "healthcareCommonProcedureCode", "renderingProviderPtan")
    frame = parsed(spark, sf_dir, keys, keys).select("id", "claim", F.posexplode("claim.serviceLines").alias("position", "line"))
    pick = lambda key, default: F.coalesce(f"line.{key}", f"claim.{key}", F.lit(default))
    return frame.select(
        "id",
        F.col("position").cast("bigint").alias("position"),
        pick("internalControlNumber", "0").alias("icn"),
        pick("billedAmount", "0").alias("billed"),
        pick("healthcareCommonProcedureCode", " ").alias("procedure_code"),
        pick("renderingProviderPtan", "").alias("ptan"),
    )


@query
def date_text(spark, sf_dir):
    frame = parsed(spark, sf_dir, ("serviceEndDate", "cmsServiceDate"))
    slot = lambda value, blank: text.left_pad(text.date_text(F.coalesce(value, F.lit("0")), blank), 8, "0")
    return frame.select(
        "id",
        slot(F.col("claim.serviceEndDate"), "").alias("end_date"),
        slot(F.col("claim.cmsServiceDate"), " ").alias("line_date"),
    )


@query
def text_scalars(spark, sf_dir):
    mbi = F.col("claim.medicareBeneficiaryIdentifier")
    return parsed(spark, sf_dir, ("medicareBeneficiaryIdentifier", "internalControlNumber")).select(
        "id",
        F.left(mbi, F.lit(11)).alias("mbi"),
        F.length(mbi).cast("bigint").alias("mbi_length"),
        F.length(F.coalesce("claim.internalControlNumber", F.lit(""))).cast("bigint").alias("icn_length"),
    )


@query
def record_concat(spark, sf_dir):
    """A NULL part makes the whole text NULL."""
    return parsed(spark, sf_dir, ("planCode", "internalControlNumber", "beneficiaryGender")).select(
        "id",
        F.concat(
            "claim.planCode", F.lit("|"), "claim.internalControlNumber", F.lit("|"), "claim.beneficiaryGender"
        ).alias("joined"),
    )


@query
def diag_flags(spark, sf_dir):
    code = F.get("claim.diagnosisCodes", F.lit(0))
    return parsed(spark, sf_dir, ("diagnosisCodes",)).select(
        "id",
        code.alias("code"),
        text.type_by_letter(code).alias("type_by_letter"),
        text.type_by_length(code).alias("type_by_length"),
    )


@query
def date_format_set(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    return testbed.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format(day, "yyyy-MM-dd").alias("iso"),
        F.date_format(day, "yyyyMMdd").alias("packed"),
        F.date_format(F.date_sub(day, 1), "yyMMdd").alias("day_before"),
    )


@query
def typed_casts(spark, sf_dir):
    frame = payments.parsed_payments(testbed.payments(spark, sf_dir))
    bene = F.col("payment.beneCheck.claimInterestAmount")
    return frame.select(
        "claim_id",
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("created_at"),
        F.col("payment.interestRate").try_cast("decimal(10,5)").alias("rate"),
        bene.try_cast("decimal(9,2)").alias("interest"),
        text.number_text(bene).alias("interest_text"),
        text.whole_number(F.col("payment.interestDaysOver")).alias("days"),
        text.number_text(F.concat(F.lit("+00"), F.col("payment.beneCheck.claimAmount"))).alias("tidied"),
        text.number_text(F.concat(F.col("payment.beneCheck.claimAmount"), F.lit("e2"))).alias("shifted"),
    )


@query
def boolean_flags(spark, sf_dir):
    word = F.col("claim.isParticipatingProvider")
    return parsed(spark, sf_dir, ("isParticipatingProvider",)).select(
        "id", text.flag(word).alias("flag"), text.yes_no(text.flag(word), "P", "N").alias("participation")
    )


# Record sections


@query
def file_header(spark, sf_dir):
    return extract(spark, sf_dir).file_header()


@query
def claim_header(spark, sf_dir):
    return extract(spark, sf_dir).all_records("CLAIM_HEADER").drop("line_sequence")


@query
def claim_line(spark, sf_dir):
    return extract(spark, sf_dir).all_records("CLAIM_LINE")


@query
def file_trailer(spark, sf_dir):
    return extract(spark, sf_dir).file_trailer()


@query
def file_trailer_strict(spark, sf_dir):
    return extract(spark, sf_dir, strict_nulls=True).file_trailer()


@query
def file_metadata(spark, sf_dir):
    return extract(spark, sf_dir, WHOLE_ORDERS).file_metadata()


@query
def all_records(spark, sf_dir):
    content = F.col("record_content")
    return extract(spark, sf_dir).all_records().select(
        "extract_date", "file_name", "mac_id", "phase", "record_type",
        "record_sequence", "claim_sequence", "line_sequence",
        F.length(content).cast("bigint").alias("record_length"),
        F.md5(content).alias("record_md5"),
    )


@query
def final_extract(spark, sf_dir):
    return extract(spark, sf_dir).final()


@query
def final_extract_strict(spark, sf_dir):
    return extract(spark, sf_dir, strict_sequence=True, strict_nulls=True).final().select(
        "file_name", "record_type", "record_sequence", F.md5("record_content").alias("record_md5")
    )


# Result tables and files


@query
def read_result_table_(spark, sf_dir):
    path = scratch_path(spark, "result-table")
    testbed.result_lines(spark, sf_dir).write.text(path)
    return accepted(read_result_table(spark, path))


@query
def rejects(spark, sf_dir):
    return rejected(parse_result_lines(testbed.result_lines(spark, sf_dir))).select(
        "file_name", "record_type", "record_sequence", "reject_reason"
    )


@query
def clip_records_(spark, sf_dir):
    return clip_records(accepted(parse_result_lines(testbed.result_lines(spark, sf_dir)))).select(
        "record_sequence", "record_type", "record_content"
    )


def _per_file(written):
    return written.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.length("value")).alias("characters"),
        F.sum(checksum(F.col("value"))).alias("checksum"),
    )


@query
def split_extract(spark, sf_dir):
    path = scratch_path(spark, "split")
    split_result(parse_result_lines(testbed.result_lines(spark, sf_dir)), path)
    return _per_file(read_files(spark, path))


@query
def sink_readback(spark, sf_dir):
    path = scratch_path(spark, "extract")
    extract(spark, sf_dir).write(path, records_per_part=500, compression="gzip")
    return _per_file(read_files(spark, path))


@query
def sink_two_runs(spark, sf_dir):
    """Two runs into one folder, the first of them again."""
    path = scratch_path(spark, "extract")
    days = testbed.parameters(spark, sf_dir)
    for half in ("month(extract_date) < 6", "month(extract_date) > 6", "month(extract_date) < 6"):
        Extract(testbed.claims(spark, sf_dir), testbed.payments(spark, sf_dir), days.where(half)).write(path, compression="gzip")
    return _per_file(read_files(spark, path))


def _positions(spark, path):
    """Each line of each file with its position, from the parts as written."""
    whole = read_whole(spark, path)
    held = whole.groupBy("file_name", "part").agg(F.count(F.lit(1)).alias("held"))
    earlier = Window.partitionBy("file_name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("file_name", "part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("start"))
    return whole.join(starts, ["file_name", "part"]).select(
        "file_name", (F.col("start") + F.col("line")).alias("position"), F.md5("value").alias("md5")
    )


@query
def sink_order(spark, sf_dir):
    path = scratch_path(spark, "extract")
    extract(spark, sf_dir).write(path, records_per_part=500, compression="gzip")
    return _positions(spark, path)


@query
def stored_relation(spark, sf_dir):
    path = scratch_path(spark, "relation")
    extract(spark, sf_dir).store(path, records_per_part=500)
    return positions(read_relation(spark, path)).select(
        "file_name", "position", "mac_id", "phase", "record_type", "record_sequence", "claim_sequence", "line_sequence",
        F.md5("record_content").alias("md5"),
    )


@query
def split_order(spark, sf_dir):
    path = scratch_path(spark, "split")
    split_result(parse_result_lines(testbed.result_lines(spark, sf_dir)), path, claims_per_part=50)
    return _positions(spark, path)


def _written_claims(spark, sf_dir):
    """The claims in files of JSON text, as deliveries come: made once, whatever the number of deliveries."""
    path = scratch_path(spark, "documents")
    with finer_tasks(spark):
        testbed.claims(spark, sf_dir).write.option("compression", "zstd").parquet(path)
    return read_claims(spark, path)


@query
def stage_two_deliveries(spark, sf_dir):
    path = scratch_path(spark, "claims")
    claims = _written_claims(spark, sf_dir)
    for delivery, part in (("a", "id % 2 = 0"), ("b", "id % 2 = 1"), ("b", "id % 2 = 1")):
        stage_claims(claims.where(part), path, delivery)
    staged = read_staged_claims(spark, path)
    return staged.groupBy("receipt_date", "delivery").agg(
        F.count(F.lit(1)).alias("claims"), F.coalesce(F.sum(F.greatest("line_count", F.lit(0))), F.lit(0)).alias("lines")
    )


def _delivered_twice(spark, sf_dir):
    """Claims in deliveries ``a`` and ``b``, those of ``b`` again with another date in ``c``, and ``b`` anew without some."""
    path = scratch_path(spark, "claims")
    claims = _written_claims(spark, sf_dir)
    moved = F.regexp_replace("claim_jsonb", r'("receiptDate":")\d{4}', "$11900")
    stage_claims(claims.where("id % 4 < 3"), path, "a")
    stage_claims(claims.where("id % 4 > 0"), path, "b")
    stage_claims(claims.where("id % 4 = 1").withColumn("claim_jsonb", moved), path, "c")
    stage_claims(claims.where("id % 4 > 1"), path, "b")
    return read_staged_claims(spark, path)


@query
def stage_same_claim_twice(spark, sf_dir):
    return _delivered_twice(spark, sf_dir).groupBy("receipt_date", "delivery").agg(
        F.count(F.lit(1)).alias("claims"), F.countDistinct("id").alias("ids"),
        F.coalesce(F.sum(F.greatest("line_count", F.lit(0))), F.lit(0)).alias("lines"),
    )


@query
def extract_same_claim_twice(spark, sf_dir):
    """The records of claims that came in several deliveries; those that were moved are of no wanted day."""
    run = Extract(_delivered_twice(spark, sf_dir), testbed.payments(spark, sf_dir), testbed.parameters(spark, sf_dir))
    return _per_kind(run.all_records())


def _per_kind(rows):
    return rows.groupBy("extract_date", "mac_id", "phase", "record_type").agg(
        F.count(F.lit(1)).alias("records"), F.sum(checksum(F.col("record_content"))).alias("checksum")
    )


# Checks


@query
def document_rejects(spark, sf_dir):
    return record_checks.document_rejects(testbed.damaged_claims(spark, sf_dir))


@query
def damaged_totals(spark, sf_dir):
    run = Extract(testbed.damaged_claims(spark, sf_dir), testbed.payments(spark, sf_dir), testbed.parameters(spark, sf_dir))
    return run.mac_totals()


@query
def records_per_file(spark, sf_dir):
    return record_checks.records_per_file(extract(spark, sf_dir).all_records())


@query
def file_count(spark, sf_dir):
    return record_checks.file_count(extract(spark, sf_dir).all_records())


@query
def record_widths(spark, sf_dir):
    return record_checks.record_widths(extract(spark, sf_dir).all_records())


@query
def trailer_reconcile(spark, sf_dir):
    return record_checks.trailer_reconcile(extract(spark, sf_dir).all_records())


@query
def document_findings(spark, sf_dir):
    paid = payments.parsed_payments(testbed.payments(spark, sf_dir))
    return record_checks.claim_findings(testbed.claims(spark, sf_dir)).unionByName(record_checks.payment_findings(paid))


@query
def layout_dedupe(spark, sf_dir):
    return layout_checks.dedupe(testbed.layout_fields(spark, sf_dir))


@query
def layout_length(spark, sf_dir):
    return layout_checks.length_mismatches(layout_checks.dedupe(testbed.layout_fields(spark, sf_dir)))


@query
def layout_gap_overlap(spark, sf_dir):
    return layout_checks.gaps_and_overlaps(layout_checks.dedupe(testbed.layout_fields(spark, sf_dir)))


@query
def layout_padding(spark, sf_dir):
    return layout_checks.padding_warnings(layout_checks.dedupe(testbed.layout_fields(spark, sf_dir)))


@query
def layout_summary(spark, sf_dir):
    return layout_checks.summary(testbed.layout_fields(spark, sf_dir))


# The older variant


@query
def adhoc_header_fanout(spark, sf_dir):
    return adhoc.header_fanout(extract(spark, sf_dir).phased, testbed.payments(spark, sf_dir))


@query
def adhoc_width_drift(spark, sf_dir):
    return layout_checks.width_drift(layout_checks.dedupe(testbed.layout_fields(spark, sf_dir)))


def _older(rows, content="record_content", *others):
    return rows.groupBy("extract_date", "mac_id", "phase").agg(
        F.count(F.lit(1)).alias("records"),
        F.min(F.length(content)).alias("shortest"),
        F.max(F.length(content)).alias("longest"),
        F.sum(checksum(F.col(content))).alias("checksum"),
        *others,
    )


@query
def adhoc_claim_header(spark, sf_dir):
    run = extract(spark, sf_dir)
    return _older(adhoc.older_headers(run.numbered, parsed(spark, sf_dir, records.HEADER_KEYS, by_id=True), testbed.payments(spark, sf_dir)))


@query
def adhoc_claim_line(spark, sf_dir):
    """The older lines, and how many characters the splitter takes off each."""
    older = extract(spark, sf_dir).all_records("CLAIM_LINE").withColumn("record_content", adhoc.older_line(F.col("record_content")))
    cut = clip_records(older.withColumn("whole", F.col("record_content")))
    return _older(cut, "whole", F.max(F.length("whole") - F.length("record_content")).alias("lost"))
