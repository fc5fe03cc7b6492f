"""Claims and payment responses shaped from the star-schema test tables.

The test tables hold no claims, so each order becomes a claim document with its
line items as service lines, and each event a payment response.  Rules:

* ``id`` is the order key; ``macId`` is 10000 + the customer's nation, missing on
  every 97th order; claims are received in quarterly batches.
* A document holds an order's lines of one range of part keys (``2 ** PART_BITS`` of them). Parts grow with the
  lines, some 30 lines each: such a range has about 30,000 lines of all orders at every scale, so a document has
  no more than that, and an order of a third of all lines is many claims of some 10,000 lines each.
* Event ``e`` of user ``u`` pays claim ``100 u + e mod 29``: no join is needed, and
  the events of one busy user spread over 29 claims.
* Values go missing by simple remainders, to reach every default and fall-back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PART_BITS = 10
# Ids of the second and later documents of one order lie above all order keys.
DOCUMENT_STEP = 1 << 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(column, scale: int = 2) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast(f"decimal(12,{scale})")


def _text(prefix: str, column: Column) -> Column:
    return F.concat(F.lit(prefix), column.cast("string"))


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


# What the lines of a document are made from, beside the order's key.
_LINE_COLUMNS = (
    "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)


def _line(order: Column, row: Column) -> Column:
    part, supplier = row["l_partkey"], row["l_suppkey"]
    return F.struct(
        row["l_linenumber"].alias("serviceLineNumber"),
        F.when(part % 2 == 0, part.cast("string")).alias("internalControlNumber"),
        _unless(supplier % 4 == 0, F.date_format(row["l_shipdate"], "yyyy-MM-dd")).alias("cmsServiceDate"),
        _unless(part % 5 == 0, row["l_returnflag"]).alias("healthCareServiceLocationFacilityCode"),
        _unless(part % 10 == 0, part.cast("string")).alias("healthcareCommonProcedureCode"),
        _unless(part % 3 == 0, F.array(row["l_returnflag"], row["l_linestatus"])).alias("healthcareCommonProcedureCodeModifiers"),
        _unless(part % 50 == 0, _money(row["l_extendedprice"])).alias("billedAmount"),
        _unless(part % 6 == 0, _money(row["l_extendedprice"]).cast("string")).alias("allowedAmount"),
        F.when(part % 2 == 1, F.array(_text("Z", row["l_linenumber"]))).alias("diagnosisCodes"),
        _money(row["l_quantity"]).alias("paidToProviderAmount"),
        _money(row["l_discount"]).alias("paidToBeneficiaryAmount"),
        F.when(row["l_quantity"] >= 25, _money(row["l_tax"])).alias("appliedToDeductibleAmount"),
        _money(row["l_tax"]).alias("coinsuranceAmount"),
        _unless(part % 7 == 0, F.array(_money(row["l_discount"]), _money(row["l_tax"]))).alias("cutbackAmounts"),
        _unless(supplier % 9 == 0, (supplier + 1400000000).cast("string")).alias("renderingProviderNpi"),
        _unless(supplier % 8 == 0, _text("L", supplier)).alias("renderingProviderPtan"),
        _unless(supplier % 10 == 0, (supplier % 90).cast("string")).alias("renderingProviderSpecialtyCode"),
        F.concat_ws("-", order, row["l_linenumber"], row["l_partkey"]).alias("providerServiceLineId"),
        _unless(part % 4 == 0, _text("FACILITY ", part)).alias("serviceFacilityLocationLastOrOrganizationName"),
        _unless(part % 4 == 0, _text("ROAD ", supplier)).alias("serviceFacilityLocationAddressLine1"),
        _unless(part % 4 == 0, _text("CITY ", supplier)).alias("serviceFacilityLocationCity"),
        _unless(part % 4 == 0, row["l_linestatus"]).alias("serviceFacilityLocationState"),
        _unless(part % 4 == 0, (supplier + 10000).cast("string")).alias("serviceFacilityLocationZipCode"),
    )


def _lines(order: Column, rows: Column) -> Column:
    """The lines of a document from its rows, by part and not by line number, so that numbering has work to do."""
    keys = ("l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    keyed = F.transform(rows, lambda row: F.struct(*[row[key].alias(key) for key in keys], _line(order, row).alias("line")))
    return F.array_sort(keyed)["line"]


def _id(order: str, document: str) -> Column:
    return F.col(order) + F.coalesce(document, F.lit(0)) * F.lit(DOCUMENT_STEP)


def _documents(lineitem: DataFrame, *dealt_by: str) -> DataFrame:
    """``rows_id, l_orderkey, rows_document, rows``: the line items of an order and a range of parts.

    They are dealt by document as they are read, by ``dealt_by``, and become lines after the last shuffle: a line is some
    ten times as large, and a partial aggregate of a whole split before the shuffle would merge next to nothing and spill.
    """
    placed = lineitem.select(
        _id("l_orderkey", "document").alias("rows_id"), "l_orderkey", F.col("document").alias("rows_document"), *_LINE_COLUMNS
    ).repartition(*dealt_by)
    # An array holds the lines of one document.
    return placed.groupBy("rows_id", "l_orderkey", "rows_document").agg(F.collect_list(F.struct(*_LINE_COLUMNS)).alias("rows"))


def claims(spark: SparkSession, sf_dir: str, part_bits: int | None = None, by_id: bool = True) -> DataFrame:
    """``(id, claim_jsonb)``; ``part_bits`` in place of ``PART_BITS``.

    The claims lie by id: the orders' few values are shuffled once for each of their documents, so that neither
    the documents nor their lines have to move again where claims are joined by id. For a single step that reads them all,
    ``by_id=False`` spares the second reading of the line items that this takes.
    """
    bits = PART_BITS if part_bits is None else part_bits
    lineitem = table(spark, sf_dir, "lineitem").withColumn("document", F.shiftright("l_partkey", bits))
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", _money("c_acctbal").alias("balance"), "c_mktsegment"
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", _money("o_totalprice").alias("price"),
        F.col("o_orderdate").cast("date").alias("day"), "o_orderpriority",
    )
    headed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    if not by_id:
        rows = _documents(lineitem, "l_orderkey", "rows_document")
        joined = headed.join(rows, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        return joined.select(_id("o_orderkey", "rows_document").alias("id"), F.to_json(_document()).alias("claim_jsonb"))
    # A struct, as a range may be NULL and sets leave NULL out.
    ranges = lineitem.groupBy("l_orderkey").agg(F.collect_set(F.struct("document")).alias("ranges"))
    headed = (
        headed.join(ranges, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select("*", F.explode_outer("ranges").alias("range"))
        .select(*orders.columns, *customer.columns, F.col("range.document").alias("document"))
        .withColumn("id", _id("o_orderkey", "document"))
    )
    rows = _documents(lineitem, "rows_id")
    # Rows meet by id alone, the only column that they are dealt by. That they are of the same order and range is not written as
    # an equality, as Spark would deal both sides again by all columns that are compared so.
    missing, rows_missing = F.col("document").isNull(), F.col("rows_document").isNull()
    same_order = (F.col("o_orderkey") <= F.col("l_orderkey")) & (F.col("o_orderkey") >= F.col("l_orderkey"))
    same_range = (missing & rows_missing) | (~missing & ~rows_missing)
    joined = headed.join(rows, (F.col("id") == F.col("rows_id")) & same_order & same_range, "left")
    return joined.select("id", F.to_json(_document()).alias("claim_jsonb"))


def _document() -> Column:
    key, day, price = F.col("o_orderkey"), F.col("day"), F.col("price")
    iso = lambda d: F.date_format(d, "yyyy-MM-dd")
    # A letter and three to seven digits.
    code = F.concat(
        F.char(F.lit(65) + key % 26),
        F.left((key + 1000000).cast("string"), (F.lit(3) + key % 5).cast("int")),
    )
    words = F.array(*[F.lit(w) for w in ("true", "on", "f", "no", "1")])
    return F.struct(
        _unless(key % 97 == 0, (F.col("c_nationkey") + 10000).cast("string")).alias("macId"),
        iso(F.trunc(day, "quarter")).alias("receiptDate"),
        F.left("o_orderpriority", F.lit(1)).alias("planCode"),
        _unless(key % 11 == 0, key.cast("string")).alias("internalControlNumber"),
        F.col("c_mktsegment").alias("beneficiaryLastName"),
        F.col("c_name").alias("beneficiaryFirstName"),
        F.col("o_orderstatus").alias("beneficiaryGender"),
        (F.col("o_custkey") + 1000000000).alias("billingProviderNpi"),
        _unless(key % 12 == 0, (F.col("c_nationkey") + 900000000).cast("string")).alias("billingProviderEin"),
        F.when(key % 2 == 0, "E").otherwise("SYS").alias("billingProviderTinType"),
        F.when(key % 17 == 0, F.array().cast("array<string>"))
        .when(key % 13 != 0, F.array(code, F.lit("U071")))
        .alias("diagnosisCodes"),
        price.cast("string").alias("totalAllowedAmount"),
        F.col("balance").alias("totalCoinsuranceAmount"),
        _unless(key % 5 == 0, (key % 10000).cast("decimal(9,2)")).alias("appliedToDeductibleAmount"),
        price.alias("totalBilledAmount"),
        iso(F.date_sub(day, (key % 30).cast("int"))).alias("serviceStartDate"),
        _unless(key % 7 == 0, iso(day)).alias("serviceEndDate"),
        F.concat(F.lit("207Q-"), "o_orderpriority").alias("providerTaxonomyCode"),
        _unless(key % 3 == 0, (key + 1200000000).cast("string")).alias("referringProviderNpi"),
        _text("P", F.col("o_custkey")).alias("billingProviderPtan"),
        _unless(key % 6 == 0, (key % 300).cast("decimal(9,1)")).alias("regularDeductibleAmountMet"),
        _text("SUBMIT", F.col("c_nationkey")).alias("submitterId"),
        _text("PCN-", key).alias("patientControlNumber"),
        _unless(key % 4 == 0, (key % 500).cast("decimal(9,2)").cast("string")).alias("patientPaidAmount"),
        _text("1EG4TE5MK", key).alias("medicareBeneficiaryIdentifier"),
        _unless(key % 9 == 0, iso(day)).alias("cmsServiceDate"),
        _unless(key % 8 == 0, F.col("c_mktsegment")).alias("healthCareServiceLocationFacilityCode"),
        _unless(key % 10 == 0, (key % 100000).cast("string")).alias("healthcareCommonProcedureCode"),
        F.when(key % 2 == 0, "XY").alias("healthcareCommonProcedureCodeModifiers"),
        F.when(key % 2 == 0, price).alias("billedAmount"),
        F.when(key % 3 == 0, price).alias("allowedAmount"),
        F.get(words, (key % 6).cast("int")).alias("isParticipatingProvider"),
        F.when(key % 3 != 0, F.lit("n/a, none")).alias("cutbackAmounts"),
        (F.col("o_custkey") + 1300000000).cast("string").alias("renderingProviderNpi"),
        _unless(key % 4 == 0, _text("C", F.col("o_custkey"))).alias("renderingProviderPtan"),
        _unless(key % 4 == 0, F.lit("08")).alias("renderingProviderSpecialtyCode"),
        F.col("c_name").alias("serviceFacilityLocationLastOrOrganizationName"),
        _text("STREET ", key).alias("serviceFacilityLocationAddressLine1"),
        _unless(key % 5 == 0, F.lit("TOWN")).alias("serviceFacilityLocationCity"),
        F.lit("NY").alias("serviceFacilityLocationState"),
        _unless(key % 7 == 0, F.lit("10001-1234")).alias("serviceFacilityLocationZipCode"),
        _lines(F.col("l_orderkey"), F.col("rows")).alias("serviceLines"),
    )


def damaged_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The claims, some of them damaged: by the remainder of the id by 50 cut off (7), no object (9),
    or with an element among the lines that is no object (8)."""
    kind, document = F.col("id") % 50, F.col("claim_jsonb")
    odd = F.regexp_replace(document, r'"serviceLines":\[', '"serviceLines":["odd",')
    damaged = F.when(kind == 7, F.expr("left(claim_jsonb, length(claim_jsonb) - 5)")).when(kind == 8, odd).when(kind == 9, "[1]")
    return claims(spark, sf_dir, by_id=False).select("id", damaged.otherwise(document).alias("claim_jsonb"))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(claim_id, created_at, payment_response_json)``"""
    event, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    amount = F.col("value").cast("decimal(9,2)")
    day = F.col("ts").cast("date")
    iso = lambda d: F.date_format(d, "yyyy-MM-dd")
    bene = F.struct(
        _unless(event % 6 == 0, event.cast("string")).alias("checkNumber"),
        kind.alias("checkStatus"),
        amount.alias("claimAmount"),
        _text("H", user).alias("beneHicNumber"),
        iso(day).alias("checkIssueDate"),
        iso(F.date_add(day, 1)).alias("checkStatusDate"),
        _unless(event % 4 == 0, F.when(event % 44 == 1, "n/a").otherwise(amount.cast("string"))).alias("claimInterestAmount"),
        (-amount).alias("claimRecoupmentAmount"),
        (kind == "error").alias("couldNotBeForwarded"),
        F.get_json_object("props", "$.k").alias("higlasClaimCheckNumber"),
    )
    provider = F.struct(
        (event + 5000000).cast("string").alias("checkNumber"),
        F.left(kind, F.lit(1)).alias("checkStatus"),
        amount.cast("string").alias("claimAmount"),
        iso(F.date_add(day, 2)).alias("checkStatusDate"),
        iso(day).alias("checkIssueDate"),
        amount.alias("claimInterestAmount"),
        F.lit("0").alias("claimRecoupmentAmount"),
        F.when(kind == "view", "on").when(kind == "click", "no").when(kind == "error", "Y").alias("couldNotBeForwarded"),
        F.concat(F.lit("E"), event).alias("higlasClaimCheckNumber"),
    )
    document = F.struct(
        F.col("value").cast("decimal(10,5)").alias("interestRate"),
        _unless(event % 8 == 0, F.when(event % 50 == 1, "3.0").otherwise((event % 400).cast("string"))).alias("interestDaysOver"),
        bene.alias("beneCheck"),
        _unless(event % 5 == 0, provider).alias("providerCheck"),
    )
    return table(spark, sf_dir, "events").select(
        (user * 100 + event % 29).alias("claim_id"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.to_json(document).alias("payment_response_json"),
    )


def parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every receipt date, each run on the day after it at 03:04:05."""
    day = F.trunc(F.col("o_orderdate").cast("date"), "quarter")
    dates = table(spark, sf_dir, "orders").select(day.alias("extract_date")).distinct()
    run = F.date_add("extract_date", 1).cast("timestamp") + F.expr("interval '03:04:05' hour to second")
    return dates.select("extract_date", run.alias("run_ts"))


def layout_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layout table with one record type per brand and one field per part.

    Parts lie ten positions apart and are ten times their size wide, so fields
    of a brand leave gaps, overlap or meet; every fifth field is listed twice.
    """
    key, size = F.col("p_partkey"), F.col("p_size").cast("bigint")
    kind = F.when(size % 5 == 0, "-DATE").when(size % 5 == 1, "-NUM").when(size % 5 == 2, "-EOMB-AMT").otherwise("")
    copies = F.when(key % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return table(spark, sf_dir, "part").withColumn("copy", F.explode(copies)).select(
        F.col("p_brand").alias("record_type"),
        F.concat(F.upper(F.replace("p_name", F.lit(" "), F.lit("-"))), kind).alias("field_name"),
        (key * 10 + 1).alias("start"),
        (key * 10 + size * 10).alias("end"),
        F.when(key % 3 == 0, "RPAD").otherwise("LPAD").alias("pad_side"),
        (size * 10 + F.when(key % 7 == 0, 3).otherwise(0)).alias("pad_len"),
        F.when(key % 4 == 0, " ").otherwise("0").alias("pad_char"),
        (key * 2 + F.col("copy")).alias("line"),
    )


def result_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a saved result table, one per order, some broken on purpose."""
    key = F.col("o_orderkey")
    kinds = F.array(*[F.lit(x) for x in ("FILE_HEADER", "CLAIM_HEADER", "CLAIM_LINE", "FILE_TRAILER", "OTHER")])
    mac = ((F.col("o_custkey") % 25) + 10000).cast("string")
    name = F.when(key % 50 == 2, "  ").otherwise(F.concat(F.lit(" P.IDR.IN.EFT.MAP.P2."), mac, F.lit(".txt ")))
    text = F.concat_ws("  ", "o_orderstatus", F.rpad("o_orderpriority", 20, " "), _money("o_totalprice").cast("string"))
    content = (
        F.when(key % 50 == 3, "")
        .when(key % 50 == 4, F.rpad(text, 5700, "x"))
        .when(key % 50 == 5, F.concat(text, F.lit("|cut off")))
        .otherwise(F.rpad(text, (key % 10 + 38).cast("int"), F.lit(" ")))
    )
    keys = F.concat_ws(
        "|", F.lit(""), name, mac, F.lit("P2"), F.get(kinds, (key % 5).cast("int")),
        key, F.floor(key / 10), F.when(key % 3 != 0, (key % 7).cast("string")).otherwise(""),
    )
    line = F.when(key % 50 == 1, keys).otherwise(F.concat(keys, F.lit("|"), content, F.lit("|")))
    heading = [
        "|file_name|mac_id|phase|record_type|record_sequence|claim_sequence|line_sequence|record_content|",
        "|---|---|---|---|---:|---:|---:|---|",
        "   ",
    ]
    lines = F.when(key == 0, F.array(*[F.lit(x) for x in heading], line)).otherwise(F.array(line))
    return table(spark, sf_dir, "orders").select(F.explode(lines).alias("value"))
