"""Claim and payment-response tables.

Claims are ``(id BIGINT, claim_jsonb STRING)``.  A staged claim table instead has
the document as a ``claim STRUCT``, parsed once for all later runs, and ``mac_id``,
``receipt_date`` and ``line_count`` as columns.  It is laid out by ``receipt_date`` and
the ``delivery`` that brought the claims: selecting a day then reads that day's files only, and selecting and numbering
claims reads no part of the documents.  A claim that several deliveries brought counts once, as its latest delivery has it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotline.functions.json_text import CLAIM_SCHEMA, line_count, parse_claim, parse_claim_key, parse_claim_values
from slotline.session import finer_tasks
from slotline.sources.deliveries import current_rows, finish_run

CLAIM_TABLE = "id bigint, claim_jsonb string"
PAYMENT_TABLE = "claim_id bigint, created_at timestamp, payment_response_json string"
STAGED_TABLE = (
    T.StructType()
    .add("id", T.LongType())
    .add("claim", CLAIM_SCHEMA)
    .add("mac_id", T.StringType())
    .add("line_count", T.LongType())
    .add("receipt_date", T.StringType())
    .add("delivery", T.StringType())
)


def read_claims(spark: SparkSession, path: str, format: str = "parquet", **options: str) -> DataFrame:
    """Claims as JSON text from files."""
    return spark.read.format(format).options(**options).schema(CLAIM_TABLE).load(path)


def read_staged_claims(spark: SparkSession, path: str) -> DataFrame:
    """Claims as written by :func:`stage_claims`, each once; receipt dates stay text."""
    return current_rows(_all_runs(spark, path), path).select(*STAGED_TABLE.names)


def _all_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(T.StructType(STAGED_TABLE.fields + [T.StructField("run", T.StringType())])).parquet(path)


def read_payments(spark: SparkSession, path: str, format: str = "parquet", **options: str) -> DataFrame:
    return spark.read.format(format).options(**options).schema(PAYMENT_TABLE).load(path)


def read_jdbc(
    spark: SparkSession, url: str, table: str, id_column: str, lower: int, upper: int, partitions: int, **options: str
) -> DataFrame:
    """A live table read in ``partitions`` id ranges, one query per task."""
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", id_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .options(**options)
        .load()
    )


def is_staged(claims: DataFrame) -> bool:
    """Whether the documents are parsed already."""
    return {"claim", "mac_id", "receipt_date", "line_count"} <= set(claims.columns)


def is_delivered(claims: DataFrame) -> bool:
    """Whether the claims are of a staged table, which has each of them once."""
    return is_staged(claims) and "delivery" in claims.columns


def claim_keys(claims: DataFrame) -> DataFrame:
    """``(id, mac_id, receipt_date, line_count)``, the narrow side of the claims.

    A one-element ``inline`` keeps later filters on these columns above the
    parser; pushed below it, every filter would parse the documents again.
    """
    return (claims if is_staged(claims) else keyed_claims(claims)).select("id", "mac_id", "receipt_date", "line_count")


def keyed_claims(claims: DataFrame) -> DataFrame:
    """Claims as JSON text with ``mac_id``, ``receipt_date`` and ``line_count``."""
    return claims.select("id", "claim_jsonb", F.inline(F.array(parse_claim_key(F.col("claim_jsonb"))))).select(
        "id",
        "claim_jsonb",
        F.col("macId").alias("mac_id"),
        F.col("receiptDate").alias("receipt_date"),
        line_count(F.col("serviceLines"), F.col("claim_jsonb")).alias("line_count"),
    )


def parsed_claims(claims: DataFrame, keys=None, line_keys=()) -> DataFrame:
    """``(id, claim STRUCT)``: each document parsed once, as a whole or for the values of some keys.

    A one-element ``inline`` keeps later filters above the parser, such as those that Spark derives from exploding lines.
    """
    if is_staged(claims):
        return claims.select("id", "claim")
    return claims.select("id", F.inline(F.array(F.struct(_claim(keys, line_keys).alias("claim")))))


def _claim(keys, line_keys) -> Column:
    document = F.col("claim_jsonb")
    return parse_claim(document) if keys is None else parse_claim_values(document, keys, line_keys)


def narrow_claims(claims: DataFrame, keys=(), line_keys=()) -> DataFrame:
    """``(id, claim, mac_id, receipt_date, line_count)`` of claims as JSON text, with the values of some keys as the claim.

    For a run that needs few values of a document in several steps: stored by the caller, these rows are read again
    where the documents would be read, parsed and shuffled once a step. Claims may come twice, as in the text.
    """
    keyed = claims.select("id", "claim_jsonb", F.inline(F.array(parse_claim_key(F.col("claim_jsonb"))))).select(
        "id",
        F.col("macId").alias("mac_id"),
        F.col("receiptDate").alias("receipt_date"),
        line_count(F.col("serviceLines"), F.col("claim_jsonb")).alias("line_count"),
        F.inline(F.array(F.struct(_claim(keys, line_keys).alias("claim")))),
    )
    return keyed.select("id", "claim", "mac_id", "receipt_date", "line_count")


def stage_claims(claims: DataFrame, path: str, delivery: str = "0") -> None:
    """Add a delivery of claims to the typed table at ``path``, laid out by receipt date, delivery and run.

    Staging a delivery again replaces all that it brought; other deliveries stay, and a claim in several counts
    as the last of them has it (see :mod:`slotline.sources.deliveries`).  A delivery with a claim twice is refused,
    and nothing changes.  Each task writes few days, as a file of so many columns costs as much as hundreds of claims;
    adaptive execution cuts a busy day into many tasks and files, in which ids are in order. Documents are
    shuffled as text and parsed whole after that.
    """
    run = uuid.uuid4().hex
    placed = (
        claims.select("id", "claim_jsonb", F.inline(F.array(parse_claim_key(F.col("claim_jsonb")))))
        .select("id", "claim_jsonb", F.col("receiptDate").alias("receipt_date"))
        .hint("rebalance", "receipt_date")
        .sortWithinPartitions("receipt_date", "id")
    )
    typed = placed.withColumn("claim", parse_claim(F.col("claim_jsonb"))).select(
        "id",
        "claim",
        F.col("claim.macId").alias("mac_id"),
        F.size("claim.serviceLines").cast("bigint").alias("line_count"),
        "receipt_date",
        F.lit(delivery).alias("delivery"),
        F.lit(run).alias("run"),
    )
    with finer_tasks(claims.sparkSession):
        typed.write.mode("append").partitionBy("receipt_date", "delivery", "run").parquet(path)
    finish_run(_all_runs(claims.sparkSession, path), path, delivery, run)
