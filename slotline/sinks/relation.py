"""The ordered result relation as a Parquet table.

``<path>/file_name=<name>/`` holds a file's records in order: by the numbers in the names of its Parquet files, then by
the row's place in the Parquet file, which the reader knows. So no column for the order is stored, a row's text is never
taken together with others', and a reader that doesn't need the order pays nothing for it. Writing replaces the
folders of the file names written and leaves all others as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotline.operators.records import RECORD_COLUMNS

_STORED = (
    "mac_id string, phase string, record_type string, record_sequence bigint, claim_sequence bigint, "
    "line_sequence bigint, record_content string, file_name string"
)


def write_relation(records: DataFrame, path: str, content: Column, order: list[Column]) -> None:
    """Store records that lie in tasks by (``file_name``, ``part``); sorted in each task, the text built after."""
    others = [name for name in RECORD_COLUMNS if name != "file_name"]
    (
        records.withColumn("file_name", F.coalesce("file_name", F.lit("")))
        .sortWithinPartitions("file_name", "part", *order)
        .select("file_name", *others, content.alias("record_content"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", 0)
        .partitionBy("file_name")
        .parquet(path)
    )


def read_relation(spark: SparkSession, path: str) -> DataFrame:
    """The eight columns of the relation, with ``part`` and ``row``: records of a file are in the order of both."""
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("bigint")
    stored = spark.read.schema(_STORED).parquet(path)
    return stored.select(*RECORD_COLUMNS, "record_content", part.alias("part"), F.col("_metadata.row_index").alias("row"))


def positions(stored: DataFrame) -> DataFrame:
    """``position`` from 0 within the file in place of ``part`` and ``row``; only counts of parts are numbered."""
    held = stored.groupBy("file_name", "part").agg(F.count(F.lit(1)).alias("held"))
    before = F.sum("held").over(Window.partitionBy("file_name").orderBy("part")) - F.col("held")
    offsets = held.select("file_name", "part", before.alias("before"))
    placed = stored.join(offsets, ["file_name", "part"])
    return placed.withColumn("position", F.col("before") + F.col("row")).drop("part", "row", "before")
