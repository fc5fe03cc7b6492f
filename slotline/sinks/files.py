"""One folder of ordered text files per output file.

``<path>/file_name=<name>/`` holds the records of a file; its text is its files in the
order of the numbers in their names (as text, names of more than five digits sort elsewhere).  Writing replaces the folders of the file names written, whole,
and leaves all others as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotline.layouts.records import LAYOUTS
from slotline.operators.lines import CLAIM_STEP
from slotline.operators.records import section_rank
from slotline.sources.result_table import accepted

# A header's part and a trailer's in a split, before and after any part of the body.
FIRST_PART, LAST_PART = -1, 1 << 62


def in_task_order(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``rows`` dealt to tasks in the order of ``(file_name, part)``, the same number of parts to each.

    ``parts`` has a row for each part there may be; parts are far fewer than rows,
    and what is written by earlier tasks gets lower numbers in file names.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.row_number().over(Window.orderBy("file_name", "part")) - 1
    task = F.floor(place * tasks / F.count(F.lit(1)).over(Window.partitionBy()))
    dealt = parts.select("file_name", "part", task.cast("int").alias("task"))
    return rows.join(dealt, ["file_name", "part"]).repartitionById(tasks, "task").drop("task")


def write_files(
    records: DataFrame, path: str, content: Column, order: list[Column], compression: str = "none"
) -> None:
    """Write records that lie in tasks by (``file_name``, ``part``); padded records shrink much by ``compression``.

    The sort is local to each task and runs on whatever ``records`` holds; the
    text ``content`` is built after it.  A name known not to be NULL spares the
    writer a projection, after which it would sort the text by name once more.
    """
    (
        records.withColumn("file_name", F.coalesce("file_name", F.lit("")))
        .sortWithinPartitions("file_name", "part", *order)
        .select("file_name", content.alias("value"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("file_name")
        .text(path, compression=compression)
    )


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Lines of written files with ``file_name`` and ``part``, the number of the file within its folder's order."""
    lines = spark.read.schema("value string, file_name string").text(path)
    return lines.withColumn("part", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int"))


def read_whole(spark: SparkSession, path: str) -> DataFrame:
    """Lines of written files with their number within their part, for checks of order.

    Reads each part as one text, so it is for parts that fit a row.
    """
    texts = spark.read.schema("value string, file_name string").text(path, wholetext=True)
    texts = texts.withColumn("part", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int"))
    lines = F.split(F.regexp_replace("value", r"\n\z", ""), "\n", -1)
    return texts.select("file_name", "part", F.posexplode(lines).alias("line", "value"))


def clip_records(result: DataFrame) -> DataFrame:
    """Cut each record to the width of its type; unknown types stay whole."""
    width = F.create_map(*[F.lit(x) for layout in LAYOUTS for x in (layout.record_type, layout.width)])
    limit = F.coalesce(F.try_element_at(width, F.col("record_type")), F.length("record_content"))
    return result.withColumn("record_content", F.left("record_content", limit))


def split_place() -> Column:
    """A body row's place: its claim's number from 0, from either sequence; NULL without any."""
    by_record = F.floor(F.col("record_sequence") / CLAIM_STEP) - 2
    return F.coalesce(F.col("claim_sequence") - 1, by_record).cast("bigint")


def split_order() -> list[Column]:
    """Rows of a split file: header, body by claim and record, rows without any sequence, trailer."""
    return [section_rank(), split_place().asc_nulls_last(), F.col("record_sequence").asc_nulls_last(),
            F.col("line_sequence").asc_nulls_first(), F.col("record_content")]


def split_result(parsed: DataFrame, path: str, claims_per_part: int = 10_000) -> None:
    """Write the usable rows of a saved result table, one folder per file name.

    Rows may come in any order and a file name may come back later.  Rows of unknown
    types are of the body.  Rows without any sequence have no place; they are spread
    over parts before the trailer.
    """
    unplaced = LAST_PART - 1 - F.pmod(F.xxhash64("record_content"), F.lit(1000))
    part = (
        F.when(F.col("record_type") == "FILE_HEADER", F.lit(FIRST_PART))
        .when(F.col("record_type") == "FILE_TRAILER", F.lit(LAST_PART))
        .when(split_place().isNull(), unplaced)
        .otherwise(F.greatest(F.floor(split_place() / claims_per_part), F.lit(0)))
        .cast("bigint")
    )
    rows = clip_records(accepted(parsed)).withColumn("part", part)
    placed = in_task_order(rows, rows.select("file_name", "part").distinct())
    write_files(placed, path, F.col("record_content"), split_order())
