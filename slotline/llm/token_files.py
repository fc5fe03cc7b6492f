"""Token files: the ids of documents in Parquet list columns, laid out for selective reads.

A file holds, in ascending ``doc_id`` order, ``doc_id``, ``n_tokens``, ``offset`` (ids of
the file before the document) and ``ids`` (list of int). Ids are dictionary encoded (16 bits
or fewer each, as a vocabulary is small) or delta encoded; the metadata columns are delta
encoded, so that positions can be read without touching an id. Row groups and pages are
of a set size and each file has the page indexes that let a reader of some documents skip
the other pages. File names ascend with the ids.

Documents are dealt by ranges of ``doc_id`` and of a hash of the text, so that rows of one
``doc_id`` may span files: ties are in the order of that hash. A null ``doc_id`` comes
first. A null or empty text has just the end id; texts of any length are one row. An empty
table makes files without rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotline.llm.common import new_path, small_batches, staged, text_of
from slotline.llm.token_ids import Encoder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
SCHEMA = "doc_id long, n_tokens long, offset long, ids array<int>"


def encoded(documents: DataFrame, vocabulary: str = VOCABULARY, kind: str = "words", end_id: int = END_ID) -> DataFrame:
    """The rows of the files: documents in order, each with its ids and its offset in the file."""
    small_batches(documents.sparkSession, 500)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = Encoder.of(kind, vocabulary), 0
        for batch in batches:
            values, bounds = encoder.ids(batch.column("text").to_pylist())
            values = pa.array(np.insert(values.astype(np.int32), bounds[1:], end_id))
            ends = bounds + np.arange(len(bounds))
            counts = ends[1:] - ends[:-1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts),
                    pa.array(before + ends[:-1]),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values),
                ],
                names=["doc_id", "n_tokens", "offset", "ids"],
            )
            before += int(ends[-1])

    ordered = (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    return ordered.mapInArrow(encode, SCHEMA)


def write(
    rows: DataFrame,
    path: str,
    ids_encoding: str = "dictionary",
    row_group_bytes: int = 32 << 20,
    page_bytes: int = 64 << 10,
    page_rows: int = 1000,
) -> None:
    """Write encoded documents to a folder of token files."""
    if ids_encoding not in ("dictionary", "delta"):
        raise ValueError(f"ids are dictionary or delta encoded, not {ids_encoding}")
    options = {
        "parquet.writer.version": "v2",
        "parquet.block.size": row_group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.page.row.count.limit": page_rows,
        "parquet.enable.dictionary#ids.list.element": str(ids_encoding == "dictionary").lower(),
        "compression": "zstd",
    } | {f"parquet.enable.dictionary#{name}": "false" for name in ("doc_id", "n_tokens", "offset")}
    rows.write.options(**options).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The documents of token files, with ``start``: the ids of all documents before.

    The start is the offset in the file plus the ids of the files before, which come from
    the metadata columns alone, one row for each file.
    """
    files = spark.read.schema(SCHEMA).parquet(path).withColumn("file", F.col("_metadata.file_name"))
    held = files.groupBy("file").agg(F.sum("n_tokens").alias("held"))
    # By number, as the names' order as text ends where the numbers get longer.
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    before = Window.orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)
    # Stored, so that the planner knows how few rows these are before it joins.
    starts = staged(held.select("file", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("earlier")), "file-starts")
    return files.join(starts, "file").select("doc_id", (F.col("earlier") + F.col("offset")).alias("start"), "n_tokens", "ids")


def with_crc(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC of the ids as little-endian unsigned 32-bit integers."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            ends, values = ids.offsets.to_numpy(), np.ascontiguousarray(ids.values.to_numpy(), "<i4")
            view = memoryview(values).cast("B")
            sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:])]
            columns = [batch.column(name) for name in ("doc_id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    small_batches(rows.sparkSession, 500)
    return rows.mapInArrow(check, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(documents: DataFrame) -> DataFrame:
    """Write the documents' token files to the shared folder, and read them back."""
    spark = documents.sparkSession
    path = new_path(spark, "token-files")
    write(encoded(documents), path)
    return read(spark, path)
