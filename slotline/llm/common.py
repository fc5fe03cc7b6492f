"""What the corpus operators share: tables staged for all executors, and null-safe reads."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a temporary folder of its own and any
    other session an error, as a machine's own folder is of no use to the others.
    """
    conf = spark.sparkContext.getConf()
    application = spark.sparkContext.applicationId
    folder = conf.get("spark.checkpoint.dir") or _OWN_FOLDERS.get(application)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _OWN_FOLDERS[application] = "file://" + tempfile.mkdtemp(prefix="llm-stage-")
    return f"{folder.rstrip('/')}/{application}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def staged(frame: DataFrame, label: str, **options) -> DataFrame:
    """The frame, written once to the shared folder and read back from there.

    This cuts the lineage: what follows survives the loss of any executor and
    never runs the frame's plan again.
    """
    path = new_path(frame.sparkSession, label)
    frame.write.options(**options).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


#: Bytes of an Arrow batch from which on it gets no further row.
BATCH_BYTES = 32 << 20


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Get ready for Python tasks: Arrow batches of so many rows and ``BATCH_BYTES``, so that long texts don't
    fill a worker's memory, and this package on the workers' path where they see its folder
    (elsewhere it is installed or sent along with ``--py-files``)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    here = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if here not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (here, *paths) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def hashed_sample(frame: DataFrame, keys: list[str], rows: int, count: int | None = None) -> DataFrame:
    """About ``rows`` of the frame's rows, chosen by a hash of their keys; all if there are no more.

    The same rows on each run, whatever the partitions. The number wanders by a few
    times its square root.
    """
    count = frame.count() if count is None else count
    if count <= rows:
        return frame
    return frame.filter(F.pmod(F.xxhash64(*keys), F.lit(1 << 40)) < int((1 << 40) * rows / count))
