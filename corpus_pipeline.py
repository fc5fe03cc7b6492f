"""The corpus pipeline: documents without toxic, poor, copied and leaked ones, packed into sequences.

``STAGES`` names the stages and their functions; each takes the documents that its predecessor kept
and returns those it keeps with the columns of ``documents``; the last returns the packed pieces.
``run`` stores what a stage returns and reads it again for the next, so that no stage's plan contains
another's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotline.llm import order_minhash, packing, phrase_index, quality_labels, toxicity
from slotline.llm.common import staged, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted toxic."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality_labels.only_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return order_minhash.without_copies(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage occurs."""
    return phrase_index.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in their sequences."""
    return packing.packed(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("toxicity", toxic),
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: SQL cannot express the stages' models and tokenizer; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
