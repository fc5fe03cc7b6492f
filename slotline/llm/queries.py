"""The queries of the corpus operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotline.llm import conversation_repair, html_template, ngram_join, order_minhash, packing, phrase_index
from slotline.llm import quality_labels, quality_rules, spelling_variants, sql, token_files, toxicity, url_rules, warc
from slotline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "anomaly",
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_labels.classify(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.with_crc(token_files.round_trip(table(spark, sf_dir, "documents")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_index.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract(table(spark, sf_dir, "pages"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.packed(table(spark, sf_dir, "documents"))
    return placed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages")).drop("mined")


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.classes(table(spark, sf_dir, "documents"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.report(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_token_files": op3_token_files,
    "op4_toxicity": op4_toxicity,
    "op5_warc": op5_warc,
    "op6_decontamination": op6_decontamination,
    "op7_html_extraction": op7_html_extraction,
    "op8_packing": op8_packing,
    "op9_url_filters": op9_url_filters,
    "op10_order_minhash": op10_order_minhash,
    "op11_ngram_join": op11_ngram_join,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_spelling_variants": op13_spelling_variants,
}
ORACLE: dict[str, str] = {
    "op5_warc": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
        SELECT p.page_id, p.payload_bytes, p.payload_digest,
               CASE WHEN p.page_id <> f.first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN p.page_id <> f.first THEN f.first END AS refers_to
        FROM p LEFT JOIN f USING (payload_digest)
    """,
    # Looks every run of 10 words (and every run as long as a shorter item) up among the items' runs.
    "op6_decontamination": r"""
        WITH d AS (
            SELECT doc_id, row_number() OVER () AS doc, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), b AS (
            SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), p AS (
            SELECT DISTINCT item_id, size, array_to_string(w[s:s + size - 1], ' ') AS phrase
            FROM (SELECT item_id, w, least(len(w), 10) AS size, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s
                  FROM b WHERE len(w) > 0)
        ), o AS (
            SELECT DISTINCT doc, s, z.size, p.item_id
            FROM (SELECT doc, w, z.size, unnest(range(1, len(w) - z.size + 2)) AS s
                  FROM d, (SELECT DISTINCT size FROM p) z WHERE len(w) >= z.size) z
            JOIN p ON p.size = z.size AND p.phrase = array_to_string(w[s:s + z.size - 1], ' ')
        ), h AS (
            SELECT doc, count(DISTINCT x) AS n_hit
            FROM (SELECT doc, unnest(range(s, s + size)) AS x FROM o) GROUP BY doc
        ), i AS (
            SELECT doc, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
            FROM (SELECT DISTINCT doc, item_id FROM o) GROUP BY doc
        )
        SELECT d.doc_id, coalesce(len(d.w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN h USING (doc) LEFT JOIN i USING (doc)
    """,
    "op11_ngram_join": sql.NGRAM_JOIN,
    "op12_conversation_repair": sql.CONVERSATION_REPAIR,
    "op13_spelling_variants": sql.SPELLING_VARIANTS,
}
