"""The registered queries on the smallest tables, and each stage of the pipeline against a plain version."""

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from slotline.llm import order_minhash, packing, phrase_index, quality_labels, queries, toxicity
from slotline.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = contract.queries()
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} <= {x.split("_")[0] for x in names}
    assert set(queries.ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    database = duckdb.connect()
    for one in ("documents", "pages", "benchmark", "labels", "conversations"):
        database.execute(f"CREATE VIEW {one} AS SELECT * FROM '{SF_DIR}/{one}.parquet'")
    frame = queries.QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    cursor = database.execute(queries.ORACLE[name])
    names = [x[0] for x in cursor.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in cursor.fetchall())
    assert sorted(repr(tuple(row[c] for c in columns)) for row in frame.collect()) == want


@pytest.mark.parametrize("name", ["op1_quality_rules", "op2_quality_classifier", "op4_toxicity", "op10_order_minhash"])
def test_a_row_for_each_document(spark, name):
    found = [r["doc_id"] for r in queries.QUERIES[name](spark, SF_DIR).collect()]
    assert sorted(found) == sorted(r["doc_id"] for r in table(spark, SF_DIR, "documents").collect())


def test_stages(spark):
    documents = table(spark, SF_DIR, "documents")
    columns, kept = documents.columns, documents
    rows = lambda frame: {r["doc_id"]: r["text"] for r in frame.collect()}
    before = rows(kept)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after_frame = stage(spark, kept, SF_DIR)
        assert after_frame.columns == columns
        after = rows(after_frame)
        assert after.items() <= before.items()
        assert set(after) == set(by_hand(spark, name, kept)), name
        kept = spark.createDataFrame(
            [r for r in documents.collect() if r["doc_id"] in after], documents.schema
        )
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SF_DIR).collect()
    total = {}
    for row in pieces:
        total[row["doc_id"]] = total.get(row["doc_id"], 0) + row["length"]
        assert row["offset"] + row["length"] <= packing.WINDOW
    assert set(total) == set(before) and all(total[r["doc_id"]] == r["doc_tokens"] for r in pieces)


def by_hand(spark, name, documents):
    """The ids that a stage keeps, from the operator's full result or by comparing all with all."""
    if name == "toxicity":
        found = toxicity.scored(documents, table(spark, SF_DIR, "labels")).collect()
        return [r["doc_id"] for r in found if not r["predicted"]]
    if name == "quality":
        return [r["doc_id"] for r in quality_labels.classify(documents).collect() if r["kept"]]
    rows = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    if name == "decontamination":
        found = phrase_index.report(documents, table(spark, SF_DIR, "benchmark")).collect()
        return [r["doc_id"] for r in found if not r["contaminated"]]
    texts = {i: order_minhash.word_hashes(t) for i, t in rows}
    name_of = {i: i for i in texts}

    def root(i):
        while name_of[i] != i:
            i = name_of[i]
        return i

    for i in texts:
        for j in texts:
            if j < i:
                same = texts[i][0] == texts[j][0]
                if same or order_minhash.similarity(texts[i][1], texts[j][1]) >= order_minhash.SIMILARITY:
                    x, y = root(i), root(j)
                    name_of[max(x, y)] = min(x, y)
    return [i for i in texts if root(i) == i]
