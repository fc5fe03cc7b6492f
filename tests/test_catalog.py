"""Every registered query against its SQL on the smallest data set."""

import duckdb
import pytest
from pyspark.sql import functions as F

from catalog import queries
from catalog.oracle import ORACLE
from catalog.queries import QUERIES
from slotline import testbed

SF_DIR = "/root/testdata/sf0.001"
TABLES = "customer events lineitem orders part".split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, database, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    got = sorted(repr(tuple(row[c] for c in columns)) for row in frame.collect())
    cursor = database.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in cursor.fetchall())
    assert got == want


def test_lines_of_far_parts_become_several_claims(spark, monkeypatch):
    whole = testbed.claims(spark, SF_DIR).selectExpr("id", "claim_jsonb").count()
    monkeypatch.setattr(testbed, "PART_BITS", 4)
    claims = testbed.claims(spark, SF_DIR)
    assert claims.count() > whole
    assert claims.select("id").distinct().count() == claims.count()
    lines = claims.selectExpr("sum(json_array_length(get_json_object(claim_jsonb, '$.serviceLines'))) AS n").collect()[0].n
    assert lines == testbed.table(spark, SF_DIR, "lineitem").count()


def test_an_order_of_a_third_of_all_lines_is_many_claims(spark):
    sf_dir = "/root/testdata/sf0.1"
    line = testbed.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    order = F.when(F.col("l_partkey") % 3 == 0, 1).otherwise(F.col("l_orderkey"))
    held = line.groupBy(order.alias("order"), F.shiftright("l_partkey", testbed.PART_BITS).alias("document")).count()
    assert held.where("order = 1").count() > 15
    assert held.agg(F.max("count")).collect()[0][0] < 15_000


@pytest.mark.parametrize("name", ["json_text", "json_array_len", "file_metadata"])
def test_claims_of_whole_orders(spark, tmp_path, name):
    """Lines of one order whose parts are 5,000 apart are one claim."""
    for table in TABLES:
        frame = testbed.table(spark, SF_DIR, table)
        if table == "lineitem":
            frame = frame.withColumn("l_partkey", F.col("l_partkey") + F.col("l_linenumber") * 5000)
        frame.write.parquet(f"{tmp_path}/{table}.parquet")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    frame = QUERIES[name](spark, str(tmp_path))
    cursor = connection.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    got = sorted(repr(tuple(row[c] for c in columns)) for row in frame.collect())
    assert got == sorted(repr(tuple(row)) for row in cursor.fetchall())
    if name != "file_metadata":
        assert len(got) == testbed.table(spark, SF_DIR, "orders").count()


def test_line_items_are_shuffled_as_they_are_read(spark):
    """No line is built, and nothing aggregated, before the first shuffle of the line items."""
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = testbed.claims(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    below = plan[plan.index("RepartitionByExpression"):]
    assert "Aggregate" not in below and "FACILITY" not in below
    assert "FACILITY" in plan[: plan.index("Join")]


@pytest.mark.parametrize("name", ["claim_key", "claim_key_semi", "line_sequence"])
def test_documents_are_made_once_and_stored_narrow(spark, name):
    """Line items are read below the stored rows alone."""
    leaves = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().withCachedData().collectLeaves()
    found = [leaves.apply(i).toString() for i in range(leaves.size())]
    assert any(leaf.startswith("InMemoryRelation") for leaf in found)
    assert not [leaf for leaf in found if leaf.startswith("Relation") and "l_orderkey" in leaf]


def test_rejects_read_the_documents_once(spark):
    leaves = QUERIES["document_rejects"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().collectLeaves()
    assert sum("l_orderkey" in leaves.apply(i).toString() for i in range(leaves.size())) == 1


@pytest.mark.parametrize("name", ["stage_two_deliveries", "stage_same_claim_twice", "extract_same_claim_twice"])
def test_documents_are_made_once_for_all_deliveries(spark, name, monkeypatch):
    deliveries, stage = [], queries.stage_claims

    def noted(claims, path, delivery):
        deliveries.append(claims._jdf.queryExecution().analyzed().toString())
        stage(claims, path, delivery)

    monkeypatch.setattr(queries, "stage_claims", noted)
    QUERIES[name](spark, SF_DIR)
    assert len(deliveries) > 2 and not any("to_json" in plan for plan in deliveries)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("name", ["all_records", "claim_header", "claim_line", "file_count"])
def test_documents_are_not_shuffled(spark, no_broadcast, name):
    """Line items are shuffled once, and never as text: claims lie by id, and the numbers come to them."""
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan()
    nodes, found = [plan], []
    while nodes:
        node = nodes.pop()
        found.append(node)
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    shuffles = [node for node in found if node.nodeName() == "Exchange"]
    columns = [[node.output().apply(i).name() for i in range(node.output().size())] for node in shuffles]
    assert not [names for names in columns if "claim_jsonb" in names or "claim" in names]
    # Those of claims without id are none, as the second filter of the plan has it.
    lines = [node for node, names in zip(shuffles, columns) if "l_shipdate" in names]
    assert 1 <= len(lines) <= 2
    assert len([names for names in columns if names == ["packed"]]) == 1


@pytest.mark.parametrize("name", ["service_lines", "json_array_text", "coalesce_fallback"])
def test_documents_are_parsed_once(spark, name):
    """Exploding lines derives no filter that would parse the documents again."""
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan()
    nodes, found = [plan], []
    while nodes:
        node = nodes.pop()
        found.append(node)
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    assert sum("from_json" in node.simpleString(100_000) for node in found) == 1


def test_two_runs_write_packed_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    QUERIES["sink_two_runs"](spark, SF_DIR)
    names = [path.name for path in tmp_path.rglob("part-*")]
    assert names and all(name.endswith(".gz") for name in names)
