"""Time the headline queries; prints one JSON line.

Claims and payment responses are first made from the test tables and written as
the tables a run would read (``prepare`` in the output, not part of the value).
``stage_claims`` turns the JSON claims into the typed table; the other queries
read that table, and ``final_extract_json`` the JSON one.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from catalog.queries import checksum
from pyspark.sql import functions as F

from slotline import Extract, build_session, read_claims, read_payments, read_staged_claims, stage_claims, testbed
from slotline.checks import records as record_checks
from slotline.operators.payments import latest_payment
from slotline.sinks import split_result
from slotline.sources import read_result_table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(folder: Path) -> dict:
    spark = build_session(
        "slotline-bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=str(2 * int(CPUS)),
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(folder / "shared"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    at = lambda name: str(folder / name)

    started = time.perf_counter()
    testbed.claims(spark, SF_DIR).write.parquet(at("claims_json"))
    testbed.payments(spark, SF_DIR).write.parquet(at("payments"))
    testbed.parameters(spark, SF_DIR).write.parquet(at("parameters"))
    testbed.result_lines(spark, SF_DIR).write.text(at("result"))
    prepared = time.perf_counter() - started

    raw, paid = read_claims(spark, at("claims_json")), read_payments(spark, at("payments"))
    days = spark.read.parquet(at("parameters"))
    timings: dict[str, float] = {}

    def timed(name, action):
        start = time.perf_counter()
        action()
        timings[name] = round(time.perf_counter() - start, 3)

    def drain(frame):
        frame.write.format("noop").mode("overwrite").save()

    def digest(frame):
        frame.groupBy("record_type").agg(F.count(F.lit(1)), F.sum(checksum(F.col("record_content")))).collect()

    timed("stage_claims", lambda: stage_claims(raw, at("claims")))
    extract = lambda claims: Extract(claims, paid, days)
    staged = read_staged_claims(spark, at("claims"))
    timed("claim_phase", lambda: drain(extract(staged).phased))
    timed("mac_totals", lambda: drain(extract(staged).mac_totals()))
    timed("mac_totals_json", lambda: drain(extract(raw).mac_totals()))
    timed("latest_payment", lambda: drain(latest_payment(paid)))
    timed("claim_sequence", lambda: drain(extract(staged).numbered))
    timed("claim_header", lambda: drain(extract(staged).all_records("CLAIM_HEADER")))
    timed("claim_line", lambda: drain(extract(staged).all_records("CLAIM_LINE")))
    timed("final_extract", lambda: digest(extract(staged).all_records()))
    timed("final_extract_sorted", lambda: drain(extract(staged).final()))
    timed("final_extract_json", lambda: drain(extract(raw).final()))
    # A daily run: one day out of the whole history.
    day = days.orderBy("extract_date").limit(1).collect()[0]["extract_date"]
    one_day = days.where(F.col("extract_date") == F.lit(day))
    timed("one_day", lambda: drain(Extract(staged, paid, one_day).final()))
    timed("one_day_json", lambda: drain(Extract(raw, paid, one_day).final()))
    timed("write_files", lambda: extract(staged).write(at("extracts")))
    timed("trailer_reconcile", lambda: drain(record_checks.trailer_reconcile(extract(staged).all_records())))
    timed("split_extract", lambda: split_result(read_result_table(spark, at("result")), at("split")))
    spark.stop()
    return {
        "metric": "total_query_time",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "prepare": round(prepared, 3),
        "sf": SF_DIR.rsplit("sf", 1)[-1],
        "cpus": int(CPUS),
    }


if __name__ == "__main__":
    with tempfile.TemporaryDirectory(prefix="slotline-bench-") as folder:
        print(json.dumps(run(Path(folder))))
