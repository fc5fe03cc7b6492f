"""Whole extracts of small hand-made claims."""

from datetime import date, datetime, timezone

import pytest

from slotline import Extract, extract_parameters, read_staged_claims, stage_claims
from slotline.checks import records as record_checks
from slotline.operators.payments import latest_payment, latest_payment_lateral
from slotline.sinks import positions, read_files, read_relation
from slotline.sinks.files import read_whole

DAY, RUN = date(2025, 12, 12), datetime(2025, 12, 13, 3, 4, 5, tzinfo=timezone.utc)
P3_FILE = "P.IDR.IN.EFT.MAP.P3.05202.D.251212.T220405.txt"
P2_FILE = P3_FILE.replace("P3", "P2")


def claim(**values):
    return {"macId": "5202", "receiptDate": "2025-12-12", **values}


def line(number, **values):
    return {"serviceLineNumber": number, **values}


@pytest.fixture
def run(spark, make_claims, make_payments):
    def make(documents, *payments, **options):
        return Extract(make_claims(documents), make_payments(*payments), extract_parameters(spark, DAY, RUN), **options)

    return make


def records(extract):
    return [row.asDict() for row in extract.final().collect()]


def text(extract, kind, index=0):
    return [r["record_content"] for r in records(extract) if r["record_type"] == kind][index]


def at(record, start, end):
    return record[start - 1 : end]


def test_claim_without_payment(run):
    got = records(run({1: claim()}))
    assert [(r["file_name"], r["record_type"], r["record_sequence"]) for r in got] == [
        (P2_FILE, "FILE_HEADER", 1),
        (P2_FILE, "CLAIM_HEADER", 2000),
        (P2_FILE, "FILE_TRAILER", 999999),
    ]
    header = got[1]["record_content"]
    assert at(header, 67, 75) == "000000000" and at(header, 186, 194) == "000000000"
    assert at(header, 1968, 1969) == "NN"
    assert at(header, 431, 434) == "00P2"
    assert at(header, 4, 23) == "00" + "0" * 13 + "5202 "
    assert at(header, 50, 57) == "00000000" and at(header, 277, 292) == "0" * 16
    assert at(header, 294, 301) == "20251212"
    assert got[0]["record_content"] == "MAPHP2052020520220251212D        20250106"
    assert got[2]["record_content"] == "MAPTP20520205202D000000003000000001000000000"


def test_latest_payment_gives_one_header(run):
    amounts = [
        (1, "2025-01-01T00:00:00", {"beneCheck": {"checkNumber": "11", "claimAmount": 12.5}}),
        (1, "2025-03-01T00:00:00", {"beneCheck": {"checkNumber": "33", "claimAmount": "12.50", "couldNotBeForwarded": True}}),
        (1, "2025-02-01T00:00:00", {"beneCheck": {"checkNumber": "22"}}),
    ]
    got = records(run({1: claim()}, *amounts))
    assert [r["record_type"] for r in got] == ["FILE_HEADER", "CLAIM_HEADER", "FILE_TRAILER"]
    header = got[1]["record_content"]
    assert got[1]["file_name"] == P3_FILE and at(header, 67, 75) == "000000033"
    assert at(header, 149, 155) == "0012.50" and at(header, 1968, 1969) == "YN"


def test_payment_without_time_wins(make_claims, make_payments):
    paid = make_payments((1, "2025-01-01T00:00:00", {"a": 1}), (1, None, {"a": 2}), (2, "2025-01-01T00:00:00", {"a": 3}))
    assert sorted(tuple(row) for row in latest_payment(paid).select("claim_id", "payment_response_json").collect()) == [
        (1, '{"a": 2}'), (2, '{"a": 3}'),
    ]
    lateral = latest_payment_lateral(make_claims({1: {}, 3: {}}), paid)
    assert sorted((row.id, row.payment_response_json) for row in lateral.collect()) == [(1, '{"a": 2}'), (3, None)]


def test_responses_shrink_to_one_per_claim_before_the_shuffle(spark, make_payments):
    rows = [(1 if i % 3 else i, f"2025-01-01T00:{i // 60:02}:{i % 60:02}", {"n": i}) for i in range(600)]
    latest = latest_payment(make_payments(*rows))
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(claim_id") < plan.index("Partial")
    got = {row.claim_id: row.payment_response_json for row in latest.collect()}
    assert got[1] == '{"n": 599}' and len(got) == 201


def test_unselected_claims_are_absent(run):
    other = {1: claim(receiptDate="2025-12-11"), 2: {"receiptDate": "2025-12-12"}, 3: claim(macId=None), 4: {"macId": "5202"}}
    assert records(run(other)) == []


def test_no_lines(run):
    extract = run({1: claim(serviceLines=[]), 2: claim()})
    assert at(text(extract, "CLAIM_HEADER", 0), 24, 25) == "00" and at(text(extract, "CLAIM_HEADER", 1), 24, 25) == "00"
    assert all(r["record_type"] != "CLAIM_LINE" for r in records(extract))


def test_trailer_of_file_without_any_lines(run):
    assert text(run({1: claim()}), "FILE_TRAILER")[-9:] == "000000000"
    assert text(run({1: claim()}, strict_nulls=True), "FILE_TRAILER") is None
    assert run({1: claim()}, strict_nulls=True).file_trailer().collect()[0].record_content is None


def test_lines_are_ordered_by_number_then_position(run):
    lines = [line("10", providerServiceLineId="a"), line("9", providerServiceLineId="b"), line(2, providerServiceLineId="c"),
             line("9", providerServiceLineId="d"), line(None, providerServiceLineId="e")]
    got = [r for r in records(run({1: claim(serviceLines=lines)})) if r["record_type"] == "CLAIM_LINE"]
    assert [(r["line_sequence"], r["record_sequence"], at(r["record_content"], 921, 921)) for r in got] == [
        (1, 2001, "c"), (2, 2002, "b"), (3, 2003, "d"), (4, 2004, "a"), (5, 2005, "e"),
    ]


def test_line_values_fall_back_to_the_claim(run):
    document = claim(
        internalControlNumber="77", billedAmount=8.10, diagnosisCodes=[], cutbackAmounts="x",
        serviceLines=[line(1, allowedAmount=3, cmsServiceDate="2025-12-12", diagnosisCodes=["M545"],
                           healthcareCommonProcedureCodeModifiers=["25", "59"], cutbackAmounts=[1.50, 2])],
    )
    got = text(run({1: document}), "CLAIM_LINE")
    assert at(got, 6, 18) == "0000000000077" and at(got, 19, 20) == "01"
    assert at(got, 29, 36) == "2025 12 "
    assert at(got, 53, 60) == '["' * 4
    assert at(got, 81, 87) == "00008.1" and at(got, 88, 94) == "0000003"
    assert at(got, 214, 221) == "9" + " " * 7
    assert at(got, 391, 397) == "[1.5, 2"


def test_codes_and_names(run):
    header = text(run({1: claim(diagnosisCodes=["S72001A", "M545"], beneficiaryLastName="Montgomery")}), "CLAIM_HEADER")
    assert at(header, 119, 134) == "0S72001A0S72001A" and at(header, 40, 45) == "Montgo"
    assert at(text(run({1: claim()}), "CLAIM_HEADER"), 119, 134) == " " * 16


def test_hundred_lines_print_two_digits(run):
    extract = run({1: claim(serviceLines=[line(i) for i in range(1, 101)])})
    assert at(text(extract, "CLAIM_HEADER"), 24, 25) == "10"
    assert at(text(extract, "CLAIM_LINE", 99), 2, 3) == "10"


def test_trailer_counts_and_widths(run):
    documents = {1: claim(serviceLines=[line(1), line(2)]), 2: claim(serviceLines=[line(1), line(2), line(3)])}
    extract = run(documents)
    assert text(extract, "FILE_TRAILER")[17:] == "000000009000000002000000005"
    assert all(row.fits for row in record_checks.record_widths(extract.all_records()).collect())
    assert all(row.agrees for row in record_checks.trailer_reconcile(extract.all_records()).collect())


def test_thousandth_claim_comes_before_the_trailer(run):
    documents = {i: claim() for i in range(1, 1001)}
    assert [r["record_type"] for r in records(run(documents))][-2:] == ["CLAIM_HEADER", "FILE_TRAILER"]
    strict = records(run(documents, strict_sequence=True))
    sequences = [r["record_sequence"] for r in strict]
    assert sequences == sorted(sequences) and strict[-1]["claim_sequence"] == 1000
    assert strict[-1]["record_sequence"] == 1_001_000


def test_several_days_and_contractors(spark, make_claims, make_payments):
    claims = make_claims({1: claim(), 2: claim(macId="1"), 3: claim(receiptDate="2025-12-11"), 4: claim()})
    days = extract_parameters(spark, [DAY, date(2025, 12, 11)], RUN)
    got = [(r.file_name, r.record_type, r.claim_sequence) for r in Extract(claims, make_payments((4, None, {})), days).final().collect()]
    bodies = [x for x in got if x[1] == "CLAIM_HEADER"]
    assert bodies == [
        ("P.IDR.IN.EFT.MAP.P2.00001.D.251212.T220405.txt", "CLAIM_HEADER", 1),
        ("P.IDR.IN.EFT.MAP.P2.05202.D.251211.T220405.txt", "CLAIM_HEADER", 1),
        (P2_FILE, "CLAIM_HEADER", 1),
        (P3_FILE, "CLAIM_HEADER", 1),
    ]
    assert len(got) == 12


def test_staged_claims_give_the_same_extract(spark, tmp_path, make_claims, make_payments):
    claims = make_claims({1: claim(serviceLines=[line(2), line(1)], totalBilledAmount=5.50), 2: claim(), 3: claim(receiptDate="2025-01-01")})
    paid = make_payments((2, None, {"interestRate": 0.04750}))
    stage_claims(claims, str(tmp_path / "claims"))
    staged = read_staged_claims(spark, str(tmp_path / "claims"))
    days = extract_parameters(spark, DAY, RUN)
    extract = Extract(staged, paid, days)
    assert extract.final().collect() == Extract(claims, paid, days).final().collect()
    plan = extract.claim_rows()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(receipt_date" in plan or "PartitionFilters: [(receipt_date" in plan


def test_written_files_hold_their_records_in_order(run, spark, tmp_path):
    documents = {i: claim(serviceLines=[line(2), line(1)]) for i in range(1, 26)}
    extract = run(documents, (3, None, {}))
    path = str(tmp_path / "extracts")
    for _ in range(2):  # the second run replaces the first
        extract.write(path, records_per_part=30)
    want = {}
    for r in records(extract):
        want.setdefault(r["file_name"], []).append(r["record_content"])
    for name, contents in want.items():
        files = sorted((tmp_path / "extracts" / f"file_name={name}").glob("*.txt"))
        assert [x for file in files for x in file.read_text().split("\n")[:-1]] == contents
        assert len(files) == (1 if "P3" in name else 3)
    assert read_files(spark, path).count() == sum(map(len, want.values()))


def test_packed_files_hold_the_same_lines(run, spark, tmp_path):
    extract = run({i: claim(serviceLines=[line(2), line(1)]) for i in range(1, 26)}, (3, None, {}))
    lines = []
    for compression in ("none", "gzip"):
        path = tmp_path / compression
        extract.write(str(path), records_per_part=30, compression=compression)
        lines.append([(r.file_name, r.part, r.line, r.value) for r in read_whole(spark, str(path)).orderBy("file_name", "part", "line").collect()])
    assert lines[0] == lines[1] and len(lines[0]) == len(records(extract))
    size = lambda kind: sum(file.stat().st_size for file in (tmp_path / kind).rglob("part-*"))
    assert size("gzip") * 5 < size("none")


def test_an_odd_element_loses_no_line(run, make_claims):
    documents = {1: claim(serviceLines=[line(2, billedAmount=7.50), "oops", 5, None, line(1)], diagnosisCodes=[250.00, "M1", 1.50])}
    documents[1] = __import__("json").dumps(documents[1]).replace("250.0,", "250.00,").replace("1.5]", "1.50]")
    extract = run(documents)
    assert at(text(extract, "CLAIM_HEADER"), 24, 25) == "05" and text(extract, "FILE_TRAILER")[-9:] == "000000005"
    assert [r["line_sequence"] for r in records(extract) if r["record_type"] == "CLAIM_LINE"] == [1, 2, 3, 4, 5]
    assert at(text(extract, "CLAIM_HEADER"), 119, 134) == "9250.00 9250.00 "
    rejects = record_checks.document_rejects(make_claims({**documents, 2: "{", 3: "[1]", 4: {"serviceLines": 5}, 5: claim()}))
    assert sorted((r.id, r.place, r.reason) for r in rejects.collect() if r.place is not None) == [
        (1, 1, "line is no object"), (1, 2, "line is no object"), (1, 3, "line is no object"),
    ]
    assert {(r.id, r.reason) for r in rejects.collect() if r.place is None} == {
        (2, "unreadable"), (3, "not an object"), (4, "lines are no array"),
    }


@pytest.mark.parametrize("document, paid", [
    (claim(serviceLines=[line("3.0")]), {}),
    (claim(isParticipatingProvider="maybe", serviceLines=[line(1)]), {}),
    (claim(), {"beneCheck": {"claimAmount": "n/a"}}),
    (claim(), {"interestDaysOver": "3.5"}),
    (claim(), {"providerCheck": {"couldNotBeForwarded": "perhaps"}}),
])
def test_strict_values_end_the_run(run, document, paid):
    assert records(run({1: document}, (1, None, paid)))
    with pytest.raises(Exception, match="no (line |whole )?(number|flag): "):
        records(run({1: document}, (1, None, paid), strict_values=True))


def test_strict_values_let_good_ones_pass(run):
    good = claim(serviceLines=[line(1, billedAmount="1e2"), line(None)], isParticipatingProvider="on", totalBilledAmount=7)
    assert records(run({1: good}, strict_values=True)) == records(run({1: good}))


def test_findings(make_claims, make_payments):
    claims = make_claims({1: claim(serviceLines={"a": 1}, isParticipatingProvider="maybe"), 2: claim(serviceLines=[line("3.0"), line(1)])})
    got = {row.finding: row.occurrences for row in record_checks.claim_findings(claims).collect()}
    assert got == {"lines_not_an_array": 1, "bad_line_numbers": 1, "bad_participation_flags": 1}


def test_other_files_and_days_stay(spark, tmp_path, make_claims, make_payments):
    """Two days into one folder, the first again, then the first with fewer claims."""
    path, other = str(tmp_path / "extracts"), date(2025, 12, 11)
    run_day = lambda documents, day: Extract(
        make_claims(documents), make_payments(), extract_parameters(spark, day, RUN.replace(day=day.day + 1))
    ).write(path, records_per_part=2)
    first = {i: claim(receiptDate="2025-12-11") for i in range(9)}
    run_day(first, other)
    run_day({50: claim(), 51: claim()}, DAY)
    count = lambda: {r.file_name[-19:-12]: r["count"] for r in read_files(spark, path).groupBy("file_name").count().collect()}
    whole = count()
    assert sorted(whole.values()) == [4, 11]
    run_day(first, other)
    assert count() == whole
    run_day({1: claim(receiptDate="2025-12-11")}, other)
    assert sorted(count().values()) == [3, 4]


def test_deliveries_add_up(spark, tmp_path, make_claims):
    path = str(tmp_path / "claims")
    ids = lambda: sorted(r.id for r in read_staged_claims(spark, path).collect())
    stage_claims(make_claims({1: claim(), 2: claim(receiptDate="2025-12-11")}), path, "a")
    stage_claims(make_claims({3: claim()}), path, "b")
    assert ids() == [1, 2, 3]
    stage_claims(make_claims({4: claim()}), path, "b")
    assert ids() == [1, 2, 4]


def test_a_day_of_text_claims_is_cut_out_before_the_shuffle(run):
    """Documents are filtered by day, and responses by claim, below any join or window with them."""
    rows = run({1: claim()}, (1, None, {})).claim_rows()
    plan = rows._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = lambda text: len(text) - len(text.lstrip(" :+-|"))
    document = next(i for i, text in enumerate(plan) if "LogicalRDD [id" in text)
    above = [text for i, text in enumerate(plan[:document]) if all(depth(text) < depth(x) for x in plan[i + 1 : document + 1])]
    filters = [i for i, text in enumerate(above) if "Filter" in text and "scalar-subquery" in text]
    joins = [i for i, text in enumerate(above) if "Join" in text]
    assert filters and joins and min(filters) > max(joins)
    window = next(i for i, text in enumerate(plan) if "Window" in text and "claim_id" in text)
    assert any("Join LeftSemi" in text and depth(text) > depth(plan[window]) for text in plan[window:])


def test_building_a_frame_starts_no_job(spark, run):
    started = lambda: spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    extract = run({1: claim(serviceLines=[line(1)])}, (1, None, {}))
    spark.sparkContext.setJobGroup("building", "building")
    try:
        extract.final(), extract.all_records(), extract.numbered, extract.mac_totals()
        assert not started()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_numbering_has_no_window_over_a_file(run):
    """Windows over claims run within a piece, others over a claim's responses."""
    plan = run({1: claim()}).claim_rows()._jdf.queryExecution().optimizedPlan().toString()
    windows = [text for text in plan.split("\n") if "row_number" in text]
    assert windows and all("claim_id" in text or "piece" in text for text in windows)


def test_claim_of_two_deliveries_counts_once(spark, tmp_path, make_claims, make_payments):
    path = str(tmp_path / "claims")
    first, other = claim(serviceLines=[line(1)]), claim(receiptDate="2025-12-11")
    stage_claims(make_claims({1: first, 2: first}), path, "a")
    stage_claims(make_claims({1: first, 2: other, 3: first}), path, "b")
    held = lambda: sorted((r.id, r.delivery, r.receipt_date) for r in read_staged_claims(spark, path).collect())
    assert held() == [(1, "b", "2025-12-12"), (2, "b", "2025-12-11"), (3, "b", "2025-12-12")]
    extract = Extract(read_staged_claims(spark, path), make_payments(), extract_parameters(spark, DAY, RUN))
    kinds = [r["record_type"] for r in records(extract)]
    assert kinds == ["FILE_HEADER", "CLAIM_HEADER", "CLAIM_LINE", "CLAIM_HEADER", "CLAIM_LINE", "FILE_TRAILER"]
    assert text(extract, "FILE_TRAILER")[17:] == "000000006000000002000000002"
    # What a delivery no longer holds falls back to the one before, whatever date it had.
    stage_claims(make_claims({3: claim(receiptDate="2025-12-10")}), path, "b")
    assert held() == [(1, "a", "2025-12-12"), (2, "a", "2025-12-12"), (3, "b", "2025-12-10")]
    # A refused delivery changes nothing.
    twice = make_claims({1: first}).union(make_claims({1: other}))
    with pytest.raises(ValueError, match="claim 1 2 times"):
        stage_claims(twice, path, "c")
    assert [row[1] for row in held()] == ["a", "a", "b"]


def test_claim_given_twice_as_text_ends_the_run(spark, make_claims, make_payments):
    twice = make_claims({1: claim()}).union(make_claims({1: claim(planCode="2")}))
    with pytest.raises(Exception, match="claim comes more than once: 1"):
        Extract(twice, make_payments(), extract_parameters(spark, DAY, RUN)).final().collect()


def test_records_of_all_kinds_are_compiled(spark, run, tmp_path, make_claims, make_payments):
    """Code that the JVM refuses to compile would run interpreted."""
    stage_claims(make_claims({1: claim(serviceLines=[line(1)])}), str(tmp_path / "claims"))
    staged = Extract(read_staged_claims(spark, str(tmp_path / "claims")), make_payments((1, None, {})), extract_parameters(spark, DAY, RUN))
    spark.conf.set("spark.sql.codegen.fallback", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    try:
        for extract in (staged, run({1: claim(serviceLines=[line(1)])}, (1, None, {}))):
            assert len(records(extract)) == 4
            assert extract.all_records("CLAIM_HEADER").count() == 1
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
        spark.conf.unset("spark.sql.codegen.factoryMode")


def test_stored_relation_keeps_the_order(spark, make_claims, make_payments, tmp_path):
    documents = {i: {"macId": "%05d" % (10000 + i % 2), "receiptDate": DAY.isoformat(), "serviceLines": [{"serviceLineNumber": n} for n in range(i % 4)]} for i in range(1, 60)}
    extract = Extract(make_claims(documents), make_payments(), extract_parameters(spark, DAY, RUN))
    path = str(tmp_path / "relation")
    for _ in range(2):
        extract.store(path, records_per_part=7)
    stored = positions(read_relation(spark, path))
    columns = extract.final().columns
    got = stored.orderBy("file_name", "position").select(*columns).collect()
    assert got == extract.final().collect()
    assert [r.position for r in stored.orderBy("file_name", "position").where("mac_id = '10001'").collect()] == list(range(sum(r.mac_id == "10001" for r in got)))


def test_rejects_of_odd_documents(make_claims):
    documents = {
        1: '{"serviceLines": [{}, null, 5, "x", [1], {"a": {"b": 1}}]}', 2: '  {"serviceLines": [{}]}', 3: '{"serviceLines": null}', 4: "{}",
        5: '[{"serviceLines": [1]}]', 6: '{"serviceLines": {"a": 1}}', 7: '{"serviceLines": [{"a": 1}]', 8: '{"a": 1, "a": 2}',
        9: '{"x": {"serviceLines": [1]}, "serviceLines": [{}]}', 10: '"x"', 11: '{"serviceLines": []}', 12: "",
    }
    claims = make_claims(documents).unionByName(make_claims({13: ""}).selectExpr("id", "cast(null AS string) AS claim_jsonb"))
    got = {(r.id, r.place, r.reason) for r in record_checks.document_rejects(claims).collect()}
    assert got == {
        *[(1, at, "line is no object") for at in (1, 2, 3, 4)], (5, None, "not an object"), (6, None, "lines are no array"),
        (7, None, "unreadable"), (8, None, "unreadable"), (10, None, "not an object"), (12, None, "unreadable"), (13, None, "unreadable"),
    }


def staged_files(tmp_path):
    return [len(list(day.glob("*/*/*.parquet"))) for day in sorted(tmp_path.glob("receipt_date=*"))]


@pytest.fixture
def unmerged(spark):
    """Shuffle partitions stay as they are, but for those of over 4 kB, which are cut."""
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def test_a_small_day_is_one_staged_file(spark, make_claims, tmp_path, unmerged):
    days = [f"2025-12-{day}" for day in (10, 11, 12)]
    documents = {(at << 16) + at: claim(receiptDate=days[at % 3]) for at in range(60)}
    stage_claims(make_claims(documents), str(tmp_path))
    assert staged_files(tmp_path) == [1, 1, 1]
    assert sorted(row.id for row in read_staged_claims(spark, str(tmp_path)).collect()) == sorted(documents)


def test_a_busy_day_is_cut_into_many_staged_files(spark, make_claims, tmp_path, unmerged):
    documents = {at: claim(planCode=str(hash((at, "x"))), submitterId=f"{at * 7919:x}" * 30) for at in range(2000)}
    stage_claims(make_claims(documents).repartition(8), str(tmp_path))
    assert staged_files(tmp_path)[0] > 4
    assert sorted(row.id for row in read_staged_claims(spark, str(tmp_path)).collect()) == sorted(documents)
