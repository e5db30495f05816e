from datetime import date, datetime

from types import SimpleNamespace

from pyspark.sql import functions as F

from lienflow.operators import audit, outreach, parties, quality, schedule, search, stats, transcripts
from lienflow.session import shared_folder
from lienflow.sources.dimension import source_dimension
from lienflow.streaming.alerts import current_alerts, failure_alerts, start_alerts


def at(text):
    return f"timestamp'{text}'"


def test_shared_folder(spark):
    assert shared_folder(spark) == shared_folder(spark)
    named = SimpleNamespace(conf={"spark.checkpoint.dir": "/shared/named/"})
    assert shared_folder(named) == "/shared/named"


def test_due(spark):
    sources = source_dimension(spark, disabled=("NY",))
    rows = [("KY", "2024-01-10 00:00:00"), ("TX", "2024-01-09 00:00:00"), ("CA", "2024-01-04 00:00:01")]
    filings = spark.createDataFrame(rows, "state string, t string").selectExpr(
        "state", "timestamp(t) AS ingested_at", "cast(NULL AS date) AS filing_date"
    )
    due = {r.state for r in schedule.due_states(sources, filings, at("2024-01-10 23:00:00")).collect()}
    assert "TX" in due and "FL" in due and not due & {"KY", "CA", "NY"} and len(due) == 48
    exact = {r.state for r in schedule.due_states(sources, filings, at("2024-01-11 00:00:00")).collect()}
    assert "KY" in exact and "CA" not in exact
    runs = spark.createDataFrame([("TX", "completed", "2024-01-10 22:00:00"), ("FL", "failed", "2024-01-10 22:00:00")], "state string, status string, t string")
    by_run = schedule.due_states(sources, filings, at("2024-01-10 23:00:00"), runs.selectExpr("*", "timestamp(t) AS completed_at"))
    found = {r.state for r in by_run.collect()}
    assert "TX" not in found and "FL" in found


def test_costs(spark):
    filings = spark.createDataFrame([("TX",)], "state string").selectExpr("state", "current_timestamp() AS ingested_at", "current_date() AS filing_date")
    costs = {r.tier: r for r in schedule.cost_by_tier(source_dimension(spark), filings).collect()}
    assert {t: c.annual_cost for t, c in costs.items()} == {
        "open_api": 0.0,
        "state_bulk": 103830.0,
        "commercial": 300000.0,
        "total": 403830.0,
    }
    assert (costs["total"].budget_remaining, costs["commercial"].n_states, costs["open_api"].states) == (596170.0, 34, "CO,CT")


def test_last_run_record_wins(spark):
    rows = [
        ("r", "TX", "state_bulk", 1, None, 0, "running"),
        ("r", "??", "??", 2, 9, 5, "completed"),
        ("q", "CA", "state_bulk", 3, None, 0, "running"),
    ]
    records = spark.createDataFrame(rows, "run_id string, state string, source_tier string, recorded_at int, completed_at int, records_fetched long, status string")
    zero = {c: F.lit(0).cast("long") for c in ("records_new", "records_updated", "records_skipped")}
    records = records.withColumns(zero | {"started_at": F.col("recorded_at"), "error_message": F.lit(None).cast("string")})
    runs = audit.latest_runs(records)
    last = {r.run_id: r for r in runs.collect()}
    assert (last["r"].state, last["r"].started_at, last["r"].status, last["r"].records_fetched) == ("TX", 1, "completed", 5)
    assert [r.run_id for r in audit.run_history(runs, limit=1).collect()] == ["q"]
    assert audit.run_totals(runs).first().total_fetched == 5
    assert audit.run_totals(runs.limit(0)).first().total_new == 0


def test_three_files(spark):
    documents = spark.createDataFrame([(1,), (2,)], "DocNumber int")
    debtors = spark.createDataFrame([(1, 2, "B", "TX"), (1, 1, "A", "CA")], "DocNumber int, seq int, name string, state string")
    merged = parties.merge_three_files(documents, debtors, debtors.limit(0), "DocNumber", "seq").orderBy("DocNumber").collect()
    assert (merged[0].debtor_name, merged[0].debtor_state, merged[0].n_debtor) == ("A", "CA", 2)
    assert (merged[1].debtor_name, merged[1].n_debtor, merged[1].n_secured_party) == (None, 0, 0)


def test_reconcile_reduces_repeats(spark):
    schema = "state string, filing_number string, filing_type string, arrival int"
    left = spark.createDataFrame([("TX", "1", "a", 1), ("TX", "1", "b", 2), ("TX", "2", None, 1), ("TX", "3", "x", 1)], schema)
    right = spark.createDataFrame([("TX", "1", "b", 1), ("TX", "2", "y", 1), ("TX", "4", "x", 1)], schema)
    found = {r.filing_number: (r.verdict, r.fields) for r in quality.reconcile(left, right, ["filing_type"]).collect()}
    assert found == {"1": ("agree", ""), "2": ("differ", "filing_type"), "3": ("only_left", ""), "4": ("only_right", "")}


def test_collateral_reasons(spark):
    rows = [("KY", None), ("TX", None), ("TX", "all"), ("NY", None), ("ZZ", None)]
    filings = spark.createDataFrame(rows, "state string, collateral_description string").withColumn("filing_number", F.lit("1"))
    sources = source_dimension(spark, collateral_access={"NY": "image_only"})
    found = sorted((r.state, r.collateral_reason) for r in quality.pending_collateral(filings, sources).collect())
    assert found == [("KY", "not_in_feed"), ("NY", "image_only"), ("TX", "pending_collateral"), ("ZZ", "pending_collateral")]


def test_backfill_resumes(spark):
    ranges = quality.backfill_ranges(spark.createDataFrame([("TX",)], "state string"), "2024-01-20", "2024-03-05")
    assert [(r.range_start, r.range_end) for r in ranges.orderBy("range_start").collect()][::2] == [
        (date(2024, 1, 1), date(2024, 1, 31)),
        (date(2024, 3, 1), date(2024, 3, 31)),
    ]
    manifest = ranges.filter("range_start < '2024-03-01'").withColumn("status", F.lit("completed"))
    assert [r.range_start for r in quality.pending_ranges(ranges, manifest).collect()] == [date(2024, 3, 1)]


def test_name_search(spark):
    filings = spark.createDataFrame([("1", "TX", "The Acme Co"), ("2", "DE", "Acme Co"), ("3", "DE", "ACME, INC"), ("4", "TX", None)], "filing_number string, state string, debtor_name string")
    watchlist = spark.createDataFrame([("Acme, Inc",), ("acme, inc",)], "watch_name string")
    found = search.match_watchlist(filings, watchlist).collect()
    assert sorted((r.filing_number, r.watch_name) for r in found) == [("1", "ACME, INC"), ("3", "ACME, INC")]
    people = spark.createDataFrame([("1", "J. Smith"), ("2", "John Smith"), ("3", "Jane Smith"), ("4", "Smith")], "filing_number string, debtor_name string")
    listed = spark.createDataFrame([("John Smith",)], "watch_name string")
    assert sorted(r.filing_number for r in search.match_initials(people, listed).collect()) == ["1", "2"]


def test_chains(spark):
    rows = [("1", "UCC-1", None, "2020-01-01"), ("2", "UCC-3-CONTINUATION", "1", "2024-01-01"), ("3", "UCC-3-TERMINATION", "9", "2024-02-01")]
    filings = spark.createDataFrame(rows, "filing_number string, filing_type string, original_filing_number string, d string")
    filings = filings.selectExpr("'TX' AS state", "*", "date(d) AS filing_date", "add_months(date(d), 60) AS lapse_date")
    (chain,) = search.amendment_chains(filings).collect()
    assert (chain.n_amendments, chain.n_continuations, chain.last_amendment) == (1, 1, date(2024, 1, 1))
    assert [r.filing_number for r in search.orphan_amendments(filings).collect()] == ["3"]
    assert [r.filing_number for r in search.lapsing(filings, "2025-01-01", "2025-12-31").collect()] == ["1"]


CALLS = "id string, state string, priority string, status string, retry_count int, max_retries int, queue_no int, last string"


def calls(spark, rows):
    frame = spark.createDataFrame(rows, CALLS).selectExpr("*", "timestamp(last) AS last_attempt_at").drop("last")
    nothing = F.lit(None)
    return frame.withColumns({"completed_at": nothing.cast("timestamp"), "outcome": nothing.cast("string"), "notes": nothing.cast("string")})


def test_ready_calls(spark):
    now, earlier = "timestamp'2024-01-15 15:00:00'", "2024-01-15 01:00:00"
    rows = [
        ("a", "NY", "low", "approved", 0, 2, 1, None),
        ("b", "CT", "odd", "approved", 0, 2, 2, None),
        ("c", "GA", "high", "approved", 0, 2, 3, None),
        ("d", "CA", "high", "approved", 0, 2, 4, None),
        ("e", "FL", "high", "pending_approval", 0, 2, 5, earlier),
        ("f", "FL", "high", "approved", 0, 2, 6, "2024-01-14 23:00:00"),
        ("g", "ZZ", "high", "approved", 0, 2, 7, None),
    ]
    ready = outreach.ready_calls(calls(spark, rows), source_dimension(spark), now)
    assert [r.id for r in ready.collect()] == ["c", "b", "a"]


def test_attempts(spark):
    rows = [(x, "NY", "high", "approved", 0, 2, 1, None) for x in "abcd"]
    attempts = [("a", 1, "no-answer"), ("b", 1, "no-answer"), ("b", 2, "busy"), ("c", 1, "no-answer"), ("c", 2, "x"), ("c", 3, "successful")]
    given = spark.createDataFrame(attempts, "id string, attempt_no int, outcome string").selectExpr(
        "*", "timestamp('2024-01-15') + make_dt_interval(0, attempt_no) AS attempted_at", "'' AS notes"
    )
    found = {r.id: r for r in outreach.apply_attempts(calls(spark, rows), given).collect()}
    assert {i: (r.status, r.retry_count) for i, r in found.items()} == {
        "a": ("approved", 1),
        "b": ("failed_escalated", 2),
        "c": ("completed", 3),
        "d": ("approved", 0),
    }
    assert found["c"].completed_at == datetime(2024, 1, 15, 3) and found["d"].last_attempt_at is None


TEXT = "Agent: What is the annual fee?\n\nHuman: It is\n  ten dollars \nthanks\nbye\nfee again"


def test_answers(spark):
    questions = ["What is the annual fee?", "Is there a deposit account?", "Who are you"]
    calls = spark.createDataFrame([(1, TEXT), (2, "short")], "call_id int, transcript string")
    found = {r.call_id: [(a.question_key, a.answer) for a in r.answers] for r in transcripts.answers_in_text(calls, "transcript", questions).collect()}
    answer = "Human: It is ten dollars thanks"
    assert found[1] == [("annual_fee", answer), ("deposit_account", None), ("who", None)]
    lines = calls.selectExpr("call_id", "posexplode(split(transcript, '\\n')) AS (line_no, text)")
    by_line = transcripts.answers_in_lines(lines, questions).orderBy("call_id", "question_no").collect()
    assert [(r.question_key, r.answer) for r in by_line if r.call_id == 1] == found[1]
    assert [r.answer for r in by_line if r.call_id == 2] == [None] * 3


def test_requirements(spark):
    known = spark.createDataFrame([("TX", "fee", "5"), ("TX", "form", "A")], "state string, question_key string, answer string")
    answers = [("TX", 0, "fee", "6", "2024-01-01"), ("TX", 0, "fee", None, "2024-01-02"), ("CA", 0, "fee", "7", "2024-01-01")]
    given = spark.createDataFrame(answers, "state string, question_no int, question_key string, answer string, t string").selectExpr("*", "timestamp(t) AS called_at")
    merged = transcripts.merge_requirements(known, given).orderBy("question_key").collect()
    assert [(r.state, r.question_key, r.answer, r.data_confidence) for r in merged] == [("TX", "fee", None, "medium"), ("TX", "form", "A", "medium")]
    assert {str(r.last_call_date) for r in merged} == {"2024-01-02"}


def test_call_outcomes(spark):
    rows = [(51, True), (50, True), (None, True), (99, None)]
    found = transcripts.call_outcomes(spark.createDataFrame(rows, "n_chars long, completed boolean")).collect()
    assert [(r.human_reached, r.call_successful, r.needs_follow_up) for r in found] == [
        (True, True, False),
        (False, False, True),
        (False, False, True),
        (True, False, True),
    ]


def test_alerts_in_batch_and_stream(spark, tmp_path):
    lines = [("2024-01-01 00:01:00", "run FAILED"), ("2024-01-01 00:04:59", '{"status": "failed"}'), ("2024-01-01 00:05:00", "status=failed"), ("2024-01-01 00:20:00", "status=completed")]
    log = spark.createDataFrame(lines, "t string, message string").selectExpr("timestamp(t) AS ts", "message")
    expected = [(datetime(2024, 1, 1, 0, 0), 2), (datetime(2024, 1, 1, 0, 5), 1)]
    assert [(r.window_start, r.n_failures) for r in failure_alerts(log).orderBy("window_start").collect()] == expected
    log.write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(log.schema).parquet(str(tmp_path / "log"))
    start_alerts(stream, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True).awaitTermination()
    found = current_alerts(spark.read.parquet(str(tmp_path / "out"))).orderBy("window_start").collect()
    assert [(r.window_start, r.n_failures) for r in found] == expected


def test_cutoffs_leave_records_where_they_are(spark):
    """Records of one state are not dealt out by state, also while nothing is stored."""
    records = spark.range(8).selectExpr("'KY' AS state", "string(id) AS filing_number", "date_add(date'2024-01-01', int(id)) AS filing_date")
    none = spark.createDataFrame([], "state string, filing_date date")
    stored = spark.createDataFrame([("KY", date(2024, 1, 5))], "state string, filing_date date")
    for filings, n in ((none, 8), (stored, 4)):
        found = stats.incremental(records, filings)
        plan = found._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" not in plan and found.count() == n
