import random
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lienflow.operators import stats
from lienflow.operators import sequences
from lienflow.operators.sequences import with_previous
from lienflow.operators.store import FilingStore
from lienflow.operators.upsert import classify, merge
from lienflow.operators.quality import backfill_ranges, removed_filings, replacement_diff
from lienflow.plans.ingest import backfill, ingest, ingest_landed
from lienflow.schema import FEED_FIELDS, FILING_SCHEMA
from lienflow.sources import json_feeds
from lienflow.streaming.arrivals import landed_lines, start_upserts

FIRST, LATER = "timestamp'2024-01-01 00:00:00'", "timestamp'2024-02-01 00:00:00'"


def batch(spark, records, start=0):
    """Feed records in the given order; each is a dict of fields."""
    schema = ", ".join(f"{f} {'date' if f in ('filing_date', 'lapse_date') else 'string'}" for f in FEED_FIELDS)
    base = {"filing_type": "UCC-1", "source_tier": "state_bulk", "source_raw": "raw"}
    rows = [tuple((base | r).get(f) for f in FEED_FIELDS) + (start + i,) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, schema + ", n long").withColumn("arrival", F.struct("n")).drop("n")


def counts(result):
    found = result.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_new", "n_updated", "n_skipped")]).first()
    return tuple(found)


@pytest.fixture
def store(spark, tmp_path):
    return FilingStore(spark, str(tmp_path / "store"))


def k(number, state="TX", **fields):
    return {"filing_number": number, "state": state, **fields}


def test_new_skip_update(spark, store):
    assert counts(store.upsert(batch(spark, [k("1")]), FIRST, "b1")) == (1, 0, 0)
    assert counts(store.upsert(batch(spark, [k("1", debtor_name="IGNORED")]), LATER, "b2")) == (0, 0, 1)
    row = store.filings().first()
    assert (row.debtor_name, row.last_updated_at) == (None, datetime(2024, 1, 1))
    assert counts(store.upsert(batch(spark, [k("1", source_raw="b", debtor_name="NEW NAME")]), LATER, "b3")) == (0, 1, 0)
    (row,) = store.filings().collect()
    assert (row.debtor_name, row.source_raw) == ("NEW NAME", "b")
    assert (row.ingested_at, row.last_updated_at) == (datetime(2024, 1, 1), datetime(2024, 2, 1))
    assert counts(store.upsert(batch(spark, [k("1", "CA")]), LATER, "b4")) == (1, 0, 0)
    assert store.filings().count() == 2


def test_batch(spark, store):
    assert counts(store.upsert(batch(spark, [k(str(i)) for i in range(5)]), FIRST, "b5")) == (5, 0, 0)
    mixed = [k("1"), k("1", source_raw="changed"), k("9")]
    assert counts(store.upsert(batch(spark, mixed), LATER, "b6")) == (1, 1, 1)
    assert counts(store.upsert(batch(spark, []), LATER, "b7")) == (0, 0, 0)
    assert store.filings().count() == 6


def test_rejects_are_kept(spark, store):
    bad = [k(None), k("UNKNOWN"), k("1", None), k("1", "??"), k("2")]
    assert counts(store.upsert(batch(spark, bad), FIRST, "b8")) == (1, 0, 0)
    reasons = store.quarantine().groupBy("reject_reason").count().collect()
    assert {r.reject_reason: r["count"] for r in reasons} == {"missing_filing_number": 2, "no_state_code": 2}


def test_counts_and_latest_date(spark, store):
    rows = [k(str(i), filing_date=date(2024, i + 4, 15)) for i in range(3)] + [k("a", "CA"), k("b", "CA")]
    store.upsert(batch(spark, rows), FIRST, "b9")
    filings = store.filings()
    assert [r.n_filings for r in (stats.filing_counts(filings, s).first() for s in ("TX", "CA", None))] == [3, 2, 5]
    latest = {r.state: r.latest_filing_date for r in stats.latest_by_state(filings).collect()}
    assert latest == {"TX": date(2024, 6, 15), "CA": None}
    known = stats.count_by(spark.createDataFrame([("",), (None,), ("a",)], "filing_status string"), "filing_status")
    assert [tuple(r) for r in known.collect()] == [("unknown", 2), ("a", 1)]


def sequential(stored, incoming):
    """The plain loop: one record after the other."""
    table, outcomes = {key: dict(v) for key, v in stored.items()}, []
    for r in incoming:
        key = (r["state"], r["filing_number"])
        if key not in table:
            table[key] = {"raw": r["source_raw"], "name": r["debtor_name"], "since": 2, "updated": 2}
            outcomes.append("new")
        elif table[key]["raw"] == r["source_raw"]:
            outcomes.append("skipped")
        else:
            table[key] |= {"raw": r["source_raw"], "name": r["debtor_name"], "updated": 2}
            outcomes.append("updated")
    return table, outcomes


@pytest.mark.parametrize("hot_rows", [1_000_000, 10, 1])
@pytest.mark.parametrize("seed", [7])
def test_same_as_one_by_one(spark, seed, hot_rows):
    """One key holds a third of all rows; spreading it changes nothing."""
    rng = random.Random(seed)
    raws = ["a", "b", None]

    def records(n):
        keys = ["hot" if rng.random() < 0.34 else str(rng.randrange(20)) for _ in range(n)]
        return [k(x, "TX" if x == "hot" else rng.choice(["TX", "CA"]), source_raw=rng.choice(raws), debtor_name=str(rng.random())) for x in keys]

    old, new = records(60), records(300)
    stored_rows, _ = sequential({}, old)
    stored = merge(batch(spark, old), None, FIRST, count=False)
    stored_rows = {key: v | {"since": 1, "updated": 1} for key, v in stored_rows.items()}
    table, outcomes = sequential(stored_rows, new)
    incoming = batch(spark, new)
    found = classify(incoming, stored, hot_rows).orderBy("arrival").collect()
    assert [r.outcome for r in found] == outcomes
    month = {1: datetime(2024, 1, 1), 2: datetime(2024, 2, 1)}
    expected = {key: (v["raw"], v["name"], month[v["since"]], month[v["updated"]]) for key, v in table.items()}
    merged = merge(incoming, stored, LATER, hot_rows).collect()
    assert {(r.state, r.filing_number): (r.source_raw, r.debtor_name, r.ingested_at, r.last_updated_at) for r in merged} == expected
    assert sum(r.n_new + r.n_updated + r.n_skipped for r in merged) == len(new)


def test_no_task_holds_a_hot_key(spark):
    rows = spark.range(4000).selectExpr("'x' AS key", "id", "id % 7 AS v")
    spread = with_previous(rows, ["key"], ["id"], "v", hot_rows=100)
    sizes = spread.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < 2000
    assert spread.filter("previous.v <> (id - 1) % 7 OR (id > 0 AND previous IS NULL)").count() == 0


def test_ingest_records_runs(spark, store):
    records = [k("1", filing_date="01/15/2024", debtor_name=" doe  john "), k("2", filing_date="20241115")]
    records = [r | {"source_tier": "state_bulk"} for r in records]
    raw = spark.createDataFrame([tuple(r.get(f) for f in FEED_FIELDS) for r in records], ", ".join(f"{f} string" for f in FEED_FIELDS))
    raw = raw.withColumn("arrival", F.struct(F.monotonically_increasing_id().alias("n")))
    (run,) = ingest(store, raw, FIRST, "batch-1").collect()
    assert (run.state, run.records_fetched, run.records_new, run.status) == ("TX", 2, 2, "completed")
    assert run.source_tier == "state_bulk" and run.run_id.startswith("TX_20240101_000000_")
    assert store.filings().filter("debtor_name = 'DOE JOHN'").first().filing_date == date(2024, 1, 15)
    (again,) = ingest(store, raw, LATER, "batch-2").collect()
    assert (again.records_fetched, again.records_skipped) == (1, 1)
    assert ingest(store, raw, LATER, "batch-3", full_refresh=True).first().records_skipped == 2
    events = {r["event"]: r["count"] for r in store.events().groupBy("event").count().collect()}
    assert events == {"ingestion_start": 3, "ingestion_complete": 3}
    assert store.current_runs().count() == 3
    assert (run.started_at, run.completed_at) == (datetime(2024, 1, 1), datetime(2024, 1, 1))
    # The same batch again changes nothing, and earlier records can still be read.
    first = ingest(store, raw, FIRST, "batch-1")
    assert first.first().records_new == 2 and store.current_runs().count() == 3


def test_failed_run_is_recorded(spark, store):
    raw = batch(spark, [k("1", filing_date=date(2024, 1, 1))]).withColumn("debtor_name", F.raise_error(F.lit("broken feed")))
    with pytest.raises(Exception, match="broken feed"):
        ingest(store, raw, FIRST, "bad", full_refresh=True)
    run = store.current_runs().first()
    assert run.status == "failed" and "broken feed" in run.error_message
    assert store.filings().count() == 0
    failed = store.events().filter("event = 'ingestion_failed'").first()
    assert failed.state == "TX" and failed.error == run.error_message and failed.records_new == 0


def test_full_replacement(spark, store):
    store.upsert(batch(spark, [k("1", "ID"), k("2", "ID"), k("3", "TX")]), FIRST, "b10")
    delivered = merge(batch(spark, [k("2", "ID", source_raw="n"), k("4", "ID")]), None, LATER, count=False)
    stored = store.filings()
    assert {(r.filing_number, r.change) for r in replacement_diff(stored, delivered).collect()} == {
        ("1", "removed"),
        ("2", "changed"),
        ("4", "added"),
    }
    assert [r.filing_number for r in removed_filings(stored, delivered).collect()] == ["1"]
    store.replace_state("ID", batch(spark, [k("2", "ID", source_raw="n"), k("4", "ID")]), LATER, "full")
    assert {(r.state, r.filing_number) for r in store.filings().collect()} == {("ID", "2"), ("ID", "4"), ("TX", "3")}


def test_streamed_files(spark, store, tmp_path):
    folder = tmp_path / "landed"
    folder.mkdir()

    def land(name, *numbers):
        (folder / name).write_text("".join(f'{{"filing_number": "{n}", "debtor_name": "x"}}\n' for n in numbers))

    def to_records(lines):
        return json_feeds.map_bulk(lines.withColumnRenamed("value", "record"), "TX")

    def run():
        lines = landed_lines(spark, str(folder), max_files=1)
        start_upserts(lines, to_records, store, str(tmp_path / "state"), FIRST).awaitTermination()

    land("a.jsonl", 1, 2)
    run()
    land("b.jsonl", 2, 3)
    land("c.jsonl", 3, 4)
    run()
    assert sorted(r.filing_number for r in store.filings().collect()) == ["1", "2", "3", "4"]
    epochs = [c.batch for c in store.commits()]
    assert [e.split("-epoch-")[1] for e in epochs] == [f"{i:09d}" for i in range(3)]
    assert len({e.split("-epoch-")[0] for e in epochs}) == 1
    assert [sum(x) for x in zip(*[counts(store.outcomes(e)) for e in epochs])] == [4, 0, 2]


def test_landed_files(spark, store, tmp_path):
    root = tmp_path / "files"
    for state, name, text in [
        ("KY", "ky.csv", "FileNumber,FileDate,DebtorName\nK1,01/15/2024,doe\n,x,y\n"),
        ("TX", "tx.json", '{"records": [{"filing_number": "T1"}, {"filing_number": "T2"}]}'),
        ("AL", "al.json", '{"results": [{"filing_number": "A1", "debtor": {"name": "n"}}]}'),
    ]:
        (root / state).mkdir(parents=True)
        (root / state / name).write_text(text)

    def run(as_of, **chosen):
        runs = ingest_landed(store, str(root), as_of, re.sub("[^0-9a-z]+", "-", f"{as_of} {chosen}"), **chosen)
        return None if runs is None else {r.state: (r.records_new, r.records_skipped) for r in runs.collect()}

    (root / "KY" / "2024-01-15").mkdir()
    (root / "KY" / "2024-01-15" / "more.csv").write_text("DebtorName,FileNumber\nroe,K2\n")
    (root / "KY" / "late.csv.tmp").write_text("FileNumber\nK3\n")
    assert run(FIRST, states=["ky"]) == {"KY": (2, 0)}
    assert run(FIRST, tier="commercial") == {"AL": (1, 0)}
    assert run("timestamp'2024-01-01 12:00:00'") == {"TX": (2, 0)}
    assert run("timestamp'2024-01-01 13:00:00'") is None
    assert run(LATER, everything=True) == {"AL": (0, 1), "KY": (0, 2), "TX": (0, 2)}
    assert store.quarantine().count() == 2


def test_backfill(spark, store):
    rows = [k("1", filing_date="2024-01-15"), k("2", filing_date="02/15/2024"), k("3", filing_date="2023-12-31"), k("4")]
    raw = spark.createDataFrame([tuple(r.get(f) for f in FEED_FIELDS) for r in rows], ", ".join(f"{f} string" for f in FEED_FIELDS))
    raw = raw.withColumn("arrival", F.struct("filing_number"))
    states = spark.createDataFrame([("TX",)], "state string")
    assert backfill(store, raw, backfill_ranges(states, "2024-01-01", "2024-01-31"), FIRST, "a").first().records_new == 2
    assert backfill(store, raw, backfill_ranges(states, "2024-01-01", "2024-02-28"), LATER, "b").first().records_fetched == 2
    # The undated record went along with the first call.
    assert sorted(r.filing_number for r in store.filings().collect()) == ["1", "2", "4"]


def test_backfill_of_a_late_state(spark, store):
    rows = [k("1", filing_date="2024-01-15"), k("1", "CA", filing_date="2024-01-16")]
    raw = spark.createDataFrame([tuple(r.get(f) for f in FEED_FIELDS) for r in rows], ", ".join(f"{f} string" for f in FEED_FIELDS))
    raw = raw.withColumn("arrival", F.struct("filing_number"))
    ranges = backfill_ranges(spark.createDataFrame([("TX",), ("CA",)], "state string"), "2024-01-01", "2024-01-31")
    backfill(store, raw.filter("state = 'TX'"), ranges, FIRST, "a")
    assert backfill(store, raw.filter("state = 'CA'"), ranges, LATER, "b").first().records_new == 1
    assert {r.state for r in store.filings().collect()} == {"TX", "CA"}


def test_parties(spark, store):
    columns = "filing_state string, filing_number string, role string, party_no int, name string"
    empty = {c: F.lit(None).cast("string") for c in ("address", "city", "state", "zip")}

    def party(*rows):
        return spark.createDataFrame(rows, columns).withColumns(empty)

    store.upsert_parties(party(("TX", "1", "debtor", 0, "A"), ("TX", "1", "debtor", 1, "B"), ("CA", "1", "debtor", 0, "C")), "p1")
    store.upsert_parties(party(("TX", "1", "debtor", 0, "D"), ("TX", "2", "secured_party", 0, "E")), "p2")
    found = {(r.filing_state, r.filing_number, r.role, r.name) for r in store.parties().collect()}
    assert found == {("TX", "1", "debtor", "D"), ("TX", "2", "secured_party", "E"), ("CA", "1", "debtor", "C")}


def test_a_batch_that_breaks_off_is_not_seen(spark, store, monkeypatch):
    store.upsert(batch(spark, [k("1"), k(None)]), FIRST, "a")
    monkeypatch.setattr(FilingStore, "_commit", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        store.upsert(batch(spark, [k("1", source_raw="b"), k("2"), k(None)]), LATER, "b")
    assert [r.source_raw for r in store.filings().collect()] == ["raw"] and store.quarantine().count() == 1
    monkeypatch.undo()
    assert counts(store.upsert(batch(spark, [k("1", source_raw="b"), k("2"), k(None)]), LATER, "b")) == (1, 1, 0)
    assert store.filings().count() == 2 and store.quarantine().count() == 2
    store.compact("base")
    store.upsert(batch(spark, [k("2", source_raw="c"), k("3")]), LATER, "c")
    assert {(r.filing_number, r.source_raw) for r in store.filings().collect()} == {("1", "b"), ("2", "c"), ("3", "raw")}
    assert [c.batch for c in store.commits()] == ["base", "c"]


def test_unreadable_pages_make_a_run_partial(spark, store, tmp_path):
    folder = tmp_path / "files" / "AL"
    folder.mkdir(parents=True)
    (folder / "good.json").write_text('{"results": [{"filing_number": "A1"}, {"filing_number": "A2"}]}')
    (folder / "cut.json").write_text('{"results": [{"filing_number": "A3"}, {"filing_number": "A4"')
    (folder / "other.json").write_text('{"unknown": [{"filing_number": "A5"}]}')
    (run,) = ingest_landed(store, str(tmp_path / "files"), FIRST, "one", states=["AL"]).collect()
    assert (run.status, run.records_new, run.error_message) == ("partial", 2, "2 documents could not be read")
    assert [r.reject_reason for r in store.quarantine().collect()] == ["unreadable_document"] * 2


def test_states_of_odd_shape_lose_nothing(spark, store):
    """A party of a state code that no filing can have leaves the others alone."""
    old = [("tx", "1", "debtor", 0, "A"), ("tx", "2", "debtor", 0, "B")]
    columns = "filing_state string, filing_number string, role string, party_no int, name string"
    empty = {c: F.lit(None).cast("string") for c in ("address", "city", "state", "zip")}
    store.upsert_parties(spark.createDataFrame(old, columns).withColumns(empty), "p1")
    store.upsert_parties(spark.createDataFrame([("tx", "1", "debtor", 0, "C")], columns).withColumns(empty), "p2")
    assert {(r.filing_number, r.name) for r in store.parties().collect()} == {("1", "C"), ("2", "B")}


def test_schema(store):
    assert store.filings().schema.names == FILING_SCHEMA.names and len(FILING_SCHEMA) == 25


def test_window_gets_tasks_by_rows(spark, monkeypatch):
    """The tasks of the window follow the rows; hot keys are found in the buckets that are full enough."""
    monkeypatch.setattr(sequences, "PIECE_ROWS", 100)
    rows = spark.range(5_000).selectExpr("string(if(id < 900, 0, id)) AS key", "id", "string(id) AS v")
    plain = with_previous(rows, ["key"], ["id"], "v")
    assert plain.rdd.getNumPartitions() >= 50
    spread = with_previous(rows, ["key"], ["id"], "v", hot_rows=500)
    expected = {i: str(i - 1) if 0 < i < 900 else None for i in range(5_000)}
    for found in (plain, spread):
        assert {r.id: r.previous and r.previous.v for r in found.collect()} == expected
