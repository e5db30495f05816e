"""Runs that lose nothing, and the store at any time."""

import gzip
import os
import random
from datetime import date

import pytest
from pyspark.sql import functions as F
from test_upsert import FIRST, LATER, batch, k

from lienflow.operators import schedule, search, stats, store as store_module
from lienflow.operators.quality import backfill_ranges
from lienflow.operators.store import COUNTED_BY, FilingStore
from lienflow.plans.ingest import backfill, ingest_landed
from lienflow.schema import FEED_FIELDS
from lienflow.sources import json_feeds
from lienflow.sources.dimension import source_dimension
from lienflow.streaming.arrivals import applied_epochs, landed_lines, start_upserts

NOW = "current_timestamp()"


@pytest.fixture
def store(spark, tmp_path):
    return FilingStore(spark, str(tmp_path / "store"))


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return path


def numbers(store, state=None):
    rows = store.filings() if state is None else store.filings().filter(F.col("state") == state)
    return sorted(r.filing_number for r in rows.collect())


def landed(store, root, name, **chosen):
    runs = ingest_landed(store, str(root), NOW, name, lookback_days=40_000, **chosen)
    return None if runs is None else {r.state: (r.status, r.records_new) for r in runs.collect()}


# -- the ledger -------------------------------------------------------------------------------------------


def test_files_of_any_time_are_read_once(store, tmp_path):
    root = tmp_path / "files"
    put(root / "KY" / "a.csv", "FileNumber,DebtorName\nK1,x\n")
    assert landed(store, root, "one", states=["KY"]) == {"KY": ("completed", 1)}
    # A file with a time before the first run, one in another folder, and one that is written anew.
    old = put(root / "KY" / "old.csv", "FileNumber,DebtorName\nK2,x\n")
    os.utime(old, (1, 1))
    put(root / "KY" / "day" / "b.csv", "FileNumber,DebtorName\nK3,x\n")
    assert landed(store, root, "two", states=["KY"]) == {"KY": ("completed", 2)}
    assert landed(store, root, "three", states=["KY"]) is None
    put(root / "KY" / "a.csv", "FileNumber,DebtorName\nK1,x\nK4,y\n")
    assert landed(store, root, "four", states=["KY"]) == {"KY": ("completed", 1)}
    assert numbers(store) == ["K1", "K2", "K3", "K4"]
    assert store.ledger().filter("is_read").count() == 4
    store.compact("base")
    assert landed(store, root, "five", states=["KY"]) is None


def test_a_file_that_lands_during_a_run_is_read_by_the_next(store, tmp_path, monkeypatch):
    root = tmp_path / "files"
    put(root / "KY" / "a.csv", "FileNumber\nK1\n")
    upsert = FilingStore.upsert

    def slow(self, *args, **kwargs):
        late = put(root / "KY" / "b.csv", "FileNumber\nK2\n")
        os.utime(late, (100, 100))
        return upsert(self, *args, **kwargs)

    monkeypatch.setattr(FilingStore, "upsert", slow)
    landed(store, root, "one", states=["KY"])
    monkeypatch.undo()
    assert numbers(store) == ["K1"]
    assert landed(store, root, "two", states=["KY"]) == {"KY": ("completed", 1)}


def test_a_failed_batch_leaves_no_file_in_the_ledger(store, tmp_path, monkeypatch):
    root = tmp_path / "files"
    put(root / "KY" / "a.csv", "FileNumber\nK1\n")
    monkeypatch.setattr(FilingStore, "_commit", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        landed(store, root, "one", states=["KY"])
    monkeypatch.undo()
    assert store.ledger().count() == 0 and store.current_runs().first().status == "failed"
    assert landed(store, root, "one", states=["KY"]) == {"KY": ("completed", 1)}
    # Asked for again after its commit, only the records of the run are written.
    assert landed(store, root, "one", states=["KY"]) == {"KY": ("completed", 1)}


def test_updates_that_land_with_the_master(store, tmp_path):
    root = tmp_path / "files"
    put(root / "TX" / "master" / "m.json", '[{"filing_number": "M1", "file_date": "2024-01-01"}]')
    update = put(root / "TX" / "update" / "u.json", '[{"filing_number": "U1", "file_date": "2024-01-02"}]')
    os.utime(update, (1, 1))
    assert landed(store, root, "one", states=["TX"]) == {"TX": ("completed", 1)} and numbers(store) == ["M1"]
    assert landed(store, root, "two", states=["TX"]) == {"TX": ("completed", 1)} and numbers(store) == ["M1", "U1"]
    assert landed(store, root, "three", states=["TX"]) is None


def test_passed_over_deliveries_stay_passed_over(store, tmp_path):
    root = tmp_path / "files"
    for day, text in (("1", "FileNumber\tDebtorName\nI1\tx\n"), ("2", "FileNumber\tDebtorName\nI2\tx\n")):
        os.utime(put(root / "ID" / day / "all.tsv", text), (int(day) * 1000, int(day) * 1000))
    assert landed(store, root, "one", states=["ID"])["ID"][0] == "completed"
    assert numbers(store) == ["I2"]
    assert landed(store, root, "two", states=["ID"]) is None
    assert {(r.delivery, r.is_read) for r in store.ledger().collect()} == {("1", False), ("2", True)}


# -- what stays on disk -----------------------------------------------------------------------------------


def test_a_large_batch_is_merged_in_parts(spark, tmp_path, monkeypatch):
    """In parts of whole keys the same rows and outcomes, whatever the keys; one part writes after the other."""
    first = [k(f"F{i % 9}", debtor_name=f"n{i}", source_raw=f"r{i // 2}") for i in range(40)]
    second = [k(f"F{i % 14}", debtor_name=f"m{i}", source_raw=f"r{i}") for i in range(20, 60)]
    found, written = {}, []
    write = FilingStore._write
    monkeypatch.setattr(FilingStore, "_write", lambda self, rows, name, **more: (written.append(name), write(self, rows, name, **more)))
    for rows in (1_000_000, 20):
        monkeypatch.setattr(store_module, "PART_ROWS", rows)
        store = FilingStore(spark, str(tmp_path / f"store-{rows}"))
        counts = [sorted(store.upsert(batch(spark, b), FIRST, name).collect()) for name, b in (("one", first), ("two", second))]
        kept = sorted((r.filing_number, r.debtor_name, r.source_raw) for r in store.filings().collect())
        found[rows] = kept, counts, sorted(map(tuple, store.statistics().collect()))
        assert not (tmp_path / f"store-{rows}" / "incoming" / "batch=one").exists()
        assert not (tmp_path / f"store-{rows}" / "parts" / "batch=one").exists()
    assert found[20] == found[1_000_000] and len(found[20][0]) == 14
    assert written.count("one") == 1 + 3


def test_what_a_run_reads_into_goes_with_it(spark, store, tmp_path):
    root = tmp_path / "files"
    put(root / "KY" / "a.csv", "FileNumber,DebtorName\nK1,x\n")
    put(root / "CA" / "a.xml", "<Root><Filing><FilingNumber>C1</FilingNumber><Debtor><Name>x</Name></Debtor></Filing></Root>")
    assert landed(store, root, "one", states=["KY", "CA"]) == {"KY": ("completed", 1), "CA": ("completed", 1)}
    assert numbers(store) == ["C1", "K1"] and store.parties().count() == 1
    left = {p.parent.name for p in (tmp_path / "store").glob("*/batch=*")}
    assert left == {"filings", "statistics", "quarantine", "filing_parties", "ledger", "listing", "ingestion_runs", "event_log"}


# -- states by themselves ---------------------------------------------------------------------------------


def test_a_state_that_cannot_be_read_fails_alone(store, tmp_path):
    root = tmp_path / "files"
    put(root / "KY" / "a.csv", "FileNumber\nK1\n")
    broken = root / "TX" / "master.json.gz"
    put(broken, "this is no gzip file")
    formats = {"TX": "json_lines"}
    found = landed(store, root, "one", states=["KY", "TX"], formats=formats)
    assert found == {"KY": ("completed", 1), "TX": ("failed", 0)} and numbers(store) == ["K1"]
    failed = store.current_runs().filter("state = 'TX'").first()
    assert failed.status == "failed" and failed.error_message
    events = {(r.state, r.event) for r in store.events().collect()}
    ends = {("KY", "ingestion_complete"), ("TX", "ingestion_failed")}
    assert events == ends | {("KY", "ingestion_start"), ("TX", "ingestion_start")}
    assert store.ledger().filter("state = 'TX'").count() == 0
    # Alone it fails as well, stores nothing, and is read once it is whole.
    assert landed(store, root, "two", states=["TX"], formats=formats) == {"TX": ("failed", 0)}
    assert not store.is_committed("two")
    with gzip.open(broken, "wt") as out:
        out.write('{"filing_number": "T1"}\n')
    assert landed(store, root, "three", states=["KY", "TX"], formats=formats) == {"TX": ("completed", 1)}
    assert landed(store, root, "four", states=["KY", "TX"], formats={"KY": "nonsense"}) is None
    put(root / "KY" / "b.csv", "FileNumber\nK2\n")
    assert landed(store, root, "five", states=["KY"], formats={"KY": "nonsense"}) == {"KY": ("failed", 0)}
    assert "nonsense" in store.current_runs().filter("state = 'KY' AND status = 'failed'").first().error_message


def test_a_file_that_cannot_be_read_makes_a_run_partial(store, tmp_path):
    root = tmp_path / "files"
    for i in range(5):
        put(root / "TX" / f"update-{i}.json", f'{{"filing_number": "T{i}"}}\n')
    broken = put(root / "TX" / "update-2b.json.gz", "this is no gzip file")
    formats = {"TX": "json_lines"}
    assert landed(store, root, "one", states=["TX"], formats=formats) == {"TX": ("partial", 5)}
    assert store.current_runs().first().error_message and store.ledger().count() == 5
    with gzip.open(broken, "wt") as out:
        out.write('{"filing_number": "T9"}\n')
    assert landed(store, root, "two", states=["TX"], formats=formats) == {"TX": ("completed", 1)}
    assert landed(store, root, "three", states=["TX"], formats=formats) is None
    # A full delivery is taken whole or not at all.
    header = "FileNumber\tDebtorName\n"
    put(root / "ID" / "1" / "a.tsv", f"{header}I1\tx\nI2\tx\n")
    landed(store, root, "four", states=["ID"])
    put(root / "ID" / "2" / "a.tsv", f"{header}I1\ty\n")
    put(root / "ID" / "2" / "b.tsv.gz", "this is no gzip file")
    assert landed(store, root, "five", states=["ID"]) == {"ID": ("failed", 0)} and numbers(store, "ID") == ["I1", "I2"]


# -- streams ----------------------------------------------------------------------------------------------


def test_streams_do_not_take_each_other_for_applied(spark, store, tmp_path):
    def to_records(lines):
        return json_feeds.map_bulk(lines.withColumnRenamed("value", "record"), "TX")

    def run(folder, checkpoint):
        start_upserts(landed_lines(spark, str(tmp_path / folder)), to_records, store, str(tmp_path / checkpoint), FIRST).awaitTermination()

    put(tmp_path / "s1" / "a.jsonl", '{"filing_number": "1"}\n')
    put(tmp_path / "s2" / "a.jsonl", '{"filing_number": "2"}\n')
    run("s1", "c1")
    run("s2", "c2")
    put(tmp_path / "s1" / "b.jsonl", '{"filing_number": "3"}\n')
    run("s1", "replaced")
    run("s1", "replaced")
    assert numbers(store) == ["1", "2", "3"]
    epochs = applied_epochs(store).collect()
    assert len(epochs) == 3 and {(r.n_epochs, r.last_epoch) for r in epochs} == {(1, 0)}


# -- ranges -----------------------------------------------------------------------------------------------


def test_only_delivered_ranges_are_finished(spark, store):
    def feed(*rows):
        schema = ", ".join(f"{f} string" for f in FEED_FIELDS)
        raw = spark.createDataFrame([tuple(r.get(f) for f in FEED_FIELDS) for r in rows], schema)
        return raw.withColumn("arrival", F.struct("filing_number"))

    def finished():
        rows = store.read("backfill_manifest", "state string, range_start date, n_records long").collect()
        return sorted((r.state, r.range_start.month, r.n_records) for r in rows)

    ranges = backfill_ranges(spark.createDataFrame([("TX",), ("CA",)], "state string"), "2024-01-01", "2024-03-31")
    first = feed(k("1", filing_date="2024-01-15"), k("2", filing_date="2024-01-16"), k("3", "CA", filing_date="02/01/2024"))
    backfill(store, first, ranges, FIRST, "a")
    assert finished() == [("CA", 2, 1), ("TX", 1, 2)]
    second = feed(k("4", filing_date="2024-02-15"), k("5", filing_date="2024-01-15"), k("6", "CA", filing_date="2024-02-02"))
    empty = spark.createDataFrame([("TX", date(2024, 3, 1)), ("TX", date(2023, 1, 1))], "state string, range_start date")
    backfill(store, second, ranges, LATER, "b", empty=empty)
    assert finished() == [("CA", 2, 1), ("TX", 1, 2), ("TX", 2, 1), ("TX", 3, 0)]
    # What belongs to a finished range was delivered before.
    assert numbers(store) == ["1", "2", "3", "4"]


# -- the store at any time --------------------------------------------------------------------------------


def counted(rows):
    return {tuple(r) for r in rows.groupBy(*COUNTED_BY).agg(F.count("*").alias("n")).collect()}


def test_statistics_follow_every_batch(spark, store):
    """Random batches, full deliveries and new bases: the sums always equal the counts over all filings."""
    rng = random.Random(9)
    seen = {}
    for step in range(6):
        rows = [
            k(str(rng.randrange(12)), rng.choice(["TX", "CA", "ID"]), source_raw=rng.choice("abc"), filing_status=rng.choice(["active", None]),
              filing_date=rng.choice([None, date(2024, 1, rng.randint(1, 28))]))
            for _ in range(25)
        ]
        moment = f"timestamp'2024-01-{step + 1:02d} 00:00:00'"
        name = f"b{step}"
        if step % 3 == 2:
            store.replace_state("ID", batch(spark, rows), moment, name)
        else:
            store.upsert(batch(spark, rows), moment, name)
        if step in (3, 4):
            store.compact(f"base-{step}")
        assert {tuple(r) for r in store.statistics().collect()} == counted(store.filings())
        seen[name] = {tuple(r) for r in store.filings().collect()}
    for name, rows in seen.items():
        assert {tuple(r) for r in store.filings(until=name).collect()} == rows
        assert {tuple(r) for r in store.statistics(until=name).collect()} == counted(store.filings(until=name))
    by_key = {name: {(r[1], r[0]): r for r in rows} for name, rows in seen.items()}
    raw = store.filings().columns.index("source_raw")
    for first, last in (("b0", "b1"), ("b1", "b2"), ("b1", "b5"), (None, "b3")):
        old, new = by_key.get(first, {}), by_key[last]
        expected = {(*x, "added") for x in new.keys() - old.keys()} | {(*x, "removed") for x in old.keys() - new.keys()}
        expected |= {(*x, "changed") for x in old.keys() & new.keys() if old[x][raw] != new[x][raw]}
        assert {tuple(r) for r in store.changes_between(first, last).collect()} == expected
    with pytest.raises(ValueError, match="no such commit"):
        store.filings(until="nothing")


def test_reports_read_no_filing(spark, store):
    store.upsert(batch(spark, [k("1", filing_date=date(2024, 1, 2)), k("2", "CA")]), FIRST, "a")
    counts = store.statistics()
    report = schedule.status_report(source_dimension(spark), counts, LATER)
    same = schedule.status_report(source_dimension(spark), store.filings(), LATER)
    assert report.collect() == same.collect()
    for read in (report, stats.all_stats(counts), stats.summary(counts), stats.count_by(counts, "state")):
        assert not any("/filings/" in file for file in read.inputFiles())
    assert {tuple(r) for r in stats.all_stats(counts).collect()} == {tuple(r) for r in stats.all_stats(store.filings()).collect()}


def test_a_batch_reads_its_states_and_numbers_only(spark, store, capsys):
    """Folders of other states are not listed and numbers beyond the batch's are left to the file statistics."""
    store.upsert(batch(spark, [k(f"{i:03d}", s) for i in range(50) for s in ("TX", "CA")]), FIRST, "a")
    near = store._near(store.filings(), batch(spark, [k("010"), k("012")]))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    near.select("filing_number").explain("formatted")
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    plan = capsys.readouterr().out
    assert "state#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(filing_number,010)" in plan and "LessThanOrEqual(filing_number,012)" in plan
    assert near.count() == 3 and store._near(store.filings(), batch(spark, [])).count() == 0


def test_bases_are_made_and_cleaned(spark, tmp_path):
    store = FilingStore(spark, str(tmp_path / "often"), compact_after=3)
    for i in range(8):
        store.upsert(batch(spark, [k(str(i)), k("0", source_raw=str(i))]), FIRST, f"b{i}")
    assert len(store.commits()) <= 4 and len(numbers(store)) == 8
    before = store.filings().collect()
    assert store.clean("current_timestamp() - interval 1 day") == []
    removed = store.clean("current_timestamp() + interval 1 day")
    assert "b0" in removed and sorted(store.filings().collect()) == sorted(before)
    assert store.is_committed("b0") and store.clean("current_timestamp() + interval 1 day") == []
    assert {tuple(r) for r in store.statistics().collect()} == counted(store.filings())
    # The commit rows are in one file now, and none is lost.
    assert len(list((tmp_path / "often" / "commits").glob("*.parquet"))) == 1
    assert [r.seq for r in store.log()] == list(range(1, len(store.log()) + 1)) and len(store.log()) > 8


# -- chains -----------------------------------------------------------------------------------------------


def test_chains_of_any_depth(spark):
    rng = random.Random(3)
    up = {0: None}
    for i in range(1, 120):
        up[i] = i - 1 if i < 70 else rng.randrange(i)
    up |= {200: 999, 201: 200, 300: 301, 301: 302, 302: 300, 303: 301, 304: 303, 400: 400}
    text = lambda n: None if n is None else str(n)
    frame = spark.createDataFrame([("TX", text(i), text(j)) for i, j in up.items()], "state string, filing_number string, original_filing_number string")
    frame = frame.unionByName(frame.limit(5).withColumn("state", F.lit("CA")))

    def walk(i):
        seen = set()
        while i in up and up[i] is not None:
            if i in seen:
                return None, None
            seen.add(i)
            i = up[i]
        return str(i), len(seen)

    found = {r.filing_number: (r.root_number, r.depth) for r in search.chain_roots(frame).filter("state = 'TX'").collect()}
    assert found == {str(i): walk(i) for i in up}
    assert search.chain_roots(frame.limit(0)).count() == 0


def test_lapse_after_continuations(spark):
    schema = "filing_number string, original_filing_number string, filing_type string, filing_date date, lapse_date date, state string"
    keep = "UCC-3-CONTINUATION"
    rows = [
        ("1", None, "UCC-1", date(2000, 1, 10), None, "TX"),
        ("2", "1", keep, date(2004, 8, 1), None, "TX"),  # in the window: to 2010
        ("3", "2", keep, date(2004, 9, 1), None, "TX"),  # the same window again
        ("4", "3", keep, date(2008, 1, 1), None, "TX"),  # too early
        ("5", "4", keep, date(2010, 1, 10), None, "TX"),  # the last day: to 2015
        ("6", "5", "UCC-3-TERMINATION", date(2012, 1, 1), None, "TX"),
        ("7", None, "UCC-1", date(2000, 1, 1), date(2003, 1, 1), "TX"),
        ("8", "7", keep, date(2003, 1, 2), None, "TX"),  # too late
        ("9", None, "UCC-1", None, None, "TX"),
    ]
    found = {r.filing_number: r for r in search.whole_chains(spark.createDataFrame(rows, schema)).collect()}
    one = found["1"]
    assert (one.n_amendments, one.depth, one.n_continuations) == (5, 5, 4)
    assert (one.effective_lapse, one.terminated_on) == (date(2015, 1, 10), date(2012, 1, 1))
    assert found["7"].effective_lapse == date(2003, 1, 1) and found["9"].effective_lapse is None
