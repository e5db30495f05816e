"""Registered queries: every operator over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from functools import wraps

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lienflow import fixed_values as fixed
from lienflow.functions.dates import normalize_date
from lienflow.functions.filings import normalize_filings
from lienflow.functions.text import (
    normalize_filing_type,
    normalize_name,
    normalize_state,
    normalize_status,
    normalize_zip,
    question_key,
)
from lienflow.operators import audit, outreach, parties, quality, schedule, search, stats, transcripts, upsert
from lienflow.operators.store import FilingStore
from lienflow.plans import inputs
from lienflow.plans.ingest import backfill, ingest, ingest_landed
from lienflow.plans.inputs import state_of, table
from lienflow.schema import FEED_FIELDS, MANIFEST_SCHEMA
from lienflow.session import configure, scratch_path
from lienflow.sources import delimited, dimension, fixed_width, json_feeds, landing, logs, xml_feeds
from lienflow.sources.records import split_keyed
from lienflow.streaming import alerts, arrivals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Moments at which time-dependent queries are asked.
INGEST_MOMENT = "timestamp'2001-08-02 12:00:00'"
LATER_MOMENT = "timestamp'2001-08-03 12:00:00'"
CALL_MOMENT = "timestamp'2024-01-15 17:00:00'"

QUESTIONS = [
    "What is the process for the and",
    "How do we register die sich der",
    "Can you tell la letre que",
    "Is there a xylophone quotient",
]


def query(make: Query) -> Query:
    @wraps(make)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return make(configure(spark), sf_dir)

    QUERIES[make.__name__] = run
    return run


def as_text(rows: DataFrame, *dates: str, times: tuple[str, ...] = ()) -> DataFrame:
    """Dates and times as ISO text."""
    texts = {d: F.date_format(d, "yyyy-MM-dd") for d in dates}
    return rows.withColumns(texts | {t: F.date_format(t, "yyyy-MM-dd HH:mm:ss") for t in times})


# -- normalization ---------------------------------------------------------------------------------


@query
def normalize_dates(spark, sf_dir):
    raw = inputs.raw_filings(spark, sf_dir)
    return as_text(raw.selectExpr("filing_number", f"{normalize_date('filing_date')} AS filing_date"), "filing_date")


@query
def normalize_types_status(spark, sf_dir):
    raw = inputs.raw_filings(spark, sf_dir)
    return raw.selectExpr(
        "filing_number",
        f"{normalize_filing_type('filing_type')} AS filing_type",
        f"{normalize_status('filing_status')} AS filing_status",
    )


@query
def normalize_names_zip(spark, sf_dir):
    raw = inputs.raw_filings(spark, sf_dir)
    return raw.selectExpr(
        "filing_number",
        f"{normalize_name('debtor_name', True)} AS debtor_name",
        f"{normalize_name('debtor_name')} AS debtor_name_as_is",
        f"{normalize_zip('debtor_zip')} AS debtor_zip",
        f"{normalize_state('debtor_state')} AS debtor_state",
    )


@query
def normalized_filings(spark, sf_dir):
    keyed, _ = split_keyed(inputs.raw_filings(spark, sf_dir))
    normalized = normalize_filings(keyed.withColumn("filing_type", F.coalesce(F.nullif("filing_type", F.lit("")), F.lit("UCC"))))
    return as_text(
        normalized.select(*FEED_FIELDS),
        "filing_date",
        "lapse_date",
    )


@query
def question_keys(spark, sf_dir):
    """Short keys of whole texts, read as questions."""
    documents = table(spark, sf_dir, "benchmark")
    return documents.selectExpr("item_id", f"{question_key('text')} AS question_key")


# -- upsert ----------------------------------------------------------------------------------------


@query
def upsert_outcomes(spark, sf_dir):
    classified = upsert.classify(inputs.line_batch(spark, sf_dir))
    return classified.groupBy("outcome").agg(F.count("*").alias("n_rows"))


@query
def upsert_outcomes_by_state(spark, sf_dir):
    """Outcomes against stored filings: the lines with status O are stored, those with F arrive."""
    lines = inputs.line_batch(spark, sf_dir)
    stored = upsert.merge(lines.filter("l_linestatus = 'O'"), None, INGEST_MOMENT, count=False)
    classified = upsert.classify(lines.filter("l_linestatus = 'F'"), stored)
    return upsert.outcome_counts(classified, ["state"])


@query
def upsert_final_state(spark, sf_dir):
    merged = upsert.merge(inputs.line_batch(spark, sf_dir), None, INGEST_MOMENT)
    return as_text(
        merged.select("state", "filing_number", "debtor_name", "filing_date", "source_raw", "n_new", "n_updated", "n_skipped"),
        "filing_date",
    )


@query
def upsert_hot_keys(spark, sf_dir):
    """The same outcomes when keys with more than five rows are spread over several tasks."""
    classified = upsert.classify(inputs.line_batch(spark, sf_dir), hot_rows=5)
    return upsert.outcome_counts(classified, ["state"])


@query
def replacement_changes(spark, sf_dir):
    """What a full delivery of the lines with status F changes in a store of those with status O."""
    lines = inputs.line_batch(spark, sf_dir)
    at = INGEST_MOMENT
    stored = upsert.merge(lines.filter("l_linestatus = 'O'"), None, at, count=False)
    delivered = upsert.merge(lines.filter("l_linestatus = 'F'"), None, at, count=False)
    return quality.replacement_diff(stored, delivered).groupBy("state", "change").agg(F.count("*").alias("n_filings"))


def _store(spark: SparkSession, name: str) -> FilingStore:
    return FilingStore(spark, scratch_path(spark, name))


@query
def stored_upsert(spark, sf_dir):
    """The table on disk after the lines with status O and then those with status F."""
    lines, store = inputs.line_batch(spark, sf_dir), _store(spark, "store")
    for status in ("O", "F"):
        store.upsert(lines.filter(F.col("l_linestatus") == status), INGEST_MOMENT, status)
    return as_text(store.filings().select("state", "filing_number", "debtor_name", "filing_date", "source_raw"), "filing_date")


@query
def compacted_store(spark, sf_dir):
    """The same table, the second batch applied twice, folded into a new base before and after."""
    lines, store = inputs.line_batch(spark, sf_dir), _store(spark, "folded")
    for step in ("O", "base-1", "F", "F", "base-2"):
        if step.startswith("base"):
            store.compact(step)
        else:
            store.upsert(lines.filter(F.col("l_linestatus") == step), INGEST_MOMENT, step)
    return store.filings().select("state", "filing_number", "debtor_name", "source_raw")


@query
def cleaned_store(spark, sf_dir):
    """The same table in a store that makes its own bases, after what they replaced is removed."""
    lines, store = inputs.line_batch(spark, sf_dir), _store(spark, "cleaned")
    store.compact_after = 1
    for status in ("O", "F"):
        store.upsert(lines.filter(F.col("l_linestatus") == status), INGEST_MOMENT, status)
    store.clean("current_timestamp() + interval 1 day")
    return store.filings().select("state", "filing_number", "debtor_name", "source_raw")


@query
def ingested_runs(spark, sf_dir):
    """Run records of two ingestion runs: all raw filings, and then all of them again."""
    raw, store = _rendered(spark, sf_dir).drop("ordered_at"), _store(spark, "runs")
    raw = raw.withColumn("arrival", F.struct("source_raw"))
    for batch in ("first", "second"):
        ingest(store, raw, INGEST_MOMENT, batch, full_refresh=True)
    runs = store.current_runs()
    return runs.select("state", "source_tier", "records_fetched", "records_new", "records_updated", "records_skipped", "status")


@query
def event_log(spark, sf_dir):
    """Events of a run of all raw filings and of one that fails."""
    store = _broken_store(spark, sf_dir)
    columns = ["state", "event", "tier", "records_new", "record_errors"]
    return store.events().select(*columns, F.col("error").isNotNull().cast("long").alias("n_errors"))


@query
def failed_runs(spark, sf_dir):
    """Run records after a run that fails, with the filings that are stored all the same."""
    store = _broken_store(spark, sf_dir)
    held = store.filings().groupBy("state").agg(F.count("*").alias("records_stored"))
    runs = store.current_runs().join(held, "state", "left")
    error = F.coalesce(F.col("error_message").contains("broken feed"), F.lit(False)).alias("has_error")
    return runs.select("state", "source_tier", "status", "records_new", "records_stored", error)


def _broken_store(spark: SparkSession, sf_dir: str) -> FilingStore:
    raw, store = _rendered(spark, sf_dir).drop("ordered_at"), _store(spark, "broken")
    raw = raw.withColumn("arrival", F.struct("source_raw"))
    ingest(store, raw, INGEST_MOMENT, "good", full_refresh=True)
    broken = raw.withColumn("debtor_city", F.when(F.col("filing_number").isNotNull(), F.raise_error(F.lit("broken feed"))))
    with suppress(PySparkException):
        ingest(store, broken, LATER_MOMENT, "bad", full_refresh=True)
    return store


@query
def run_ids(spark, sf_dir):
    events = inputs.event_times(spark, sf_dir)
    made = audit.run_id(F.expr(state_of("user_id % 25")), F.col("ts"), F.col("event_id").cast("string"))
    return events.select("event_id", made.alias("run_id"))


@query
def streamed_upsert(spark, sf_dir):
    """Landed JSON lines streamed through the upsert."""
    landed, store = scratch_path(spark, "landed"), _store(spark, "streamed")
    _rendered(spark, sf_dir).selectExpr(f"{BULK_JSON} AS value").write.text(landed, compression=LANDED)

    def to_records(lines: DataFrame) -> DataFrame:
        return json_feeds.map_bulk(lines.withColumnRenamed("value", "record"), "TX")

    lines = arrivals.landed_lines(spark, landed)
    arrivals.start_upserts(lines, to_records, store, scratch_path(spark, "stream-state"), INGEST_MOMENT).awaitTermination()
    columns = ["state", "filing_number", "filing_type", "filing_date", "filing_status", "debtor_name"]
    return as_text(store.filings().select(*columns), "filing_date")


@query
def two_streams_run(spark, sf_dir):
    """Two streams into one store, then the first folder with more files and another checkpoint."""
    store = _store(spark, "streams")
    lines = inputs.raw_filings(spark, sf_dir).selectExpr("bigint(filing_number) % 3 AS part", f"{BULK_JSON} AS value")
    folders = [scratch_path(spark, "landed") for _ in range(2)]

    def to_records(rows: DataFrame) -> DataFrame:
        return json_feeds.map_bulk(rows.withColumnRenamed("value", "record"), "TX")

    for part, folder in enumerate([*folders, folders[0]]):
        lines.filter(F.col("part") == part).select("value").write.mode("append").text(folder, compression=LANDED)
        landed = arrivals.landed_lines(spark, folder)
        arrivals.start_upserts(landed, to_records, store, scratch_path(spark, "stream-state"), INGEST_MOMENT).awaitTermination()
    epochs = arrivals.applied_epochs(store).agg(F.count("*").alias("n_streams"))
    return _filed(store, "debtor_name").join(epochs)


# -- the store at any time -------------------------------------------------------------------------


def _stepped_store(spark: SparkSession, sf_dir: str) -> FilingStore:
    """Lines with status O, folded, then those with F, then those with F again as all that one state holds."""
    lines, store = inputs.line_batch(spark, sf_dir), _store(spark, "stepped")
    later = lines.filter("l_linestatus = 'F'")
    store.upsert(lines.filter("l_linestatus = 'O'"), INGEST_MOMENT, "open")
    store.compact("base")
    store.upsert(later, LATER_MOMENT, "closed")
    store.replace_state("ID", later, LATER_MOMENT, "whole")
    return store


@query
def stored_statistics(spark, sf_dir):
    """Counts and dates of the store, from what its batches changed: no filing is read."""
    found = stats.all_stats(_stepped_store(spark, sf_dir).statistics())
    return as_text(found, "earliest_filing", "latest_filing")


@query
def stored_status(spark, sf_dir):
    """The status report of the store, from what its batches changed."""
    store = _stepped_store(spark, sf_dir)
    report = schedule.status_report(dimension.source_dimension(spark), store.statistics(), LATER_MOMENT)
    held = report.filter("filing_count > 0").select("state", "tier", "filing_count", "latest_filing_date")
    return as_text(held, "latest_filing_date")


@query
def stored_latency(spark, sf_dir):
    """Days from filing to ingestion, in the months of one year, from what the batches changed."""
    counts = _stepped_store(spark, sf_dir).statistics()
    return quality.latency_report(counts.filter("year(filing_date) = 1998"), target_days=1000)


@query
def filings_as_of(spark, sf_dir):
    """The filings as the first batch left them, read after two more and a new base."""
    store = _stepped_store(spark, sf_dir)
    return as_text(store.filings(until="open").select("state", "filing_number", "filing_date", "source_raw"), "filing_date")


@query
def changes_between(spark, sf_dir):
    """What the later batches added, changed and removed."""
    return _stepped_store(spark, sf_dir).changes_between("open", "whole")


# -- statistics and schedule -----------------------------------------------------------------------


@query
def stats_by_state(spark, sf_dir):
    return stats.count_by(inputs.filings(spark, sf_dir), "state")


@query
def stats_by_status(spark, sf_dir):
    return stats.count_by(inputs.filings(spark, sf_dir), "filing_status")


@query
def stats_by_tier(spark, sf_dir):
    return stats.count_by(inputs.filings(spark, sf_dir), "source_tier")


@query
def stats_summary(spark, sf_dir):
    return as_text(stats.summary(inputs.filings(spark, sf_dir)), "earliest_filing", "latest_filing")


@query
def stats_all(spark, sf_dir):
    return as_text(stats.all_stats(inputs.filings(spark, sf_dir)), "earliest_filing", "latest_filing")


@query
def top_states(spark, sf_dir):
    return stats.top_states(inputs.filings(spark, sf_dir))


@query
def latest_by_state(spark, sf_dir):
    latest = stats.latest_by_state(inputs.filings(spark, sf_dir))
    return as_text(latest, "latest_filing_date", times=("last_ingestion",))


@query
def filing_count_tx(spark, sf_dir):
    return stats.filing_counts(inputs.filings(spark, sf_dir), "TX")


@query
def incremental_since(spark, sf_dir):
    """Raw filings on or after the latest date that is stored as lapsed in their state."""
    raw = normalize_filings(inputs.raw_filings(spark, sf_dir))
    stored = raw.filter("filing_status = 'lapsed'")
    late = stats.incremental(raw, stored, lookback_days=30)
    return as_text(late.select("filing_number", "state", "filing_date"), "filing_date")


@query
def since_filter(spark, sf_dir):
    """Raw dates in every shape against a fixed date; undated records stay."""
    raw = inputs.raw_filings(spark, sf_dir)
    return landing.drop_before(raw, "2000-01-01").select("filing_number", "state")


@query
def due_states(spark, sf_dir):
    sources = dimension.source_dimension(spark, disabled=("WY",))
    due = schedule.due_states(sources, inputs.filings(spark, sf_dir), INGEST_MOMENT)
    return as_text(due, times=("last_ingestion",))


@query
def status_report(spark, sf_dir):
    sources = dimension.source_dimension(spark, disabled=("WY",))
    report = schedule.status_report(sources, inputs.filings(spark, sf_dir), INGEST_MOMENT)
    return as_text(report, "latest_filing_date", times=("last_ingestion",))


@query
def cost_by_tier(spark, sf_dir):
    costs = schedule.cost_by_tier(dimension.source_dimension(spark), inputs.filings(spark, sf_dir))
    return costs.withColumn("budget_remaining", F.coalesce("budget_remaining", F.lit(0.0)))


@query
def filings_of_tier(spark, sf_dir):
    """Filings of the enabled bulk sources."""
    sources = dimension.select_sources(dimension.source_dimension(spark, disabled=("NY",)), "state_bulk")
    held = inputs.filings(spark, sf_dir).join(F.broadcast(sources.select("state")), "state", "left_semi")
    return stats.count_by(held, "state")


@query
def commercial_coverage(spark, sf_dir):
    """Filings of the states without a direct feed."""
    commercial = dimension.commercial_states(dimension.source_dimension(spark))
    held = inputs.filings(spark, sf_dir).join(F.broadcast(commercial), "state", "left_semi")
    return stats.count_by(held, "state")


# -- runs and logs ---------------------------------------------------------------------------------


@query
def run_history(spark, sf_dir):
    runs = audit.latest_runs(inputs.run_records(spark, sf_dir))
    history = audit.run_history(runs, limit=50).drop("error_message")
    return as_text(history, times=("started_at", "completed_at"))


@query
def run_history_of_state(spark, sf_dir):
    runs = audit.latest_runs(inputs.run_records(spark, sf_dir))
    return audit.run_history(runs, state="TX", limit=10).select("run_id", "state", "status", "error_message")


@query
def run_totals(spark, sf_dir):
    return audit.run_totals(audit.latest_runs(inputs.run_records(spark, sf_dir)))


@query
def activity_log(spark, sf_dir):
    """Events written as JSON lines, read back as an activity log."""
    path = scratch_path(spark, "activity")
    events = inputs.event_times(spark, sf_dir)
    events.select(
        F.col("ts").alias("timestamp"),
        F.expr(state_of("user_id % 25")).alias("state"),
        F.lit("setup").alias("phase"),
        F.col("event_type").alias("action_type"),
        F.col("props").alias("details"),
        F.when(F.col("event_type") == "error", "failure").otherwise("success").alias("outcome"),
    ).write.json(path)
    log = logs.read_activity_log(spark, path)
    counted = log.groupBy("state", "action_type", "outcome").agg(
        F.count("*").alias("n_events"), F.count("url").alias("n_urls"), F.max("timestamp").alias("last_at")
    )
    return as_text(counted, times=("last_at",))


@query
def research_facts(spark, sf_dir):
    """Facts by path from variant documents of no fixed shape."""
    events = table(spark, sf_dir, "events")
    documents = events.select("event_id", F.try_parse_json("props").alias("document"))
    return logs.research_facts(documents, {"k": "$.k", "absent": "$.authorization_model.model_type"})


@query
def failure_alert_5min(spark, sf_dir):
    fired = alerts.failure_alerts(inputs.event_log(inputs.event_times(spark, sf_dir)))
    return as_text(fired, times=("window_start", "window_end"))


@query
def failure_alert_stream(spark, sf_dir):
    """The same alerts from a stream over the same table."""
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    log = inputs.event_log(stream.withColumn("ts", F.col("ts").cast("timestamp")))
    out, checkpoint = scratch_path(spark, "alerts"), scratch_path(spark, "alerts-state")
    alerts.start_alerts(log, out, checkpoint, available_now=True).awaitTermination()
    return as_text(alerts.current_alerts(spark.read.parquet(out)), times=("window_start", "window_end"))


# -- feeds -----------------------------------------------------------------------------------------

FEED_COLUMNS = ["state", "filing_number", "filing_type", "filing_date", "filing_status", "debtor_name", "secured_party_name"]


def _rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw filings, one in fifty without a number."""
    raw = inputs.raw_filings(spark, sf_dir)
    return raw.withColumn("filing_number", F.expr("if(int(filing_number) % 50 = 0, NULL, filing_number)"))


def _with_headers(raw: DataFrame, headers: dict[str, str]) -> DataFrame:
    return raw.selectExpr(*[f"{field} AS `{header}`" for field, header in headers.items()])


def _keyed(records: DataFrame, columns: list[str] = FEED_COLUMNS) -> DataFrame:
    return split_keyed(records)[0].select(*columns)


@query
def csv_scan(spark, sf_dir):
    """Two kinds of files, their columns in another order, with line breaks within quoted values."""
    path = scratch_path(spark, "csv")
    headers = delimited.header_map("KY")
    raw = _rendered(spark, sf_dir).withColumn("debtor_address", F.expr("concat(split(trim(debtor_address), ' ')[0], '\\nSuite 2')"))
    orders = {"a": headers, "b": dict(reversed(headers.items()))}
    for i, (part, columns) in enumerate(orders.items()):
        share = raw.filter(F.length("debtor_name") % 2 == i) if part else raw
        _with_headers(share, columns).write.csv(f"{path}/{part}", header=True, escape='"')
    records = delimited.read_delimited(spark, [f"{path}/{part}" for part in orders], "KY")
    source = [f"get_json_object(source_raw, '$.{h}') AS {c}" for h, c in (("FileNumber", "raw_number"), ("DebtorAddress", "raw_address"))]
    return split_keyed(records)[0].selectExpr("state", *headers, *source)


@query
def tab_delimited_scan(spark, sf_dir):
    path = scratch_path(spark, "tsv")
    _with_headers(_rendered(spark, sf_dir), delimited.header_map("ID")).write.csv(path, header=True, sep="\t")
    return _keyed(delimited.read_delimited(spark, path, "ID", sep="\t"))


@query
def fuzzy_header_scan(spark, sf_dir):
    """Headers that no map knows."""
    headers = {
        "filing_number": "File Num",
        "filing_type": "Filing-Type",
        "filing_date": "FILE DATE",
        "lapse_date": "Lapse",
        "filing_status": "Current Status",
        "debtor_name": "Name of Debtor",
        "secured_party_name": "Secured Party Name",
    }
    path = scratch_path(spark, "fuzzy")
    _with_headers(_rendered(spark, sf_dir), headers).write.csv(path, header=True, sep="|")
    return _keyed(delimited.read_delimited(spark, path, "VT", sep="|"))


@query
def rejected_records(spark, sf_dir):
    """Records without a number, counted by reason."""
    _, rejects = split_keyed(_rendered(spark, sf_dir))
    return rejects.groupBy("state", "reject_reason").agg(F.count("*").alias("n_records"))


FIXED_WIDTH_LINE = "concat({})".format(
    ", ".join(f"rpad(coalesce({field}, ''), {end - start}, ' ')" for field, start, end in fixed.FIXED_WIDTH_LAYOUT)
)
BULK_JSON = "to_json(struct({}))".format(", ".join(f"{field} AS {key}" for field, key in fixed.BULK_JSON_KEYS.items()))
OPEN_DATA_JSON = "to_json(struct({}))".format(
    ", ".join(f"{field} AS {keys[0]}" for field, keys in fixed.OPEN_DATA_KEYS["CT"].items())
)
NESTED = [f"{party}_{part}" for party in fixed.COMMERCIAL_PARTIES for part in fixed.PARTY_KEYS]
COMMERCIAL_JSON = {
    # Field names as they are; other spellings with nested parties; yet other spellings.
    "baselayer": "to_json(struct({}))".format(", ".join(f"{f} AS {keys[0]}" for f, keys in fixed.COMMERCIAL_KEYS.items())),
    "fcs": "to_json(struct({}, struct({}) AS debtor, struct({}) AS securedParty))".format(
        ", ".join(f"{f} AS {keys[1]}" for f, keys in fixed.COMMERCIAL_KEYS.items() if f not in NESTED),
        *[", ".join(f"{party}_{part} AS {keys[-1]}" for part, keys in fixed.PARTY_KEYS.items()) for party in fixed.COMMERCIAL_PARTIES],
    ),
    "lexisnexis": "to_json(struct({}))".format(", ".join(f"{f} AS {keys[-1]}" for f, keys in fixed.COMMERCIAL_KEYS.items())),
}
PAGE_KEY = "bigint(filing_number) AS page_key"
# An XML file is read by one task, so a large feed comes in several.
XML_FILE_ROWS = 50_000
# Feeds that land on a small disk come packed; a packed file is read by one task as well, and a write makes many.
LANDED = "gzip"


@query
def fixed_width_scan(spark, sf_dir):
    """Lines of the fixed layout; those without a number are short header lines."""
    raw = _rendered(spark, sf_dir)
    path = scratch_path(spark, "fixed")
    raw.selectExpr(f"if(filing_number IS NULL, 'UCC EXTRACT', {FIXED_WIDTH_LINE}) AS value").write.text(path)
    return _keyed(fixed_width.read_fixed_width(spark, path))


@query
def json_lines_scan(spark, sf_dir):
    path = scratch_path(spark, "lines")
    _rendered(spark, sf_dir).selectExpr(f"{BULK_JSON} AS value").write.text(path)
    return _keyed(json_feeds.read_bulk_lines(spark, path, "TX"))


@query
def json_document_scan(spark, sf_dir):
    """Documents of 500 records in three shapes: root array, ``records`` and ``filings``."""
    records = inputs.raw_filings(spark, sf_dir).selectExpr(PAGE_KEY, f"{BULK_JSON} AS record")
    shapes = ["items", """concat('{"records": ', items, '}')""", """concat('{"count": 1, "filings": ', items, '}')"""]
    documents = inputs.pages(records, 500, inputs.pick("page_no % 3", shapes))
    return _keyed(json_feeds.map_bulk(json_feeds.unwrap(documents, fixed.DOCUMENT_KEYS, single_record=True), "TX"))


@query
def open_data_pages(spark, sf_dir):
    """Open-data pages with a root array, times after the dates."""
    records = inputs.raw_filings(spark, sf_dir).selectExpr(PAGE_KEY, f"{OPEN_DATA_JSON} AS record")
    documents = inputs.pages(records, 500, "items")
    return _keyed(json_feeds.map_open_data(json_feeds.unwrap(documents, ["data"]), "CT"))


def _commercial_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commercial pages of three providers: other envelopes, other spellings, nested parties."""
    providers = list(COMMERCIAL_JSON)
    spelt = inputs.pick("bigint(filing_number) div 500 % 3", list(COMMERCIAL_JSON.values()))
    records = inputs.raw_filings(spark, sf_dir).selectExpr(PAGE_KEY, f"{spelt} AS record")
    envelopes = [fixed.PAGE_KEYS[name][i % 2] for i, name in enumerate(providers)]
    body = f"""concat('{{"', {inputs.pick("page_no % 3", [f"'{e}'" for e in envelopes])}, '": ', items, '}}')"""
    documents = inputs.pages(records, 500, body)
    records = json_feeds.unwrap_pages(documents, inputs.pick("page_no % 3", [f"'{name}'" for name in providers]))
    return json_feeds.map_commercial(records, "AL")


@query
def envelope_unwrap(spark, sf_dir):
    return _keyed(_commercial_records(spark, sf_dir), list(fixed.COMMERCIAL_KEYS))


@query
def normalized_pages(spark, sf_dir):
    """The same pages, every field normalized."""
    columns = FEED_COLUMNS + ["debtor_address", "debtor_city", "debtor_state", "debtor_zip", "collateral_description"]
    return as_text(normalize_filings(_keyed(_commercial_records(spark, sf_dir), columns)), "filing_date")


def _write_xml(raw: DataFrame, path: str, no_secured_party: str = "false") -> None:
    raw.selectExpr(
        "filing_number AS FilingNumber",
        "filing_type AS FileType",
        "filing_date AS FileDate",
        "filing_status AS Unlisted",
        "struct(debtor_name AS OrganizationName, debtor_zip AS PostalCode) AS Debtor",
        f"if({no_secured_party}, NULL, struct(secured_party_name AS Name)) AS SecuredParty",
    ).write.format("xml").options(rootTag="Root", rowTag="Filing", maxRecordsPerFile=XML_FILE_ROWS, compression=LANDED).save(path)


@query
def xml_scan(spark, sf_dir):
    path = scratch_path(spark, "xml")
    _write_xml(_rendered(spark, sf_dir), path)
    columns = ["state", "filing_number", "filing_type", "filing_date", "debtor_name", "debtor_zip", "secured_party_name"]
    return _keyed(xml_feeds.read_xml(spark, path, "CA"), columns)


@query
def mixed_xml_scan(spark, sf_dir):
    """Every filing as an element of one kind and again as one of another, in turns; the later one holds."""
    path = scratch_path(spark, "mixed")
    number, name = "concat('<FilingNumber>', filing_number, '</FilingNumber>')", "concat('<Debtor><Name>', '{}', '</Name></Debtor>')"
    one = f"concat('<Filing id=\"1\">', {number}, {name.format('one')}, '</Filing>')"
    two = f"concat('<Document>', {number}, {name.format('two')}, '</Document>')"
    turns = f"if(bigint(filing_number) % 2 = 0, concat({one}, {two}), concat({two}, '\n ', {one}))"
    inputs.raw_filings(spark, sf_dir).selectExpr(f"{turns} AS value").write.text(path)
    merged = upsert.merge(_keyed(xml_feeds.read_xml(spark, path, "CA"), [*FEED_FIELDS, "arrival"]), None, INGEST_MOMENT)
    return merged.select("state", "filing_number", "debtor_name", "n_new", "n_updated")


@query
def feed_dispatch(spark, sf_dir):
    """Five states, each in its own format, read through the format table into one."""
    raw = inputs.raw_filings(spark, sf_dir)
    states = ["KY", "ID", "TX", "CA", "FL"]
    root = scratch_path(spark, "feeds")
    share = {s: raw.filter(F.col("state").isin(inputs.STATES[i::5])) for i, s in enumerate(states)}
    paths = {s: f"{root}/{s}" for s in states}
    _with_headers(share["KY"], delimited.header_map("KY")).write.csv(paths["KY"], header=True)
    _with_headers(share["ID"], delimited.header_map("ID")).write.csv(paths["ID"], header=True, sep="\t")
    share["TX"].selectExpr(BULK_JSON).write.text(paths["TX"])
    _write_xml(share["CA"], paths["CA"])
    share["FL"].selectExpr(FIXED_WIDTH_LINE).write.text(paths["FL"])
    records = landing.read_feeds(spark, paths, formats={"TX": "json_lines"})
    return _keyed(records, ["state", "filing_number", "filing_type", "debtor_name", "secured_party_name"])


@query
def xml_parties(spark, sf_dir):
    """All parties of filings that name two debtors."""
    path = scratch_path(spark, "parties")
    inputs.raw_filings(spark, sf_dir).selectExpr(
        "filing_number AS FilingNumber",
        "array(struct(debtor_name AS Name, string(NULL) AS State), struct(secured_party_name AS Name, secured_party_state AS State)) AS Debtor",
        "array(struct(secured_party_name AS OrganizationName)) AS SecuredParty",
    ).write.format("xml").options(rootTag="Root", rowTag="Document", maxRecordsPerFile=XML_FILE_ROWS).save(path)
    parties_of = xml_feeds.xml_parties(xml_feeds.scan_xml(spark, path), "IN")
    return parties_of.select("filing_state", "filing_number", "role", "party_no", "name", "state")


@query
def latest_landed_files(spark, sf_dir):
    """All complete files of each state, by what they hold; some lie in a folder of their day."""
    path = scratch_path(spark, "landing")
    raw = inputs.raw_filings(spark, sf_dir)
    lines = "concat(filing_number, '|', source_raw) AS value"
    days = {("state",): "filing_status <> 'Expired'", ("state", "day"): "filing_status = 'Expired'"}
    for folders, test in days.items():
        written = raw.filter(test).selectExpr("state", "'2024-01-15' AS day", lines).select("value", *folders)
        written.write.mode("append").partitionBy(*folders).text(path)
    files = landing.landed_files(spark, path)
    listed = [r.path for r in files.select("path").collect()]
    place = "regexp_replace({}, '^file:/+', 'file:/') AS path"
    held = spark.read.text(listed).selectExpr("value", place.format("_metadata.file_path"))
    return held.join(files.withColumn("path", F.expr(place.format("path"))), "path").selectExpr(
        "state", "delivery <> '' AS in_second_file", "substring_index(value, '|', 1) AS filing_number"
    )


def _filed(store: FilingStore, *columns: str) -> DataFrame:
    return store.filings().select("state", "filing_number", *columns)


def _write_pages(records: DataFrame, path: str, broken: str = "false") -> None:
    """Commercial pages, one file each; those for which ``broken`` holds are cut off."""
    body = f"if({broken}, left(concat('{{\"results\": ', items), 200), concat('{{\"results\": ', items, '}}'))"
    documents = inputs.pages(records, 500, body)
    documents.repartition("page_no").select("value", "page_no").write.partitionBy("page_no").text(path)


@query
def landed_delivery(spark, sf_dir):
    """A delivery of several files in folders of their own, and pages of another state, as the store holds them."""
    root, store = scratch_path(spark, "delivery"), _store(spark, "delivered")
    raw = inputs.raw_filings(spark, sf_dir)
    ky = raw.filter("state = 'KY'").withColumn("part", F.expr("concat('K', bigint(filing_number) % 3)"))
    headers = delimited.header_map("KY")
    ky.selectExpr(*[f"{field} AS {header}" for field, header in headers.items()], "part").write.partitionBy("part").csv(
        f"{root}/KY", header=True
    )
    _write_pages(raw.filter("state = 'AL'").selectExpr(PAGE_KEY, f"{COMMERCIAL_JSON['baselayer']} AS record"), f"{root}/AL")
    ingest_landed(store, root, INGEST_MOMENT, "first", states=["KY", "AL"])
    return _filed(store, "debtor_name")


@query
def unreadable_documents(spark, sf_dir):
    """Every third page is cut off: it is kept as a reject, and the run is partial."""
    root, store = scratch_path(spark, "cut"), _store(spark, "partial")
    records = inputs.raw_filings(spark, sf_dir).selectExpr(PAGE_KEY, f"{COMMERCIAL_JSON['baselayer']} AS record")
    _write_pages(records, f"{root}/AL", "page_no % 3 = 1")
    runs = ingest_landed(store, root, INGEST_MOMENT, "first", states=["AL"])
    rejects = store.quarantine().filter("reject_reason = 'unreadable_document'").groupBy("state").agg(F.count("*").alias("n_unreadable"))
    held = store.filings().groupBy("state").agg(F.count("*").alias("n_filings"))
    errors = store.events().filter("event = 'ingestion_complete'").selectExpr("state", "record_errors AS n_errors")
    told = runs.select("state", "status", "error_message")
    return told.join(rejects, "state").join(held, "state").join(errors, "state")


def _backfilled(spark: SparkSession, sf_dir: str) -> FilingStore:
    """Two states are wanted: the first call delivers one of them and half of the other, the second call the rest.

    A month without filings is finished where the second call says that it holds none.
    """
    store = _store(spark, "backfill")
    raw = inputs.raw_filings(spark, sf_dir).drop("ordered_at").withColumn("arrival", F.struct("source_raw"))
    states = spark.createDataFrame([("TX",), ("CA",)], "state string")
    ranges = quality.backfill_ranges(states, "1996-01-01", "1997-12-31")
    early = f"state = 'CA' AND {normalize_date('filing_date')} < '1996-07-01'"
    none = ranges.filter("range_start BETWEEN '1997-11-01' AND '1997-12-01'")
    backfill(store, raw.filter(f"state = 'TX' OR ({early})"), ranges, INGEST_MOMENT, "first")
    backfill(store, raw.filter("state = 'CA'"), ranges, INGEST_MOMENT, "second", empty=none)
    return store


@query
def backfill_run(spark, sf_dir):
    return _filed(_backfilled(spark, sf_dir))


@query
def backfill_manifest(spark, sf_dir):
    """The ranges that are noted as finished, with the call that finished them."""
    store = _backfilled(spark, sf_dir)
    manifest = store.read("backfill_manifest", f"{MANIFEST_SCHEMA}, batch string")
    return as_text(manifest.select("state", "range_start", "range_end", "batch", "n_records"), "range_start", "range_end")


@query
def full_replacement_run(spark, sf_dir):
    """The second delivery of a state that always delivers all lacks a third of the filings."""
    root, store = scratch_path(spark, "replacement"), _store(spark, "replaced")
    raw = inputs.raw_filings(spark, sf_dir)
    for day, share in (("1", raw), ("2", raw.filter("bigint(filing_number) % 3 <> 0"))):
        _with_headers(share, delimited.header_map("ID")).write.csv(f"{root}/ID/{day}", header=True, sep="\t", compression=LANDED)
        ingest_landed(store, root, INGEST_MOMENT, day, states=["ID"])
    return _filed(store, "debtor_name")


def _backdate(spark: SparkSession, path: str) -> None:
    """Give the files of a folder a time long ago, as a copy that keeps its time has."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(conf)
    for status in files.listStatus(folder):
        files.setTimes(status.getPath(), 978307200000, -1)


def _write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(conf).create(target)
    out.write(bytearray(content))
    out.close()


@query
def ledger_run(spark, sf_dir):
    """Four runs over files that land before and between them, some with an old time: each file is read once.

    A row per filing, and one per run with the records that it took.
    """
    root, store = scratch_path(spark, "ledger"), _store(spark, "ledgered")
    raw = inputs.raw_filings(spark, sf_dir)
    for batch, parts in (("first", (0, 1)), ("second", (2,)), ("third", (3,)), ("fourth", ())):
        for part in parts:
            rows = raw.filter(f"bigint(filing_number) % 4 = {part}")
            _with_headers(rows, delimited.header_map("KY")).write.csv(f"{root}/KY/part-{part}", header=True)
        if batch == "third":
            _backdate(spark, f"{root}/KY/part-3")
        ingest_landed(store, root, "current_timestamp()", batch, states=["KY"], lookback_days=40_000)
    filed = _filed(store).selectExpr("'filing' AS kind", "filing_number AS name", "1L AS n")
    order = F.row_number().over(Window.orderBy("started_at"))
    runs = store.current_runs().select(F.lit("run").alias("kind"), order.cast("string").alias("name"), F.col("records_new").alias("n"))
    return filed.unionByName(runs)


@query
def isolated_runs(spark, sf_dir):
    """Three states of which one delivers a file that cannot be read: the others are stored all the same."""
    root, store = scratch_path(spark, "isolated"), _store(spark, "apart")
    raw = inputs.raw_filings(spark, sf_dir)
    _with_headers(raw, delimited.header_map("KY")).write.csv(f"{root}/KY", header=True, compression=LANDED)
    _write_xml(raw, f"{root}/CA")
    _write_bytes(spark, f"{root}/TX/master.json.gz", b"no gzip file")
    ingest_landed(store, root, INGEST_MOMENT, "first", states=["KY", "CA", "TX"], formats={"TX": "json_lines"})
    ended = store.events().filter("event <> 'ingestion_start'").select("state", "event")
    held = stats.latest_by_state(store.statistics()).select("state", "filing_count")
    told = store.current_runs().selectExpr("state", "status", "records_new", "error_message IS NOT NULL AS has_error")
    return told.join(ended, "state").join(held, "state", "left")


@query
def two_phase_run(spark, sf_dir):
    """Master files while nothing is stored, then the updates since the latest stored date."""
    root, store = scratch_path(spark, "phases"), _store(spark, "phased")
    raw = inputs.raw_filings(spark, sf_dir)
    raw.filter("filing_status <> 'Expired'").selectExpr(BULK_JSON).write.text(f"{root}/TX/master", compression=LANDED)
    raw.selectExpr(BULK_JSON).write.text(f"{root}/TX/update", compression=LANDED)
    for batch in ("first", "second"):
        ingest_landed(store, root, "current_timestamp()", batch, states=["TX"], formats={"TX": "json_lines"})
    return store.filings().select("filing_number")


@query
def three_file_run(spark, sf_dir):
    """Documents, debtors and secured parties of one delivery, with all parties stored."""
    root, store = scratch_path(spark, "three"), _store(spark, "merged")
    documents, debtors, secured = _delivery(spark, sf_dir)
    documents.write.csv(f"{root}/WV/documents", header=True)
    for part, rows in (("debtors", debtors), ("secured", secured)):
        named = rows.orderBy("DocNumber", "seq").selectExpr("DocNumber", "name AS PartyName", "state AS PartyState")
        named.write.csv(f"{root}/WV/{part}", header=True)
        # Sorted over many files; of one time, their names tell the order.
        _backdate(spark, f"{root}/WV/{part}")
    ingest_landed(store, root, INGEST_MOMENT, "first", states=["WV"])
    counts = store.parties().groupBy("filing_number").agg(
        F.count_if(F.col("role") == "secured_party").alias("n_secured"), F.count_if(F.col("role") == "debtor").alias("n_debtors")
    )
    return _filed(store, "debtor_name", "secured_party_name").drop("state").join(counts, "filing_number")


@query
def stored_parties(spark, sf_dir):
    """The second delivery names no secured party for every other filing."""
    store = _store(spark, "parties")
    raw = inputs.raw_filings(spark, sf_dir)
    for i, lost in enumerate(("false", "bigint(filing_number) % 2 = 0")):
        root = scratch_path(spark, "party-feed")
        _write_xml(raw, f"{root}/CA", lost)
        ingest_landed(store, root, INGEST_MOMENT, f"delivery-{i}", states=["CA"], full_refresh=True)
    return store.parties().select("filing_number", "role", "party_no", "name")


@query
def two_phase_load(spark, sf_dir):
    """The master file of open and pending filings, then the update with all filings since a date."""
    raw = inputs.raw_filings(spark, sf_dir)
    master, update = scratch_path(spark, "master"), scratch_path(spark, "update")
    raw.filter("filing_status <> 'Expired'").selectExpr(f"{BULK_JSON} AS value").write.text(master)
    raw.selectExpr(f"{BULK_JSON} AS value").write.text(update)
    phases = {"master": None, "update": "2000-01-01"}
    parts = [
        _keyed(landing.read_two_phase(spark, "TX", master, update, since, "json_lines"), ["filing_number"]).withColumn(
            "phase", F.lit(phase)
        )
        for phase, since in phases.items()
    ]
    return parts[0].unionByName(parts[1])


@query
def consent_rules(spark, sf_dir):
    """Rules from documents that map states to rules."""
    rule = f"map({state_of('c_nationkey')}, struct(if(c_mktsegment = 'BUILDING', 'two_party', 'one_party') AS consent_type))"
    documents = table(spark, sf_dir, "customer").selectExpr(f"to_json(struct({rule} AS states)) AS value")
    return logs.consent_rules(documents).groupBy("state", "consent_type").agg(F.count("*").alias("n_documents"))


@query
def page_slice(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey", "o_orderstatus")
    since = F.lit("1996-01-01").cast("timestamp_ntz")
    return as_text(json_feeds.page_slice(orders, "o_orderdate", "o_orderkey", 500, 250, since), "o_orderdate")


@query
def page_after(spark, sf_dir):
    """The page that follows a known row; the date bound is pushed to the scan."""
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey", "o_orderstatus")
    last = (F.lit("1996-06-01").cast("timestamp_ntz"), 40)
    return as_text(json_feeds.page_after(orders, "o_orderdate", "o_orderkey", last, 250), "o_orderdate")


# -- parties, agreement, quality -------------------------------------------------------------------


def _delivery(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A delivery in three files: documents, debtors and secured parties."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    lines, suppliers = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    documents = orders.selectExpr("o_orderkey AS DocNumber", "o_orderstatus AS Status")
    debtors = orders.join(customers, F.expr("o_custkey = c_custkey")).selectExpr(
        "o_orderkey AS DocNumber", "struct(c_custkey) AS seq", "c_name AS name", f"{state_of('c_nationkey')} AS state"
    )
    secured = lines.join(suppliers, F.expr("l_suppkey = s_suppkey")).selectExpr(
        "l_orderkey AS DocNumber",
        "struct(l_linenumber, l_suppkey) AS seq",
        "s_name AS name",
        f"{state_of('s_nationkey')} AS state",
    )
    return documents, debtors, secured


@query
def three_file_merge(spark, sf_dir):
    return parties.merge_three_files(*_delivery(spark, sf_dir), key="DocNumber", order="seq")


@query
def party_table(spark, sf_dir):
    """All secured parties of all documents as a child table."""
    _, _, secured = _delivery(spark, sf_dir)
    rows = parties.party_table(secured.withColumn("filing_state", F.lit("WV")), "DocNumber", "filing_state", "seq")
    return rows.select("filing_state", "DocNumber", "name", "state", F.col("first_seen.l_linenumber").alias("first_line"))


@query
def cross_source_reconcile(spark, sf_dir):
    """Orders against the last line of each order."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        f"{state_of('o_orderkey % 25')} AS state",
        "string(o_orderkey) AS filing_number",
        "o_orderstatus AS filing_status",
        "string(year(o_orderdate)) AS filing_year",
        "struct(o_orderdate) AS arrival",
    )
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        f"{state_of('l_orderkey % 25')} AS state",
        "string(l_orderkey) AS filing_number",
        "l_linestatus AS filing_status",
        "string(year(l_shipdate)) AS filing_year",
        inputs.LINE_ARRIVAL,
    )
    return quality.reconcile_counts(quality.reconcile(orders, lines, ["filing_status", "filing_year"]))


@query
def latency_sla(spark, sf_dir):
    """Orders count as ingested up to ten days after their date."""
    filed = inputs.filings(spark, sf_dir)
    later = F.expr("date_add(date(ingested_at), int(bigint(filing_number) * 7 % 11))")
    return quality.latency_report(filed.withColumn("ingested_at", later))


def _with_collateral(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings with the name of a returned part as collateral text."""
    lines = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    named = lines.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    texts = named.groupBy(F.col("l_orderkey").cast("string").alias("filing_number")).agg(F.min("p_name").alias("text"))
    joined = inputs.raw_filings(spark, sf_dir).join(texts, "filing_number", "left")
    return joined.withColumn("collateral_description", F.col("text")).drop("text")


@query
def collateral_coverage(spark, sf_dir):
    sources = dimension.source_dimension(spark, collateral_access={"NY": "image_only", "AL": "paid_retrieval_required"})
    return quality.collateral_coverage(_with_collateral(spark, sf_dir), sources)


@query
def pending_collateral(spark, sf_dir):
    return quality.pending_collateral(_with_collateral(spark, sf_dir), dimension.source_dimension(spark))


@query
def backfill_pending(spark, sf_dir):
    """State months of the whole span in which no order is finished yet."""
    sources = dimension.source_dimension(spark)
    ranges = quality.backfill_ranges(sources, "1995-01-01", "2001-12-31")
    filed = inputs.filings(spark, sf_dir)
    done = filed.select(
        "state",
        F.to_date(F.trunc("filing_date", "month")).alias("range_start"),
        F.when(F.col("filing_status") == "lapsed", "completed").otherwise("running").alias("status"),
    )
    return as_text(quality.pending_ranges(ranges, done), "range_start", "range_end")


# -- search and chains -----------------------------------------------------------------------------


@query
def name_search(spark, sf_dir):
    """Customers under another spelling, and some under the exact one, against all debtors."""
    customers = table(spark, sf_dir, "customer")
    respelt = customers.select(F.format_string("The %s, Inc.", F.translate("c_name", "#", " ")).alias("watch_name"))
    exact = customers.filter("c_mktsegment = 'BUILDING'").select(F.concat("c_name", F.lit(" LLC")).alias("watch_name"))
    raw = inputs.raw_filings(spark, sf_dir)
    return search.match_watchlist(raw, respelt.union(exact)).select("filing_number", "state", "watch_name")


@query
def stored_name_search(spark, sf_dir):
    """Names under another spelling against the search keys that the store holds."""
    store = _store(spark, "searched")
    raw = inputs.raw_filings(spark, sf_dir).drop("ordered_at").withColumn("arrival", F.struct("source_raw"))
    store.upsert(normalize_filings(raw), INGEST_MOMENT, "all")
    customers = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'")
    respelt = customers.select(F.format_string("The %s, Inc.", F.translate("c_name", "#", " ")).alias("watch_name"))
    return search.match_watchlist(store.searchable(), respelt).select("filing_number", "state", "watch_name")


@query
def initial_search(spark, sf_dir):
    """Individuals whose given name is abbreviated in the list."""
    customers = table(spark, sf_dir, "customer")
    given = inputs.pick("c_nationkey % 3", ["'John'", "'Jane'", "'Mary'"])
    named = customers.selectExpr("c_custkey", "c_mktsegment", f"{given} AS given", "concat(' Doe', c_custkey) AS surname")
    people = named.selectExpr("c_custkey", "concat(given, surname) AS debtor_name")
    listed = named.filter("c_mktsegment = 'MACHINERY'").selectExpr("concat(left(given, 1), surname) AS watch_name")
    return search.match_initials(people, listed).select("c_custkey", "debtor_name", "watch_name")


@query
def lapse_horizon(spark, sf_dir):
    lapsing = search.lapsing(inputs.filings(spark, sf_dir), "2001-01-01", "2001-03-31")
    return as_text(lapsing.select("filing_number", "state", "lapse_date"), "lapse_date")


def _chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten consecutive orders form a chain: the first is the original, the rest amend it."""
    return table(spark, sf_dir, "orders").selectExpr(
        f"{state_of('o_orderkey div 10 % 25')} AS state",
        "string(o_orderkey) AS filing_number",
        f"{normalize_filing_type(inputs.TYPE_OF)} AS filing_type",
        "date(o_orderdate) AS filing_date",
        "if(o_orderkey % 10 <> 0, string(o_orderkey div 10 * 10), NULL) AS original_filing_number",
    )


@query
def amendment_chains(spark, sf_dir):
    chains = search.amendment_chains(_chains(spark, sf_dir))
    return as_text(chains, "filing_date", "last_amendment")


def _long_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty consecutive orders form a chain, each amending the one before; in every tenth chain two amend each other."""
    return table(spark, sf_dir, "orders").selectExpr(
        f"{state_of('o_orderkey div 40 % 25')} AS state",
        "string(o_orderkey) AS filing_number",
        "CASE WHEN o_orderkey % 37 = 1 THEN 'UCC-3-TERMINATION' WHEN o_orderkey % 3 = 0 THEN 'UCC-3-CONTINUATION' ELSE 'UCC-3' END AS filing_type",
        "add_months(date'1980-01-01', int(o_orderkey % 40 * 9 + o_orderkey % 5)) AS filing_date",
        "if(o_orderkey % 80 = 0, add_months(date'1980-01-01', 62), NULL) AS lapse_date",
        "CASE WHEN o_orderkey % 400 = 7 THEN string(o_orderkey + 1) WHEN o_orderkey % 40 = 0 THEN NULL "
        "ELSE string(o_orderkey - 1) END AS original_filing_number",
    )


@query
def chain_roots(spark, sf_dir):
    return search.chain_roots(_long_chains(spark, sf_dir))


@query
def whole_chains(spark, sf_dir):
    chains = search.whole_chains(_long_chains(spark, sf_dir))
    return as_text(chains, "filing_date", "lapse_date", "last_amendment", "terminated_on", "effective_lapse")


@query
def orphan_amendments(spark, sf_dir):
    """Amendments to originals that are not open any more."""
    filed = _chains(spark, sf_dir)
    recent = filed.filter("original_filing_number is not null or filing_date >= date '1998-01-01'")
    return search.orphan_amendments(recent).select("state", "filing_number", "original_filing_number")


# -- outreach --------------------------------------------------------------------------------------


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = inputs.call_queue(spark, sf_dir)
    return outreach.apply_attempts(queue, inputs.call_attempts(spark, sf_dir, CALL_MOMENT))


@query
def call_states(spark, sf_dir):
    calls = _calls(spark, sf_dir)
    kept = calls.select("id", "status", "retry_count", "outcome", "notes", "last_attempt_at", "completed_at")
    return as_text(kept, times=("last_attempt_at", "completed_at"))


@query
def queue_summary(spark, sf_dir):
    return outreach.queue_summary(_calls(spark, sf_dir))


@query
def states_attempted(spark, sf_dir):
    return outreach.states_attempted(_calls(spark, sf_dir), CALL_MOMENT)


@query
def ready_calls(spark, sf_dir):
    """Calls of the queue as it stands, with the attempts of the last hours only as today's."""
    queue = inputs.call_queue(spark, sf_dir)
    recent = inputs.call_attempts(spark, sf_dir, CALL_MOMENT).filter("notes = 'signup'")
    calls = outreach.apply_attempts(queue, recent.filter("attempted_at >= timestamp '2024-01-15 16:30:00'"))
    ready = outreach.ready_calls(calls, dimension.source_dimension(spark), CALL_MOMENT)
    return ready.select("id", "state", "priority")


@query
def approved_calls(spark, sf_dir):
    """Pending calls after approvals that came in as sign-up events."""
    events = inputs.event_times(spark, sf_dir).filter("event_type = 'signup'")
    given = events.select(F.col("event_id").cast("string").alias("id"), F.col("ts").alias("approved_at"))
    calls = outreach.approve(inputs.call_queue(spark, sf_dir), given)
    return as_text(calls.select("id", "status", "approved_at"), times=("approved_at",))


@query
def next_windows(spark, sf_dir):
    calls = outreach.next_windows(
        inputs.call_queue(spark, sf_dir), dimension.source_dimension(spark), "timestamp'2024-01-12 22:00:00'"
    )
    return as_text(calls.select("id", "state", "next_window"), times=("next_window",))


@query
def consent_flags(spark, sf_dir):
    calls = outreach.with_consent(inputs.call_queue(spark, sf_dir), dimension.source_dimension(spark))
    return calls.groupBy("state", "two_party_consent").agg(F.count("*").alias("n_calls"))


@query
def answer_extraction(spark, sf_dir):
    return transcripts.answers_in_lines(inputs.transcript_lines(spark, sf_dir), QUESTIONS)


@query
def answer_extraction_text(spark, sf_dir):
    """Answers from whole documents, read as transcripts."""
    documents = table(spark, sf_dir, "documents")
    answered = transcripts.answers_in_text(documents, "text", QUESTIONS)
    return answered.select("doc_id", F.inline("answers")).drop("question_no")


@query
def call_outcomes(spark, sf_dir):
    sizes = transcripts.transcript_sizes(inputs.transcript_lines(spark, sf_dir))
    turns = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("call_id"))
    ended = turns.agg((F.max("turn") % 2 == 1).alias("completed"))
    return transcripts.call_outcomes(sizes.join(ended, "call_id"))


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = transcripts.answers_in_lines(inputs.transcript_lines(spark, sf_dir), QUESTIONS)
    called_at = "timestamp'2024-01-01' + make_dt_interval(0, 0, int(call_id)) AS called_at"
    state = f"{state_of('call_id % 25')} AS state"
    return answers.selectExpr(state, "question_no", "question_key", "answer", called_at)


@query
def requirements_merge(spark, sf_dir):
    """What the calls tell, put over what is known about the states that have suppliers."""
    suppliers = table(spark, sf_dir, "supplier")
    known = suppliers.groupBy(F.expr(state_of("s_nationkey")).alias("state")).agg(
        F.lit("fee").alias("question_key"), F.min("s_name").alias("answer")
    )
    merged = transcripts.merge_requirements(known, _answers(spark, sf_dir))
    return as_text(merged, "last_call_date")


@query
def saved_transcripts(spark, sf_dir):
    """Transcript lines saved by state and day, read back."""
    path = scratch_path(spark, "transcripts")
    lines = inputs.transcript_lines(spark, sf_dir)
    day = "string(date_add(date'2024-01-01', int(call_id % 10))) AS date"
    rows = lines.selectExpr("*", f"{state_of('call_id % 25')} AS state", day)
    transcripts.save_transcripts(rows, path)
    saved = spark.read.schema("call_id long, line_no long, text string, state string, date string").json(path)
    return saved.groupBy("state", "date").agg(F.count("*").alias("n_lines"), F.sum(F.length("text")).alias("n_chars"))
