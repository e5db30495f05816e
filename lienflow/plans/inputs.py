"""Filings, feeds, queues and logs derived from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lienflow.functions.filings import normalize_filings
from lienflow.functions.sql import listing, quote
from lienflow.schema import FEED_FIELDS

# State code of each nation key: two open-data, fifteen bulk and eight commercial states.
STATES = "CT CO CA TX KY WV ID ND MN AR IN NY NC SC SD AZ FL AL AK DE DC GA HI IA IL".split()

# Filing type by the last digit of the order key.
TYPES = ["UCC1", "ucc 3", "Continuation", "partial-assignment", "IRS", "05", " UCC-1 ", "something", "", None]

# Date shape by the order key modulo seven.
DATE_SHAPES = [
    "yyyy-MM-dd",
    "yyyy-MM-dd'T'HH:mm:ss",
    "MM/dd/yyyy",
    "MM-dd-yyyy",
    "yyyyMMdd",
    "MM/dd/yy",
    "dd-MMM-yyyy",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def state_of(index: str) -> str:
    return f"get(array({listing(STATES)}), int({index}))"


def pick(index: str, values: list[str]) -> str:
    """The value at a position; an expression, no join."""
    return f"CASE {index} " + " ".join(f"WHEN {i} THEN {value}" for i, value in enumerate(values)) + " END"


def tier_of(index: str) -> str:
    return f"CASE WHEN {index} < 2 THEN 'open_api' WHEN {index} < 17 THEN 'state_bulk' ELSE 'commercial' END"


TYPE_OF = pick("o_orderkey % 10", ["NULL" if t is None else quote(t) for t in TYPES])
STATUS_OF = (
    "CASE o_orderstatus WHEN 'O' THEN 'A' WHEN 'F' THEN 'Expired' "
    "ELSE if(o_orderkey % 3 = 0, 'pending', ' terminated ') END"
)
CUSTOMER = "string(c_custkey)"
ZIPS = [
    f"lpad({CUSTOMER}, 5, '1')",
    f"lpad({CUSTOMER}, 9, '2')",
    "concat('K1A ', c_custkey % 10, 'B1')",
    f"concat(lpad({CUSTOMER}, 5, '3'), '-', lpad({CUSTOMER}, 4, '4'))",
]
PRINTED_DATE = pick("o_orderkey % 7", [f"date_format(o_orderdate, {quote(shape)})" for shape in DATE_SHAPES])

# The raw filing of an order as SQL.
RAW_FIELDS = {
    "filing_number": "string(o_orderkey)",
    "state": state_of("c_nationkey"),
    "filing_type": TYPE_OF,
    "filing_date": f"if(o_orderkey % 97 = 0, 'not-a-date', {PRINTED_DATE})",
    "lapse_date": "date_format(add_months(o_orderdate, 60), 'yyyy-MM-dd')",
    "filing_status": STATUS_OF,
    "debtor_name": "concat('  ', lower(c_name), '   llc ')",
    "debtor_address": "concat(' ', c_custkey, '  Main   St ')",
    "debtor_city": "concat('Port ', c_nationkey)",
    "debtor_organization": "if(c_custkey % 2 = 0, c_name, NULL)",
    "debtor_type": "if(c_custkey % 2 = 0, 'organization', 'individual')",
    "debtor_state": f"lower({state_of('c_nationkey')})",
    "debtor_zip": pick("c_custkey % 4", ZIPS),
    "secured_party_name": "s_name",
    "secured_party_address": "concat(s_suppkey, ' Bank  Row')",
    "secured_party_city": "concat('Bank City ', s_nationkey)",
    "secured_party_state": state_of("s_nationkey"),
    "secured_party_zip": "lpad(string(s_suppkey), 5, '7')",
    "collateral_description": "if(o_orderkey % 4 = 0, NULL, concat('all  assets ', o_orderpriority))",
    "original_filing_number": "if(o_orderkey % 6 = 0, string(o_orderkey div 2), NULL)",
    "amendment_type": "if(o_orderkey % 6 = 0, 'continuation', NULL)",
    "source_tier": tier_of("c_nationkey"),
    "source_raw": "concat_ws('|', string(o_orderkey), o_orderstatus)",
}


def _feed(fields: dict[str, str]) -> list[str]:
    return [f"{fields.get(f, 'cast(NULL AS string)')} AS {f}" for f in FEED_FIELDS]


def raw_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw filing per order, with values as untidy as feeds deliver them."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    suppliers = table(spark, sf_dir, "supplier")
    # The supplier of an order: the least among its lines.
    parties = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("party"))
    joined = (
        orders.join(customers, F.expr("o_custkey = c_custkey"))
        .join(parties, F.expr("l_orderkey = o_orderkey"), "left")
        .join(suppliers, F.expr("s_suppkey = party"), "left")
    )
    return joined.selectExpr(*_feed(RAW_FIELDS), "timestamp(o_orderdate) AS ordered_at")


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized filings, ingested at the time of the order."""
    normalized = normalize_filings(raw_filings(spark, sf_dir))
    return normalized.withColumnRenamed("ordered_at", "ingested_at")


# Arrival order of an order's lines; these columns together are unique.
LINE_ARRIVAL = "struct(l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS arrival"

LINE_FIELDS = {
    "filing_number": "string(l_orderkey)",
    "state": state_of("l_orderkey % 25"),
    "filing_type": "'UCC-1'",
    "filing_date": "date(l_shipdate)",
    "lapse_date": "cast(NULL AS date)",
    "filing_status": "if(l_linestatus = 'O', 'active', 'lapsed')",
    "debtor_name": "concat('PART ', l_partkey)",
    "source_raw": "l_returnflag",
}


def line_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An incoming batch with many rows per key: one per order line, its return flag as source text."""
    return table(spark, sf_dir, "lineitem").selectExpr(*_feed(LINE_FIELDS), LINE_ARRIVAL, "l_linestatus")


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as a timestamp; the tables hold it without a zone."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def event_log(events: DataFrame) -> DataFrame:
    """A log line per event; errors report a failure."""
    return events.selectExpr("ts", "concat('run finished status=', if(event_type = 'error', 'failed', 'completed')) AS message")


def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two records per run: one at its start, one at its end."""
    rows = event_times(spark, sf_dir).selectExpr(
        "*",
        "event_id % 1000 AS n",
        "event_type = 'error' AS failed",
        "ts + interval 1 minute AS ended",
        "explode(array(false, true)) AS at_end",
    )
    return rows.selectExpr(
        "string(event_id) AS run_id",
        f"if(at_end, '??', {state_of('user_id % 25')}) AS state",
        f"if(at_end, '??', {tier_of('user_id % 25')}) AS source_tier",
        "if(at_end, ended, ts) AS started_at",
        "if(at_end, ended, NULL) AS completed_at",
        "if(at_end, n, 0L) AS records_fetched",
        "if(at_end AND NOT failed, n div 2, 0L) AS records_new",
        "if(at_end AND NOT failed, n - n div 2, 0L) AS records_updated",
        "0L AS records_skipped",
        "CASE WHEN NOT at_end THEN 'running' WHEN failed THEN 'failed' ELSE 'completed' END AS status",
        "if(at_end AND failed, 'source unavailable', NULL) AS error_message",
        "if(at_end, ended, ts) AS recorded_at",
    )


def call_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One queued call per order."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return orders.join(customers, F.expr("o_custkey = c_custkey")).selectExpr(
        "o_orderkey AS queue_no",
        "string(o_orderkey) AS id",
        f"{state_of('c_nationkey')} AS state",
        "CASE WHEN left(o_orderpriority, 1) <= '2' THEN 'high' WHEN left(o_orderpriority, 1) <= '4' THEN 'normal' "
        "ELSE 'low' END AS priority",
        "CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'pending_approval' ELSE 'completed' END AS status",
        "0 AS retry_count",
        "2 AS max_retries",
        *[f"cast(NULL AS timestamp) AS {c}" for c in ("approved_at", "last_attempt_at", "completed_at")],
        *[f"cast(NULL AS string) AS {c}" for c in ("outcome", "notes")],
    )


def call_attempts(spark: SparkSession, sf_dir: str, until: str) -> DataFrame:
    """Attempts on the calls, from events up to a moment: three each, spread over the whole queue."""
    calls = table(spark, sf_dir, "orders").agg(F.count("*").alias("calls"))
    return (
        event_times(spark, sf_dir)
        .filter(f"ts <= {until}")
        .join(F.broadcast(calls))
        .selectExpr(
            "string(event_id div 3 * 7 % calls) AS id",
            "ts AS attempted_at",
            "event_id AS attempt_no",
            "if(event_type = 'purchase', 'completed', 'no-answer') AS outcome",
            "event_type AS notes",
        )
    )


def transcript_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transcript line per conversation turn."""
    line = "translate(text, '\\r\\n', '  ') AS text"
    return table(spark, sf_dir, "conversations").selectExpr("conv_id AS call_id", "turn AS line_no", line)


def pages(records: DataFrame, per_page: int, body: str) -> DataFrame:
    """JSON documents of at most ``per_page`` orders each; ``body`` makes one from ``page_no`` and ``items``."""
    grouped = records.groupBy(F.expr(f"page_key div {per_page} AS page_no")).agg(F.collect_list("record").alias("records"))
    listed = grouped.selectExpr("page_no", "concat('[', array_join(records, ','), ']') AS items")
    return listed.selectExpr("page_no", f"{body} AS value")
