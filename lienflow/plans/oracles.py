"""SQL twins of the registered queries, written independently of them."""

from __future__ import annotations

from lienflow.plans.inputs import STATES

S = "(list_value(" + ", ".join(f"'{s}'" for s in STATES) + "))"

RAW = f"""
raw AS (
  SELECT o_orderkey AS k, c_custkey AS c, c_nationkey AS nation, c_name, s_name, o_orderdate, o_orderstatus,
    ' ' || c_custkey || '  Main   St ' AS address_text, 'Port ' || c_nationkey AS debtor_city,
    CASE WHEN c_custkey % 2 = 0 THEN c_name END AS debtor_organization,
    CASE WHEN c_custkey % 2 = 0 THEN 'organization' ELSE 'individual' END AS debtor_type,
    s_suppkey || ' Bank  Row' AS bank_address_text, 'Bank City ' || s_nationkey AS secured_party_city,
    lpad(cast(s_suppkey AS varchar), 5, '7') AS secured_party_zip,
    CASE WHEN o_orderkey % 4 <> 0 THEN 'all  assets ' || o_orderpriority END AS collateral_text,
    CASE WHEN o_orderkey % 6 = 0 THEN cast(o_orderkey // 2 AS varchar) END AS original_filing_number,
    CASE WHEN o_orderkey % 6 = 0 THEN 'continuation' END AS amendment_type,
    o_orderkey || '|' || o_orderstatus AS source_raw,
    cast(o_orderkey AS varchar) AS filing_number,
    {S}[c_nationkey + 1] AS state,
    {S}[s_nationkey + 1] AS secured_party_state,
    CASE WHEN o_orderkey % 97 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS filing_date,
    CASE o_orderkey % 10 WHEN 0 THEN 'UCC1' WHEN 1 THEN 'ucc 3' WHEN 2 THEN 'Continuation'
      WHEN 3 THEN 'partial-assignment' WHEN 4 THEN 'IRS' WHEN 5 THEN '05' WHEN 6 THEN 'UCC-1'
      WHEN 7 THEN 'something' END AS type_text,
    CASE o_orderkey % 10 WHEN 0 THEN 'UCC-1' WHEN 1 THEN 'UCC-3' WHEN 2 THEN 'UCC-3-CONTINUATION'
      WHEN 3 THEN 'UCC-3-PARTIAL-ASSIGNMENT' WHEN 4 THEN 'FEDERAL-TAX-LIEN' WHEN 5 THEN 'UCC-5'
      WHEN 6 THEN 'UCC-1' WHEN 7 THEN 'SOMETHING' END AS filing_type,
    CASE o_orderstatus WHEN 'O' THEN 'A' WHEN 'F' THEN 'Expired'
      ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'pending' ELSE 'terminated' END END AS status_text,
    CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'lapsed'
      ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'pending' ELSE 'terminated' END END AS filing_status,
    lower(c_name) || '   llc' AS debtor_text,
    upper(c_name) || ' LLC' AS debtor_name,
    CASE c_custkey % 4 WHEN 0 THEN lpad(cast(c_custkey AS varchar), 5, '1')
      WHEN 1 THEN lpad(cast(c_custkey AS varchar), 9, '2')
      WHEN 2 THEN 'K1A ' || (c_custkey % 10) || 'B1'
      ELSE lpad(cast(c_custkey AS varchar), 5, '3') || '-' || lpad(cast(c_custkey AS varchar), 4, '4') END AS zip_text,
    CASE c_custkey % 4 WHEN 0 THEN lpad(cast(c_custkey AS varchar), 5, '1')
      WHEN 1 THEN substr(lpad(cast(c_custkey AS varchar), 9, '2'), 1, 5) || '-'
        || substr(lpad(cast(c_custkey AS varchar), 9, '2'), 6, 4)
      WHEN 2 THEN 'K1A ' || (c_custkey % 10) || 'B1'
      ELSE lpad(cast(c_custkey AS varchar), 5, '3') || '-' || lpad(cast(c_custkey AS varchar), 4, '4') END AS debtor_zip,
    CASE WHEN c_nationkey < 2 THEN 'open_api' WHEN c_nationkey < 17 THEN 'state_bulk' ELSE 'commercial' END AS source_tier
  FROM orders JOIN customer ON o_custkey = c_custkey
    LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS party FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
    LEFT JOIN supplier ON s_suppkey = party
),
printed AS (
  SELECT *, CASE WHEN k % 97 = 0 THEN 'not-a-date' ELSE CASE k % 7
      WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
      WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 3 THEN strftime(o_orderdate, '%m-%d-%Y')
      WHEN 4 THEN strftime(o_orderdate, '%Y%m%d') WHEN 5 THEN strftime(o_orderdate, '%m/%d/%y')
      ELSE strftime(o_orderdate, '%d-%b-%Y') END END AS date_text
  FROM raw
)"""

# Polling interval in hours of the states in the test data; the rest is daily.
HOURS = """
CASE WHEN state IN ('CA', 'WV', 'MN', 'AR', 'IN', 'NY', 'NC', 'SC', 'SD') THEN 168
  WHEN state IN ('ID', 'ND') THEN 336 WHEN state = 'AZ' THEN 720 ELSE 24 END"""
FREQUENCY = """
CASE WHEN state IN ('CA', 'WV', 'MN', 'AR', 'IN', 'NY', 'NC', 'SC', 'SD') THEN 'weekly'
  WHEN state IN ('ID', 'ND') THEN 'biweekly' WHEN state = 'AZ' THEN 'monthly' ELSE 'daily' END"""
TIER = """
CASE WHEN state IN ('CT', 'CO') THEN 'open_api'
  WHEN state IN ('CA', 'TX', 'KY', 'WV', 'ID', 'ND', 'MN', 'AR', 'IN', 'NY', 'NC', 'SC', 'SD', 'AZ', 'FL')
  THEN 'state_bulk' ELSE 'commercial' END"""
ALL_STATES = (
    "AL AK AZ AR CA CO CT DE DC FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND "
    "OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY"
)
DIM = f"""
dim AS (
  SELECT state, {TIER} AS tier, {FREQUENCY} AS poll_frequency, {HOURS} AS hours, state <> 'WY' AS enabled
  FROM (SELECT unnest(string_split('{ALL_STATES}', ' ')) AS state)
)"""

LINES = f"""
lines AS (
  SELECT {S}[l_orderkey % 25 + 1] AS state, cast(l_orderkey AS varchar) AS filing_number, l_returnflag AS src,
    'PART ' || l_partkey AS debtor_name, strftime(l_shipdate, '%Y-%m-%d') AS filing_date, l_linestatus,
    row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS seq
  FROM lineitem
)"""


def _sequence(rows: str) -> str:
    """Outcome of each incoming row of a sequence per key."""
    return f"""
  SELECT *, CASE WHEN NOT incoming THEN NULL
      WHEN lag(seq) OVER w IS NULL THEN 'new'
      WHEN lag(src) OVER w IS NOT DISTINCT FROM src THEN 'skipped' ELSE 'updated' END AS outcome
  FROM ({rows}) WINDOW w AS (PARTITION BY state, filing_number ORDER BY incoming, seq)"""


# The store after the lines with status O (opened), and after those with F and the whole delivery of one state (final).
STEPPED = f"""
{LINES},
ordered AS (SELECT *, row_number() OVER (PARTITION BY filing_number ORDER BY l_linestatus = 'F', seq) AS place FROM lines),
classified AS ({_sequence("SELECT state, filing_number, src, filing_date, l_linestatus, place AS seq, true AS incoming FROM ordered")}),
opened AS (
  SELECT state, filing_number, arg_max(src, seq) FILTER (outcome <> 'skipped') AS src,
    arg_max(filing_date, seq) FILTER (outcome <> 'skipped') AS filing_date
  FROM classified WHERE l_linestatus = 'O' GROUP BY ALL),
final AS (
  SELECT state, filing_number, arg_max(src, seq) FILTER (outcome <> 'skipped') AS src,
    arg_max(filing_date, seq) FILTER (outcome <> 'skipped') AS filing_date,
    CASE arg_max(l_linestatus, seq) FILTER (outcome <> 'skipped') WHEN 'O' THEN 'active' ELSE 'lapsed' END AS filing_status
  FROM classified WHERE state <> 'ID' GROUP BY ALL
  UNION ALL SELECT state, filing_number, arg_max(src, seq), arg_max(filing_date, seq), 'lapsed'
  FROM lines WHERE state = 'ID' AND l_linestatus = 'F' GROUP BY ALL)"""

# Every filing walks up its chain; one that has not arrived after a hundred steps goes round in a circle.
CHAIN_WALK = f"""
WITH RECURSIVE filed AS (
  SELECT o_orderkey AS k, {S}[o_orderkey // 40 % 25 + 1] AS state, cast(o_orderkey AS varchar) AS filing_number,
    CASE WHEN o_orderkey % 37 = 1 THEN 'UCC-3-TERMINATION' WHEN o_orderkey % 3 = 0 THEN 'UCC-3-CONTINUATION' ELSE 'UCC-3' END AS filing_type,
    timestamp '1980-01-01' + to_months(cast(o_orderkey % 40 * 9 + o_orderkey % 5 AS integer)) AS filing_date,
    CASE WHEN o_orderkey % 80 = 0 THEN timestamp '1985-03-01' END AS lapse_date,
    CASE WHEN o_orderkey % 400 = 7 THEN o_orderkey + 1 WHEN o_orderkey % 40 = 0 THEN NULL ELSE o_orderkey - 1 END AS up
  FROM orders),
walk(k, place, depth) AS (
  SELECT k, k, cast(0 AS bigint) FROM filed
  UNION ALL SELECT walk.k, up, depth + 1 FROM walk JOIN filed ON filed.k = walk.place WHERE up IS NOT NULL AND depth < 100),
arrived AS (
  SELECT k, place, depth FROM walk WHERE place NOT IN (SELECT k FROM filed WHERE up IS NOT NULL)),
rooted AS (
  SELECT state, filing_number, cast(place AS varchar) AS root_number, depth FROM filed LEFT JOIN arrived USING (k))"""


SPLIT_LINES = """
  SELECT state, filing_number, src, seq, true AS incoming FROM lines WHERE l_linestatus = 'F'
  UNION ALL
  SELECT state, filing_number, arg_max(src, seq), 0, false FROM lines WHERE l_linestatus = 'O' GROUP BY ALL"""

COUNTS = """count(*) AS n_fetched, count_if(outcome = 'new') AS n_new,
  count_if(outcome = 'updated') AS n_updated, count_if(outcome = 'skipped') AS n_skipped"""

RUNS = f"""
runs AS (
  SELECT cast(event_id AS varchar) AS run_id, {S}[user_id % 25 + 1] AS state,
    CASE WHEN user_id % 25 < 2 THEN 'open_api' WHEN user_id % 25 < 17 THEN 'state_bulk' ELSE 'commercial' END AS source_tier,
    ts AS started, ts + interval 1 minute AS completed, event_id % 1000 AS n,
    CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status
  FROM events
)"""

ALERTS = """
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(w + interval 5 minute, '%Y-%m-%d %H:%M:%S') AS window_end, count(*) AS n_failures
FROM (SELECT time_bucket(interval 5 minute, ts) AS w FROM events WHERE event_type = 'error') GROUP BY w"""


def _scanned(state: str, columns: str, keyed: bool = True) -> str:
    missing = "WHERE k % 50 <> 0" if keyed else ""
    return f"WITH {RAW} SELECT '{state}' AS state, filing_number, {columns} FROM printed {missing}"


SCAN_TYPE = "coalesce(type_text, 'UCC') AS filing_type"
SCAN_COLUMNS = (
    f"{SCAN_TYPE}, date_text AS filing_date, status_text AS filing_status, "
    "debtor_text AS debtor_name, s_name AS secured_party_name"
)
SCAN_NO_STATUS = SCAN_COLUMNS.replace("status_text AS", "cast(NULL AS varchar) AS")

CALLS = f"""
attempts AS (
  SELECT event_id // 3 * 7 % (SELECT count(*) FROM orders) AS id, ts, event_id, event_type
  FROM events WHERE ts <= timestamp '2024-01-15 17:00:00'
),
folded AS (
  SELECT id, count(*) AS tries, max(ts) AS last_at, arg_max(event_type, ts) AS last_type,
    max(ts) FILTER (event_type = 'purchase') AS done_at
  FROM attempts GROUP BY id
),
queue AS (
  SELECT o_orderkey AS k, {S}[c_nationkey + 1] AS state,
    CASE WHEN o_orderpriority[1] IN ('1', '2') THEN 'high' WHEN o_orderpriority[1] = '5' THEN 'low'
      ELSE 'normal' END AS priority,
    CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'pending_approval' ELSE 'completed' END AS status
  FROM orders JOIN customer ON o_custkey = c_custkey
),
calls AS (
  SELECT cast(k AS varchar) AS id, state, priority,
    CASE WHEN tries IS NULL THEN status WHEN last_type = 'purchase' THEN 'completed'
      WHEN tries >= 2 THEN 'failed_escalated' ELSE 'approved' END AS status,
    coalesce(tries, 0) AS retry_count, last_at, last_type, done_at
  FROM queue LEFT JOIN folded ON k = folded.id
)"""

# Hours behind UTC in winter of the states in the test data.
OFFSET = """
CASE WHEN state IN ('CT', 'KY', 'IN', 'NY', 'NC', 'SC', 'FL', 'DE', 'DC', 'GA') THEN 5
  WHEN state IN ('TX', 'ND', 'MN', 'AR', 'SD', 'AL', 'IA', 'IL') OR state = 'WI' THEN 6
  WHEN state IN ('CO', 'ID', 'AZ') THEN 7 WHEN state = 'CA' THEN 8 WHEN state = 'AK' THEN 9
  WHEN state = 'WV' THEN 5 WHEN state = 'HI' THEN 10 END"""

# Telling words and key of each question.
ASKED = """
asked(question_no, question_key, words) AS (VALUES
  (0, 'process', ['process']),
  (1, 'register_die_sich_der', ['register', 'die', 'sich', 'der']),
  (2, 'tell_la_letre_que', ['tell', 'la', 'letre', 'que']),
  (3, 'xylophone_quotient', ['there', 'xylophone', 'quotient'])
)"""

ANSWERS = f"""
{ASKED},
turns AS (
  SELECT conv_id AS call_id, turn AS line_no, translate(text, chr(13) || chr(10), '  ') AS text FROM conversations
),
hits AS (
  SELECT call_id, question_no, question_key, min(line_no) FILTER (
    2 * len(list_filter(words, lambda w: contains(lower(text), w))) >= len(words)) AS hit
  FROM turns CROSS JOIN asked GROUP BY ALL
),
answers AS (
  SELECT h.call_id, h.question_no, h.question_key,
    string_agg(nullif(trim(t.text), ''), ' ' ORDER BY t.line_no) AS answer
  FROM hits h LEFT JOIN turns t ON t.call_id = h.call_id AND t.line_no BETWEEN h.hit + 1 AND h.hit + 4
  GROUP BY ALL
)"""

ORACLES: dict[str, str] = {
    "normalize_dates": f"WITH {RAW} SELECT filing_number, filing_date FROM raw",
    "normalize_types_status": f"WITH {RAW} SELECT filing_number, filing_type, filing_status FROM raw",
    "normalize_names_zip": f"""
WITH {RAW} SELECT filing_number, debtor_name, lower(debtor_name) AS debtor_name_as_is, debtor_zip, state AS debtor_state
FROM raw""",
    "normalized_filings": f"""
WITH {RAW} SELECT filing_number, state, coalesce(filing_type, 'UCC') AS filing_type, filing_date,
  strftime(o_orderdate + interval 60 month, '%Y-%m-%d') AS lapse_date, filing_status, debtor_name,
  c || ' Main St' AS debtor_address, debtor_city, state AS debtor_state, debtor_zip, debtor_organization, debtor_type,
  upper(s_name) AS secured_party_name, replace(bank_address_text, '  ', ' ') AS secured_party_address, secured_party_city,
  secured_party_state, secured_party_zip, replace(collateral_text, '  ', ' ') AS collateral_description,
  original_filing_number, amendment_type, source_tier, source_raw
FROM raw""",
    "question_keys": r"""
SELECT item_id, coalesce(nullif(array_to_string(list_slice(list_filter(
  string_split(trim(regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{M}\p{N}_\s]', '', 'g'), '\s+', ' ', 'g')), ' '),
  lambda w: NOT list_contains(['what', 'is', 'the', 'to', 'a', 'an', 'are', 'how', 'do', 'does', 'for', 'of', 'in', 'and',
    'or', 'can', 'we', 'i', 'you', 'your', 'about', 'from', 'this', 'that', 'there', 'their'], w)), 1, 4), '_'), ''),
  'unknown') AS question_key
FROM benchmark""",
    "upsert_outcomes": f"""
WITH {LINES} SELECT outcome, count(*) AS n_rows
FROM ({_sequence("SELECT *, true AS incoming FROM lines")}) GROUP BY outcome""",
    "upsert_hot_keys": f"""
WITH {LINES} SELECT state, {COUNTS}
FROM ({_sequence("SELECT *, true AS incoming FROM lines")}) GROUP BY state""",
    "upsert_outcomes_by_state": f"""
WITH {LINES} SELECT state, {COUNTS} FROM ({_sequence(SPLIT_LINES)}) WHERE incoming GROUP BY state""",
    "upsert_final_state": f"""
WITH {LINES}, classified AS ({_sequence("SELECT *, true AS incoming FROM lines")})
SELECT state, filing_number,
  arg_max(debtor_name, seq) FILTER (outcome <> 'skipped') AS debtor_name,
  arg_max(filing_date, seq) FILTER (outcome <> 'skipped') AS filing_date,
  arg_max(src, seq) FILTER (outcome <> 'skipped') AS source_raw,
  count_if(outcome = 'new') AS n_new, count_if(outcome = 'updated') AS n_updated, count_if(outcome = 'skipped') AS n_skipped
FROM classified GROUP BY state, filing_number""",
    "stored_upsert": f"""
WITH {LINES},
ordered AS (SELECT *, row_number() OVER (PARTITION BY filing_number ORDER BY l_linestatus = 'F', seq) AS place FROM lines),
classified AS ({_sequence("SELECT state, filing_number, src, debtor_name, filing_date, place AS seq, true AS incoming FROM ordered")})
SELECT state, filing_number,
  arg_max(debtor_name, seq) FILTER (outcome <> 'skipped') AS debtor_name,
  arg_max(filing_date, seq) FILTER (outcome <> 'skipped') AS filing_date,
  arg_max(src, seq) FILTER (outcome <> 'skipped') AS source_raw
FROM classified GROUP BY state, filing_number""",
    "ingested_runs": f"""
WITH {RAW}, n AS (SELECT state, source_tier, count(*) FILTER (k % 50 <> 0) AS n FROM raw GROUP BY ALL)
SELECT state, source_tier, n AS records_fetched, n AS records_new, cast(0 AS bigint) AS records_updated,
  cast(0 AS bigint) AS records_skipped, 'completed' AS status FROM n
UNION ALL SELECT state, source_tier, n, 0, 0, n, 'completed' FROM n""",
    "run_ids": f"""
SELECT event_id, {S}[user_id % 25 + 1] || '_' || strftime(ts, '%Y%m%d_%H%M%S') || '_'
  || substr(sha256({S}[user_id % 25 + 1] || '|' || event_id), 1, 8) AS run_id FROM events""",
    "streamed_upsert": f"""
WITH {RAW} SELECT 'TX' AS state, filing_number, coalesce(filing_type, 'UCC') AS filing_type, filing_date, filing_status,
  debtor_name FROM raw WHERE k % 50 <> 0""",
    "xml_parties": f"""
WITH {RAW}
SELECT 'IN' AS filing_state, filing_number, 'debtor' AS role, 0 AS party_no, debtor_text AS name, cast(NULL AS varchar) AS state FROM raw
UNION ALL SELECT 'IN', filing_number, 'debtor', 1, s_name, secured_party_state FROM raw
UNION ALL SELECT 'IN', filing_number, 'secured_party', 0, s_name, NULL FROM raw""",
    "latest_landed_files": f"""
WITH {RAW} SELECT state, o_orderstatus = 'F' AS in_second_file, filing_number FROM raw""",
    "landed_delivery": f"""
WITH {RAW} SELECT state, filing_number, debtor_name FROM raw WHERE state IN ('KY', 'AL')""",
    "unreadable_documents": f"""
WITH {RAW}, p AS (SELECT k // 500 AS page, count(*) AS n FROM raw GROUP BY 1)
SELECT 'AL' AS state, cast(count_if(page % 3 = 1) AS bigint) AS n_unreadable,
  cast(sum(n) FILTER (page % 3 <> 1) AS bigint) AS n_filings, 'partial' AS status,
  count_if(page % 3 = 1) || ' documents could not be read' AS error_message, cast(count_if(page % 3 = 1) AS bigint) AS n_errors
FROM p""",
    "backfill_run": f"""
WITH {RAW} SELECT state, filing_number FROM raw
WHERE state IN ('TX', 'CA') AND (filing_date IS NULL OR substr(filing_date, 1, 4) IN ('1996', '1997'))""",
    "backfill_manifest": f"""
WITH {RAW}, delivered AS (
  SELECT state, substr(filing_date, 1, 7) || '-01' AS range_start, count(*) AS n_records FROM raw
  WHERE state IN ('TX', 'CA') AND substr(filing_date, 1, 4) IN ('1996', '1997') GROUP BY ALL),
told AS (
  SELECT * FROM delivered
  UNION ALL SELECT s, d, 0 FROM (VALUES ('TX'), ('CA')) a(s), (VALUES ('1997-11-01'), ('1997-12-01')) b(d)
  WHERE (s, d) NOT IN (SELECT (state, range_start) FROM delivered))
SELECT state, range_start, strftime(last_day(cast(range_start AS date)), '%Y-%m-%d') AS range_end,
  CASE WHEN n_records > 0 AND (state = 'TX' OR range_start < '1996-07-01') THEN 'first' ELSE 'second' END AS batch,
  n_records FROM told""",
    "ledger_run": f"""
WITH {RAW} SELECT 'filing' AS kind, filing_number AS name, cast(1 AS bigint) AS n FROM raw
UNION ALL SELECT 'run', CASE WHEN k % 4 < 2 THEN '1' ELSE cast(k % 4 AS varchar) END, count(*) FROM raw GROUP BY ALL""",
    "isolated_runs": f"""
WITH {RAW}, n AS (SELECT count(*) AS n FROM raw)
SELECT state, 'completed' AS status, n AS records_new, false AS has_error, 'ingestion_complete' AS event, n AS filing_count
FROM n, (VALUES ('KY'), ('CA')) s(state)
UNION ALL SELECT 'TX', 'failed', 0, true, 'ingestion_failed', NULL""",
    "two_streams_run": f"""
WITH {RAW} SELECT 'TX' AS state, filing_number, debtor_name, cast(3 AS bigint) AS n_streams FROM raw""",
    "mixed_xml_scan": f"""
WITH {RAW} SELECT 'CA' AS state, filing_number, CASE WHEN k % 2 = 0 THEN 'two' ELSE 'one' END AS debtor_name,
  cast(1 AS bigint) AS n_new, cast(1 AS bigint) AS n_updated FROM raw""",
    "stored_statistics": f"""
WITH {STEPPED}, sets AS (
  SELECT 'total' AS dimension, 'all' AS value, filing_date FROM final
  UNION ALL SELECT 'state', state, filing_date FROM final
  UNION ALL SELECT 'filing_status', filing_status, filing_date FROM final
  UNION ALL SELECT 'source_tier', 'unknown', filing_date FROM final)
SELECT dimension, value, count(*) AS n_filings, min(filing_date) AS earliest_filing, max(filing_date) AS latest_filing
FROM sets GROUP BY ALL""",
    "stored_status": f"""
WITH {STEPPED} SELECT state, {TIER} AS tier, count(*) AS filing_count, max(filing_date) AS latest_filing_date
FROM final GROUP BY ALL""",
    "stored_latency": f"""
WITH {STEPPED}, first AS (
  SELECT state, filing_number, bool_or(l_linestatus = 'O') AS early FROM lines GROUP BY ALL),
d AS (
  SELECT state, (CASE WHEN early THEN date '2001-08-02' ELSE date '2001-08-03' END) - cast(filing_date AS date) AS days
  FROM final JOIN first USING (state, filing_number) WHERE filing_date LIKE '1998%')
SELECT state, count(*) AS n_filings, cast(max(days) AS integer) AS max_days, round(avg(days), 4) AS mean_days,
  quantile_cont(days, 0.5) AS median_days, count_if(days > 1000) AS n_late FROM d GROUP BY state""",
    "filings_as_of": f"""
WITH {STEPPED} SELECT state, filing_number, filing_date, src AS source_raw FROM opened""",
    "changes_between": f"""
WITH {STEPPED} SELECT coalesce(o.state, f.state) AS state, coalesce(o.filing_number, f.filing_number) AS filing_number,
  CASE WHEN o.state IS NULL THEN 'added' WHEN f.state IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM opened o FULL JOIN final f ON o.state = f.state AND o.filing_number = f.filing_number
WHERE o.state IS NULL OR f.state IS NULL OR o.src <> f.src""",
    "chain_roots": f"""
{CHAIN_WALK}
SELECT state, filing_number, root_number, depth FROM rooted""",
    "whole_chains": f"""
{CHAIN_WALK},
chains AS (
  SELECT root_number, count(*) AS n, max(depth) AS depth, count_if(filing_type = 'UCC-3-CONTINUATION') AS n_continuations,
    max(filing_date) AS last_amendment, min(filing_date) FILTER (filing_type = 'UCC-3-TERMINATION') AS terminated_on,
    list_sort(list_distinct(list(filing_date) FILTER (filing_type = 'UCC-3-CONTINUATION'))) AS continued
  FROM rooted JOIN filed USING (state, filing_number) WHERE depth > 0 GROUP BY root_number),
first AS (
  SELECT *, coalesce(lapse_date, filing_date + interval 60 month) AS lapse FROM filed WHERE up IS NULL)
SELECT f.state, filing_number, strftime(f.filing_date, '%Y-%m-%d') AS filing_date, strftime(lapse_date, '%Y-%m-%d') AS lapse_date,
  coalesce(n, 0) AS n_amendments, coalesce(c.depth, 0) AS depth, coalesce(n_continuations, 0) AS n_continuations,
  strftime(last_amendment, '%Y-%m-%d') AS last_amendment, strftime(terminated_on, '%Y-%m-%d') AS terminated_on,
  strftime(CASE WHEN continued IS NULL THEN lapse ELSE list_reduce(continued,
    lambda l, d: CASE WHEN d BETWEEN l - interval 6 month AND l THEN l + interval 60 month ELSE l END, lapse) END,
    '%Y-%m-%d') AS effective_lapse
FROM first f LEFT JOIN chains c ON root_number = filing_number""",
    "full_replacement_run": f"""
WITH {RAW} SELECT 'ID' AS state, filing_number, debtor_name FROM raw WHERE k % 3 <> 0""",
    "two_phase_run": f"""
WITH {RAW}, latest AS (SELECT max(filing_date) AS d FROM raw WHERE o_orderstatus <> 'F')
SELECT filing_number FROM raw, latest WHERE o_orderstatus <> 'F' OR filing_date IS NULL OR filing_date >= d""",
    "three_file_run": f"""
WITH secured AS (
  SELECT l_orderkey, arg_min(s_name, (l_linenumber, l_suppkey)) AS name, count(*) AS n
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_orderkey)
SELECT cast(o_orderkey AS varchar) AS filing_number, upper(c_name) AS debtor_name, upper(name) AS secured_party_name,
  coalesce(n, 0) AS n_secured, cast(1 AS bigint) AS n_debtors
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN secured ON l_orderkey = o_orderkey""",
    "stored_parties": f"""
WITH {RAW}
SELECT filing_number, 'debtor' AS role, 0 AS party_no, debtor_text AS name FROM raw
UNION ALL SELECT filing_number, 'secured_party', 0, s_name FROM raw WHERE k % 2 = 1""",
    "event_log": f"""
WITH {RAW}, n AS (SELECT state, source_tier, count(*) FILTER (k % 50 <> 0) AS n, count(*) FILTER (k % 50 = 0) AS e FROM raw GROUP BY ALL)
SELECT state, 'ingestion_start' AS event, source_tier AS tier, cast(NULL AS bigint) AS records_new, cast(NULL AS bigint) AS record_errors,
  cast(0 AS bigint) AS n_errors FROM n
UNION ALL SELECT state, 'ingestion_complete', NULL, n, e, 0 FROM n
UNION ALL SELECT state, 'ingestion_start', source_tier, NULL, NULL, 0 FROM n
UNION ALL SELECT state, 'ingestion_failed', NULL, 0, 0, 1 FROM n""",
    "failed_runs": f"""
WITH {RAW}, n AS (SELECT state, source_tier, count(*) FILTER (k % 50 <> 0) AS n FROM raw GROUP BY ALL)
SELECT state, source_tier, 'completed' AS status, n AS records_new, n AS records_stored, false AS has_error FROM n
UNION ALL SELECT state, source_tier, 'failed', 0, n, true FROM n""",
    "compacted_store": f"""
WITH {LINES},
ordered AS (SELECT *, row_number() OVER (PARTITION BY filing_number ORDER BY l_linestatus = 'F', seq) AS place FROM lines),
classified AS ({_sequence("SELECT state, filing_number, src, debtor_name, filing_date, place AS seq, true AS incoming FROM ordered")})
SELECT state, filing_number, arg_max(debtor_name, seq) FILTER (outcome <> 'skipped') AS debtor_name,
  arg_max(src, seq) FILTER (outcome <> 'skipped') AS source_raw
FROM classified GROUP BY state, filing_number""",
    "stored_name_search": f"""
WITH {RAW} SELECT filing_number, state, 'THE ' || upper(replace(raw.c_name, '#', ' ')) || ', INC.' AS watch_name
FROM raw JOIN customer ON c = c_custkey WHERE state <> 'DE' AND c_mktsegment = 'BUILDING'""",
    "two_phase_load": f"""
WITH {RAW} SELECT filing_number, 'master' AS phase FROM raw WHERE o_orderstatus <> 'F'
UNION ALL SELECT filing_number, 'update' FROM raw WHERE filing_date IS NULL OR filing_date >= '2000-01-01'""",
    "consent_rules": f"""
SELECT {S}[c_nationkey + 1] AS state, CASE WHEN c_mktsegment = 'BUILDING' THEN 'two_party' ELSE 'one_party' END AS consent_type,
  count(*) AS n_documents FROM customer GROUP BY ALL""",
    "filings_of_tier": f"""
WITH {RAW} SELECT state, count(*) AS n_filings FROM raw WHERE source_tier = 'state_bulk' AND state <> 'NY' GROUP BY state""",
    "replacement_changes": f"""
WITH {LINES},
held AS (SELECT state, filing_number, l_linestatus, arg_max(src, seq) AS src FROM lines GROUP BY ALL),
old AS (SELECT * FROM held WHERE l_linestatus = 'O' AND state IN (SELECT state FROM held WHERE l_linestatus = 'F')),
new AS (SELECT * FROM held WHERE l_linestatus = 'F')
SELECT coalesce(o.state, n.state) AS state, CASE WHEN o.state IS NULL THEN 'added' WHEN n.state IS NULL THEN 'removed'
  WHEN o.src = n.src THEN 'unchanged' ELSE 'changed' END AS change, count(*) AS n_filings
FROM old o FULL JOIN new n ON o.state = n.state AND o.filing_number = n.filing_number GROUP BY ALL""",
    "stats_by_state": f"WITH {RAW} SELECT state, count(*) AS n_filings FROM raw GROUP BY state",
    "stats_by_status": f"WITH {RAW} SELECT filing_status, count(*) AS n_filings FROM raw GROUP BY filing_status",
    "stats_by_tier": f"WITH {RAW} SELECT source_tier, count(*) AS n_filings FROM raw GROUP BY source_tier",
    "stats_summary": f"""
WITH {RAW} SELECT count(*) AS total_filings, count(DISTINCT state) AS states_covered,
  min(filing_date) AS earliest_filing, max(filing_date) AS latest_filing FROM raw""",
    "stats_all": f"""
WITH {RAW}, sets AS (
  SELECT 'total' AS dimension, 'all' AS value, filing_date FROM raw
  UNION ALL SELECT 'state', state, filing_date FROM raw
  UNION ALL SELECT 'filing_status', filing_status, filing_date FROM raw
  UNION ALL SELECT 'source_tier', source_tier, filing_date FROM raw)
SELECT dimension, value, count(*) AS n_filings, min(filing_date) AS earliest_filing, max(filing_date) AS latest_filing
FROM sets GROUP BY ALL""",
    "top_states": f"""
WITH {RAW} SELECT state, count(*) AS n_filings FROM raw GROUP BY state ORDER BY n_filings DESC, state LIMIT 10""",
    "latest_by_state": f"""
WITH {RAW} SELECT state, count(*) AS filing_count, max(filing_date) AS latest_filing_date,
  strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS last_ingestion FROM raw GROUP BY state""",
    "filing_count_tx": f"WITH {RAW} SELECT count(*) AS n_filings FROM raw WHERE state = 'TX'",
    "incremental_since": f"""
WITH {RAW}, cutoffs AS (
  SELECT state, strftime(max(filing_date)::date - 30, '%Y-%m-%d') AS cutoff FROM raw WHERE filing_status = 'lapsed' GROUP BY state)
SELECT filing_number, state, filing_date FROM raw LEFT JOIN cutoffs USING (state)
WHERE filing_date IS NULL OR cutoff IS NULL OR filing_date >= cutoff""",
    "since_filter": f"""
WITH {RAW} SELECT filing_number, state FROM raw WHERE filing_date IS NULL OR filing_date >= '2000-01-01'""",
    "due_states": f"""
WITH {RAW}, {DIM}, held AS (SELECT state, max(o_orderdate) AS last FROM raw GROUP BY state)
SELECT state, tier, strftime(last, '%Y-%m-%d %H:%M:%S') AS last_ingestion FROM dim LEFT JOIN held USING (state)
WHERE enabled AND (last IS NULL OR timestamp '2001-08-02 12:00:00' >= last + to_hours(hours))""",
    "status_report": f"""
WITH {RAW}, {DIM}, held AS (
  SELECT state, max(o_orderdate) AS last, max(filing_date) AS latest, count(*) AS n FROM raw GROUP BY state)
SELECT state, tier, poll_frequency, enabled, strftime(last, '%Y-%m-%d %H:%M:%S') AS last_ingestion,
  latest AS latest_filing_date, coalesce(n, 0) AS filing_count,
  enabled AND (last IS NULL OR timestamp '2001-08-02 12:00:00' >= last + to_hours(hours)) AS due
FROM dim LEFT JOIN held USING (state)""",
    "cost_by_tier": f"""
WITH {RAW}, {DIM}, tiers AS (
  SELECT tier, count(*) AS n_states, sum(coalesce(n, 0)) AS n_filings, string_agg(state, ',' ORDER BY state) AS states,
    CASE tier WHEN 'open_api' THEN 0.0 WHEN 'state_bulk' THEN 103830.0 ELSE 300000.0 END AS annual_cost
  FROM dim LEFT JOIN (SELECT state, count(*) AS n FROM raw GROUP BY state) USING (state) GROUP BY tier)
SELECT tier, cast(n_states AS bigint) AS n_states, cast(n_filings AS bigint) AS n_filings,
  cast(annual_cost AS double) AS annual_cost, states, cast(0 AS double) AS budget_remaining FROM tiers
UNION ALL SELECT 'total', cast(sum(n_states) AS bigint), cast(sum(n_filings) AS bigint),
  cast(sum(annual_cost) AS double), '', cast(1000000 - sum(annual_cost) AS double) FROM tiers""",
    "commercial_coverage": f"""
WITH {RAW} SELECT state, count(*) AS n_filings FROM raw WHERE source_tier = 'commercial' GROUP BY state""",
    "run_history": f"""
WITH {RUNS} SELECT run_id, state, source_tier, strftime(started, '%Y-%m-%d %H:%M:%S') AS started_at,
  strftime(completed, '%Y-%m-%d %H:%M:%S') AS completed_at, n AS records_fetched,
  CASE WHEN status = 'completed' THEN n // 2 ELSE 0 END AS records_new,
  CASE WHEN status = 'completed' THEN n - n // 2 ELSE 0 END AS records_updated,
  cast(0 AS bigint) AS records_skipped, status
FROM runs ORDER BY started DESC, run_id LIMIT 50""",
    "run_history_of_state": f"""
WITH {RUNS} SELECT run_id, state, status, CASE WHEN status = 'failed' THEN 'source unavailable' END AS error_message
FROM runs WHERE state = 'TX' ORDER BY started DESC, run_id LIMIT 10""",
    "run_totals": f"""
WITH {RUNS} SELECT count_if(status = 'completed') AS n_succeeded, count_if(status = 'failed') AS n_failed,
  cast(sum(n) FILTER (status = 'completed') AS bigint) AS total_fetched,
  cast(sum(n // 2) FILTER (status = 'completed') AS bigint) AS total_new FROM runs""",
    "activity_log": f"""
SELECT {S}[user_id % 25 + 1] AS state, event_type AS action_type,
  CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS outcome, count(*) AS n_events,
  cast(0 AS bigint) AS n_urls, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_at
FROM events GROUP BY ALL""",
    "research_facts": """
SELECT event_id, json_extract_string(props, '$.k') AS k, cast(NULL AS varchar) AS absent FROM events""",
    "failure_alert_5min": ALERTS,
    "failure_alert_stream": ALERTS,
    "csv_scan": f"""
WITH {RAW} SELECT 'KY' AS state, filing_number, {SCAN_TYPE}, date_text AS filing_date,
  strftime(o_orderdate + interval 60 month, '%Y-%m-%d') AS lapse_date, status_text AS filing_status,
  debtor_text AS debtor_name, c || chr(10) || 'Suite 2' AS debtor_address, debtor_city, lower(state) AS debtor_state,
  zip_text AS debtor_zip, s_name AS secured_party_name, bank_address_text AS secured_party_address, secured_party_city,
  secured_party_state, secured_party_zip, filing_number AS raw_number, c || chr(10) || 'Suite 2' AS raw_address
FROM printed WHERE k % 50 <> 0""",
    "tab_delimited_scan": _scanned("ID", SCAN_NO_STATUS),
    "fuzzy_header_scan": _scanned("VT", SCAN_COLUMNS),
    "fixed_width_scan": f"""
WITH {RAW} SELECT 'FL' AS state, filing_number, coalesce(nullif(trim(substr(CASE WHEN k % 10 = 6 THEN ' UCC-1 '
  ELSE type_text END, 1, 5)), ''), 'UCC') AS filing_type, nullif(trim(substr(date_text, 1, 10)), '') AS filing_date,
  nullif(trim(substr(CASE WHEN status_text = 'terminated' THEN ' terminated ' ELSE status_text END, 1, 5)), '') AS filing_status,
  debtor_text AS debtor_name, s_name AS secured_party_name FROM printed WHERE k % 50 <> 0""",
    "rejected_records": f"""
WITH {RAW} SELECT state, 'missing_filing_number' AS reject_reason, count(*) AS n_records
FROM raw WHERE k % 50 = 0 GROUP BY state""",
    "json_lines_scan": _scanned("TX", SCAN_COLUMNS),
    "json_document_scan": _scanned("TX", SCAN_COLUMNS, keyed=False),
    "open_data_pages": _scanned(
        "CT", SCAN_COLUMNS.replace("date_text AS", "split_part(date_text, 'T', 1) AS"), keyed=False
    ),
    "envelope_unwrap": f"""
WITH {RAW} SELECT filing_number, {SCAN_TYPE}, split_part(date_text, 'T', 1) AS filing_date,
  strftime(o_orderdate + interval 60 month, '%Y-%m-%d') AS lapse_date, status_text AS filing_status,
  debtor_text AS debtor_name, trim(address_text) AS debtor_address, debtor_city, lower(state) AS debtor_state,
  zip_text AS debtor_zip, debtor_organization, debtor_type, s_name AS secured_party_name,
  bank_address_text AS secured_party_address, secured_party_city, secured_party_state, secured_party_zip,
  collateral_text AS collateral_description, original_filing_number, amendment_type FROM printed""",
    "normalized_pages": f"""
WITH {RAW} SELECT 'AL' AS state, filing_number, coalesce(filing_type, 'UCC') AS filing_type, filing_date, filing_status,
  debtor_name, c || ' Main St' AS debtor_address, debtor_city, state AS debtor_state, debtor_zip,
  upper(s_name) AS secured_party_name, replace(collateral_text, '  ', ' ') AS collateral_description FROM raw""",
    "xml_scan": _scanned(
        "CA",
        f"{SCAN_TYPE}, substr(date_text, 1, 10) AS filing_date, debtor_text AS debtor_name, zip_text AS debtor_zip, "
        "s_name AS secured_party_name",
    ),
    "feed_dispatch": f"""
WITH {RAW} SELECT (list_value('KY', 'ID', 'TX', 'CA', 'FL'))[nation % 5 + 1] AS state, filing_number,
  CASE WHEN nation % 5 = 4 THEN coalesce(nullif(trim(substr(CASE WHEN k % 10 = 6 THEN ' UCC-1 '
    ELSE type_text END, 1, 5)), ''), 'UCC') ELSE coalesce(type_text, 'UCC') END AS filing_type,
  debtor_text AS debtor_name, s_name AS secured_party_name FROM printed""",
    "page_slice": """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderkey, o_orderstatus FROM (
  SELECT * FROM orders WHERE o_orderdate >= timestamp '1996-01-01' ORDER BY o_orderdate, o_orderkey LIMIT 250 OFFSET 500)""",
    "page_after": """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderkey, o_orderstatus FROM (
  SELECT * FROM orders WHERE (o_orderdate, o_orderkey) > (timestamp '1996-06-01', 40)
  ORDER BY o_orderdate, o_orderkey LIMIT 250)""",
    "three_file_merge": f"""
WITH secured AS (
  SELECT l_orderkey, count(*) AS n, arg_min(s_name, (l_linenumber, l_suppkey)) AS name,
    arg_min(s_nationkey, (l_linenumber, l_suppkey)) AS nation
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_orderkey)
SELECT o_orderkey AS "DocNumber", o_orderstatus AS "Status", cast(1 AS bigint) AS n_debtor, c_name AS debtor_name,
  {S}[c_nationkey + 1] AS debtor_state, coalesce(n, 0) AS n_secured_party, name AS secured_party_name,
  {S}[nation + 1] AS secured_party_state
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN secured ON l_orderkey = o_orderkey""",
    "party_table": f"""
SELECT 'WV' AS filing_state, l_orderkey AS "DocNumber", s_name AS name, {S}[s_nationkey + 1] AS state,
  min(l_linenumber) AS first_line
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL""",
    "cross_source_reconcile": f"""
WITH b AS (
  SELECT l_orderkey AS k, l_linestatus AS st, strftime(l_shipdate, '%Y') AS yr FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_shipdate DESC) = 1),
a AS (SELECT o_orderkey AS k, o_orderstatus AS st, strftime(o_orderdate, '%Y') AS yr FROM orders),
j AS (
  SELECT coalesce(a.k, b.k) AS k, a.k IS NOT NULL AS in_a, b.k IS NOT NULL AS in_b,
    concat_ws(',', CASE WHEN a.st IS DISTINCT FROM b.st THEN 'filing_status' END,
      CASE WHEN a.yr IS DISTINCT FROM b.yr THEN 'filing_year' END) AS diff
  FROM a FULL JOIN b ON a.k = b.k)
SELECT {S}[k % 25 + 1] AS state, CASE WHEN NOT in_b THEN 'only_left' WHEN NOT in_a THEN 'only_right'
  WHEN diff = '' THEN 'agree' ELSE 'differ' END AS verdict,
  CASE WHEN in_a AND in_b THEN diff ELSE '' END AS fields, count(*) AS n_filings
FROM j GROUP BY ALL""",
    "latency_sla": f"""
WITH {RAW}, d AS (SELECT state, k * 7 % 11 AS days FROM raw WHERE filing_date IS NOT NULL)
SELECT state, count(*) AS n_filings, cast(max(days) AS integer) AS max_days, round(avg(days), 4) AS mean_days,
  quantile_cont(days, 0.5) AS median_days, count_if(days > 3) AS n_late FROM d GROUP BY state""",
    "collateral_coverage": f"""
WITH {RAW}, texts AS (SELECT DISTINCT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R'),
r AS (
  SELECT state, l_orderkey IS NOT NULL AS has, CASE WHEN state = 'NY' THEN 'image_only'
    WHEN state = 'AL' THEN 'paid_retrieval_required'
    WHEN state IN ('KY', 'WV', 'ID', 'ND', 'MN', 'AR', 'NC', 'SC', 'SD', 'AZ', 'CO', 'FL') THEN 'not_in_feed'
    ELSE 'pending_collateral' END AS reason
  FROM raw LEFT JOIN texts ON l_orderkey = k)
SELECT state, count(*) AS n_filings, count_if(has) AS n_with_collateral,
  count_if(NOT has AND reason = 'not_in_feed') AS n_not_in_feed,
  count_if(NOT has AND reason = 'image_only') AS n_image_only,
  count_if(NOT has AND reason = 'paid_retrieval_required') AS n_paid_retrieval_required,
  count_if(NOT has AND reason = 'pending_collateral') AS n_pending_collateral,
  round(count_if(has) / count(*), 4) AS coverage FROM r GROUP BY state""",
    "pending_collateral": f"""
WITH {RAW} SELECT state, filing_number,
  CASE WHEN state IN ('KY', 'WV', 'ID', 'ND', 'MN', 'AR', 'NC', 'SC', 'SD', 'AZ', 'CO', 'FL') THEN 'not_in_feed'
    ELSE 'pending_collateral' END AS collateral_reason
FROM raw WHERE k NOT IN (SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R')""",
    "backfill_pending": f"""
WITH {RAW}, {DIM}, ranges AS (
  SELECT state, cast(unnest(generate_series(timestamp '1995-01-01', timestamp '2001-12-31', interval 1 month)) AS date) AS d FROM dim)
SELECT state, strftime(d, '%Y-%m-%d') AS range_start, strftime(last_day(d), '%Y-%m-%d') AS range_end FROM ranges
WHERE (state, strftime(d, '%Y-%m')) NOT IN (
  SELECT (state, substr(filing_date, 1, 7)) FROM raw WHERE filing_status = 'lapsed' AND filing_date IS NOT NULL)""",
    "name_search": f"""
WITH {RAW} SELECT filing_number, state, 'THE ' || upper(replace(raw.c_name, '#', ' ')) || ', INC.' AS watch_name
FROM raw WHERE state <> 'DE'
UNION ALL SELECT filing_number, state, upper(raw.c_name) || ' LLC' FROM raw JOIN customer ON c = c_custkey
WHERE c_mktsegment = 'BUILDING'""",
    "initial_search": """
SELECT c_custkey, given || ' Doe' || c_custkey AS debtor_name, given[1] || ' Doe' || c_custkey AS watch_name
FROM (SELECT *, (list_value('John', 'Jane', 'Mary'))[c_nationkey % 3 + 1] AS given FROM customer)
WHERE c_mktsegment = 'MACHINERY'""",
    "lapse_horizon": f"""
WITH {RAW} SELECT filing_number, state, strftime(o_orderdate + interval 60 month, '%Y-%m-%d') AS lapse_date FROM raw
WHERE o_orderdate + interval 60 month BETWEEN timestamp '2001-01-01' AND timestamp '2001-03-31'""",
    "amendment_chains": f"""
WITH amended AS (
  SELECT o_orderkey // 10 * 10 AS k, count(*) AS n, count_if(o_orderkey % 10 = 2) AS c,
    max(o_orderdate) AS last FROM orders WHERE o_orderkey % 10 <> 0 GROUP BY 1)
SELECT {S}[o_orderkey // 10 % 25 + 1] AS state, cast(o_orderkey AS varchar) AS filing_number,
  strftime(o_orderdate, '%Y-%m-%d') AS filing_date, coalesce(n, 0) AS n_amendments, coalesce(c, 0) AS n_continuations,
  cast(0 AS bigint) AS n_terminations, strftime(last, '%Y-%m-%d') AS last_amendment
FROM orders LEFT JOIN amended ON k = o_orderkey WHERE o_orderkey % 10 = 0""",
    "orphan_amendments": f"""
SELECT {S}[o_orderkey // 10 % 25 + 1] AS state, cast(o_orderkey AS varchar) AS filing_number,
  cast(o_orderkey // 10 * 10 AS varchar) AS original_filing_number
FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey // 10 * 10 NOT IN (
  SELECT o_orderkey FROM orders WHERE o_orderkey % 10 = 0 AND o_orderdate >= timestamp '1998-01-01')""",
    "call_states": f"""
WITH {CALLS} SELECT id, status, retry_count,
  CASE WHEN last_type = 'purchase' THEN 'completed' WHEN last_type IS NOT NULL THEN 'no-answer' END AS outcome,
  last_type AS notes, strftime(last_at, '%Y-%m-%d %H:%M:%S') AS last_attempt_at,
  strftime(done_at, '%Y-%m-%d %H:%M:%S') AS completed_at FROM calls""",
    "queue_summary": f"""
WITH {CALLS} SELECT count(*) AS total, count_if(status = 'pending_approval') AS pending_approval,
  count_if(status = 'approved') AS approved, count_if(status = 'completed') AS completed,
  count_if(status = 'failed_escalated') AS failed_escalated FROM calls""",
    "states_attempted": f"""
WITH {CALLS} SELECT DISTINCT state FROM calls WHERE last_at >= timestamp '2024-01-15 00:00:00'""",
    "ready_calls": f"""
WITH {CALLS}, today AS (
  SELECT event_id // 3 * 7 % (SELECT count(*) FROM orders) AS k, count(*) AS tries FROM events
  WHERE event_type = 'signup' AND ts BETWEEN timestamp '2024-01-15 16:30:00' AND timestamp '2024-01-15 17:00:00' GROUP BY 1),
now AS (
  SELECT queue.k, state, priority, tries, CASE WHEN tries IS NULL THEN status
    WHEN tries >= 2 THEN 'failed_escalated' ELSE 'approved' END AS status FROM queue LEFT JOIN today USING (k))
SELECT cast(k AS varchar) AS id, state, priority FROM now
WHERE status = 'approved' AND state NOT IN (SELECT state FROM now WHERE tries IS NOT NULL)
  AND timestamp '2024-01-15 17:00:00' - to_hours({OFFSET}) BETWEEN timestamp '2024-01-15 09:00:00' AND timestamp '2024-01-15 16:30:00'""",
    "approved_calls": f"""
WITH {CALLS}, given AS (SELECT event_id AS k, max(ts) AS given_at FROM events WHERE event_type = 'signup' GROUP BY 1)
SELECT cast(queue.k AS varchar) AS id, CASE WHEN given_at IS NOT NULL THEN 'approved' ELSE status END AS status,
  strftime(given_at, '%Y-%m-%d %H:%M:%S') AS approved_at FROM queue LEFT JOIN given USING (k)""",
    "next_windows": f"""
WITH {CALLS} SELECT cast(k AS varchar) AS id, state, strftime(CASE
    WHEN timestamp '2024-01-12 22:00:00' - to_hours({OFFSET}) <= timestamp '2024-01-12 16:30:00'
    THEN timestamp '2024-01-12 22:00:00' ELSE timestamp '2024-01-15 09:00:00' + to_hours({OFFSET}) END,
  '%Y-%m-%d %H:%M:%S') AS next_window FROM queue""",
    "consent_flags": f"""
WITH {CALLS} SELECT state, state IN ('CA', 'CT', 'DE', 'FL', 'IL', 'MD', 'MA', 'MI', 'MT', 'NH', 'PA', 'WA') AS two_party_consent,
  count(*) AS n_calls FROM queue GROUP BY ALL""",
    "answer_extraction": f"WITH {ANSWERS} SELECT call_id, question_no, question_key, answer FROM answers",
    "answer_extraction_text": f"""
WITH {ASKED}, lined AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
placed AS (
  SELECT doc_id, question_key, lines, list_position(list_transform(lines,
    lambda l: 2 * len(list_filter(words, lambda w: contains(lower(l), w))) >= len(words)), true) AS hit
  FROM lined CROSS JOIN asked)
SELECT doc_id, question_key, CASE WHEN hit > 0 THEN nullif(array_to_string(list_filter(list_transform(
  list_slice(lines, hit + 1, hit + 4), lambda l: trim(l)), lambda l: l <> ''), ' '), '') END AS answer
FROM placed""",
    "call_outcomes": """
WITH calls AS (
  SELECT conv_id AS call_id, sum(length(text)) + count(*) - 1 AS n, max(turn) % 2 = 1 AS completed
  FROM conversations GROUP BY conv_id)
SELECT call_id, cast(n AS bigint) AS n_chars, completed, n > 50 AS human_reached, completed AND n > 50 AS call_successful,
  NOT (completed AND n > 50) AS needs_follow_up FROM calls""",
    "requirements_merge": f"""
WITH {ANSWERS}, known AS (SELECT {S}[s_nationkey + 1] AS state, min(s_name) AS answer FROM supplier GROUP BY 1),
latest AS (
  SELECT {S}[call_id % 25 + 1] AS state, question_key, max(call_id) AS call_id FROM answers GROUP BY ALL),
called AS (SELECT state, strftime(timestamp '2024-01-01' + to_minutes(max(call_id)), '%Y-%m-%d') AS last FROM latest GROUP BY state)
SELECT state, 'fee' AS question_key, answer, last AS last_call_date, CASE WHEN last IS NOT NULL THEN 'medium' END AS data_confidence
FROM known LEFT JOIN called USING (state)
UNION ALL
SELECT l.state, l.question_key, a.answer, last, 'medium'
FROM latest l JOIN answers a ON a.call_id = l.call_id AND a.question_key = l.question_key JOIN called ON called.state = l.state
WHERE l.state IN (SELECT state FROM known)""",
    "saved_transcripts": f"""
SELECT {S}[conv_id % 25 + 1] AS state, strftime(date '2024-01-01' + cast(conv_id % 10 AS integer), '%Y-%m-%d') AS date,
  count(*) AS n_lines, cast(sum(length(text)) AS bigint) AS n_chars FROM conversations GROUP BY ALL""",
}

ORACLES["cleaned_store"] = ORACLES["compacted_store"]
