"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# The 25 filing fields, in table order.
FILING_FIELDS = (
    "filing_number state filing_type filing_date lapse_date filing_status "
    "debtor_name debtor_address debtor_city debtor_state debtor_zip debtor_organization debtor_type "
    "secured_party_name secured_party_address secured_party_city secured_party_state secured_party_zip "
    "collateral_description original_filing_number amendment_type "
    "source_tier source_raw ingested_at last_updated_at"
).split()

KEY = ["state", "filing_number"]
DATE_FIELDS = ["filing_date", "lapse_date"]
TIME_FIELDS = ["ingested_at", "last_updated_at"]

# What an upsert never overwrites on a filing that is already stored.
KEPT_FIELDS = [*KEY, "ingested_at"]


def _type_of(field: str) -> T.DataType:
    if field in DATE_FIELDS:
        return T.DateType()
    return T.TimestampType() if field in TIME_FIELDS else T.StringType()


# Stored filings: dates parsed, times as timestamps.
FILING_SCHEMA = T.StructType([T.StructField(f, _type_of(f)) for f in FILING_FIELDS])

# A record as a feed delivers it: every mapped field is still text.
FEED_FIELDS = [f for f in FILING_FIELDS if f not in TIME_FIELDS]

RUN_SCHEMA = (
    "run_id string, state string, source_tier string, started_at timestamp, completed_at timestamp, "
    "records_fetched long, records_new long, records_updated long, records_skipped long, "
    "status string, error_message string, recorded_at timestamp"
)

MANIFEST_SCHEMA = "state string, range_start date, range_end date, status string, finished_at timestamp, n_records long"

PARTY_SCHEMA = (
    "filing_number string, party_no int, name string, address string, city string, state string, zip string, "
    "filing_state string, role string"
)

ACTIVITY_SCHEMA = (
    "timestamp timestamp, state string, phase string, action_type string, description string, "
    "url string, details string, outcome string, next_steps string, confidence string"
)

CALL_QUEUE_SCHEMA = (
    "description string, last_updated timestamp, calls array<struct<"
    "id:string, state:string, state_name:string, phone_number:string, agency_name:string, "
    "questions:array<string>, priority:string, script_reference:string, status:string, "
    "retry_count:int, max_retries:int, created_at:timestamp, approved_at:timestamp, "
    "last_attempt_at:timestamp, completed_at:timestamp, outcome:string, notes:string>>"
)
