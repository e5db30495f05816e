"""What every reader shares: the feed columns, the arrival order and the split into filings and rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lienflow.functions.sql import coalesce, quote
from lienflow.functions.text import clean
from lienflow.schema import FEED_FIELDS

DEFAULT_TYPE = "UCC"

# Source order of a row read from files: file time, file, block in the file, row in the block.
# The running id is only compared between rows of one block, so it does not matter which task a
# block went to.  Must be evaluated in the scan itself, before any shuffle.
PLACE = (
    "_metadata.file_modification_time AS file_time",
    "_metadata.file_path AS file",
    "_metadata.file_block_start AS block",
)
ARRIVAL = f"struct({', '.join(PLACE)}, monotonically_increasing_id() AS row) AS arrival"

HAS_STATE = "coalesce(state RLIKE '^[A-Z]{2}\\\\z', false)"

# What makes a record storable.
HAS_KEY = f"{HAS_STATE} AND coalesce(filing_number NOT IN ('', 'UNKNOWN'), false)"


def feed_records(rows: DataFrame, fields: dict[str, str], state: str, tier: str, raw: str) -> DataFrame:
    """Project source rows to the feed columns: trimmed text, blank as null.

    ``fields`` and ``raw`` are SQL expressions.  Rows without a filing number stay in;
    ``split_keyed`` separates them so they can be counted.
    """
    constant = {"state": quote(state), "source_tier": quote(tier), "source_raw": raw}
    cleaned = {field: clean(f"cast({value} AS string)") for field, value in fields.items()}
    cleaned["filing_type"] = coalesce(cleaned.get("filing_type", "NULL"), quote(DEFAULT_TYPE))
    values = {field: "cast(NULL AS string)" for field in FEED_FIELDS} | cleaned | constant
    kept = [c for c in ("arrival", "reject_reason") if c in rows.columns]
    return rows.selectExpr(*[f"{values[field]} AS {field}" for field in FEED_FIELDS], *kept)


def split_keyed(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records with trimmed fields: those that can be stored, and rejects with the reason why they cannot.

    A reader may have given a reason already, as for a document that cannot be read; such rows have no number.
    """
    reason = f"if({HAS_STATE}, 'missing_filing_number', 'no_state_code')"
    kept, rejects = records.filter(HAS_KEY), records.filter(f"NOT ({HAS_KEY})")
    if "reject_reason" in records.columns:
        return kept.drop("reject_reason"), rejects.withColumn("reject_reason", F.expr(f"coalesce(reject_reason, {reason})"))
    return kept, rejects.withColumn("reject_reason", F.expr(reason))
