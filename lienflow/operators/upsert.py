"""Upsert of filings on (state, filing_number).

Stored rows come first in the order of a key, incoming rows follow by arrival.  A row is ``new``
without a predecessor, ``skipped`` when its source text equals the predecessor's, else ``updated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lienflow.operators.sequences import HOT_ROWS, with_previous
from lienflow.schema import FILING_FIELDS, KEPT_FIELDS, KEY

OUTCOMES = ["new", "updated", "skipped"]
ORDER = ["is_incoming", "arrival"]


def _outcome() -> Column:
    previous = F.col("previous")
    return (
        F.when(~F.col("is_incoming"), F.lit(None).cast("string"))
        .when(previous.isNull(), "new")
        .when(previous["source_raw"].eqNullSafe(F.col("source_raw")), "skipped")
        .otherwise("updated")
    )


def _sequence(incoming: DataFrame, stored: DataFrame | None, columns: list[str], hot_rows: int) -> DataFrame:
    """Stored and incoming rows with the outcome of each incoming row.

    The stored side holds every key once, so only the incoming side can have hot keys.
    """
    rows = incoming.select(*columns, "arrival", F.lit(True).alias("is_incoming"))
    if stored is not None:
        no_arrival = F.lit(None).cast(incoming.schema["arrival"].dataType).alias("arrival")
        rows = rows.unionByName(stored.select(*columns, no_arrival, F.lit(False).alias("is_incoming")))
    sequence = with_previous(rows, KEY, ORDER, "source_raw", hot_rows=hot_rows, counted=incoming)
    return sequence.withColumn("outcome", _outcome()).drop("previous")


def classify(incoming: DataFrame, stored: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Key, arrival and outcome of every incoming row.

    Stored rows of other keys are left out first.  The runtime sends a small batch's keys to every task; a
    large batch's keys are joined on the partitioning that the window needs anyway.
    """
    columns = [*KEY, "source_raw"]
    if stored is not None:
        stored = stored.join(incoming.select(*KEY), KEY, "left_semi")
    rows = _sequence(incoming, stored, columns, hot_rows)
    return rows.filter("is_incoming").drop("is_incoming", "source_raw")


def outcome_counts(classified: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Number of new, updated and skipped rows, in all or per group."""
    counts = [F.count_if(F.col("outcome") == o).alias(f"n_{o}") for o in OUTCOMES]
    return classified.groupBy(*(by or [])).agg(F.count("*").alias("n_fetched"), *counts)


def merge(
    incoming: DataFrame,
    stored: DataFrame | None,
    as_of: str,
    hot_rows: int = HOT_ROWS,
    count: bool = True,
    always: Column | None = None,
    before: list[str] | None = None,
) -> DataFrame:
    """The table after the upsert, one row per key, with the outcome counts of the key.

    ``as_of`` is a SQL expression for the time of the upsert, such as ``current_timestamp()``.

    The last row that was not skipped gives the values; the first row keeps its ``ingested_at``.  Where
    ``always`` holds, the last incoming row gives the values even if it was skipped.  ``before`` names fields whose
    stored values are added as struct ``before``, null for a new key.
    Grouping on the key after the window on the key needs no further shuffle.
    """
    now = F.expr(as_of)
    incoming = incoming.withColumns(
        {
            "ingested_at": F.coalesce("ingested_at", now) if "ingested_at" in incoming.columns else now,
            "last_updated_at": now,
        }
    )
    rows = _sequence(incoming, stored, FILING_FIELDS, hot_rows)
    effective = ~F.col("outcome").eqNullSafe("skipped")
    if always is not None:
        effective = effective | (always & F.col("is_incoming"))
    values = F.struct(*ORDER, *[f for f in FILING_FIELDS if f not in KEPT_FIELDS])
    merged = rows.groupBy(*KEY).agg(
        F.max(F.when(effective, values)).alias("last"),
        F.min(F.struct(*ORDER, "ingested_at"))["ingested_at"].alias("ingested_at"),
        *[F.count_if(F.col("outcome") == o).alias(f"n_{o}") for o in OUTCOMES],
        *([F.max(F.when(~F.col("is_incoming"), F.struct(*before))).alias("before")] if before else []),
    )
    fields = [F.col(f) if f in KEPT_FIELDS else F.col("last")[f].alias(f) for f in FILING_FIELDS]
    return merged.select(*fields, *([f"n_{o}" for o in OUTCOMES] if count else []), *(["before"] if before else []))
