"""Run records and their history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# What the first record of a run fixes; everything else follows the last one.
FIXED_AT_START = ["state", "source_tier", "started_at"]
UPDATED = [
    "completed_at",
    "records_fetched",
    "records_new",
    "records_updated",
    "records_skipped",
    "status",
    "error_message",
]


def run_id(state: Column, started_at: Column, batch: Column) -> Column:
    """State, UTC start time and a mark of eight digits that is the same when the batch is run again."""
    mark = F.left(F.sha2(F.concat_ws("|", state, batch), 256), F.lit(8))
    return F.concat_ws("_", state, F.date_format(started_at, "yyyyMMdd_HHmmss"), mark)


def latest_runs(records: DataFrame, order: str = "recorded_at") -> DataFrame:
    """One row per run from appended run records; a maximum per run, so no run is collected in a window."""
    first = F.min(F.struct(order, *FIXED_AT_START))
    last = F.max(F.struct(order, *UPDATED))
    runs = records.groupBy("run_id").agg(first.alias("first"), last.alias("last"))
    return runs.select("run_id", *[F.col(f"first.{c}") for c in FIXED_AT_START], *[F.col(f"last.{c}") for c in UPDATED])


def run_history(runs: DataFrame, state: str | None = None, limit: int = 20) -> DataFrame:
    """The most recent runs."""
    kept = runs if state is None else runs.filter(F.col("state") == state)
    return kept.orderBy(F.desc("started_at"), "run_id").limit(limit)


def run_totals(runs: DataFrame) -> DataFrame:
    """Succeeded and failed runs, and what the succeeded ones brought in."""
    ok = F.col("status") == "completed"
    return runs.agg(
        F.count_if(ok).alias("n_succeeded"),
        F.count_if(F.col("status").isin("failed", "partial")).alias("n_failed"),
        F.coalesce(F.sum(F.when(ok, F.col("records_fetched"))), F.lit(0)).alias("total_fetched"),
        F.coalesce(F.sum(F.when(ok, F.col("records_new"))), F.lit(0)).alias("total_new"),
    )
