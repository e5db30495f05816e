"""Agreement between sources, freshness, collateral coverage, full deliveries and backfill."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lienflow import fixed_values as fixed
from lienflow.schema import KEY


def one_per_key(records: DataFrame, fields: list[str], order: str = "arrival") -> DataFrame:
    """The latest record of each key, as a maximum that is combined before the shuffle."""
    latest = F.max(F.struct(order, *fields))
    return records.groupBy(*KEY).agg(latest.alias("latest")).select(*KEY, *[F.col(f"latest.{f}") for f in fields])


def reconcile(left: DataFrame, right: DataFrame, fields: list[str], order: str = "arrival") -> DataFrame:
    """Compare two sources key by key.

    Both sides are reduced to one row per key first, so the full join never multiplies a hot key.
    """
    a = one_per_key(left, fields, order).withColumn("in_left", F.lit(True)).alias("a")
    b = one_per_key(right, fields, order).withColumn("in_right", F.lit(True)).alias("b")
    joined = a.join(b, KEY, "full_outer")
    differs = [F.when(~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")), F.lit(f)) for f in fields]
    differing = F.concat_ws(",", *differs)
    verdict = (
        F.when(F.col("in_right").isNull(), "only_left")
        .when(F.col("in_left").isNull(), "only_right")
        .when(differing == "", "agree")
        .otherwise("differ")
    )
    both = F.col("in_left") & F.col("in_right")
    return joined.select(*KEY, verdict.alias("verdict"), F.when(both, differing).otherwise("").alias("fields"))


def reconcile_counts(compared: DataFrame) -> DataFrame:
    return compared.groupBy("state", "verdict", "fields").agg(F.count("*").alias("n_filings"))


def latency_report(filings: DataFrame, target_days: int = fixed.LATENCY_TARGET_DAYS) -> DataFrame:
    """Days from filing to ingestion per state, and how many filings miss the target.

    Counting per number of days first keeps a large state small; the exact percentiles come from the counts.  Counted
    filings, as the store keeps them, give the same report without reading a filing.
    """
    days = F.datediff("ingested_at", "filing_date").alias("days")
    number = F.sum("n") if "n" in filings.columns else F.count("*")
    counts = filings.filter("filing_date is not null").groupBy("state", days).agg(number.alias("n"))
    late = F.col("days") > target_days
    return counts.groupBy("state").agg(
        F.sum("n").alias("n_filings"),
        F.max("days").alias("max_days"),
        F.round(F.sum(F.col("days") * F.col("n")) / F.sum("n"), 4).alias("mean_days"),
        F.expr("percentile(days, 0.5, n)").alias("median_days"),
        F.coalesce(F.sum(F.when(late, F.col("n"))), F.lit(0)).alias("n_late"),
    )


def with_collateral_reason(filings: DataFrame, sources: DataFrame) -> DataFrame:
    """Filings with ``collateral_reason``: why the collateral text is missing, null when it is there.

    A source whose feed holds the text owes it, so its filings are pending.
    """
    joined = filings.join(F.broadcast(sources.select("state", "collateral_access")), "state", "left")
    access = F.coalesce("collateral_access", F.lit("in_feed"))
    reason = F.when(access == "in_feed", "pending_collateral").otherwise(access)
    missing = F.col("collateral_description").isNull()
    return joined.withColumn("collateral_reason", F.when(missing, reason)).drop("collateral_access")


def collateral_coverage(filings: DataFrame, sources: DataFrame) -> DataFrame:
    """Per state: filings, share with collateral text, and how many lack it for which reason."""
    rows = with_collateral_reason(filings, sources)
    counts = [F.count_if(F.col("collateral_reason") == r).alias(f"n_{r}") for r in fixed.COLLATERAL_REASONS]
    share = F.round(F.col("n_with_collateral") / F.col("n_filings"), 4)
    return (
        rows.groupBy("state")
        .agg(F.count("*").alias("n_filings"), F.count("collateral_description").alias("n_with_collateral"), *counts)
        .withColumn("coverage", share)
    )


def pending_collateral(filings: DataFrame, sources: DataFrame) -> DataFrame:
    """Audit rows for filings without collateral text."""
    rows = with_collateral_reason(filings, sources)
    return rows.filter("collateral_reason is not null").select(*KEY, "collateral_reason")


def replacement_diff(stored: DataFrame, delivered: DataFrame) -> DataFrame:
    """What a full delivery changes, for the states it covers: added, changed, unchanged, removed.

    Both sides hold a key once.
    """
    covered = stored.join(delivered.select("state").distinct(), "state", "left_semi")
    old = covered.select(*KEY, F.struct("source_raw").alias("old"))
    new = delivered.select(*KEY, F.struct("source_raw").alias("new"))
    change = (
        F.when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed")
        .when(F.col("old").eqNullSafe(F.col("new")), "unchanged")
        .otherwise("changed")
    )
    return old.join(new, KEY, "full_outer").select(*KEY, change.alias("change"))


def removed_filings(stored: DataFrame, delivered: DataFrame) -> DataFrame:
    """Stored filings of the delivered states that the delivery no longer holds."""
    covered = stored.join(delivered.select("state").distinct(), "state", "left_semi")
    return covered.join(delivered.select(*KEY), KEY, "left_anti")


def backfill_ranges(states: DataFrame, first: str, last: str) -> DataFrame:
    """One row per state and calendar month between two dates."""
    months = F.sequence(F.trunc(F.lit(first).cast("date"), "month"), F.lit(last).cast("date"), F.expr("interval 1 month"))
    return states.select("state", F.explode(months).alias("range_start")).withColumn(
        "range_end", F.last_day("range_start")
    )


def pending_ranges(ranges: DataFrame, manifest: DataFrame) -> DataFrame:
    """Ranges that no earlier backfill has finished; this is what makes it resumable."""
    done = manifest.filter("status = 'completed'").select("state", "range_start").distinct()
    return ranges.join(done, ["state", "range_start"], "left_anti")
