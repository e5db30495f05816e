"""Counts and statistics over the filing table.

All of them also take counted filings, as the store keeps them: rows that stand for ``n`` filings each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lienflow.functions.dates import is_before


def _known(column: str) -> Column:
    return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit("unknown"))


def _number(filings: DataFrame) -> Column:
    return F.coalesce(F.sum("n"), F.lit(0).cast("long")) if "n" in filings.columns else F.count("*")


def count_by(filings: DataFrame, column: str) -> DataFrame:
    """Filings per value, missing values as ``unknown``, most frequent first."""
    counts = filings.groupBy(_known(column).alias(column)).agg(_number(filings).alias("n_filings"))
    return counts.orderBy(F.desc("n_filings"), column)


def filing_counts(filings: DataFrame, state: str | None = None) -> DataFrame:
    """The number of filings, in all or of one state."""
    kept = filings if state is None else filings.filter(F.col("state") == state)
    return kept.agg(_number(filings).alias("n_filings"))


def latest_by_state(filings: DataFrame) -> DataFrame:
    """Per state: filings, latest filing date and latest ingestion; one pass, combined before the shuffle."""
    return filings.groupBy("state").agg(
        _number(filings).alias("filing_count"),
        F.max("filing_date").alias("latest_filing_date"),
        F.max("ingested_at").alias("last_ingestion"),
    )


def summary(filings: DataFrame) -> DataFrame:
    """Total, number of states, earliest and latest filing date."""
    by_state = filings.groupBy("state").agg(
        _number(filings).alias("n"), F.min("filing_date").alias("low"), F.max("filing_date").alias("high")
    )
    return by_state.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_filings"),
        F.count("*").alias("states_covered"),
        F.min("low").alias("earliest_filing"),
        F.max("high").alias("latest_filing"),
    )


def all_stats(filings: DataFrame) -> DataFrame:
    """Total and counts per state, status and tier from a single scan."""
    dimensions = ["state", "filing_status", "source_tier"]
    weight = ["n"] if "n" in filings.columns else []
    values = filings.select(*[_known(d).alias(d) for d in dimensions], "filing_date", *weight)
    sets = [[], *[[F.col(d)] for d in dimensions]]
    grouped = values.groupingSets(sets, *dimensions).agg(
        F.grouping_id().alias("level"),
        _number(filings).alias("n_filings"),
        F.min("filing_date").alias("earliest_filing"),
        F.max("filing_date").alias("latest_filing"),
    )
    names = {7: "total", 3: "state", 5: "filing_status", 6: "source_tier"}
    dimension = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("level").cast("int")]
    value = F.coalesce(*dimensions, F.lit("all"))
    return grouped.select(
        dimension.alias("dimension"), value.alias("value"), "n_filings", "earliest_filing", "latest_filing"
    )


def top_states(filings: DataFrame, n: int = 10) -> DataFrame:
    return count_by(filings, "state").limit(n)


def incremental(records: DataFrame, filings: DataFrame, lookback_days: int = 0) -> DataFrame:
    """Records filed on or after the latest stored date of their state, less a look-back for late data.

    Records of states without stored filings all pass.  The cut-offs, a row per state, go to every task: dealt out by
    state, all records of a state would go to one.
    """
    cutoffs = filings.groupBy("state").agg(F.date_sub(F.max("filing_date"), lookback_days).alias("cutoff"))
    joined = records.join(F.broadcast(cutoffs), "state", "left")
    return joined.filter(f"NOT {is_before('filing_date', 'cutoff')}").drop("cutoff")
