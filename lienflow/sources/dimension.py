"""The source dimension: one row per jurisdiction."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lienflow import fixed_values as fixed

SOURCE_COLUMNS = (
    "state tier poll_frequency data_format expected_latency_days annual_cost_usd delivery_model "
    "state_name time_zone poll_hours enabled collateral_access two_party_consent"
).split()


def no_collateral_in_feed() -> list[str]:
    """Jurisdictions whose own layout has no collateral text, by their field maps.

    XML, JSON and commercial feeds have a place for it; delimited feeds without a map may have a fitting header.
    """
    states = [s for s, fields in fixed.DELIMITED_HEADERS.items() if "collateral_description" not in fields]
    states += [s for s, fields in fixed.OPEN_DATA_KEYS.items() if "collateral_description" not in fields]
    if all(field != "collateral_description" for field, _, _ in fixed.FIXED_WIDTH_LAYOUT):
        states += [row[0] for row in fixed.DIRECT_SOURCES if row[3] == "fixed_width"]
    return states


def source_dimension(
    spark: SparkSession, disabled: tuple[str, ...] = (), collateral_access: dict[str, str] | None = None
) -> DataFrame:
    """All 51 jurisdictions; a fixed-size table that is safe to broadcast.

    ``collateral_access`` overrides what is known about the collateral text of a state's feed:
    ``in_feed``, ``not_in_feed``, ``image_only`` or ``paid_retrieval_required``.
    """
    access = dict.fromkeys(no_collateral_in_feed(), "not_in_feed") | (collateral_access or {})
    direct = {row[0]: row[1:] for row in fixed.DIRECT_SOURCES}
    rows = []
    for state, name, zone in fixed.JURISDICTIONS:
        source = direct.get(state, fixed.COMMERCIAL_SOURCE)
        rows.append(
            (
                state,
                *source,
                name,
                zone,
                fixed.FREQUENCY_HOURS[source[1]],
                state not in disabled,
                access.get(state, "in_feed"),
                state in fixed.TWO_PARTY_CONSENT,
            )
        )
    # An Arrow table becomes a local relation: no task is needed to read it.
    return spark.createDataFrame(pa.table(dict(zip(SOURCE_COLUMNS, map(list, zip(*rows))))))


def select_sources(
    sources: DataFrame, tier: str | None = None, states: list[str] | None = None, enabled_only: bool = True
) -> DataFrame:
    """Sources of a tier or a list of states."""
    if tier is not None:
        if tier not in fixed.TIERS:
            raise ValueError(f"unknown tier: {tier}")
        sources = sources.filter(F.col("tier") == tier)
    if states is not None:
        sources = sources.filter(F.col("state").isin([s.upper() for s in states]))
    return sources.filter("enabled") if enabled_only else sources


def direct_states(sources: DataFrame) -> DataFrame:
    """States with an open-data or bulk feed of their own."""
    open_data = select_sources(sources, "open_api", enabled_only=False).select("state")
    bulk = select_sources(sources, "state_bulk", enabled_only=False).select("state")
    return open_data.union(bulk).distinct()


def commercial_states(sources: DataFrame) -> DataFrame:
    """Every state without a direct feed."""
    return sources.select("state").exceptAll(direct_states(sources))
