"""Record-level normalization of a whole filing table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lienflow.functions.dates import normalize_date
from lienflow.functions.sql import name
from lienflow.functions.text import (
    normalize_filing_type,
    normalize_name,
    normalize_state,
    normalize_status,
    normalize_zip,
)


def _upper_name(value: str) -> str:
    return normalize_name(value, uppercase=True)


NORMALIZERS = {
    "filing_date": normalize_date,
    "lapse_date": normalize_date,
    "filing_type": normalize_filing_type,
    "filing_status": normalize_status,
    "debtor_name": _upper_name,
    "debtor_address": normalize_name,
    "debtor_city": normalize_name,
    "debtor_state": normalize_state,
    "debtor_zip": normalize_zip,
    "secured_party_name": _upper_name,
    "secured_party_address": normalize_name,
    "secured_party_city": normalize_name,
    "secured_party_state": normalize_state,
    "secured_party_zip": normalize_zip,
    "collateral_description": normalize_name,
}


def normalize_filings(filings: DataFrame) -> DataFrame:
    """Normalize every field that is present; one projection, no shuffle."""

    def field(column: str) -> str:
        quoted = name(column)
        return f"{NORMALIZERS[column](quoted)} AS {quoted}" if column in NORMALIZERS else quoted

    return filings.selectExpr(*map(field, filings.columns))
