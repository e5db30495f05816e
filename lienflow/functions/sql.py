"""Small helpers to write SQL expressions.

The functions of this package take and return the text of a SQL expression, so that a wide
projection is one ``selectExpr`` and its plan is built in one call:
``df.selectExpr("state", f"{normalize_date('filing_date')} AS filing_date")``.
"""

from __future__ import annotations


def quote(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(column: str) -> str:
    """A column or field name, whatever characters it has."""
    return "`" + column.replace("`", "``") + "`"


def listing(texts) -> str:
    """String literals separated by commas."""
    return ", ".join(map(quote, texts))


def lookup(key: str, table: dict[str, str]) -> str:
    """The table's value for a key, null for an unknown key."""
    return f"map({listing(text for pair in table.items() for text in pair)})[{key}]"


def coalesce(*values: str) -> str:
    return f"coalesce({', '.join(values)})"


def replace_all(value: str, *rules: tuple[str, str]) -> str:
    """Regular expressions and replacements, one after the other."""
    for pattern, replacement in rules:
        value = f"regexp_replace({value}, {quote(pattern)}, {quote(replacement)})"
    return value
