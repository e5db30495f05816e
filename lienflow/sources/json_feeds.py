"""JSON feeds: bulk documents, one object per line, open-data pages and commercial pages.

All of them end up as one column ``record`` with the JSON text of one record,
and every field is read from that text in a single ``from_json`` with the needed keys only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lienflow import fixed_values as fixed
from lienflow.functions.sql import coalesce, name, quote
from lienflow.functions.text import first_clean
from lienflow.sources.records import ARRIVAL, feed_records


def scan_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file.  A single JSON document cannot be split, so land large feeds as lines."""
    return spark.read.text(path, wholetext=True).selectExpr("value", ARRIVAL)


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """One record per line; splits and streams at any size."""
    return spark.read.text(path).selectExpr("value AS record", ARRIVAL)


def _schema(keys: list[str], kind: str) -> str:
    return quote(", ".join(f"{name(key)} {kind}" for key in dict.fromkeys(keys)))


def unwrap(documents: DataFrame, keys: list[str], single_record: bool = False) -> DataFrame:
    """Records of documents in ``value``: a root array, or the first present array among ``keys``.

    With ``single_record`` an object that has none of the keys is a record itself.
    """
    return _unwrap(documents, _first(keys), "array(value)" if single_record else "NULL")


def unwrap_pages(documents: DataFrame, provider: str) -> DataFrame:
    """Records of commercial pages in ``value``; ``provider`` is an expression for who sent the page.

    A page of an unknown provider is read like one of the first.
    """
    cases = " ".join(f"WHEN {quote(who)} THEN {_first(keys)}" for who, keys in fixed.PAGE_KEYS.items())
    return _unwrap(documents, f"CASE {provider} {cases} ELSE {_first(next(iter(fixed.PAGE_KEYS.values())))} END", "NULL")


def _first(keys: list[str]) -> str:
    return coalesce(*[f"wrapped[{quote(key)}]" for key in keys])


def _unwrap(documents: DataFrame, held: str, default: str) -> DataFrame:
    """Explode the array whose text ``held`` finds among the root keys; records keep their own text.

    A document that is no JSON, that is too large for one value, or that has none of the keys, gives one row with
    its text, no record to read from it, and the reason ``unreadable_document``: it ends up among the rejects.
    """
    wrapped = documents.selectExpr(
        "*",
        "from_json(value, 'map<string, string>') AS wrapped",
        "try_parse_json(value) IS NULL AS broken",
    )
    kept = [c for c in documents.columns if c != "value"]
    array = wrapped.selectExpr(*kept, "value", "broken", f"if(ltrim(value) LIKE '[%', value, {held}) AS items")
    found = f"if(broken, NULL, if(items IS NULL, {default}, from_json(items, 'array<string>')))"
    records = array.selectExpr(*kept, "value", f"{found} AS records").selectExpr(
        *kept,
        "posexplode(coalesce(records, array(value))) AS (position, record)",
        "if(records IS NULL, 'unreadable_document', NULL) AS reject_reason",
    )
    exploded = records
    if "arrival" not in kept:
        return exploded.drop("position")
    return exploded.withColumn("arrival", F.col("arrival").withField("position", F.col("position"))).drop("position")


def _parse(records: DataFrame, keys: list[str]) -> DataFrame:
    """The needed keys of each record, read in one go and with their types.

    Exploding an array of one keeps the optimizer from parsing once per use, as it would after
    pushing a filter on a field below a plain projection.
    """
    readable = "if(reject_reason IS NULL, record, NULL)" if "reject_reason" in records.columns else "record"
    return records.selectExpr("*", f"explode(array(from_json({readable}, {_schema(keys, 'variant')}))) AS parsed")


def _text(key: str, path: str = "$") -> str:
    return _text_of(f"parsed.{name(key)}", path)


def _text_of(value: str, path: str = "$") -> str:
    return f"try_variant_get({value}, {quote(path)}, 'string')"


def _filled(key: str) -> str:
    return _filled_of(f"parsed.{name(key)}")


def _filled_of(value: str) -> str:
    """A value's text; the number zero, false and empty containers count as missing, the text "0" does not."""
    is_text = f"schema_of_variant({value}) = 'STRING'"
    return f"if({_text_of(value)} IN ('0', '0.0', 'false', '[]', '{{}}') AND NOT ({is_text}), NULL, {_text_of(value)})"


def map_bulk(records: DataFrame, state: str, keys: dict[str, str] | None = None) -> DataFrame:
    """Records of a bulk feed; zero and false count as missing, as blank text does."""
    keys = keys or fixed.BULK_JSON_KEYS
    rows = _parse(records, list(keys.values()))
    return materialized(feed_records(rows, {f: _filled(key) for f, key in keys.items()}, state, "state_bulk", "record"))


def map_open_data(records: DataFrame, state: str) -> DataFrame:
    """Records of an open-data page; a time after the date is cut off."""
    keys = fixed.OPEN_DATA_KEYS[state]
    rows = _parse(records, sum(keys.values(), []))
    fields = {field: first_clean(*map(_text, names)) for field, names in keys.items()}
    return materialized(feed_records(rows, _cut_times(fields), state, "open_api", "record"))


def _cut_times(fields: dict[str, str]) -> dict[str, str]:
    dates = [f for f in ("filing_date", "lapse_date") if f in fields]
    return fields | {f: f"substring_index({fields[f]}, 'T', 1)" for f in dates}


def map_commercial(records: DataFrame, state: str) -> DataFrame:
    """Records of a commercial page: the first key with text wins, then the nested party objects."""
    nested = sum(fixed.COMMERCIAL_PARTIES.values(), [])
    keys = list(dict.fromkeys(sum(fixed.COMMERCIAL_KEYS.values(), [])))
    rows = _parse(records, [*keys, *nested])

    def inner(party: str, part: str) -> list[str]:
        return [_text(key, f"$.{inside}") for key in fixed.COMMERCIAL_PARTIES[party] for inside in fixed.PARTY_KEYS[part]]

    insides = {f"{party}_{part}": inner(party, part) for party in fixed.COMMERCIAL_PARTIES for part in fixed.PARTY_KEYS}
    paths = list(dict.fromkeys(sum(insides.values(), [])))
    # The texts of all keys by one function over their values, behind an exploded array of one: written out key by
    # key, and repeated in every use, they are beyond what the JVM can compile.
    values = ", ".join(f"parsed.{name(key)}" for key in keys)
    texts = f"transform(array({values}), v -> {_filled_of('v')}) AS flat"
    rows = rows.selectExpr("*", f"explode(array(struct({texts}, array({', '.join(paths)}) AS inner))) AS got")

    def flat(key: str) -> str:
        text = f"get(got.flat, {keys.index(key)})"
        return f"if({text} LIKE '{{%', NULL, {text})" if key in nested else text

    fields = {field: [flat(key) for key in names] for field, names in fixed.COMMERCIAL_KEYS.items()}
    for field, found in insides.items():
        fields[field] += [f"get(got.inner, {paths.index(text)})" for text in found]
    chosen = {field: first_clean(*found) for field, found in fields.items()}
    return materialized(feed_records(rows, _cut_times(chosen), state, "commercial", "record"))


def materialized(records: DataFrame) -> DataFrame:
    """The same rows; what is built on them does not repeat the expressions that made them."""
    return records.selectExpr("explode(array(struct(*))) AS r").select("r.*")


def read_bulk_documents(spark: SparkSession, path: str, state: str) -> DataFrame:
    return map_bulk(unwrap(scan_documents(spark, path), fixed.DOCUMENT_KEYS, single_record=True), state)


def read_bulk_lines(spark: SparkSession, path: str, state: str) -> DataFrame:
    return map_bulk(scan_lines(spark, path), state)


def read_open_data(spark: SparkSession, path: str, state: str) -> DataFrame:
    """Landed open-data pages: each file holds a root array."""
    return map_open_data(unwrap(scan_documents(spark, path), ["data"]), state)


def read_commercial(spark: SparkSession, path: str, state: str, provider: str = "baselayer") -> DataFrame:
    """Landed commercial pages of one provider."""
    return map_commercial(unwrap_pages(scan_documents(spark, path), quote(provider)), state)


def page_slice(records: DataFrame, date_column: str, key_column: str, offset: int, limit: int, since=None) -> DataFrame:
    """One page in date order, as an API would return it."""
    kept = records.filter(F.col(date_column) >= F.lit(since)) if since is not None else records
    return kept.orderBy(date_column, key_column).offset(offset).limit(limit)


def page_after(records: DataFrame, date_column: str, key_column: str, last, limit: int) -> DataFrame:
    """The page after the row ``last = (date, key)``: the filter reaches the scan, however deep the page."""
    day, key = F.lit(last[0]), F.lit(last[1])
    beyond = (F.col(date_column) > day) | ((F.col(date_column) == day) & (F.col(key_column) > key))
    return records.filter((F.col(date_column) >= day) & beyond).orderBy(date_column, key_column).limit(limit)
