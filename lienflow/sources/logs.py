"""Logs, dimensions and documents that come as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lienflow.schema import ACTIVITY_SCHEMA, CALL_QUEUE_SCHEMA


def read_activity_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ACTIVITY_SCHEMA).json(path)


def read_call_queue(spark: SparkSession, path: str) -> DataFrame:
    """The calls of a queue document, one row each, in document order."""
    document = spark.read.schema(CALL_QUEUE_SCHEMA).option("multiLine", True).json(path)
    return document.select(F.posexplode("calls").alias("queue_no", "call")).select("queue_no", "call.*")


def read_consent_rules(spark: SparkSession, path: str) -> DataFrame:
    """A document with a map from state to rule, one row per state."""
    return consent_rules(spark.read.text(path, wholetext=True))


def consent_rules(documents: DataFrame) -> DataFrame:
    """The rules of documents in ``value``."""
    schema = "'states map<string, struct<consent_type: string, statute: string>>'"
    rules = documents.selectExpr(f"explode(from_json(value, {schema}).states) AS (state, rule)")
    return rules.select("state", "rule.*")


def read_research(spark: SparkSession, path: str) -> DataFrame:
    """Research documents of differing shape, one variant per file."""
    reader = spark.read.options(multiLine=True, singleVariantColumn="document")
    return reader.json(path).select("document", F.col("_metadata.file_path").alias("path"))


def research_facts(documents: DataFrame, paths: dict[str, str]) -> DataFrame:
    """Named facts from variant documents; a path that a document lacks gives null."""
    facts = [F.try_variant_get("document", path, "string").alias(name) for name, path in paths.items()]
    kept = [c for c in documents.columns if c != "document"]
    return documents.select(*kept, *facts)
