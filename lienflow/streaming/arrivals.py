"""Continuous ingestion of landed files through the same upsert as a batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lienflow.functions.filings import normalize_filings
from lienflow.operators.store import COMMIT_SCHEMA, FilingStore
from lienflow.sources.records import PLACE

# How the batch of a micro-batch is called.
BATCH = "^stream-(.+)-epoch-([0-9]+)$"


def landed_lines(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Lines of newly landed files and where they stand; ``max_files`` bounds a micro-batch."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(path)
    return lines.selectExpr("value", *PLACE)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that a checkpoint belongs to; it is written when the stream first starts."""
    told = spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata")
    return told.first()["id"]


def applied_epochs(store: FilingStore) -> DataFrame:
    """Per stream the number of micro-batches that are committed and the last one's epoch."""
    found = store.read("commits", COMMIT_SCHEMA).selectExpr(f"regexp_extract(batch, '{BATCH}', 1) AS stream", f"bigint(nullif(regexp_extract(batch, '{BATCH}', 2), '')) AS epoch")
    streams = found.filter("epoch IS NOT NULL").groupBy("stream")
    return streams.agg(F.count_distinct("epoch").alias("n_epochs"), F.max("epoch").alias("last_epoch"))


def start_upserts(
    lines: DataFrame,
    to_records: Callable[[DataFrame], DataFrame],
    store: FilingStore,
    checkpoint: str,
    as_of: str = "current_timestamp()",
    available_now: bool = True,
) -> StreamingQuery:
    """Upsert every micro-batch under its stream and epoch: one that is run again after a failure is applied once.

    The stream is known by the id that its checkpoint keeps, so another stream on the same store, or one that begins
    anew with another checkpoint, counts epochs of its own and nothing of it is taken as applied.  The row number in
    a block, which a stream cannot number, is added to the micro-batch.
    """
    arrival = "struct(file_time, file, block, monotonically_increasing_id() AS row) AS arrival"

    def apply(batch: DataFrame, epoch: int) -> None:
        records = normalize_filings(to_records(batch.selectExpr("value", arrival)))
        store.upsert(records, as_of, f"stream-{stream_id(batch.sparkSession, checkpoint)}-epoch-{epoch:09d}")

    writer = lines.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
