"""Failure alerts over five-minute windows, for batch and stream alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from lienflow import fixed_values as fixed

LATENESS = "10 minutes"


def failure_alerts(log: DataFrame, threshold: int = 1, lateness: str = LATENESS) -> DataFrame:
    """Windows with at least ``threshold`` failure messages (``ts`` timestamp, ``message`` text).

    On a stream the watermark bounds the state to the open windows; on a batch it has no effect.
    A window without failures gives no row, so silence is no alarm.
    """
    failures = log.filter(F.col("message").rlike(fixed.FAILURE_PATTERN)).withWatermark("ts", lateness)
    counts = failures.groupBy(F.window("ts", fixed.ALARM_PERIOD)).agg(F.count("*").alias("n_failures"))
    fired = counts.filter(F.col("n_failures") >= threshold)
    return fired.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n_failures")


def start_alerts(log: DataFrame, out: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Write alerts as they change; the latest row of a window is the valid one (see ``current_alerts``)."""

    def append(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(out)

    writer = failure_alerts(log).writeStream.outputMode("update").foreachBatch(append)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def current_alerts(written: DataFrame) -> DataFrame:
    """One row per window; repeated epochs after a restart do no harm."""
    latest = F.max(F.struct("epoch", "n_failures"))["n_failures"]
    return written.groupBy("window_start", "window_end").agg(latest.alias("n_failures"))
