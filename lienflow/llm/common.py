"""Helpers of the corpus operators: rows in and out of Python tasks, words and hashes of whole batches of texts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lienflow.session import scratch_path

#: Rows and bytes that a Python task takes at once; a single longer text is a slice of its own.
ARROW_ROWS = 2_000
SLICE_BYTES = 1 << 20

#: Bytes from which on a run is known by a hash of its bytes.
LONG_RUN = 128

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_powers: list[np.ndarray] = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keep the batches between the JVM and Python small, and let Python workers find this package.

    On a cluster the package is installed or sent along; the path helps where driver and workers share a disk.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def free_shuffles(spark: SparkSession) -> None:
    """Remove the files of a job's shuffles at its end, not when the driver next collects garbage."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


@contextmanager
def measured_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Joins that run inside send a side to all tasks by the bytes that the runtime measures, not by its files' size.

    The driver holds such a side whole.  Files of repeated values are a small part of their rows, and what an explode
    makes of them is not counted at all.
    """
    planned, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = {key: spark.conf.get(key, None) for key in (planned, measured)}
    spark.conf.set(measured, before[measured] or spark.conf.get(planned))
    spark.conf.set(planned, "-1")
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again: cuts the lineage and outlives lost executors."""
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about ``limit`` bytes of text, in their order; a longer text is a piece of its own."""
    for batch in batches:
        texts = batch.column(column)
        if not len(texts):
            continue
        ends = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
        first = 0
        while first < len(texts):
            last = int(np.searchsorted(ends, ends[first] + limit, "right")) - 1
            last = min(max(last, first + 1), len(texts))
            yield batch.slice(first, last - first)
            first = last


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (no nulls) one after the other, and where each begins and the last ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes, cut where texts meet; per text the index of its first run."""
    if not len(member):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    edges = offsets[offsets < len(member)]
    before = np.empty_like(member)
    before[0] = False
    before[1:] = member[:-1]
    before[edges] = False
    starts = np.flatnonzero(member & ~before)
    after = np.empty_like(member)
    after[-1] = False
    after[:-1] = member[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(member & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = values ^ np.uint64(seed)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_tables(size: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < size:
        size = 1 << max(size, SLICE_BYTES).bit_length()
        tables = []
        for base in (_MULTIPLIER, _INVERSE):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            tables.append(np.cumprod(factors, dtype=np.uint64))
        _powers[:] = tables
    return _powers


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of value times power of the position; ``run_hashes`` takes hashes of runs from them."""
    powers, _ = _power_tables(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers[: len(values)], out=sums[1:])
    return sums


def run_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs from start to end, equal for equal runs wherever they stand.

    Fast, but equal for some different runs of a thousand and more values of regular shape as well: for choosing and
    bucketing, not for telling long runs apart (see ``run_keys``).
    """
    _, inverse = _power_tables(len(sums))
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def run_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit keys of the runs of bytes from start to end, equal for equal runs wherever they stand.

    Long runs have a hash of their bytes: sums of powers modulo a power of two are equal for some of them whatever the
    base.  Below ``LONG_RUN`` bytes too few powers of two divide such a sum for it to vanish.
    """
    from xxhash import xxh3_64_intdigest

    keys = run_hashes(prefix_sums(data), starts, ends)
    long = np.flatnonzero(ends - starts >= LONG_RUN)
    if len(long):
        view = memoryview(np.ascontiguousarray(data))
        bounds = zip(starts[long].tolist(), ends[long].tolist(), strict=True)
        keys[long] = np.array([xxh3_64_intdigest(view[a:b]) for a, b in bounds], np.uint64)
    return keys


def owners(first: np.ndarray) -> np.ndarray:
    """For each run the text it lies in; ``first`` as from ``runs``."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
