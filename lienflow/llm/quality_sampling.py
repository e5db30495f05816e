"""Importance resampling: a hashed n-gram model of wanted text against one of all text, sampled by Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lienflow.llm.common import (
    mix,
    owners,
    prefix_sums,
    run_hashes,
    runs,
    slices,
    small_batches,
    stored,
    text_bytes,
    text_or_empty,
)

#: Size of the hashed n-gram tables; the broadcast table has four bytes for each bucket.
BUCKETS = 1 << 18
#: Most labelled documents that the target model is fitted on (those of least hash, where there are more).
LABELLED_ROWS = 200_000
#: Share of held-out wanted documents that the threshold keeps.
KEEP_WANTED = 0.998
#: Log weights are divided by it before Gumbel noise of scale 1 is added.
TEMPERATURE = 0.02
#: Log ratios are drawn towards 0 by so many standard errors of their counts.
SHRINK = 2.0

_SLICES = 64


def _table(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


_WHITE = _table((9, 13), (32, 32))
_KINDS = [
    _table((65, 90)),
    _table((97, 122)),
    _table((33, 47), (58, 64), (91, 96), (123, 126)),
    _table((48, 57)),
]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def ngrams(data: np.ndarray, offsets: np.ndarray, buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of each n-gram: lower-cased words, pairs of word shapes, five bytes with a word's begin.

    A word's shape is how many capitals, small letters, signs and digits of ASCII it has (three at most), how
    long it is, and whether it repeats the word before.
    """
    member = ~_WHITE[data]
    starts, ends, first = runs(member, offsets)
    if not len(starts):
        return []
    owner = owners(first)
    low = _LOWER[data]
    hashes = run_hashes(prefix_sums(low), starts, ends)
    found = [(owner, mix(hashes, 1))]
    shape = np.minimum((ends - starts) // 4, 5)
    for kind in _KINDS:
        counts = np.zeros(len(data) + 1, np.int64)
        np.cumsum(kind[data], out=counts[1:])
        shape = shape * 4 + np.minimum(counts[ends] - counts[starts], 3)
    shape *= 2
    shape[1:] += hashes[1:] == hashes[:-1]
    together = np.flatnonzero(owner[1:] == owner[:-1])
    found.append((owner[together], mix((shape[together] * 100_003 + shape[together + 1]).astype(np.uint64), 2)))
    if len(data) > 4:
        size = len(data) - 4
        wide = np.where(member, low, 32).astype(np.uint64)
        gram = wide[:size].copy()
        inside = member[1 : size + 1].copy()
        for k in range(1, 5):
            gram |= wide[k : size + k] << np.uint64(8 * k)
            inside &= member[k : size + k]
        at = np.flatnonzero(inside)
        owner = np.searchsorted(offsets, at, "right") - 1
        whole = at + 5 <= offsets[owner + 1]
        found.append((owner[whole], mix(gram[at[whole]], 3)))
    return [(o, (h & np.uint64(buckets - 1)).astype(np.int64)) for o, h in found]


@dataclass
class Ratio:
    """Log of target to raw probability of each bucket, 0 where it is above 0."""

    log_ratio: np.ndarray
    threshold: float = float("-inf")

    def weights(self, texts: pa.Array) -> np.ndarray:
        data, offsets = text_bytes(texts)
        total, number = np.zeros(len(texts)), np.zeros(len(texts))
        for owner, bucket in ngrams(data, offsets, len(self.log_ratio)):
            total += np.bincount(owner, self.log_ratio[bucket], minlength=len(texts))
            number += np.bincount(owner, minlength=len(texts))
        return total / np.sqrt(np.maximum(number, 1))


def labelled(labels: DataFrame, limit: int = LABELLED_ROWS) -> DataFrame:
    """One row per labelled id: wanted (quality 1 and not toxic) and whether it is held out; ``limit`` at most."""
    return (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.expr("min(quality) = 1 AND max(coalesce(toxic, 0)) = 0").alias("wanted"))
        .select("doc_id", "wanted", F.expr("pmod(xxhash64(doc_id, 'fold'), 5) = 0").alias("held_out"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )


def _flagged(documents: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    flags = F.broadcast(labelled(labels, limit))
    return documents.select("doc_id", text_or_empty("text").alias("text")).join(flags, "doc_id", "left")


def fit(documents: DataFrame, labels: DataFrame, buckets: int = BUCKETS, limit: int = LABELLED_ROWS) -> Ratio:
    """Count n-grams of all documents and of the wanted ones that are not held out, and compare them.

    The target counts are set against what the raw counts would give at the target's share of all n-grams.
    Without wanted documents all ratios are 1.
    """
    width = buckets // _SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in slices(batches, 0):
            data, offsets = text_bytes(batch.column(0))
            fit_on = batch.column(1).to_numpy(zero_copy_only=False)
            for owner, bucket in ngrams(data, offsets, buckets):
                raw += np.bincount(bucket, minlength=buckets)
                target += np.bincount(bucket[fit_on[owner]], minlength=buckets)
        if raw.any():
            parts = [pa.array(list(x.reshape(_SLICES, width)), pa.list_(pa.int64())) for x in (raw, target)]
            yield pa.RecordBatch.from_arrays([pa.array(range(_SLICES), pa.int32()), *parts], ["part", "raw", "target"])


    counted = (
        _flagged(documents, labels, limit)
        .select("text", F.expr("coalesce(wanted AND NOT held_out, false)").alias("fit_on"))
        .mapInArrow(count, "part int, raw array<bigint>, target array<bigint>")
    )
    sums = counted.groupBy("part").applyInArrow(_add_up, "part int, raw array<bigint>, target array<bigint>").collect()
    raw, target = np.zeros((_SLICES, width)), np.zeros((_SLICES, width))
    for row in sums:
        raw[row["part"]], target[row["part"]] = row["raw"], row["target"]
    raw, target = raw.ravel(), target.ravel()
    if not target.any():
        return Ratio(np.zeros(buckets, np.float32))
    expected = raw * (target.sum() / raw.sum())
    ratio = np.log((target + 1) / (expected + 1))
    error = np.sqrt(1 / (target + 1) + 1 / (expected + 1))
    return Ratio(np.minimum(0, ratio + SHRINK * error).astype(np.float32))


def _add_up(rows: pa.Table) -> pa.Table:
    """The sum of the tasks' counts for one part of the buckets."""
    sums = []
    for name in ("raw", "target"):
        column = rows[name].combine_chunks()
        sums.append(column.flatten().to_numpy().reshape(len(column), -1).sum(axis=0))
    return pa.table(
        {
            "part": pa.array([rows["part"][0].as_py()], pa.int32()),
            "raw": pa.array([sums[0]], pa.list_(pa.int64())),
            "target": pa.array([sums[1]], pa.list_(pa.int64())),
        }
    )


_GUMBEL = "-ln(-ln((pmod(xxhash64({id}, 'gumbel'), 9007199254740992L) + 0.5D) / 9007199254740992D))"


def _key(weight: str, id_column: str) -> str:
    return f"{weight} / {TEMPERATURE}D + ({_GUMBEL.format(id=id_column)})"


def kth_largest(rows: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of a column of doubles; histograms narrow the range until few rows are left."""
    few = 50_000
    rows = rows.select(column).filter(F.col(column).isNotNull())
    while True:
        low, high, number = rows.agg(F.min(column), F.max(column), F.count("*")).first()
        if k <= 0 or not number:
            return float("inf")
        if k >= number or low == high:
            return low
        if number <= few:
            return rows.orderBy(F.col(column).desc()).limit(k).agg(F.min(column)).first()[0]
        bin_of = F.floor((F.col(column) - F.lit(low)) / F.lit((high - low) / 4096))
        for found, count in sorted(rows.groupBy(bin_of.alias("bin")).count().collect(), reverse=True):
            if count >= k:
                rows = rows.filter(bin_of == F.lit(found))
                break
            k -= count


def score(documents: DataFrame, ratio: Ratio) -> DataFrame:
    """doc_id, weight, sampling key of each row."""
    spread = documents.sparkSession.sparkContext.broadcast(ratio)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            weights = pa.array(spread.value.weights(batch.column(1)), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), weights], ["doc_id", "weight"])

    rows = documents.select("doc_id", text_or_empty("text").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(weigh, f"doc_id {kind}, weight double").withColumn("key", F.expr(_key("weight", "doc_id")))


def resample(documents: DataFrame, labels: DataFrame, keep_wanted: float = KEEP_WANTED) -> tuple[Ratio, DataFrame]:
    """The fitted ratio with its sampling threshold, and doc_id, weight, key and selected of every row.

    A document's weight is the sum of the truncated log ratios of its n-grams over the root of their number.
    k is the number of documents whose weight reaches the value that ``keep_wanted`` of the held-out wanted
    documents reach; the k largest keys (weight over temperature plus Gumbel noise drawn from the id) are
    selected.  Null and empty texts weigh 0.  Rows of equal key, such as repeated rows, are selected together.
    Without labels every document is selected.
    """
    small_batches(documents.sparkSession)
    ratio = fit(documents, labels)
    scored = stored(score(documents, ratio), "weights")
    held_out = F.broadcast(labelled(labels).filter("wanted AND held_out").select("doc_id"))
    level = scored.join(held_out, "doc_id").agg(F.expr(f"percentile(weight, {1 - keep_wanted})")).first()[0]
    if level is not None:
        k = scored.filter(F.col("weight") >= F.lit(level)).count()
        ratio.threshold = kth_largest(scored, "key", k)
    return ratio, scored.withColumn("selected", F.col("key") >= F.lit(ratio.threshold))


def keep_selected(documents: DataFrame, ratio: Ratio) -> DataFrame:
    """The selected rows, all columns as they are: weighed anew, so that no text is shuffled."""
    spread = documents.sparkSession.sparkContext.broadcast(ratio)
    wide = documents.select(F.struct("*").alias("row"), text_or_empty("text").alias("text"))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            weights = pa.array(spread.value.weights(batch.column(1)), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), weights], ["row", "weight"])

    schema = f"row {wide.schema['row'].dataType.simpleString()}, weight double"
    chosen = wide.mapInArrow(weigh, schema).filter(F.expr(_key("weight", "row.doc_id")) >= F.lit(ratio.threshold))
    return chosen.select("row.*")
