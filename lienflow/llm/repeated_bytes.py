"""Removal of every byte that lies in a 400-byte string which occurs again, by depth-limited radix passes.

Suffixes are ordered only as deep as the threshold, digit by digit from the most significant, and only while their
group has more than one member; groups that are still equal at full depth are the repeated strings.

Sorting every suffix would move hundreds of times the input, so suffixes stand for the anchor they pass through:
of the 64-byte grams of a 400-byte string, the leftmost of least hash.  Equal strings have equal anchors at equal
distance, and every string has exactly one.  The first digit is the anchor's gram.  Further digits are taken for
runs of neighbouring strings at once: their common middle, where it occurs once, clears all of them; their whole
extent, where it occurs again, confirms all of them; what is left is split eightfold, down to single strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from lienflow.llm.common import (
    free_shuffles,
    prefix_sums,
    run_hashes,
    slices,
    small_batches,
    stored,
    text_bytes,
    text_or_empty,
)

#: Bytes of a string that may not occur twice, and of the grams that anchors are chosen from.
LENGTH = 400
GRAM = 64
#: Strings at neighbouring distances from their anchor that are judged together, pass by pass.
RUNS = (64, 8, 1)

_TEXT_KEY = "unhex(md5(encode(text, 'UTF-8')))"


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor position, gram hash, first and last string begin of every anchor of all texts.

    Positions count through ``data``.  The strings from first to last begin all have this anchor.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none
    sums = prefix_sums(data)
    at = np.arange(len(data) - gram + 1)
    hashes = run_hashes(sums, at, at + gram)
    # High bits of the hash, then the position: the least is the leftmost of least hash.
    bits = max(int(len(data)).bit_length(), 1)
    low = np.uint64((1 << bits) - 1)
    ranked = (hashes & ~low) | at.astype(np.uint64)
    width, reach = length - gram + 1, 1
    least = ranked
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
    begins = np.arange(len(least))
    text = np.searchsorted(offsets, begins, "right") - 1
    inside = begins + length <= offsets[text + 1]
    begins = begins[inside]
    anchor = (least[inside] & low).astype(np.int64)
    if not len(begins):
        return none, none, none, none
    new = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(begins) != 1)]))
    last = np.append(new[1:], len(begins)) - 1
    return anchor[new], hashes[anchor[new]].view(np.int64), begins[new], begins[last]


def _find_anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            data, offsets = text_bytes(batch.column(1))
            position, hashed, first, last = anchors(data, offsets, length, gram)
            if len(position):
                text = np.searchsorted(offsets, first, "right") - 1
                base = offsets[text]
                columns = [
                    batch.column(0).take(pa.array(text)),
                    pa.array(hashed, pa.int64()),
                    pa.array((position - base).astype(np.int32)),
                    pa.array((first - base).astype(np.int32)),
                    pa.array((last - base).astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["text_key", "gram", "anchor", "first", "last"])

    return texts.mapInArrow(find, "text_key binary, gram bigint, anchor int, first int, last int")


_CONTEXTS = "text_key binary, copies bigint, gram bigint, anchor int, first int, last int, context binary"
_PIECES = (
    "text_key binary, copies bigint, gram bigint, anchor int, cell int, low int, high int, middle bigint, whole bigint"
)


def _contexts(rows: DataFrame, length: int) -> DataFrame:
    """For each surviving anchor the bytes of all its strings."""
    schema = to_arrow_schema(rows.sparkSession.createDataFrame([], _CONTEXTS).schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found: list[tuple] = []
            for key, text, copies, anchors in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                data = text.encode()
                for one in anchors:
                    context = data[one["first"] : one["last"] + length]
                    found.append((key, copies, one["gram"], one["anchor"], one["first"], one["last"], context))
            if found:
                yield _batch(found, schema)

    return rows.select("text_key", "text", "copies", "anchors").mapInArrow(cut, _CONTEXTS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _pieces(contexts: DataFrame, length: int, size: int) -> DataFrame:
    """The strings of each context in cells of ``size`` distances from string begin to anchor.

    ``low`` to ``high`` are the distances that the context has of the cell; ``whole`` stands for all bytes of
    those strings, ``middle`` for the bytes that every string of the cell has, whichever of them are there.
    """
    from xxhash import xxh3_64_intdigest

    schema = to_arrow_schema(contexts.sparkSession.createDataFrame([], _PIECES).schema)

    def signed(data: bytes) -> int:
        value = xxh3_64_intdigest(data)
        return value - (1 << 64) if value >> 63 else value

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for key, copies, gram, anchor, first, last, context in zip(
                *(batch.column(i).to_pylist() for i in range(7)), strict=True
            ):
                at = anchor - first
                for cell in range((anchor - last) // size, at // size + 1):
                    low, high = max(cell * size, anchor - last), min(cell * size + size - 1, at)
                    whole = signed(context[at - high : at - low + length])
                    middle = signed(context[at - cell * size : at - cell * size - size + 1 + length])
                    found.append((key, copies, gram, anchor, cell, low, high, middle, whole))
            if found:
                yield _batch(found, schema)

    columns = ["text_key", "copies", "gram", "anchor", "first", "last", "context"]
    return contexts.select(*columns).mapInArrow(cut, _PIECES)


def repeated_strings(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """text_key, first and last begin (bytes) of runs of strings of ``length`` bytes that occur more than once.

    A text that stands in several rows occurs as often.  Texts shorter than ``length`` have no strings.
    """
    small_batches(documents.sparkSession)
    # The passes move many times the input, which would all be kept on disk until the driver collects garbage.
    free_shuffles(documents.sparkSession)
    texts = documents.select(text_or_empty("text").alias("text")).filter(F.octet_length("text") >= length)
    keyed = texts.select(F.expr(_TEXT_KEY).alias("text_key"), "text")
    found = stored(_find_anchors(keyed, length, gram), "anchors")

    # First digit: only anchors whose gram occurs again go on.  Counts are combined before the shuffle; they are
    # stored, since the runtime splits a hot key of a join only where both sides come straight from a shuffle.
    grams = stored(found.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram"), "grams")
    by_text = (
        found.join(grams, "gram", "left_semi")
        .groupBy("text_key")
        .agg(F.collect_set(F.struct("anchor", "gram", "first", "last")).alias("anchors"))
    )
    unique = keyed.groupBy("text_key").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    contexts = stored(_contexts(unique.join(by_text, "text_key"), length), "contexts")

    confirmed: list[DataFrame] = []
    opened = contexts
    for size in [r for r in RUNS if r == 1 or 4 * r <= length]:
        pieces = _pieces(opened, length, size)
        group = ["gram", "low", "high", "whole"]
        again = pieces.groupBy(*group).agg(F.sum("copies").alias("n")).filter("n > 1").select(*group, F.lit(True).alias("same"))
        judged = stored(pieces.join(stored(again, "again"), group, "left").fillna(False, ["same"]), "judged")
        confirmed.append(judged.filter("same").select("text_key", "anchor", "low", "high"))
        if size == 1:
            break
        # Runs whose middle occurs once hold no repeated string.  Those still in doubt go on, and with them one of
        # each confirmed group that they may share a string with.
        group = ["gram", "cell", "middle"]
        doubted = (
            judged.groupBy(*group)
            .agg(F.sum("copies").alias("n"), F.bool_or(~F.col("same")).alias("doubt"))
            .filter("n > 1 AND doubt")
            .select(*group)
        )
        rest = judged.join(stored(doubted, "doubted"), group, "left_semi")
        one = rest.filter("same").groupBy("gram", "low", "high", "whole").agg(F.min(F.struct("text_key", "anchor")).alias("p"))
        places = rest.filter("NOT same").select("text_key", "anchor", "low", "high").unionByName(
            one.select("p.text_key", "p.anchor", "low", "high")
        )
        opened = contexts.join(places, ["text_key", "anchor"]).select(
            "text_key",
            "copies",
            "gram",
            "anchor",
            F.expr("anchor - high").alias("first"),
            F.expr("anchor - low").alias("last"),
            F.expr(f"substr(context, anchor - high - first + 1, high - low + {length})").alias("context"),
        )
    runs = confirmed[0]
    for more in confirmed[1:]:
        runs = runs.unionByName(more)
    return runs.selectExpr("text_key", "anchor - high AS first", "anchor - low AS last")


def spans_by_text(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """text_key and the begins of its repeated strings as runs (first, last), for texts that have any."""
    return (
        repeated_strings(documents, length, gram)
        .groupBy("text_key")
        .agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    )


def cover(runs: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal byte spans covered by the strings that begin in the runs."""
    spans: list[tuple[int, int]] = []
    for first, last in sorted((r["first"], r["last"] + length) for r in runs):
        if spans and first <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(last, spans[-1][1]))
        else:
            spans.append((first, last))
    return spans


def _joined(documents: DataFrame, length: int, gram: int) -> DataFrame:
    """row, text and runs of repeated strings of each row; texts shorter than ``length`` have none and join nothing.

    The runs are stored, so that the runtime can split a text of very many copies.
    """
    rows = documents.select(F.struct("*").alias("row"), text_or_empty("text").alias("text"))
    spans = stored(spans_by_text(documents, length, gram), "spans")
    none = F.lit(None).cast(spans.schema["runs"].dataType).alias("runs")
    short = rows.filter(F.octet_length("text") < length).select("row", "text", none)
    long = rows.filter(F.octet_length("text") >= length).withColumn("text_key", F.expr(_TEXT_KEY))
    return long.join(spans, "text_key", "left").select("row", "text", "runs").unionByName(short)


def removal_digests(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, bytes, removed bytes, removed spans and the hash of what stays, of each row; null texts are empty."""
    small_batches(documents.sparkSession)
    rows = _joined(documents.select("doc_id", "text"), length, gram).selectExpr("row.doc_id AS doc_id", "text", "runs")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found: list[tuple] = []
            for key, text, runs in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                data, at = text.encode(), 0
                spans = cover(runs or [], length)
                digest = hashlib.sha256()
                for first, last in spans:
                    digest.update(data[at:first])
                    at = last
                digest.update(data[at:])
                found.append((key, len(data), sum(b - a for a, b in spans), len(spans), digest.hexdigest()))
            yield _batch(found, schema)

    kind = rows.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    schema = to_arrow_schema(rows.sparkSession.createDataFrame([], columns).schema)
    return rows.mapInArrow(remove, columns)


def remove_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The documents without their repeated strings, columns as they are; ``n_chars`` follows ``text``.

    A character cut in two goes whole.  Rows without a repeated string, null texts too, stay as they are.
    """
    small_batches(documents.sparkSession)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            texts: list[str | None] = []
            for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if runs is None:
                    texts.append(None)
                    continue
                data, kept, at = text.encode(), [], 0
                for first, last in cover(runs, length):
                    kept.append(data[at:first])
                    at = last
                texts.append(b"".join([*kept, data[at:]]).decode(errors="ignore"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "changed"])

    rows = _joined(documents, length, gram).select("row", "text", "runs")
    changed = {"text": "coalesce(changed, row.text)", "n_chars": "coalesce(length(changed), row.n_chars)"}
    schema = f"row {rows.schema['row'].dataType.simpleString()}, changed string"
    return rows.mapInArrow(remove, schema).select(
        *[F.expr(changed.get(c, f"row.`{c}`")).alias(c) for c in documents.columns]
    )
