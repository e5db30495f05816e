"""Token ids in binary shards with a minimal perfect hash index from document keys to places.

A shard is a run of documents in the order of their ids.  Its file rows are blocks: whole documents one after the
other as little-endian ids, with the ids, begins and lengths of the documents beside them.  The index has one row
for each bucket of keys: pilots that send every key to a slot of its own, and by slot a fingerprint and the place.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from lienflow.llm.common import (
    mix,
    run_keys,
    runs,
    slices,
    small_batches,
    text_bytes,
    text_or_empty,
)
from lienflow.session import scratch_path

#: Id that ends each document.
END_ID = 2
#: Ids of a block; a document is never cut, so a longer one is a block of its own.
BLOCK_IDS = 1 << 18
#: Keys of an index bucket on average, and of a group that shares a pilot.
BUCKET_KEYS = 512
GROUP_KEYS = 4
#: Words that a Python worker keeps between batches; begun anew beyond it.
TABLE_WORDS = 1_000_000

_BLOCKS = (
    "shard int, block int, begin bigint, n_ids bigint, payload binary, "
    "keys array<bigint>, offsets array<int>, lengths array<int>"
)
_INDEX = (
    "bucket bigint, size int, seed int, pilots binary, fingerprints binary, "
    "shards array<int>, blocks array<int>, offsets array<int>, lengths array<int>"
)
_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


class WordTable:
    """Ids of texts by the tokenizers library, each distinct word encoded when it is first met.

    The tokenizer drops white space and cuts words into letters, digits and signs before it merges, so words are
    encoded apart.  A word of Latin letters with signs behind it is cut here; its letters, lower-cased as the
    tokenizer does, stand for many words.  All else goes to the library as it is.  Words are known by a 64-bit
    hash, in a sorted table.
    """

    def __init__(self, tokenizer: str, limit: int = TABLE_WORDS):
        from tokenizers import Tokenizer

        # A task has a core; threads of the library would take others' and memory for each.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.limit = limit
        self.size = max(self.tokenizer.get_vocab().values()) + 1
        # Whatever was merged, each cut ends with one of these and holds no other.
        self.last = np.zeros(self.size, bool)
        for piece, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.last[number] = piece.endswith("</w>")
        self._clear()

    def _clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.begins = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.flat = np.zeros(1 << 20, np.uint32)
        self.used = 0
        self.cuts: dict[str, bytes] = {}

    @staticmethod
    def _cut(text: str) -> tuple[str, str] | None:
        letters = text.rstrip(_PUNCTUATION)
        if letters.isalpha() and (letters.isascii() or max(letters) < "\u0100"):
            return letters.lower(), text[len(letters) :]
        return None

    def _ids(self, words: list[str]) -> list[bytes]:
        cuts = [self._cut(word) for word in words]
        known = self.cuts
        new = list({part for cut in cuts if cut for part in cut if part and part not in known})
        lines = [" ".join(new[i : i + 256]) for i in range(0, len(new), 256)]
        for i, encoded in enumerate(self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)):
            ids = np.array(encoded.ids, np.uint32)
            whole = ids.tobytes()
            ends = ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()
            for part, a, b in zip(new[256 * i : 256 * i + 256], [0, *ends[:-1]], ends, strict=True):
                known[part] = whole[a:b]
        others = [word for word, cut in zip(words, cuts, strict=True) if cut is None]
        plain = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
        other = {w: np.array(e.ids, np.uint32).tobytes() for w, e in zip(others, plain, strict=True)}
        return [
            (known[cut[0]] + known[cut[1]] if cut[1] else known[cut[0]]) if cut else other[word]
            for word, cut in zip(words, cuts, strict=True)
        ]

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Add words, their hashes sorted, to the table."""
        ids = self._ids(words)
        flat = np.frombuffer(b"".join(ids), np.uint32)
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        lengths = np.array([len(i) // 4 for i in ids], np.int64)
        begins = self.used + np.cumsum(lengths) - lengths
        self.flat[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.begins = np.insert(self.begins, at, begins)
        self.lengths = np.insert(self.lengths, at, lengths)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin and the last end."""
        data, offsets = text_bytes(texts)
        starts, ends, first = runs(~_WHITE[data], offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        hashes, example, number = np.unique(run_keys(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) > self.limit:
            self._clear()
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        missing = example[~known]
        if len(missing):
            whole = data.tobytes()
            bounds = zip(starts[missing].tolist(), ends[missing].tolist(), strict=True)
            self._learn(hashes[~known], [whole[a:b].decode() for a, b in bounds])
            at = np.searchsorted(self.hashes, hashes)
        lengths = self.lengths[at][number]
        stops = np.cumsum(lengths)
        source = np.repeat(self.begins[at][number] - (stops - lengths), lengths) + np.arange(stops[-1])
        return self.flat[source], np.concatenate([[0], stops])[first]


_tables: dict[str, WordTable] = {}


def word_table(tokenizer: str) -> WordTable:
    """The worker's table for a tokenizer."""
    if tokenizer not in _tables:
        _tables[tokenizer] = WordTable(tokenizer)
    return _tables[tokenizer]


@dataclass
class TokenStore:
    """Paths of the block files and of the index."""

    blocks: str
    index: str
    buckets: int

    def read_blocks(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(_BLOCKS).parquet(self.blocks)

    def read_index(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(_INDEX).parquet(self.index)


def write_store(documents: DataFrame, tokenizer: str, end_id: int = END_ID) -> TokenStore:
    """Encode whole texts, end each with ``end_id``, and write blocks in the order of the ids, and the index.

    Null texts are empty: they have the end id alone.  Rows without an id come first and are in no index.  Rows
    that repeat an id are all kept, side by side (ordered by a hash of the text); the index leads to the first.
    """
    spark = documents.sparkSession
    small_batches(spark)
    vocabulary = WordTable(tokenizer).size
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    schema = to_arrow_schema(spark.createDataFrame([], _BLOCKS).schema)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, block, begin = TaskContext.get().partitionId(), 0, 0
        table = word_table(tokenizer)
        keys: list[int | None] = []
        lengths: list[int] = []
        payload: list[bytes] = []
        size = 0

        def row() -> pa.RecordBatch:
            offsets = (np.cumsum(lengths) - lengths).astype(np.int32)
            values = [shard, block, begin, size, b"".join(payload), keys, offsets, lengths]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema
            )

        for batch in slices(batches, 1):
            ids, bounds = table.encode(batch.column(1))
            for key, a, b in zip(batch.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if size and size + b - a + 1 > BLOCK_IDS:
                    yield row()
                    block, begin, size = block + 1, begin + size, 0
                    keys, lengths, payload = [], [], []
                keys.append(key)
                lengths.append(b - a + 1)
                payload.append(np.append(ids[a:b], np.uint32(end_id)).astype(f"<u{width}").tobytes())
                size += b - a + 1
        if size:
            yield row()

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty("text").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    store = TokenStore(scratch_path(spark, "token-blocks"), scratch_path(spark, "token-index"), 1)
    # The payload does not shrink, so compression would be work for nothing.
    rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(encode, _BLOCKS).write.option(
        "compression", "uncompressed"
    ).parquet(store.blocks)
    _write_index(spark, store)
    return store


def _hash_table(keys: np.ndarray, size: int) -> tuple[int, np.ndarray]:
    """Seed and pilots that send ``size`` different keys to slots 0 to size - 1.

    Groups of keys, largest first, take the first pilot that leads all of theirs to free slots of their own.
    """
    groups = -(-size // GROUP_KEYS)
    for seed in range(1, 1000):
        hashed = mix(keys, seed)
        group = (hashed >> np.uint64(32)) % np.uint64(groups)
        order = np.argsort(group, kind="stable")
        bounds = np.searchsorted(group[order], np.arange(groups + 1))
        pilots = np.zeros(groups, np.uint32)
        free = np.ones(size, bool)
        for g in np.argsort(-np.diff(bounds), kind="stable"):
            members = hashed[order[bounds[g] : bounds[g + 1]]]
            if not len(members):
                break
            first, number = 0, 16
            while first < 1 << 20:
                tried = np.arange(first, first + number, dtype=np.uint64)
                slots = np.sort(mix(members[None, :] ^ mix(tried, 7)[:, None]) % np.uint64(size), axis=1)
                fits = free[slots].all(axis=1) & (np.diff(slots, axis=1) != 0).all(axis=1)
                if fits.any():
                    k = int(np.argmax(fits))
                    pilots[g] = first + k
                    free[slots[k]] = False
                    break
                first, number = first + number, min(4 * number, 4096)
            else:
                break
        else:
            return seed, pilots
        if not free.any():
            return seed, pilots
    raise RuntimeError("no seed sends the keys to slots of their own")


def _slots(keys: np.ndarray, size: int, seed: int, pilots: np.ndarray) -> np.ndarray:
    hashed = mix(keys, seed)
    group = (hashed >> np.uint64(32)) % np.uint64(len(pilots))
    return (mix(hashed ^ mix(pilots[group].astype(np.uint64), 7)) % np.uint64(size)).astype(np.int64)


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 0x5BD1E995) >> np.uint64(32)).astype(np.uint32)


def _bucket(key: str, buckets: int):
    return F.expr(f"pmod(xxhash64({key}), {buckets}L)")


def _write_index(spark: SparkSession, store: TokenStore) -> None:
    entries = store.read_blocks(spark).selectExpr(
        "shard", "block", "inline(arrays_zip(keys, offsets, lengths)) AS (key, offset, length)"
    )
    store.buckets = max(1, entries.count() // BUCKET_KEYS)
    places = (
        entries.filter("key IS NOT NULL")
        .groupBy("key")
        .agg(F.min(F.struct("shard", "block", "offset", "length")).alias("p"))
        .select(_bucket("key", store.buckets).alias("bucket"), "key", "p.*")
    )
    schema = to_arrow_schema(spark.createDataFrame([], _INDEX).schema)

    def build(rows: pa.Table) -> pa.Table:
        keys = rows["key"].to_numpy().astype(np.int64).view(np.uint64)
        seed, pilots = _hash_table(keys, len(keys))
        order = np.argsort(_slots(keys, len(keys), seed, pilots))
        columns = [rows[c].to_numpy()[order] for c in ("shard", "block", "offset", "length")]
        fingerprints = _fingerprints(keys)[order].astype("<u4").tobytes()
        values = [rows["bucket"][0].as_py(), len(keys), seed, pilots.astype("<u4").tobytes(), fingerprints, *columns]
        return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

    places.groupBy("bucket").applyInArrow(build, _INDEX).write.parquet(store.index)


def lookup(keys: DataFrame, store: TokenStore) -> DataFrame:
    """key, bucket, slot, shard, block, offset and length of the keys that the index knows, one row each.

    A key finds its slot with two hashes and the bucket's row; a stored fingerprint that differs means that the
    key was never indexed (but for one in four thousand million of those).  Null keys are not found.
    """
    spark = keys.sparkSession
    asked = keys.selectExpr("cast(key AS bigint) AS key").filter("key IS NOT NULL").distinct()
    asked = asked.select(_bucket("key", store.buckets).alias("bucket"), "key")
    found = "key bigint, bucket bigint, slot int, shard int, block int, offset int, length int"
    schema = to_arrow_schema(spark.createDataFrame([], found).schema)

    def find(wanted: pa.Table, index: pa.Table) -> pa.Table:
        if not len(wanted) or not len(index):
            return schema.empty_table()
        keys = wanted["key"].to_numpy().astype(np.int64).view(np.uint64)
        row = index.to_pylist()[0]
        slots = _slots(keys, row["size"], row["seed"], np.frombuffer(row["pilots"], "<u4"))
        known = np.frombuffer(row["fingerprints"], "<u4")[slots] == _fingerprints(keys)
        slots = slots[known]
        places = [np.array(row[c])[slots] for c in ("shards", "blocks", "offsets", "lengths")]
        columns = [keys[known].view(np.int64), np.full(len(slots), row["bucket"]), slots, *places]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    index = store.read_index(spark)
    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(find, found)


def read_documents(spark: SparkSession, store: TokenStore) -> DataFrame:
    """doc_id, shard, block, place in the shard, ids and their crc32 of every document, read block by block."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                width = len(row["payload"]) // max(row["n_ids"], 1)
                ids = np.frombuffer(row["payload"], f"<u{width}").astype("<u4")
                bounds = zip(row["offsets"], row["lengths"], strict=True)
                crc = [zlib.crc32(ids[a : a + n]) for a, n in bounds]
                number = len(row["keys"])
                columns = [
                    pa.array(row["keys"], pa.int64()),
                    pa.array([row["shard"]] * number, pa.int32()),
                    pa.array(row["begin"] + np.array(row["offsets"], np.int64)),
                    pa.array(row["lengths"], pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "shard", "place", "n_tokens", "ids_crc32"])

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    return store.read_blocks(spark).mapInArrow(
        cut, "doc_id bigint, shard int, place bigint, n_tokens bigint, ids_crc32 bigint"
    )


def fetch(keys: DataFrame, store: TokenStore) -> DataFrame:
    """key and token ids of the asked documents: index, then the block that holds each."""
    spark = keys.sparkSession
    places = lookup(keys, store).select("key", "shard", "block", "offset", "length")
    blocks = store.read_blocks(spark).select("shard", "block", "n_ids", "payload")
    # Only the asked document's bytes leave the join.
    width = "int(length(payload) / n_ids)"
    cut = places.join(blocks, ["shard", "block"]).selectExpr(
        "key", f"{width} AS width", f"substr(payload, offset * {width} + 1, length * {width}) AS raw"
    )

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [
                np.frombuffer(raw, f"<u{width}").astype(np.int64)
                for width, raw in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.int64()))], ["key", "ids"])

    return cut.mapInArrow(ids, "key bigint, ids array<bigint>")


def stored_documents(documents: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the store, read it back: doc_id, start among all ids, n_tokens, ids_crc32, and the index's bucket and slot."""
    spark = documents.sparkSession
    store = write_store(documents, tokenizer, end_id)
    totals = store.read_blocks(spark).groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    # One row for each shard: as few as the tasks that wrote them.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = totals.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("shard_start"))
    rows = read_documents(spark, store)
    places = lookup(rows.select(F.col("doc_id").alias("key")), store).select(F.col("key").alias("doc_id"), "bucket", "slot")
    return (
        rows.join(F.broadcast(shards), "shard")
        .join(places, "doc_id", "left")
        .selectExpr("doc_id", "shard_start + place AS start", "n_tokens", "ids_crc32", "bucket", "slot")
    )
