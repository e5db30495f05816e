"""Alignment of the tokens of two tokenizers over a corpus, by external spill counting.

A byte-level tokenizer (A) and a piece tokenizer (B) cut the same bytes.  Every A and B token that share a byte are
a link.  Slices of the corpus become runs: their pair-document records, in order of the B id, radix-partitioned and
packed with zstd.  Runs are merged through a heap, which counts each pair over the corpus and sees the pairs of
a B id together, so that the highest is known; what each run needs goes back to it in the order of its own pairs.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lienflow.llm.common import slices, small_batches, stored, text_bytes, text_or_empty

#: Text of one run.
RUN_BYTES = 2 << 20
#: Parts that the pairs are dealt to by their B id.  A part never holds more pairs than the vocabularies allow.
RADIX = 128
#: Runs that one task merges; more are merged in several passes.
FAN_IN = 64
#: Pairs of a run that are unpacked at once.
FRAME_PAIRS = 1 << 16
#: Chunks and links that a worker keeps between runs.
TABLE_CHUNKS = 100_000
TABLE_LINKS = 2_000_000
#: Chunks that are cut into tokens at once.
LEARNT_AT_ONCE = 5_000
#: Bits of an id within a pair's key.
ID_BITS = 20

MARKER = "▁"


# -- tokens, groups and links of chunks -------------------------------------------------------------------


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write a byte as itself where it is printable, the others as code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def cut_points(padded: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Where chunks begin: at each text, and before a single space between two characters that are no white space.

    No token of either kind reaches over such a place, so chunks are cut into tokens by themselves.  ``padded`` has
    a space before each text.
    """
    n = len(padded)
    graphic = (padded > 32) & (padded < 127)
    after = np.zeros(n + 3, np.uint8)
    after[:n] = padded
    high = padded >= 128
    lead, next_byte = after[:n].astype(np.int64), after[1 : n + 1].astype(np.int64)
    # Characters that may be white space: U+0085, U+00A0, and by their first two bytes U+1680, U+2000 to 207F, U+3000.
    odd = ((lead == 0xC2) & ((next_byte == 0x85) | (next_byte == 0xA0))) | ((lead == 0xE1) & (next_byte == 0x9A))
    odd |= ((lead == 0xE2) & ((next_byte == 0x80) | (next_byte == 0x81))) | ((lead == 0xE3) & (next_byte == 0x80))
    covered = odd.copy()
    covered[1:] |= odd[:-1]
    covered[2:] |= odd[:-2]
    solid = graphic | (high & ~covered)
    cuts = padded == 32
    cuts[1:] &= solid[:-1]
    cuts[:-1] &= solid[1:]
    if n:
        cuts[0] = cuts[-1] = False
    cuts[heads] = True
    return np.flatnonzero(cuts)


class ChunkLinks:
    """Tokens, groups and links of distinct chunks, worked out when they are first met."""

    def __init__(self, byte_model: str, piece_model: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        # A task has a core; threads of the library would take others' and memory for each.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(byte_model)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=piece_model)
        to_byte = _byte_of_character()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(to_byte[c] for c in token)
        size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        self.bytes_b = [
            b"" if self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i)
            else bytes([int(p[3:5], 16)]) if self.b.is_byte(i)
            else p.replace(MARKER, " ").encode()
            for i, p in enumerate(pieces)
        ]
        if max(len(self.bytes_a), size) >= 1 << ID_BITS:
            raise ValueError(f"ids of more than {ID_BITS} bits")
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # An id with what follows it within a group, at the end of its side, and at the end of the group.
        most = max(len(self.bytes_a), size)
        self.names = [np.array([f"{i}{mark}" for i in range(most)], object) for mark in (",", "|", ";")]
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.groups: list[str] = []
        #: Per chunk: A tokens, B tokens, groups, links, whether its bytes are told by both.
        self.facts = np.zeros((0, 5), np.int64)
        self.first_link = np.zeros(0, np.int64)
        self.links = np.zeros(0, np.int64)

    def numbers(self, chunks: list[bytes]) -> np.ndarray:
        """Numbers of distinct chunks; ``clear`` forgets them."""
        get = self.number.get
        missing = [c for c in chunks if c not in self.number]
        if missing:
            self._learn(missing)
        return np.array([get(c) for c in chunks], np.int64)

    def _learn(self, chunks: list[bytes]) -> None:
        for at in range(0, len(chunks), LEARNT_AT_ONCE):
            self._learn_some(chunks[at : at + LEARNT_AT_ONCE])

    def _learn_some(self, chunks: list[bytes]) -> None:
        known = len(self.number)
        self.number.update({c: known + i for i, c in enumerate(chunks)})
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        texts = [c.decode() for c in chunks]
        ids_a, counts_a = self._ids_a(texts, sizes)
        # The library puts the first space back in front.
        listed = self.b.encode([t[1:] for t in texts], num_threads=1)
        counts_b = np.fromiter(map(len, listed), np.int64, len(chunks))
        ids_b = np.fromiter(chain.from_iterable(listed), np.int64, int(counts_b.sum()))
        good = self._told(chunks, sizes, ids_a, counts_a, self.bytes_a, self.length_a)
        good &= self._told(chunks, sizes, ids_b, counts_b, self.bytes_b, self.length_b)
        if not good.all():
            ids_a, ids_b = ids_a[np.repeat(good, counts_a)], ids_b[np.repeat(good, counts_b)]
        facts = np.zeros((len(chunks), 5), np.int64)
        facts[:, 4] = good
        groups = [""] * len(chunks)
        ends_a, ends_b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        # Both kinds of ends in order: one that stands there twice closes a group.  Each stretch between neighbouring
        # ends lies in one A and one B token: a link.
        ends = np.concatenate([ends_a, ends_b])
        ends.sort(kind="stable")
        twice = ends[1:] == ends[:-1]
        shared = ends[1:][twice]
        ends = ends[np.concatenate([~twice, np.ones(min(len(ends), 1), bool)])]
        links = pair_key(ids_b[np.searchsorted(ends_b, ends)], ids_a[np.searchsorted(ends_a, ends)])
        chunk_ends = np.cumsum(sizes[good])
        facts[good, 0], facts[good, 1] = counts_a[good], counts_b[good]
        facts[good, 2] = np.diff(np.searchsorted(shared, chunk_ends, "right"), prepend=0)
        facts[good, 3] = np.diff(np.searchsorted(ends, chunk_ends, "right"), prepend=0)
        texts = self._group_texts(ids_a, ids_b, ends_a, ends_b, shared, facts[good, 0] + facts[good, 1])
        for i, text in zip(np.flatnonzero(good).tolist(), texts, strict=True):
            groups[i] = text
        self.groups += groups
        self.facts = np.concatenate([self.facts, facts])
        self.first_link = np.concatenate([self.first_link, len(self.links) + np.cumsum(facts[:, 3]) - facts[:, 3]])
        self.links = np.concatenate([self.links, links])

    def _ids_a(self, chunks: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A ids of all chunks, and how many each has.

        Chunks that neither end in white space nor have any behind their first space are cut into tokens many at a
        time, as one text: no token reaches over their borders.
        """
        plain = np.array([len(c) > 1 and not c[1].isspace() and not c[-1].isspace() for c in chunks], bool)
        counts = np.zeros(len(chunks), np.int64)
        joined = np.flatnonzero(plain)
        found = np.zeros(0, np.int64)
        if len(joined):
            text = "".join([chunks[i] for i in joined.tolist()])
            found = np.array(self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
            ends, borders = np.cumsum(self.length_a[found]), np.cumsum(sizes[joined])
            counts[joined] = np.diff(np.searchsorted(ends, borders) + 1, prepend=0)
        if len(joined) == len(chunks):
            return found, counts
        others = np.flatnonzero(~plain)
        apart = [self.a.encode_batch_fast([chunks[i]], add_special_tokens=False)[0].ids for i in others.tolist()]
        counts[others] = [len(x) for x in apart]
        # Put both kinds back into the order of the chunks.
        whole = np.zeros(int(counts.sum()), np.int64)
        first = np.cumsum(counts) - counts
        whole[_spread(first[joined], counts[joined])] = found
        whole[_spread(first[others], counts[others])] = np.fromiter(chain.from_iterable(apart), np.int64)
        return whole, counts

    @staticmethod
    def _told(chunks, sizes, ids, counts, table, lengths) -> np.ndarray:
        """Which chunks their tokens give back, byte for byte."""
        whole = b"".join([table[i] for i in ids.tolist()])
        ends = np.cumsum(np.concatenate([[0], lengths[ids]]))[np.cumsum(counts)]
        if whole == b"".join(chunks) and (ends == np.cumsum(sizes)).all():
            return np.ones(len(chunks), bool)
        starts = np.concatenate([[0], ends[:-1]])
        return np.array([whole[a:b] == c for a, b, c in zip(starts.tolist(), ends.tolist(), chunks, strict=True)], bool)

    def _group_texts(self, ids_a, ids_b, ends_a, ends_b, shared, counts) -> Iterator[str]:
        """The groups of each chunk as text, each group closed by a semicolon."""
        of_a, of_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        closes_a, closes_b = shared[of_a] == ends_a, shared[of_b] == ends_b
        comma, bar, semicolon = self.names
        marked = np.empty(len(ids_a) + len(ids_b), object)
        # Within a group the A ids come first.
        marked[np.arange(len(ids_a)) + np.searchsorted(of_b, of_a, "left")] = np.where(closes_a, bar[ids_a], comma[ids_a])
        marked[np.arange(len(ids_b)) + np.searchsorted(of_a, of_b, "right")] = np.where(closes_b, semicolon[ids_b], comma[ids_b])
        listed = marked.tolist()
        at = 0
        for n in counts.tolist():
            yield "".join(listed[at : at + n])
            at += n


def pair_key(ids_b: np.ndarray, ids_a: np.ndarray) -> np.ndarray:
    """Keys of pairs: in order they go by radix, then B id, then A id."""
    return ((ids_b % RADIX) << (2 * ID_BITS)) | (ids_b << ID_BITS) | ids_a


def radix_of(keys: np.ndarray) -> np.ndarray:
    return keys >> (2 * ID_BITS)


# -- runs -------------------------------------------------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as zstd, bytes of equal weight together."""
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(values, "<i8").view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack(data: bytes) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<i8").ravel()


def pack_frames(keys: np.ndarray, counts: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Rising keys, as differences, and their counts, some thousands at a time."""
    cuts = range(0, len(keys), FRAME_PAIRS)
    packed = [pack(np.diff(keys[i : i + FRAME_PAIRS], prepend=0)) for i in cuts]
    return packed, [pack(counts[i : i + FRAME_PAIRS]) for i in cuts]


def read_keys(frames: list[bytes]) -> np.ndarray:
    return np.concatenate([np.cumsum(unpack(f)) for f in frames]) if frames else np.zeros(0, np.int64)


def read_numbers(frames: list[bytes]) -> np.ndarray:
    return np.concatenate([unpack(f) for f in frames]) if frames else np.zeros(0, np.int64)


def merge_runs(runs: list[tuple[list[bytes], list[bytes]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys in order with the sum of their counts over all runs; of each run one frame is unpacked at a time.

    One heap has the last key of each frame at hand: up to the least of them all keys are there.  The other has the
    first keys, so that only runs with such keys are touched.
    """
    frames: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    at = [0] * len(runs)
    firsts: list[tuple[int, int]] = []
    lasts: list[tuple[int, int]] = []

    def advance(i: int) -> None:
        keys, counts = runs[i]
        if at[i] < len(keys):
            frames[i] = np.cumsum(unpack(keys[at[i]])), unpack(counts[at[i]])
            at[i] += 1
            heapq.heappush(firsts, (int(frames[i][0][0]), i))
            heapq.heappush(lasts, (int(frames[i][0][-1]), i))

    for i in range(len(runs)):
        advance(i)
    while lasts:
        limit = lasts[0][0]
        while lasts and lasts[0][0] <= limit:
            heapq.heappop(lasts)
        keys, counts, done = [], [], []
        while firsts and firsts[0][0] <= limit:
            _, i = heapq.heappop(firsts)
            cut = int(np.searchsorted(frames[i][0], limit, "right"))
            keys.append(frames[i][0][:cut])
            counts.append(frames[i][1][:cut])
            frames[i] = frames[i][0][cut:], frames[i][1][cut:]
            if len(frames[i][0]):
                heapq.heappush(firsts, (int(frames[i][0][0]), i))
            else:
                done.append(i)
        yield _summed(np.concatenate(keys), np.concatenate(counts))
        for i in done:
            advance(i)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else np.zeros(0, np.int64)


def highest(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a pair's count is the highest of its B id; all pairs of an id stand together."""
    if not len(keys):
        return np.zeros(0, bool)
    ids = keys >> ID_BITS
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    most = np.maximum.reduceat(counts, first)
    return counts == np.repeat(most, np.diff(np.append(first, len(ids))))


_DOCUMENT = ["doc_ids", "n_a", "n_b", "n_groups", "n_links"]
_RUN = (
    "run bigint, radix int, keys array<binary>, counts array<binary>, "
    + ", ".join(f"{c} array<bigint>" for c in _DOCUMENT)
    + ", groups array<string>, n_records binary, slots binary, times binary"
)
_PARTS = "run bigint, radix int, keys array<binary>, counts array<binary>"


def _run_rows(run: int, ids: pa.Array, texts: pa.Array, table: ChunkLinks) -> Iterator[tuple]:
    """A row for the documents and records of a run, then a row of pairs and their counts for each radix."""
    if len(table.groups) > TABLE_CHUNKS or len(table.links) > TABLE_LINKS:
        table.clear()
    data, offsets = text_bytes(texts)
    n = len(texts)
    # Each text with the space before it that belongs to it; an empty one has no chunk.
    whole = data.tobytes()
    parts = [b" " + whole[a:b] if b > a else b"" for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    ends = np.cumsum([len(p) for p in parts])
    heads = ends - [len(p) for p in parts]
    padded = b"".join(parts)
    filled = np.array([len(p) > 0 for p in parts], bool)
    starts = cut_points(np.frombuffer(padded, np.uint8), heads[filled])
    first = np.searchsorted(starts, np.append(heads, len(padded)))
    bounds = pa.py_buffer(np.append(starts, len(padded)).astype(np.int32))
    cells = pa.Array.from_buffers(pa.binary(), len(starts), [None, bounds, pa.py_buffer(padded)]).dictionary_encode()
    numbers = table.numbers(cells.dictionary.to_pylist())[cells.indices.to_numpy()] if len(starts) else np.zeros(0, np.int64)
    slot = np.repeat(np.arange(n), np.diff(first))
    facts = np.zeros((n, 4), np.int64)
    told = np.ones(n, bool)
    told[slot[table.facts[numbers, 4] == 0]] = False
    for k in range(4):
        sums = np.concatenate([[0], np.cumsum(table.facts[numbers, k])])
        facts[:, k] = np.where(told, sums[first[1:]] - sums[first[:-1]], 0)
    groups = []
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        if told[i] and b > a:
            listed = "".join([table.groups[k] for k in numbers[a:b].tolist()])[:-1]
            groups.append(hashlib.sha256(listed.encode()).hexdigest())
        else:
            groups.append("")
    # Chunks of each text with how often it has them, then the links of those chunks.
    chosen = told[slot]
    size = len(table.groups) or 1
    found, often = np.unique(slot[chosen] * size + numbers[chosen], return_counts=True)
    chunk, owner = found % size, found // size
    used, where = np.unique(chunk, return_inverse=True)
    lengths = table.facts[used, 3]
    keys, pair = np.unique(table.links[_spread(table.first_link[used], lengths)], return_inverse=True)
    begin = np.cumsum(lengths) - lengths
    pairs = pair[_spread(begin[where], lengths[where])]
    owners, times = np.repeat(owner, lengths[where]), np.repeat(often, lengths[where])
    # Records: pair, document and the number of links, in order.
    record, counts = _summed(pairs * n + owners, times)
    of_pair = np.bincount(record // max(n, 1), minlength=len(keys))
    sums = np.add.reduceat(counts, np.cumsum(of_pair) - of_pair) if len(keys) else np.zeros(0, np.int64)
    lists = [ids.to_pylist(), *[facts[:, k].tolist() for k in range(4)]]
    yield (run, -1, None, None, *lists, groups, pack(of_pair), pack(record % max(n, 1)), pack(counts))
    cuts = np.searchsorted(radix_of(keys), np.arange(RADIX + 1))
    for r in range(RADIX):
        a, b = cuts[r], cuts[r + 1]
        if b > a:
            yield (run, r, *pack_frames(keys[a:b], sums[a:b]), *[None] * 9)


_tables: dict[tuple[str, str], ChunkLinks] = {}


def write_runs(documents: DataFrame, byte_model: str, piece_model: str) -> DataFrame:
    """The runs of the corpus, as a table."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = documents.sparkSession
    small_batches(spark)
    schema = to_arrow_schema(spark.createDataFrame([], _RUN).schema)
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty("text").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = byte_model, piece_model
        if models not in _tables:
            _tables[models] = ChunkLinks(*models)
        table = _tables[models]
        run = TaskContext.get().partitionId() << 32
        for batch in slices(batches, 1, RUN_BYTES):
            made = list(zip(*_run_rows(run, batch.column(0), batch.column(1), table), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, schema, strict=True)], schema=schema)
            run += 1

    return stored(rows.mapInArrow(work, _RUN), "runs")


# -- counts over the corpus and back ----------------------------------------------------------------------


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows with equal leading columns, which stand together."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row)
    if rows:
        yield key, rows


def _small_rows(spark) -> None:
    """Rows with packed numbers are larger than rows of text: fewer at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")


def _merge_pass(parts: DataFrame, groups: int) -> DataFrame:
    """Merge the runs of each radix that fall into the same group into one."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = parts.sparkSession
    _small_rows(spark)
    schema = to_arrow_schema(spark.createDataFrame([], _PARTS).schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (radix, group), rows in _grouped(batches, 2):
            merged = list(merge_runs([row[2:] for row in rows]))
            packed = pack_frames(np.concatenate([k for k, _ in merged]), np.concatenate([n for _, n in merged]))
            made = [[group], [radix], *[[p] for p in packed]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, schema, strict=True)], schema=schema)

    placed = parts.selectExpr("radix", f"pmod(xxhash64(run), {groups}) AS group", "keys", "counts")
    sorted_rows = placed.repartition("radix", "group").sortWithinPartitions("radix", "group")
    return stored(sorted_rows.mapInArrow(merge, _PARTS), "merged")


def _weights(parts: DataFrame, counted: DataFrame, groups: int) -> DataFrame:
    """For the pairs of each run and radix, in their order, twice their count over the corpus and 1 for the highest."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = parts.sparkSession
    _small_rows(spark)
    output = "run bigint, radix int, weights array<binary>"
    schema = to_arrow_schema(spark.createDataFrame([], output).schema)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, keys, weights = None, None, None
        for batch in batches:
            runs, radixes, made = [], [], []
            for radix, group, run, frames, counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if run is None:
                    # The counts of a radix come before the runs that ask for them.
                    if (radix, group) != held:
                        held, keys, numbers = (radix, group), read_keys(frames), read_numbers(counts)
                        weights = numbers * 2 + highest(keys, numbers)
                    continue
                own = weights[np.searchsorted(keys, read_keys(frames))]
                runs.append(run)
                radixes.append(radix)
                made.append([pack(own)])
            columns = [pa.array(c, f.type) for c, f in zip((runs, radixes, made), schema, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    asking = parts.selectExpr("radix", f"pmod(xxhash64(run), {groups}) AS group", "run", "keys", "cast(NULL AS array<binary>) AS counts")
    telling = counted.selectExpr(
        "radix", f"explode(sequence(0L, {groups - 1}L)) AS group", "cast(NULL AS bigint) AS run", "keys", "counts"
    )
    both = asking.unionByName(telling).repartition("radix", "group")
    ordered = both.sortWithinPartitions("radix", "group", F.col("run").asc_nulls_first())
    return stored(ordered.mapInArrow(weigh, output), "weights")


_RESULT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
)


def align_tokens(documents: DataFrame, byte_model: str, piece_model: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each row.

    A cuts a space and the text, B the text, before which it sets a space itself; strings of special tokens are
    plain text.  Where A and B tokens both end, a group ends.  A pair's count is the number of its links in the whole
    table; n_best has the links whose pair has the highest count of its B id, ties included, and count_sum adds up
    the counts over the links.  A null or empty text, and one whose bytes A or B do not give back, has zeros and an
    empty groups_sha256 and counts nowhere.  Repeated rows count as often as they stand there; an empty table has no
    rows; other columns are not looked at.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = documents.sparkSession
    runs = write_runs(documents, byte_model, piece_model)
    whole = runs.filter("radix = -1")
    parts = runs.filter("radix >= 0").select("run", "radix", "keys", "counts")
    groups = max(1, -(-whole.count() // FAN_IN))
    counted, left = parts, groups
    while True:
        counted = _merge_pass(counted, left)
        if left == 1:
            break
        left = -(-left // FAN_IN)
    weights = _weights(parts, counted, groups)
    schema = to_arrow_schema(spark.createDataFrame([], _RESULT).schema)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(batches, 1):
            # Pairs are in order of the radix; the documents and records come last.
            own = np.concatenate([unpack(f) for row in rows[:-1] for f in row[2]]) if len(rows) > 1 else np.zeros(0, np.int64)
            *_, ids, n_a, n_b, n_groups, n_links, digests, of_pair, slots, times = rows[-1]
            slot, times = unpack(slots), unpack(times)
            own = np.repeat(own, unpack(of_pair))
            sums = np.zeros((2, len(ids)), np.int64)
            order = np.argsort(slot, kind="stable")
            present, first = np.unique(slot[order], return_index=True)
            if len(present):
                sums[0, present] = np.add.reduceat((times * (own & 1))[order], first)
                sums[1, present] = np.add.reduceat((times * (own >> 1))[order], first)
            made = [ids, n_a, n_b, n_groups, n_links, sums[0], sums[1], digests]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, schema, strict=True)], schema=schema)

    documents_of = [*_DOCUMENT, "groups", "n_records", "slots", "times"]
    last = whole.select("run", F.lit(RADIX).alias("place"), F.lit(None).cast("array<binary>").alias("weights"), *documents_of)
    none = [F.lit(None).cast(last.schema[c].dataType).alias(c) for c in documents_of]
    together = weights.select("run", F.col("radix").alias("place"), "weights", *none).unionByName(last)
    ordered = together.repartition("run").sortWithinPartitions("run", "place")
    _small_rows(spark)
    return stored(ordered.mapInArrow(add_up, _RESULT), "aligned")
