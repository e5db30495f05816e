"""SentencePiece ids and decoded text through a table of distinct chunks.

Where no piece has a word character before a white-space marker, a merge cannot reach over the begin of a marked
word.  Each chunk (white space, then the word) is then segmented by itself, once, and the ids are joined back by
position.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lienflow.llm.common import slices, small_batches, text_bytes, text_or_empty

#: Chunks that a Python worker keeps between batches; the table is begun anew beyond it.
TABLE_CHUNKS = 300_000

#: The character that stands for white space in pieces.
MARKER = "▁"


class ChunkTable:
    """Ids, ids as text and decoded text of distinct chunks, segmented when they are first met.

    A chunk is a run of spaces and what follows up to the next space; the first space of a text's first chunk is
    the marker that the model puts before every text.
    """

    def __init__(self, model: str, limit: int = TABLE_CHUNKS):
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_file=model)
        self.limit = limit
        pieces = [self.processor.id_to_piece(i) for i in range(self.processor.get_piece_size())]
        if any(c != MARKER and d == MARKER for p in pieces for c, d in zip(p, p[1:], strict=False)):
            raise ValueError("the model has pieces that cross a white-space marker")
        self.alone = self.processor.piece_to_id(MARKER)
        # Bytes of each piece; none of those that stand for no text of their own.
        special = [getattr(self.processor, f"is_{kind}") for kind in ("control", "unknown", "unused")]
        byte = self.processor.is_byte
        self.plain = [
            None if any(f(i) for f in special) else bytes([int(p[3:5], 16)]) if byte(i) else p.replace(MARKER, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.names = [str(i) for i in range(len(pieces))]
        self.number: dict[bytes, int] = {}
        self.ids: list[bytes] = []
        self.listed: list[str] = []
        self.decoded: list[str] = []

    def _numbers(self, chunks: list[bytes]) -> np.ndarray:
        """Numbers of the chunks in the table."""
        if len(self.ids) > self.limit:
            for kept in (self.number, self.ids, self.listed, self.decoded):
                kept.clear()
        get = self.number.get
        found = [get(c, -1) for c in chunks]
        missing = [i for i, n in enumerate(found) if n < 0]
        if missing:
            # The library puts the first space back in front, save where nothing follows it.
            texts = [chunks[i][1:].decode() for i in missing]
            plain, names = self.plain, self.names
            for i, ids in zip(missing, self.processor.encode(texts, num_threads=1), strict=True):
                ids = ids or [self.alone]
                found[i] = self.number[chunks[i]] = len(self.ids)
                self.ids.append(array("i", ids).tobytes())
                self.listed.append(",".join([names[n] for n in ids]))
                text = [plain[n] for n in ids]
                try:
                    self.decoded.append(b"".join(text).decode())
                except (TypeError, UnicodeDecodeError):
                    self.decoded.append(" " + self.processor.decode(ids))
        return np.array(found, np.int64)

    def chunks(self, texts: pa.Array) -> Iterator[list[int]]:
        """Each text as the numbers of its chunks, in order; none for an empty text."""
        data, offsets = text_bytes(texts)
        whole = data.tobytes()
        parts = [whole[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        marker = MARKER.encode()
        if marker in whole:
            parts = [part.replace(marker, b" ") for part in parts]
        padded = b"".join([b" " + part for part in parts])
        heads = np.cumsum([0, *[len(part) + 1 for part in parts]])
        spaced = np.frombuffer(padded, np.uint8) == 32
        begin = spaced.copy()
        begin[1:] &= ~spaced[:-1]
        begin[heads[:-1]] = True
        starts = np.flatnonzero(begin)
        bounds = pa.py_buffer(np.append(starts, len(spaced)).astype(np.int32))
        distinct = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, bounds, pa.py_buffer(padded)]
        ).dictionary_encode()
        numbers = self._numbers(distinct.dictionary.to_pylist())[distinct.indices.to_numpy()].tolist()
        first = np.searchsorted(starts, heads).tolist()
        for part, a, b in zip(parts, first[:-1], first[1:], strict=True):
            yield numbers[a:b] if part else []

    def encode(self, texts: pa.Array) -> list[list[int]]:
        """Ids of each text, as the library's own ``encode`` gives them."""
        return [self.ids_of(numbers).tolist() for numbers in self.chunks(texts)]

    def ids_of(self, numbers: list[int]) -> np.ndarray:
        """Ids of a text's chunks, joined by position."""
        table = self.ids
        return np.frombuffer(b"".join([table[n] for n in numbers]), np.int32)

    def text_of(self, numbers: list[int]) -> str:
        """Decoded text of a text's chunks; characters made of byte pieces never reach over a chunk."""
        table = self.decoded
        return "".join([table[n] for n in numbers])[1:]


_tables: dict[str, ChunkTable] = {}


def chunk_table(model: str) -> ChunkTable:
    """The worker's table for a model."""
    if model not in _tables:
        _tables[model] = ChunkTable(model)
    return _tables[model]


def encode_documents(documents: DataFrame, model: str) -> DataFrame:
    """doc_id, ids and decoded text of each row; a null or empty text has no ids and decodes to the empty text."""
    small_batches(documents.sparkSession)
    rows = documents.select("doc_id", text_or_empty("text").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_table(model)
        for batch in slices(batches, 1):
            ids, decoded = [], []
            for numbers in table.chunks(batch.column(1)):
                ids.append(table.ids_of(numbers))
                decoded.append(table.text_of(numbers))
            columns = [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"doc_id {kind}, ids array<int>, decoded string")


def encoded_digests(documents: DataFrame, model: str) -> DataFrame:
    """doc_id, number of ids and hashes of the ids and of the decoded text, without sending either to the JVM."""
    small_batches(documents.sparkSession)
    rows = documents.select("doc_id", text_or_empty("text").alias("text"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_table(model)
        for batch in slices(batches, 1):
            number, listed, decoded = [], [], []
            for numbers in table.chunks(batch.column(1)):
                ids, names = table.ids, table.listed
                number.append(sum([len(ids[n]) for n in numbers]) // 4)
                listed.append(hashlib.sha256(",".join([names[n] for n in numbers]).encode()).hexdigest())
                decoded.append(hashlib.sha256(table.text_of(numbers).encode()).hexdigest())
            columns = [batch.column(0), pa.array(number, pa.int64()), pa.array(listed), pa.array(decoded)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(digest, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
