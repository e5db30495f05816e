"""Benchmark decontamination with a generalised suffix automaton of the items' words."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lienflow.llm.common import slices, small_batches, text_bytes, text_or_empty

#: Words of a window; a match as long as this is a hit.
WINDOW = 10
#: Share of a document's words that may be hit; beyond it the document goes, below it the spans are cut out.
MAX_COVERAGE = 0.5
#: Most bytes of benchmark text in one automaton.  Larger benchmarks are held in several, each of them broadcast.
BLOCK_BYTES = 1 << 20

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_SPACED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_MARKED = np.frombuffer(_SPACED, np.uint8) != 32


def words_of(text: bytes) -> list[bytes]:
    """Words of lower-cased text: runs of digits, ASCII letters and all code points above 127."""
    return text.translate(_SPACED).split()


class SuffixAutomaton:
    """Generalised suffix automaton over word numbers, with the items of every window.

    ``windows`` maps the state of a window to the items it occurs in; a state stands for several lengths, but
    only one of them is the window's.
    """

    def __init__(self, items: list[tuple[int | None, bytes]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        numbered = []
        for item, text in items:
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            if numbers:
                numbered.append((item, numbers))
                last = 0
                for number in numbers:
                    last = self._extend(last, number)
        self.windows: dict[int, dict[int, set[int]]] = {}
        self.shortest = window
        for item, numbers in numbered:
            size = min(window, len(numbers))
            self.shortest = min(self.shortest, size)
            for state in self._states(numbers, size):
                named = self.windows.setdefault(state, {}).setdefault(size, set())
                if item is not None:
                    named.add(item)
        # The nearest state on the way up that holds windows, so that a walk visits no others.
        self.above = [-1] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up = self.link[state]
            self.above[state] = up if up in self.windows else self.above[up] if up > 0 else -1
        pairs = {a * len(self.vocabulary) + b for _, n in numbered for a, b in zip(n, n[1:], strict=False)}
        self.pairs = np.array(sorted(pairs), np.int64)

    def _extend(self, last: int, number: int) -> int:
        if number in self.next[last]:
            following = self.next[last][number]
            if self.length[following] == self.length[last] + 1:
                return following
            return self._split(last, number, following)
        state = len(self.next)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        while last >= 0 and number not in self.next[last]:
            self.next[last][number] = state
            last = self.link[last]
        if last >= 0:
            following = self.next[last][number]
            fits = self.length[following] == self.length[last] + 1
            self.link[state] = following if fits else self._split(last, number, following)
        return state

    def _split(self, last: int, number: int, following: int) -> int:
        clone = len(self.next)
        self.next.append(dict(self.next[following]))
        self.link.append(self.link[following])
        self.length.append(self.length[last] + 1)
        self.link[following] = clone
        while last >= 0 and self.next[last].get(number) == following:
            self.next[last][number] = clone
            last = self.link[last]
        return clone

    def _matches(self, numbers: list[int]) -> Iterator[tuple[int, int]]:
        """State and length of the longest match that ends at each word."""
        state = length = 0
        step, link, longest = self.next, self.link, self.length
        for number in numbers:
            while state and number not in step[state]:
                state = link[state]
                length = longest[state]
            if number in step[state]:
                state = step[state][number]
                length += 1
            yield state, length

    def _states(self, numbers: list[int], size: int) -> Iterator[int]:
        for state, length in self._matches(numbers):
            if length >= size:
                while self.length[self.link[state]] >= size:
                    state = self.link[state]
                yield state

    def stream(self, numbers: np.ndarray) -> tuple[np.ndarray, set[int]]:
        """Which words of a text are hit and the items with a window in it; a number of -1 is a word of no item.

        A match cannot reach over a pair of words that no item has, so only runs of known pairs are walked.
        """
        hit = np.zeros(len(numbers), bool)
        items: set[int] = set()
        if len(numbers) < self.shortest or not self.windows:
            return hit, items
        known = numbers >= 0
        code = numbers[:-1] * len(self.vocabulary) + numbers[1:]
        at = np.searchsorted(self.pairs, code)
        joined = known[:-1] & known[1:]
        if len(self.pairs):
            joined &= self.pairs[np.minimum(at, len(self.pairs) - 1)] == code
        else:
            joined[:] = False
        # A run begins at a known word that no pair joins to the one before.
        begins = np.flatnonzero(known & ~np.concatenate([[False], joined]))
        finishes = np.flatnonzero(known & ~np.concatenate([joined, [False]])) + 1
        for begin, finish in zip(begins, finishes, strict=True):
            if finish - begin >= self.shortest:
                self._walk(numbers[begin:finish].tolist(), int(begin), hit, items)
        return hit, items

    def _walk(self, numbers: list[int], begin: int, hit: np.ndarray, items: set[int]) -> None:
        windows, above = self.windows, self.above
        for end, (state, length) in enumerate(self._matches(numbers), begin + 1):
            if length < self.shortest:
                continue
            at = state if state in windows else above[state]
            while at > 0:
                for size, found in windows[at].items():
                    if size <= length:
                        hit[end - size : end] = True
                        items |= found
                at = above[at]


def automata(benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Iterator[SuffixAutomaton]:
    """Automata of the items, each of ``block_bytes`` bytes of text at most (or one longer item).

    Null texts have no words.  The windows of an item without an id are hit like any other's; it is not named.
    """
    items = benchmark.select("item_id", "text").filter("text IS NOT NULL")
    held: list[tuple[int, bytes]] = []
    size = 0
    for row in items.toLocalIterator():
        text = row["text"].encode()
        if held and size + len(text) > block_bytes:
            yield SuffixAutomaton(held, window)
            held, size = [], 0
        held.append((row["item_id"], text))
        size += len(text)
    if held:
        yield SuffixAutomaton(held, window)


def _numbers(machine: SuffixAutomaton, words: list[bytes]) -> np.ndarray:
    get = machine.vocabulary.get
    return np.fromiter((get(w, -1) for w in words), np.int64, len(words))


def _texts(column: pa.Array) -> Iterator[bytes]:
    data, offsets = text_bytes(column)
    whole = data.tobytes()
    for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield whole[begin:end]


def item_digest(items: set[int]) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Words, hit words and found items of each document.

    Windows are ``window`` words of an item; an item of fewer words is one window; items without words have
    none.  Null texts have no words.  Every row is looked at by itself, repeated ones too.
    """
    small_batches(documents.sparkSession)
    machines = [documents.sparkSession.sparkContext.broadcast(m) for m in automata(benchmark, window)]
    rows = documents.select("doc_id", text_or_empty("text").alias("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            columns: list[list] = [[], [], [], [], []]
            for text in _texts(batch.column(1)):
                words = words_of(text)
                hit, items = np.zeros(len(words), bool), set()
                for machine in machines:
                    more, found = machine.value.stream(_numbers(machine.value, words))
                    hit |= more
                    items |= found
                number = int(hit.sum())
                for column, value in zip(
                    columns, (len(words), number, len(items), item_digest(items), number > 0), strict=True
                ):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *arrays], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"
    return rows.mapInArrow(find, schema)


def cut_spans(text: bytes, machines: list[SuffixAutomaton], max_coverage: float = MAX_COVERAGE) -> bytes | None:
    """The text without its hit spans, a line break in the place of each; None where too many words are hit.

    What stands on either side of a cut meets, so cutting goes on until no window is left.
    """
    total = lost = 0
    while True:
        words = words_of(text)
        total = total or len(words)
        hit = np.zeros(len(words), bool)
        for machine in machines:
            hit |= machine.stream(_numbers(machine, words))[0]
        if not hit.any():
            return text
        lost += int(hit.sum())
        if lost > max_coverage * total:
            return None
        member = _MARKED[np.frombuffer(text, np.uint8)]
        edge = np.diff(np.concatenate([[False], member, [False]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        turn = np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))
        pieces, at = [], 0
        for first, last in zip(np.flatnonzero(turn == 1), np.flatnonzero(turn == -1) - 1, strict=True):
            pieces.append(text[at : starts[first]])
            at = ends[last]
        text = b"\n".join([*pieces, text[at:]])


def remove_contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE
) -> DataFrame:
    """The documents without benchmark passages, columns as they are.

    Spans of ``window`` words or more are cut out of ``text`` and ``n_chars`` follows it; documents of which
    more than ``max_coverage`` of the words are hit go.  Rows without a hit, null texts too, stay as they are.
    """
    small_batches(documents.sparkSession)
    machines = [documents.sparkSession.sparkContext.broadcast(m) for m in automata(benchmark, window)]
    wide = documents.select(F.struct("*").alias("row"), text_or_empty("text").alias("text"))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = [m.value for m in machines]
        for batch in slices(batches, 1):
            kept, texts = [], []
            for text in _texts(batch.column(1)):
                rest = cut_spans(text, used, max_coverage)
                kept.append(rest is not None)
                texts.append(rest.decode() if rest is not None and rest != text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["row", "changed"]
            ).filter(pa.array(kept))

    schema = f"row {wide.schema['row'].dataType.simpleString()}, changed string"
    changed = {"text": "coalesce(changed, row.text)", "n_chars": "coalesce(length(changed), row.n_chars)"}
    return wide.mapInArrow(clean, schema).select(
        *[F.expr(changed.get(c, f"row.`{c}`")).alias(c) for c in documents.columns]
    )
