"""Quality rules as weak supervision: rules vote or abstain, and expectation-maximisation weighs them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lienflow.llm.common import (
    owners,
    prefix_sums,
    run_hashes,
    run_keys,
    runs,
    slices,
    small_batches,
    stored,
    text_bytes,
    text_or_empty,
)

#: Words of a window that counts as repeated, least words of a document, and most of its words in such windows (%).
REPEAT_WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30

#: A document stays where the probability that it is good reaches this.
KEEP_PROBABILITY = 0.5

#: Rules: SQL that gives 1 (good), -1 (bad) or 0 (abstains) from the counts of a document.
RULES = {
    "length": "CASE WHEN n_words < 20 THEN -1 WHEN n_words >= 50 THEN 1 ELSE 0 END",
    "mean_word": "CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN -1 "
    "WHEN word_chars BETWEEN 3 * n_words AND 10 * n_words THEN 1 ELSE 0 END",
    "symbols": "CASE WHEN 10 * n_symbols > n_words THEN -1 WHEN 100 * n_symbols <= n_words THEN 1 ELSE 0 END",
    "duplicate_lines": "CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN -1 WHEN n_dup_lines = 0 THEN 1 ELSE 0 END",
    "repeated_words": "CASE WHEN 10 * n_repeat_words > 3 * n_words THEN -1 "
    "WHEN 20 * n_repeat_words <= n_words THEN 1 ELSE 0 END",
    "same_word": "CASE WHEN 10 * n_same_word > n_words THEN -1 WHEN 50 * n_same_word <= n_words THEN 1 ELSE 0 END",
    "capitals": "CASE WHEN 5 * n_capitals > 2 * n_letters THEN -1 WHEN 5 * n_capitals <= n_letters THEN 1 ELSE 0 END",
    "marks": "CASE WHEN 2 * n_marks > n_words THEN -1 WHEN 5 * n_marks <= n_words THEN 1 ELSE 0 END",
}


def _table(values: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(values.encode())] = True
    return table


_WORD = ~_table(" \t\n\v\f\r")
_SYMBOL = _table("#*$%&|<>")
_MARK = _table("!?#*$%&|<>=~^\\{}[]_@")
_CAPITAL = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LINE = ~_table("\n")

COUNTS = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_same_word",
    "n_capitals",
    "n_letters",
    "n_marks",
]


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[offsets])


def _repeated(owner: np.ndarray, hashes: np.ndarray, later_only: bool) -> np.ndarray:
    """Which entries have an equal one in the same text; the first of them only if not ``later_only``."""
    order = np.lexsort((hashes, owner))
    same = (owner[order][1:] == owner[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    marked = np.zeros(len(owner), bool)
    marked[order[1:][same]] = True
    if not later_only:
        marked[order[:-1][same]] = True
    return marked


def count_texts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The counts of ``COUNTS`` for each text."""
    size = len(offsets) - 1
    member = _WORD[data]
    starts, ends, first = runs(member, offsets)
    owner = owners(first)
    n_words = np.diff(first)
    words = run_keys(data, starts, ends)

    line_starts, line_ends, line_first = runs(_LINE[data], offsets)
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(member, out=before[1:])
    filled = before[line_ends] > before[line_starts]
    line_owner = owners(line_first)[filled]
    doubled = _repeated(line_owner, run_keys(data, line_starts[filled], line_ends[filled]), True)

    covered = np.zeros(len(starts) + 1, np.int64)
    windows = len(starts) - REPEAT_WINDOW + 1
    if windows > 0:
        at = np.flatnonzero(owner[:windows] == owner[REPEAT_WINDOW - 1 :])
        word_sums = prefix_sums(words)
        found = at[_repeated(owner[at], run_hashes(word_sums, at, at + REPEAT_WINDOW), False)]
        np.add.at(covered, found, 1)
        np.add.at(covered, found + REPEAT_WINDOW, -1)
    repeated = np.cumsum(covered)[:-1] > 0
    again = np.zeros(len(starts), bool)
    again[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])

    code_points = (data & 0xC0) != 0x80
    return [
        n_words,
        _per_text(member & code_points, offsets),
        _per_text(_SYMBOL[data], offsets),
        np.bincount(line_owner[doubled], minlength=size),
        np.bincount(owner[repeated], minlength=size),
        np.bincount(line_owner, minlength=size),
        np.bincount(owner[again], minlength=size),
        _per_text(_CAPITAL[data], offsets),
        _per_text(_LETTER[data], offsets),
        _per_text(_MARK[data], offsets),
    ]


def counts(documents: DataFrame) -> DataFrame:
    """doc_id and the counts of each row; null texts have none of anything."""
    small_batches(documents.sparkSession)
    rows = documents.select("doc_id", text_or_empty("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found = count_texts(*text_bytes(batch.column(1)))
            columns = [pa.array(c.astype(np.int64)) for c in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *COUNTS])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS))


def base_failed() -> str:
    return f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words"


def posteriors(votes: np.ndarray, weight: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Probability that a document of each vote pattern is good.

    Votes are taken as independent given good or bad.  Each rule has, for good and for bad documents, its own
    chances of voting 1, 0 and -1; these and the share of good documents are estimated by
    expectation-maximisation, begun at the share of good votes and held off 0 by one pseudo-count.
    """
    good = np.clip(0.5 + votes.sum(axis=1) / (2.0 * votes.shape[1]), 0.05, 0.95)
    good[votes.min(axis=1) < 0] -= 0.05
    for _ in range(rounds):
        share = (weight @ good + 1) / (weight.sum() + 2)
        log_odds = np.full(len(votes), np.log(share / (1 - share)))
        for rule in range(votes.shape[1]):
            chance = {}
            for kind, part in (("good", weight * good), ("bad", weight * (1 - good))):
                number = np.array([part[votes[:, rule] == v].sum() for v in (-1, 0, 1)]) + 1
                chance[kind] = np.log(number / number.sum())
            log_odds += (chance["good"] - chance["bad"])[votes[:, rule] + 1]
        last, good = good, 1 / (1 + np.exp(-np.clip(log_odds, -500, 500)))
        if np.abs(good - last).max() < 1e-9:
            break
    return good


def judge(documents: DataFrame, keep_probability: float = KEEP_PROBABILITY) -> DataFrame:
    """Counts of each row with its votes' posterior, base_failed and kept.

    The vote patterns are counted over all documents; there are at most 3 to the power of the rules of them, so
    the estimates are made on the driver and sent out as a small table.  The counts are stored, so that each text is
    gone through once.  A document that fails the base never stays.
    """
    spark = documents.sparkSession
    counted = stored(counts(documents), "counts")
    voted = counted.withColumn("pattern", F.expr("array(" + ", ".join(RULES.values()) + ")"))
    patterns = voted.groupBy("pattern").count().collect()
    schema = "pattern array<int>, p_good double"
    if patterns:
        good = posteriors(np.array([r[0] for r in patterns]), np.array([r[1] for r in patterns], float))
        table = spark.createDataFrame([(r[0], float(p)) for r, p in zip(patterns, good, strict=True)], schema)
    else:
        table = spark.createDataFrame([], schema)
    failed = F.expr(base_failed())
    return (
        voted.join(F.broadcast(table), "pattern", "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("p_good") >= keep_probability))
        .drop("pattern")
    )
