"""Near-duplicate documents by SimHash: fingerprints within a few differing bits, by the generalised pigeonhole.

The bits are grouped into partitions, correlated ones together.  With thresholds per partition whose sum of
(threshold + 1) is one more than the allowed distance, two near fingerprints are within the threshold in at least one
partition.  Every fingerprint gets thresholds of its own, those of least estimated candidates, probes the values
within them and verifies what it meets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lienflow.llm.common import slices, small_batches, stored, text_or_empty
from lienflow.llm.components import connected

BITS = 64
#: Fingerprints that differ in at most so many bits are linked.
DISTANCE = 2
SHINGLE = 3
SEED = 42
PARTITIONS = 3
#: A fingerprint that would meet more candidates than this is linked through centres instead, which costs as much.
MOST_CANDIDATES = 64
#: Shingles whose bits are counted at once.
_SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: bytes) -> int:
    """The 64 bits that are set in over half the hashes of the text's three-word shingles; 0 without words."""
    from xxhash import xxh64_digest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return int.from_bytes(xxh64_digest(joined, SEED), "big")
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - SHINGLE + 1]
    ends = ends[SHINGLE - 1 :]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _SHINGLES_AT_ONCE):
        spans = zip(starts[at : at + _SHINGLES_AT_ONCE].tolist(), ends[at : at + _SHINGLES_AT_ONCE].tolist(), strict=True)
        digests = b"".join([xxh64_digest(joined[a:b], SEED) for a, b in spans])
        counts += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big")


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id and fingerprint (a long of the same bits) of each row; a null text is an empty one."""
    small_batches(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty("text").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found = [fingerprint(t.as_buffer().to_pybytes()) for t in batch.column(1)]
            longs = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(longs)], ["doc_id", "fingerprint"])

    return rows.mapInArrow(work, "doc_id bigint, fingerprint bigint")


# -- partitions and their thresholds ----------------------------------------------------------------------


def _bit_columns(values: np.ndarray) -> np.ndarray:
    """Rows of the 64 bits of each value, the lowest bit first."""
    return (values.view(np.uint64)[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)


def bit_moments(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and for each two bits how many have both: 64 by 64 numbers from all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS), np.int64)
        rows = 0
        for batch in batches:
            bits = _bit_columns(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)).astype(np.float64)
            total += (bits.T @ bits).astype(np.int64)
            rows += len(batch)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BITS + 1)), pa.array([*total.tolist(), [rows] * BITS], pa.list_(pa.int64()))], ["bit", "both"]
        )

    parts = distinct.select("fingerprint").mapInArrow(count, "bit bigint, both array<bigint>")
    summed = parts.selectExpr("bit", "posexplode(both) AS (other, n)").groupBy("bit", "other").agg(F.sum("n").alias("n"))
    both = np.zeros((BITS + 1, BITS), np.int64)
    for row in summed.collect():
        both[row.bit, row.other] = row.n
    return int(both[BITS, 0]), both[:BITS]


def group_bits(rows: int, both: np.ndarray, partitions: int = PARTITIONS) -> list[list[int]]:
    """Bits of each partition: from the bits of strongest correlation on, each takes the bits most like its own.

    What is correlated lies together, so that the partitions say different things.
    """
    share = both / max(rows, 1)
    p = np.diag(share)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    like = np.abs((share - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(like, 0)
    free = set(range(BITS))
    groups = []
    for k in range(partitions):
        size = len(free) // (partitions - k)
        left = sorted(free)
        first = left[int(np.argmax(like[np.ix_(left, left)].sum(axis=1)))]
        group = [first]
        free.discard(first)
        while len(group) < size:
            left = sorted(free)
            best = left[int(np.argmax(like[np.ix_(left, group)].mean(axis=1)))]
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def project(values: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each value, packed into the low bits."""
    unsigned = values.view(np.uint64)
    out = np.zeros(len(values), np.uint64)
    for place, bit in enumerate(bits):
        out |= ((unsigned >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
    return out.view(np.int64)


def _halves(groups: list[list[int]]) -> list[tuple[list[int], list[int]]]:
    return [(g[: len(g) // 2], g[len(g) // 2 :]) for g in groups]


def half_shares(distinct: DataFrame, groups: list[list[int]], rows: int) -> list[list[np.ndarray]]:
    """For both halves of each partition and each value the share of fingerprints at distance 0, 1 and 2 of it.

    The tables have 2^(bits of a half) rows, whatever the number of fingerprints.
    """
    halves = [h for pair in _halves(groups) for h in pair]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros(1 << len(h), np.int64) for h in halves]
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for table, half in zip(tables, halves, strict=True):
                table += np.bincount(project(values, half), minlength=len(table))
        for k, table in enumerate(tables):
            seen = np.flatnonzero(table)
            columns = [pa.array(np.full(len(seen), k)), pa.array(seen), pa.array(table[seen])]
            yield pa.RecordBatch.from_arrays(columns, ["half", "value", "n"])

    counted = distinct.select("fingerprint").mapInArrow(count, "half bigint, value bigint, n bigint")
    tables = [np.zeros((DISTANCE + 1, 1 << len(h))) for h in halves]
    for row in counted.groupBy("half", "value").agg(F.sum("n").alias("n")).collect():
        tables[row.half][0, row.value] = row.n / max(rows, 1)
    for table, half in zip(tables, halves, strict=True):
        values = np.arange(table.shape[1])
        for distance in range(1, DISTANCE + 1):
            for flipped in combinations(range(len(half)), distance):
                table[distance] += table[0, values ^ sum(1 << b for b in flipped)]
    return [tables[i : i + 2] for i in range(0, len(tables), 2)]


def estimates(values: np.ndarray, groups: list[list[int]], shares: list[list[np.ndarray]], rows: int) -> np.ndarray:
    """Candidates of each value for each partition and each threshold from 0 on; the halves count as independent."""
    out = np.zeros((len(values), len(groups), DISTANCE + 1))
    for k, (low, high) in enumerate(_halves(groups)):
        a, b = shares[k][0][:, project(values, low)], shares[k][1][:, project(values, high)]
        for distance in range(DISTANCE + 1):
            exact = sum((a[i] * b[distance - i] for i in range(distance + 1)), np.zeros(len(values)))
            out[:, k, distance] = exact * rows + (out[:, k, distance - 1] if distance else 0)
    return out


def allocate(cost: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """Thresholds per value and partition (-1: not probed) of least total cost, by dynamic programming.

    ``cost`` has values, partitions and thresholds.  Over the partitions (threshold + 1) sums to ``distance`` + 1.
    """
    values, partitions, _ = cost.shape
    units = distance + 1
    best = np.full((values, units + 1), np.inf)
    best[:, 0] = 0
    taken = np.zeros((partitions, values, units + 1), np.int64)
    for k in range(partitions):
        now = np.full_like(best, np.inf)
        for spent in range(units + 1):
            for own in range(spent + 1):
                total = best[:, spent - own] + (cost[:, k, own - 1] if own else 0)
                better = total < now[:, spent]
                now[better, spent] = total[better]
                taken[k, better, spent] = own
        best = now
    thresholds = np.empty((values, partitions), np.int64)
    left = np.full(values, units)
    for k in range(partitions - 1, -1, -1):
        own = taken[k, np.arange(values), left]
        thresholds[:, k] = own - 1
        left = left - own
    return thresholds


def _balls(groups: list[list[int]]) -> list[list[np.ndarray]]:
    """For each partition the masks of 0, of at most 1 and of at most 2 flipped bits."""
    balls = []
    for group in groups:
        masks = [[0]]
        for distance in range(1, DISTANCE + 1):
            masks.append(masks[-1] + [sum(1 << b for b in flipped) for flipped in combinations(range(len(group)), distance)])
        balls.append([np.array(m, np.int64) for m in masks])
    return balls


_KEYS = "fingerprint bigint, part int, value bigint"


def _indexed(distinct: DataFrame, groups: list[list[int]]) -> DataFrame:
    """Each fingerprint under its value in every partition."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for k, group in enumerate(groups):
                columns = [batch.column(0), pa.array(np.full(len(batch), k, np.int32)), pa.array(project(values, group))]
                yield pa.RecordBatch.from_arrays(columns, ["fingerprint", "part", "value"])

    return distinct.select("fingerprint").mapInArrow(keys, _KEYS)


def _probes(distinct: DataFrame, groups: list[list[int]], shares: list[list[np.ndarray]], rows: int) -> DataFrame:
    """Each fingerprint with the values it looks up: those within its thresholds."""
    balls = _balls(groups)
    # Bounded: six halves of eleven bits by three distances.
    sent = distinct.sparkSession.sparkContext.broadcast(shares)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            cost = estimates(values, groups, sent.value, rows)
            # Looking up a value costs as much as verifying one candidate.
            for k in range(len(groups)):
                cost[:, k] += [len(masks) for masks in balls[k]]
            thresholds = allocate(cost)
            for k, group in enumerate(groups):
                own = project(values, group)
                for t in range(DISTANCE + 1):
                    chosen = np.flatnonzero(thresholds[:, k] == t)
                    if not len(chosen):
                        continue
                    masks = balls[k][t]
                    looked = (own[chosen][:, None] ^ masks[None, :]).ravel()
                    other = np.tile(masks != 0, len(chosen))
                    columns = [np.repeat(values[chosen], len(masks)), np.full(len(looked), k, np.int32), looked, other]
                    names = ["fingerprint", "part", "value", "other"]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return distinct.select("fingerprint").mapInArrow(probe, f"{_KEYS}, other boolean")


# -- links ------------------------------------------------------------------------------------------------


def links(distinct: DataFrame) -> DataFrame:
    """Pairs (a, b) of different fingerprints, enough of them to connect all that are within the distance.

    ``distinct`` holds each fingerprint once.  Its probes are first joined with the sizes of what they meet.  A
    fingerprint of few candidates verifies each of them.  Those of many (a family of near copies) are linked among
    themselves through centres: each stands under itself and the 64 values one bit away, and two of them are within
    two bits exactly if they share such a centre.  No centre has more than 65, all of them linked, so the least
    stands for all.  Both ways together miss no link, and neither forms all pairs of a group.
    """
    rows, both = bit_moments(distinct)
    groups = group_bits(rows, both)
    shares = half_shares(distinct, groups, rows)
    index = stored(_indexed(distinct, groups), "index")
    sizes = stored(index.groupBy("part", "value").agg(F.count("*").alias("n")), "sizes")
    probes = stored(_probes(distinct, groups, shares, rows).join(sizes, ["part", "value"]), "probes")
    met = stored(probes.groupBy("fingerprint").agg(F.sum("n").alias("met")), "met")
    crowded = met.filter(F.col("met") > MOST_CANDIDATES).select("fingerprint")
    few = met.filter(F.col("met") <= MOST_CANDIDATES).select("fingerprint")
    # Where a fingerprint is alone under its own value, there is nothing to verify.
    asked = probes.join(few, "fingerprint").filter("other OR n > 1").selectExpr("fingerprint AS a", "part", "value")
    asked = stored(asked, "asked")
    pairs = asked.join(index.withColumnRenamed("fingerprint", "b"), ["part", "value"])
    near = pairs.filter(f"a != b AND bit_count(a ^ b) <= {DISTANCE}").select("a", "b")
    around = ", ".join(f"fingerprint ^ shiftleft(1L, {b})" for b in range(BITS))
    centres = crowded.selectExpr("fingerprint", f"explode(array(fingerprint, {around})) AS centre")
    centres = stored(centres, "centres")
    least = centres.groupBy("centre").agg(F.min("fingerprint").alias("a"), F.count("*").alias("n")).filter("n > 1")
    starred = centres.join(least, "centre").filter("a != fingerprint").selectExpr("a", "fingerprint AS b")
    return near.unionByName(starred).selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct()


def near_components(documents: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id and component_size of each row.

    Rows whose fingerprints differ in at most two bits are linked; component_id is the least id that links reach,
    the row's own included, and null only where no id of the component is known.  Null and empty texts and those of
    white space have fingerprint 0 and are linked like any other; repeated rows stay rows of their own; an empty
    table has no rows.  Other columns are not looked at.
    """
    rows = stored(fingerprints(documents), "fingerprints")
    held = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "distinct")
    nodes = stored(connected(stored(links(held), "links")), "components")
    classes = stored(
        held.join(nodes.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").selectExpr(
            "fingerprint", "coalesce(component, fingerprint) AS component", "least", "n"
        ),
        "classes",
    )
    totals = classes.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("n").alias("component_size"))
    named = stored(classes.select("fingerprint", "component").join(stored(totals, "totals"), "component"), "named")
    return rows.join(named, "fingerprint").selectExpr(
        "doc_id", "lower(lpad(hex(fingerprint), 16, '0')) AS fingerprint", "component_id", "component_size"
    )


def keep_one(documents: DataFrame) -> DataFrame:
    """doc_id of one row of each component: its least id."""
    return near_components(documents).filter("doc_id = component_id").select("doc_id").distinct()
