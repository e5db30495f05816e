"""Near-duplicate documents by order MinHash, verified by banded alignment.

Similarity of two texts: their five-word shingles, each labelled with its occurrence, are aligned in order; it is
the number of aligned ones over the number of different ones, which is Jaccard similarity of the labelled shingles
where no order differs.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from lienflow.llm.common import (
    measured_broadcasts,
    mix,
    run_keys,
    runs,
    slices,
    small_batches,
    stored,
    text_bytes,
    text_or_empty,
)
from lienflow.llm.components import connected
from lienflow.session import scratch_path

SHINGLE = 5
SIMILARITY = 0.8
#: Sketches of a text, and the shingles in each.  Two texts of similarity 0.8 share one of 24 sketches of six with
#: a chance of 0.999; those of 0.5 with 0.3 and those of 0.3 with 0.02.
SKETCHES = 24
DEPTH = 6
#: Texts of few shingles also get sketches of two, since one shingle more or less changes most of those of six.
SHORT_SKETCHES = 12
SHORT_DEPTH = 2
SHORT_TO = 32
DEEP_FROM = 24
#: A leader with more pairs of untied members than these has them found by their differences from it.
PAIRS = 256

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEEDS = mix(np.arange(1, SKETCHES + SHORT_SKETCHES + 1, dtype=np.uint64), 77) | np.uint64(1)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (lower-cased runs of letters, digits and code points above 127), per text the first's index."""
    starts, ends, first = runs(_WORD[data], offsets)
    return run_keys(_LOWER[data], starts, ends), first


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the five-word shingles of one text in order, each with its occurrence; of fewer words one shingle."""
    if not len(words):
        return np.zeros(0, np.uint64)
    size = min(SHINGLE, len(words))
    hashed = mix(words[: len(words) - size + 1], 11)
    for k in range(1, size):
        hashed = mix(hashed * np.uint64(0x9E3779B97F4A7C15) + words[k : len(words) - size + 1 + k])
    order = np.argsort(hashed, kind="stable")
    ranked = hashed[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    if not fresh.all():
        place = np.arange(len(ranked))
        occurrence = np.empty(len(ranked), np.uint64)
        occurrence[order] = place - np.maximum.accumulate(np.where(fresh, place, 0))
        hashed = mix(hashed + occurrence * np.uint64(0xD6E8FEB86659FD93))
    return hashed


def _sketch(labelled: np.ndarray, seeds: np.ndarray, depth: int) -> np.ndarray:
    """For each seed the least ``depth`` shingles in text order, as one hash."""
    depth = min(depth, len(labelled))
    out = np.empty(len(seeds), np.uint64)
    # A long text is ranked a few seeds at a time.
    step = max(1, (1 << 19) // len(labelled))
    for at in range(0, len(seeds), step):
        part = seeds[at : at + step]
        ranks = labelled[None, :] * part[:, None]
        ranks ^= ranks >> np.uint64(32)
        ranks *= np.uint64(0xD6E8FEB86659FD93)
        least = np.argpartition(ranks, depth - 1, axis=1)[:, :depth] if depth < len(labelled) else None
        where = np.sort(least, axis=1) if least is not None else np.tile(np.arange(depth), (len(part), 1))
        hashed = part.copy()
        for k in range(depth):
            hashed = mix(hashed * np.uint64(0x9E3779B97F4A7C15) + labelled[where[:, k]])
        out[at : at + step] = hashed
    return out


def sketches(labelled: np.ndarray) -> np.ndarray:
    """Bucket keys of a text: equal keys make two texts candidates."""
    parts = [np.zeros(0, np.uint64)]
    if len(labelled) >= DEEP_FROM:
        parts.append(_sketch(labelled, _SEEDS[:SKETCHES], DEPTH))
    if 0 < len(labelled) <= SHORT_TO:
        parts.append(_sketch(labelled, _SEEDS[SKETCHES:], SHORT_DEPTH))
    return np.concatenate(parts)


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Aligned labelled shingles over different ones; 0 where it cannot reach ``least``.

    Labels are unique within a text, so an alignment is a rising sequence of the places in ``b`` of the shared
    labels taken in the order of ``a``.  Texts that reach ``least`` leave few shingles unaligned, and a pair of
    places further apart than that number cannot be aligned: the band.
    """
    total = len(a) + len(b)
    if not total:
        return 1.0
    needed = int(np.ceil(least * total / (1 + least) - 1e-9))
    if min(len(a), len(b)) < needed:
        return 0.0
    order = np.argsort(b)
    at = np.minimum(np.searchsorted(b, a, sorter=order), len(b) - 1)
    place = order[at]
    shared = b[place] == a
    where, place = np.flatnonzero(shared), place[shared]
    inside = np.abs(where - place) <= total - 2 * needed
    place = place[inside]
    if len(place) < needed:
        return 0.0
    aligned = len(place)
    if (np.diff(place) < 0).any():
        rising: list[int] = []
        for p in place.tolist():
            k = bisect_left(rising, p)
            rising[k : k + 1] = [p]
        aligned = len(rising)
    found = aligned / (total - aligned)
    return found if found >= least else 0.0


_SKETCHED = "doc_id bigint, k1 bigint, k2 bigint, node binary, buckets array<bigint>"


def sketch_documents(documents: DataFrame) -> DataFrame:
    """doc_id, a 128-bit key of the row's id and text, the node (its words, 128 bits) and bucket keys of each row.

    Texts of the same words are one node.  A text without words is a node by its characters.
    """
    from xxhash import xxh3_128_digest

    spark = documents.sparkSession
    small_batches(spark)
    schema = to_arrow_schema(spark.createDataFrame([], _SKETCHED).schema)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3):
            data, offsets = text_bytes(batch.column(3))
            words, first = word_hashes(data, offsets)
            nodes, buckets = [], []
            for i in range(len(batch)):
                own = words[first[i] : first[i + 1]]
                if len(own):
                    nodes.append(xxh3_128_digest(own.tobytes()))
                    # A text of fewer words than a shingle has no near copies but those of the same words.
                    keys = sketches(shingles(own)) if len(own) >= SHINGLE else own[:0]
                else:
                    nodes.append(xxh3_128_digest(b"text:" + data[offsets[i] : offsets[i + 1]].tobytes()))
                    keys = own
                buckets.append(keys.view(np.int64))
            columns = [*batch.columns[:3], pa.array(nodes, pa.binary()), pa.array(buckets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), *_row_key("doc_id", "text"), text_or_empty("text").alias("text"))
    return rows.mapInArrow(sketch, _SKETCHED)


def _row_key(id_column: str, text: str):
    return (
        F.xxhash64(F.col(id_column), F.col(text)).alias("k1"),
        F.xxhash64(F.lit("second"), F.col(text), F.col(id_column)).alias("k2"),
    )


def _verified(edges: DataFrame, words: DataFrame) -> DataFrame:
    """The pairs (a, b) with whether they are similar; ``words`` has the hashed words of each node."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(i).to_pylist() for i in (2, 3))
            same = []
            last: tuple = (None, None)
            for x, y in zip(left, right, strict=True):
                if x != last[0]:
                    last = (x, shingles(np.frombuffer(x, "<u4").astype(np.uint64)))
                same.append(similarity(last[1], shingles(np.frombuffer(y, "<u4").astype(np.uint64))) >= SIMILARITY)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(same)], ["a", "b", "same"])

    # Two long texts in a row: fewer rows at once.
    edges.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200")
    pairs = edges.join(words.selectExpr("node AS b", "words AS wb"), "b").join(
        words.selectExpr("node AS a", "words AS wa"), "a"
    )
    return pairs.select("a", "b", "wa", "wb").mapInArrow(check, "a binary, b binary, same boolean")


def _words_of(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """Hashed words of the given nodes, each once; ``k1`` picks one row of each out of the documents."""
    rows = documents.select(*_row_key("doc_id", "text")[:1], text_or_empty("text").alias("text"))
    chosen = rows.join(nodes, "k1").select("node", "text")

    def hash_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            words, first = word_hashes(*text_bytes(batch.column(1)))
            words = (words >> np.uint64(32)).astype("<u4")
            packed = pa.array([words[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed], ["node", "words"])

    # Rows of one k1 are alike but for chance; one of them stands for the node.
    return chosen.mapInArrow(hash_words, "node binary, words binary").dropDuplicates(["node"])


def similar_nodes(documents: DataFrame, sketched: DataFrame) -> DataFrame:
    """node and component (its least node) of the nodes that are similar to others, directly or by way of others.

    Members of a bucket are compared with its two leaders, those that share most buckets with others, which are
    nearest to all.  Those unlike both go on without them, first as they are, then apart by one more sketch each
    time, until no two are left together; so the work grows with the members of a bucket, not their square.  That
    ties most of what belongs together.  The pairs of a bucket that no leader has compared, that are not tied yet and
    that may be similar are compared afterwards (``_left_pairs``), so that no two similar members of a bucket stay apart.

    What a bucket's key is joined with is stored first: the runtime splits a hot key only where both sides of a
    join come straight from a shuffle.
    """
    nodes = sketched.filter("size(buckets) > 0").groupBy("node").agg(F.min(F.struct("k1", "buckets")).alias("r"))
    members = nodes.select("node", F.explode("r.buckets").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = stored(members.join(stored(shared, "shared"), "bucket"), "members")
    weight = members.groupBy("node").agg(F.sum("n").alias("weight"))
    opened = stored(members.select("node", "bucket").join(weight, "node"), "opened")
    one_row = sketched.groupBy("node").agg(F.min("k1").alias("k1"))
    words = stored(_words_of(documents, opened.select("node").distinct().join(one_row, "node")), "words")
    extra = nodes.selectExpr("node", "r.buckets AS more")

    # What was compared so far is one table that every turn adds to: a plan has one scan of it, however many turns.
    compared = scratch_path(documents.sparkSession, "known")
    checked = first = None
    for turn in range(SKETCHES + SHORT_SKETCHES):
        led = _led(opened, "leader")
        second = _led(led, "second")
        led = stored(led.join(second.select("bucket", "node", "second"), ["bucket", "node"], "left"), "led")
        if led.isEmpty():
            break
        if first is None:
            first = led.select("leader", "node").distinct()
        edges = led.selectExpr("leader AS a", "node AS b").unionByName(
            led.filter("second IS NOT NULL").selectExpr("second AS a", "node AS b")
        )
        edges = edges.distinct()
        new = edges if checked is None else edges.join(checked, ["a", "b"], "left_anti")
        known = _verified(new, words)
        known.write.mode("append").parquet(compared)
        checked = known.sparkSession.read.schema(known.schema).parquet(compared)
        unlike = checked.filter("NOT same")
        rest = led.join(unlike.selectExpr("a AS leader", "b AS node"), ["leader", "node"], "left_semi")
        alone = rest.filter("second IS NULL")
        twice = rest.join(unlike.selectExpr("a AS second", "b AS node"), ["second", "node"], "left_semi")
        rest = twice.select("node", "bucket", "weight").unionByName(alone.select("node", "bucket", "weight"))
        if turn:
            split = F.expr(f"xxhash64(bucket, element_at(more, {turn} % size(more) + 1))")
            rest = rest.join(extra, "node").select("node", split.alias("bucket"), "weight")
        opened = stored(rest, "opened")
    if checked is None:
        return members.selectExpr("node", "node AS component").limit(0)
    tied = stored(connected(checked.filter("same").select("a", "b")), "tied")
    groups = first.join(tied, "node", "left").selectExpr("leader", "node", "coalesce(component, node) AS component")
    left = _left_pairs(stored(groups, "groups"), words)
    seen = checked.selectExpr("least(a, b) AS a", "greatest(a, b) AS b")
    late = stored(_verified(left.join(seen, ["a", "b"], "left_anti"), words), "late").filter("same")
    # The late ties join whole components.
    at = {c: tied.selectExpr(f"node AS {c}", f"component AS c{c}") for c in "ab"}
    joined = late.select("a", "b").join(at["a"], "a", "left").join(at["b"], "b", "left")
    roots = stored(connected(joined.selectExpr("coalesce(ca, a) AS a", "coalesce(cb, b) AS b")), "roots")
    whole = tied.unionByName(roots.selectExpr("node", "node AS component")).distinct()
    merged = whole.join(roots.selectExpr("node AS component", "component AS root"), "component", "left")
    return merged.selectExpr("node", "coalesce(root, component) AS component")


def _left_pairs(groups: DataFrame, words: DataFrame) -> DataFrame:
    """Pairs (a < b) of nodes with a common leader that are not tied; ``groups`` has leader, node and component.

    Of a leader with more such pairs than ``PAIRS`` those are left out whose differences from it tell that they
    cannot be similar (``_near_pairs``).  That leaves out none that are similar.
    """
    mixed = stored(_mixed(groups, "leader"), "mixed")
    pairs = _across(groups, mixed.filter(f"(n - most) * n <= {PAIRS}"), "leader")
    many = groups.join(mixed.filter(f"(n - most) * n > {PAIRS}").select("leader"), "leader", "left_semi")
    many = stored(many, "crowded")
    if many.isEmpty():
        return pairs.distinct()
    return pairs.unionByName(_near_pairs(_differences(many, words))).distinct()


def _differences(groups: DataFrame, words: DataFrame) -> DataFrame:
    """member (a number), leader, node, component, size (shingles of the node), led (of the leader) and apart.

    ``apart`` has the labelled shingles that only one of node and leader has.
    """

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, leds, apart = [], [], []
            last: tuple = (None, None)
            for x, y in zip(*(batch.column(i).to_pylist() for i in (3, 4)), strict=True):
                if x != last[0]:
                    last = (x, shingles(np.frombuffer(x, "<u4").astype(np.uint64)))
                own = shingles(np.frombuffer(y, "<u4").astype(np.uint64))
                sizes.append(len(own))
                leds.append(len(last[1]))
                apart.append(np.setxor1d(own, last[1], assume_unique=True).view(np.int64))
            columns = [pa.array(sizes, pa.int64()), pa.array(leds, pa.int64()), pa.array(apart, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], [*names, "size", "led", "apart"])

    names = ["leader", "node", "component"]
    pairs = groups.join(words.selectExpr("node", "words AS wb"), "node").join(
        words.selectExpr("node AS leader", "words AS wa"), "leader"
    )
    schema = "leader binary, node binary, component binary, size bigint, led bigint, apart array<bigint>"
    found = pairs.select(*names, "wa", "wb").mapInArrow(differ, schema)
    return stored(found.withColumn("member", F.monotonically_increasing_id()), "differences")


def _near_pairs(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components that may be similar, by their differences from the common leader.

    Texts of na and nb shingles reach 0.8 only where at most t = (na + nb) / 9 shingles are in one alone.  With da and
    db differences from the leader, all but t of these are common, so o = (da + db - t) / 2 and more are.  Two texts
    that are both near the leader are tied by it; of all other pairs one text is far, with more differences than a
    ninth of its and the leader's shingles, and o is above 0.  With the differences of all texts in one order, the
    rarest first, the first common one then has o - 1 others behind it in both texts.  So a text meets far ones by its
    differences ahead of that place: about the rarer half of them, and never more than a quarter of its shingles.

    Near texts that are not tied, since their shingles come in another order, are paired as they are.
    """
    far = F.expr("9 * d > size + led")
    members = members.withColumn("d", F.expr("bigint(size(apart))"))
    close = members.filter(~far).select("leader", "node", "component")
    reordered = _across(close, _mixed(close, "leader"), "leader")
    # A hash stands for leader and shingle: equal ones of different shingles only add a pair to compare.
    each = members.selectExpr("member", "leader", "explode(apart) AS shingle").selectExpr("member", "xxhash64(leader, shingle) AS at")
    common = stored(each.groupBy("at").agg(F.count("*").alias("texts")).filter("texts > 1"), "texts")
    held = Window.partitionBy("member")
    behind = F.count("*").over(held) - F.row_number().over(held.orderBy("texts", "at"))
    facts = members.select("member", "node", "component", "size", "led", "d", far.alias("far"))
    placed = stored(each.join(common, "at").select("member", "at", behind.alias("behind")), "behind")
    # What no other text has comes first in the order and finds nothing.
    ahead = "d - behind <= least(greatest(d - greatest(ceil((9 * d + led - size) / 18), 1) + 1, 0), size div 4 + 1)"
    placed = placed.join(stored(facts, "facts"), "member")
    one = stored(placed.filter(ahead).drop("member", "led", "far"), "ahead")
    two = placed.filter("far AND d - behind <= size div 4 + 1")
    two = two.selectExpr("at", *[f"{c} AS other_{c}" for c in ("node", "component", "size", "d", "behind")])
    shared = "(d + other_d - (size + other_size) div 9 + 1) div 2"
    pairs = one.join(stored(two, "far"), "at").filter(
        f"component != other_component AND {shared} <= 1 + least(behind, other_behind)"
    )
    return pairs.selectExpr("least(node, other_node) AS a", "greatest(node, other_node) AS b").unionByName(reordered)


def _mixed(members: DataFrame, key: str) -> DataFrame:
    """The keys whose members are of several components: how many there are, and the largest component's."""
    held = members.groupBy(key, "component").agg(F.count("*").alias("m"))
    of = held.groupBy(key).agg(F.sum("m").alias("n"), F.max(F.struct("m", "component")).alias("top"), F.count("*").alias("parts"))
    return of.filter("parts > 1").selectExpr(key, "n", "top.m AS most", "top.component AS top")


def _across(members: DataFrame, mixed: DataFrame, key: str) -> DataFrame:
    """The pairs of members of a key of different components: one of the two is outside of the largest."""
    inside = stored(members.join(stored(mixed.select(key, "top"), "keys"), key), "inside")
    outside = stored(inside.filter("component != top").selectExpr(key, "node AS other", "component AS apart"), "outside")
    pairs = inside.join(outside, key).filter("component != apart")
    return pairs.selectExpr("least(node, other) AS a", "greatest(node, other) AS b")


def _led(members: DataFrame, name: str) -> DataFrame:
    """The members of each bucket but its leader, with the leader."""
    leaders = members.groupBy("bucket").agg(F.max(F.struct("weight", "node")).alias("top"), F.count("*").alias("n"))
    leaders = leaders.filter("n > 1").select("bucket", F.col("top.node").alias(name))
    return stored(members.join(stored(leaders, name), "bucket").filter(F.col("node") != F.col(name)), f"{name}-led")


def duplicate_classes(documents: DataFrame) -> DataFrame:
    """doc_id, k1, k2 of each row with the class it belongs to: class_id, its least id, and class_size, its rows.

    Texts of the same words are exact copies; texts of similarity 0.8 and more are near copies; classes are what
    these ties connect.  Null and empty texts are alike, and so are texts without words of the same characters.
    Null ids are not the least unless all are.
    """
    sketched = stored(sketch_documents(documents), "sketches")
    with measured_broadcasts(documents.sparkSession):
        components = stored(similar_nodes(documents, sketched), "components")
        rows = (
            sketched.drop("buckets")
            .join(components, "node", "left")
            .select("doc_id", "k1", "k2", F.expr("coalesce(component, node)").alias("component"))
        )
        rows = stored(rows, "classes")
    classes = rows.groupBy("component").agg(
        F.min("doc_id").alias("class_id"),
        F.count("*").alias("class_size"),
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "k1", "k2")).alias("kept"),
    )
    return rows.join(stored(classes, "class"), "component").selectExpr(
        "doc_id", "k1", "k2", "class_id", "class_size", "k1 = kept.k1 AND k2 = kept.k2 AS kept"
    )


def keep_one(documents: DataFrame) -> DataFrame:
    """One row of each class, columns as they are: the least id, then the least key; of repeated rows one stays."""
    kept = duplicate_classes(documents).filter("kept").select("k1", "k2").distinct()
    wide = documents.select(F.struct("*").alias("row"), *_row_key("doc_id", "text"))
    one = wide.join(kept, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    return one.select("row.*")
