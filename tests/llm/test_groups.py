"""Operators that set texts against each other."""

import random
import re
import time
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from made_up import near_copies, prose
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lienflow.llm import components, licences, near_dup, placement, quality_sampling, queries, repeated_bytes, token_store
from lienflow.llm.common import text_bytes


def rows(frame, *columns):
    return Counter(tuple(r) for r in frame.select(*columns).collect())


def test_token_store(spark, frame, empty, docs):
    tokenizer = queries.tokenizer_path("word_bpe_49k.json")
    found = token_store.stored_documents(frame, tokenizer).cache()
    want = brute.token_store(docs)
    # Rows of one id may stand in any order, so only those of single ids have a start of their own.
    single = {k for k, n in Counter(d[0] for d in docs).items() if n == 1}
    got = [tuple(r)[:4] for r in found.collect()]
    assert Counter(r for r in got if r[0] in single) == Counter(r for r in want if r[0] in single)
    assert Counter(r[2:] for r in got) == Counter(r[2:] for r in want)
    slots = [tuple(r) for r in found.filter("doc_id IS NOT NULL").select("bucket", "slot").distinct().collect()]
    assert len(slots) == len({d[0] for d in docs if d[0] is not None})
    assert token_store.stored_documents(empty, tokenizer).count() == 0


def test_keyed_access(spark, frame, docs):
    tokenizer = queries.tokenizer_path("word_bpe_49k.json")
    store = token_store.write_store(frame, tokenizer)
    asked = spark.createDataFrame([(0,), (210,), (200,), (999_999,), (None,), (0,)], "key bigint")
    found = {r["key"]: r["ids"] for r in token_store.fetch(asked, store).collect()}
    assert set(found) == {0, 210, 200} and found[200] == [2]
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer)
    for key in (0, 210):
        assert found[key] == [*library.encode(dict(docs)[key], add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("size", [1, 2, 3, 17, 300])
def test_perfect_hash(size):
    keys = np.random.default_rng(size).integers(0, 1 << 62, size).astype(np.uint64)
    seed, pilots = token_store._hash_table(keys, size)
    assert sorted(token_store._slots(keys, size, seed, pilots)) == list(range(size))


def test_repeats(frame, empty, docs):
    found = repeated_bytes.removal_digests(frame)
    assert rows(found, *found.columns) == Counter(brute.removal(docs))
    assert repeated_bytes.removal_digests(empty).count() == 0
    whole = {r["doc_id"]: r["text"] for r in repeated_bytes.remove_repeats(frame).collect()}
    assert whole[101] == "" and whole[0] == docs[0][1] and whole[200] is None


def test_repeats_leave_no_shuffles(spark, frame):
    """What a pass has moved is off the disk when it is done, however long the driver collects no garbage."""

    def held():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {b for b in (blocks.apply(i).toString() for i in range(blocks.size())) if b.startswith("shuffle_")}

    before = held()
    repeated_bytes.removal_digests(frame).collect()
    for _ in range(50):
        left = held() - before
        if not left:
            break
        time.sleep(0.2)
    assert not left


@pytest.mark.parametrize("seed", range(3))
def test_repeats_of_little_variety(spark, seed):
    rng = random.Random(seed)
    parts = ["".join(rng.choice("ab") for _ in range(rng.randint(5, 90))) for _ in range(12)] + ["a" * 70, "ab" * 40]
    docs = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = repeated_bytes.removal_digests(frame, length=40, gram=8)
    assert rows(found, *found.columns) == Counter(brute.removal(docs, 40))


def test_classes(frame, empty, docs):
    found = near_dup.duplicate_classes(frame)
    assert rows(found, "doc_id", "class_id") == Counter(brute.classes(docs))
    assert near_dup.duplicate_classes(empty).count() == 0


def test_one_of_each_class_stays(frame, docs):
    kept = near_dup.keep_one(frame)
    assert kept.columns == frame.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    want = Counter({c for _, c in brute.classes(docs) if c is not None})
    assert Counter({k: n for k, n in ids.items() if k is not None}) == want
    assert ids[100] == 1


def test_recall_of_near_copies(spark):
    docs = near_copies(30, 12)
    found = near_dup.duplicate_classes(spark.createDataFrame(docs, "doc_id bigint, text string"))
    got = dict(found.select("doc_id", "class_id").collect())
    want = dict(brute.classes(docs))
    assert sum(got[k] == want[k] for k in want) >= 0.98 * len(want)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=30, unique=True), st.lists(st.integers(0, 40), max_size=30, unique=True))
def test_similarity(a, b):
    n = brute.aligned(a, b)
    total = len(a) + len(b)
    want = n / (total - n) if total else 1.0
    found = near_dup.similarity(np.array(a, np.uint64), np.array(b, np.uint64), 0.5)
    assert found == pytest.approx(want if want >= 0.5 else 0)


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60) if i % 7] + [(rng.randrange(100, 140), 100) for _ in range(80)]
    found = dict(tuple(r) for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect())
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    assert found == {x: root(x) for x in parent}


def quality_rows(n):
    rng = random.Random(8)
    good = [f"{a}{b}" for a in "bcdfg" for b in ("ake", "orn", "ulet", "istle")]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(good) for _ in range(rng.randint(30, 120))]
        quality, toxic = int(rng.random() > 0.15), int(rng.random() < 0.1)
        if not quality:
            words = [w.upper() + "!!" for w in words]
        if toxic:
            for _ in range(6):
                words[rng.randrange(len(words))] = rng.choice(["vilest", "wretch"])
        rows.append((i, " ".join(words)))
        labels.append((i, quality, toxic))
    return rows, labels


def test_resampling_on_held_out_rows(spark):
    rows, labels = quality_rows(1500)
    documents = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame(labels[:900] + [(3, None, None), (None, 1, 0), labels[5]], "doc_id bigint, quality int, toxic int")
    ratio, scored = quality_sampling.resample(documents, known)
    selected = {r["doc_id"]: r["selected"] for r in scored.collect()}
    unseen = [(selected[i], q == 1 and not t) for i, q, t in labels[900:]]
    assert sum(s for s, good in unseen if good) >= 0.97 * sum(good for _, good in unseen)
    assert sum(not s for s, good in unseen if not good) >= 0.95 * sum(not good for _, good in unseen)
    kept = {r["doc_id"] for r in quality_sampling.keep_selected(documents, ratio).collect()}
    assert kept == {i for i, s in selected.items() if s}


def test_resampling_of_odd_rows(spark, frame, empty):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id bigint, quality int, toxic int")
    ratio, scored = quality_sampling.resample(frame, labels)
    assert scored.count() == frame.count() and scored.filter("selected IS NULL").count() == 0
    kept = quality_sampling.keep_selected(frame, ratio)
    assert kept.columns == frame.columns and kept.count() == scored.filter("selected").count()
    ratio, scored = quality_sampling.resample(frame, labels.limit(0))
    assert scored.filter("selected").count() == frame.count()
    ratio, scored = quality_sampling.resample(empty, labels)
    assert scored.count() == 0 and quality_sampling.keep_selected(empty, ratio).count() == 0


def test_kth_largest(spark):
    values = [random.Random(4).gauss(0, 3) for _ in range(500)]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    for k in (1, 7, 499, 500, 900):
        assert quality_sampling.kth_largest(frame, "v", k) == sorted(values, reverse=True)[min(k, 500) - 1]
    assert quality_sampling.kth_largest(frame, "v", 0) == float("inf")


def test_licences(spark, frame, empty):
    rows = [
        (1, "a/b/LICENSE", "Licensed under the MIT License."),
        (2, "a/b/c/d.txt", "plain text"),
        (3, "a/b/c/e.txt", "x\nLicensed under the Apache License, Version 2.0.\ny"),
        (4, "a/f.txt", "plain"),
        (5, "a/g/LICENSE.txt", "Licensed under CC BY-NC 4.0."),
        (6, "a/g/h/i.txt", None),
        (7, None, "Licensed under the GPL-3.0."),
        (8, "a/b/c/d.txt", ""),
        (2, "a/b/c/d.txt", "plain text"),
        (9, "top.txt", "a driving licence is not a notice of this kind at all, copyright or not"),
    ]
    documents = spark.createDataFrame(rows, "doc_id bigint, path string, text string")
    found = licences.scan_licences(documents, "path", queries.LICENCE_FILE)
    got = sorted((r["doc_id"], r["licence"], r["origin"]) for r in found.select("doc_id", F.coalesce("licence", F.lit("")).alias("licence"), "origin").collect())
    assert got == [
        (1, "MIT", "own"),
        (2, "MIT", "inherited"),
        (2, "MIT", "inherited"),
        (3, "Apache-2.0", "own"),
        (4, "", "none"),
        (5, "CC-BY-NC-4.0", "own"),
        (6, "CC-BY-NC-4.0", "inherited"),
        (7, "GPL-3.0", "own"),
        (8, "MIT", "inherited"),
        (9, "", "none"),
    ]
    assert licences.scan_licences(frame, queries.PATH, queries.LICENCE_FILE).count() == frame.count()
    assert licences.scan_licences(empty, queries.PATH, queries.LICENCE_FILE).count() == 0


def test_the_root_governs_all(spark):
    rows = [
        (1, "LICENSE", "Licensed under the MIT License."),
        (2, "top.txt", "plain"),
        (3, "a/b/c.txt", "plain"),
        (4, "d/LICENSE", "Licensed under CC BY-NC 4.0."),
        (5, "d/e/f.txt", "plain"),
        (6, "/abs/g.txt", "plain"),
        (7, "", "plain"),
        (8, None, None),
    ]
    found = licences.scan_licences(spark.createDataFrame(rows, "doc_id int, path string, text string"), "path", queries.LICENCE_FILE)
    got = {r["doc_id"]: r["licence"] for r in found.collect()}
    assert got == {1: "MIT", 2: "MIT", 3: "MIT", 4: "CC-BY-NC-4.0", 5: "CC-BY-NC-4.0", 6: "MIT", 7: None, 8: None}


def test_short_texts_are_spread(spark):
    """Texts without a string of full length go through no join, so none of them shares a key with the others."""
    short = spark.range(4000).selectExpr("id AS doc_id", "concat('short text ', id) AS text").repartition(8)
    long = spark.range(40).selectExpr("id + 10000 AS doc_id", "repeat('abc ', 200) AS text")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = repeated_bytes.removal_digests(short.unionByName(long))
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sum(sizes) == 4040 and max(sizes) < 1000


def test_licences_of_the_table(spark):
    """Every notice of the given table has its licence, and the directories of licence files pass it on."""
    plain = {
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Released under the MIT License.": "MIT",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "All rights reserved.": "Proprietary",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    }
    sf = "/root/testdata/sf0.01"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    want = {k: {plain[line] for line in (t or "").split("\n") if line in plain} for k, t in texts.items()}
    assert set().union(*want.values()) == set(plain.values())
    found = queries.op9_licences(spark, sf).collect()
    assert all(r["licence"] in want[r["doc_id"]] and r["origin"] == "own" for r in found if want[r["doc_id"]])
    given = {}
    for r in found:
        if "/LICENSE." in r["path"] and r["origin"] == "own":
            given.setdefault(r["path"].rpartition("/")[0], set()).add(r["licence"])
    for r in found:
        if not want[r["doc_id"]]:
            above = given.get(r["path"].rpartition("/")[0])
            assert r["origin"] == ("inherited" if above else "none") and r["licence"] in (above or {None})


def test_placement(spark, frame, empty, tmp_path):
    shards = [f"s{i}" for i in range(7)]
    table = placement.fill_table(shards, 101)
    assert set(Counter(table).values()) <= {14, 15}
    fewer = placement.fill_table(shards[:-1], 101)
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != "s6")
    assert moved < 101 / 3
    assert placement.fill_table(shards[::-1] + shards, 101) == table
    with pytest.raises(ValueError):
        placement.fill_table(shards, 100)
    placed = {}
    for row in placement.place(frame, shards, slots=101).collect():
        assert placed.setdefault(row["doc_id"], row["shard"]) == row["shard"] == table[row["slot"]]
    assert len(placed) == frame.select("doc_id").distinct().count()
    assert placement.place(empty, shards).count() == 0
    placement.write_sharded(frame, shards, str(tmp_path / "out"), slots=101)
    assert spark.read.parquet(str(tmp_path / "out")).count() == frame.count()


@pytest.mark.parametrize("pairs", [4096, 0])
def test_members_of_a_bucket_are_all_compared(spark, monkeypatch, pairs):
    """Of a bucket's pairs none is left out because one of the two is like a leader, by either way."""
    monkeypatch.setattr(near_dup, "PAIRS", pairs)
    base = [f"w{i}" for i in range(60)]

    def changed(*places):
        return " ".join(f"x{i}" if i in places else w for i, w in enumerate(base))

    # Each changes two words more: neighbours are similar, those further apart are not.
    texts = [changed(*range(4, 4 + n)) for n in range(0, 18, 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    hashed = [near_dup.shingles(near_dup.word_hashes(*text_bytes(pa.array([t])))[0]) for t in texts]
    links = [(a, b) for a in range(len(texts)) for b in range(a) if near_dup.similarity(hashed[a], hashed[b])]
    # All in one bucket, and every node led by the first one only.
    sketched = near_dup.stored(near_dup.sketch_documents(docs).withColumn("buckets", F.expr("array(1L)")), "sketched")
    expected = list(range(len(texts)))
    for _ in texts:
        for a, b in links:
            expected[a] = expected[b] = min(expected[a], expected[b])
    found = near_dup.similar_nodes(docs, sketched).join(sketched, "node", "right")
    classes = {}
    for r in found.collect():
        classes.setdefault(bytes(r.component or r.node), set()).add(r.doc_id)
    assert sorted(map(sorted, classes.values())) == sorted(sorted(i for i, e in enumerate(expected) if e == c) for c in set(expected))


def test_copies_that_differ_in_many_places_meet_few(spark):
    """Copies of one text, each too far from it and from the others: pairs follow the copies, not their square."""
    rng, n = random.Random(11), 120
    base = prose(rng, 100).split()
    texts = []
    for i in range(n):
        words = list(base)
        for k in rng.sample(range(100), 5):
            words[k] = f"new{i}x{k}"
        texts.append(" ".join(words))
    # Three more are copies of copies.
    texts += [t + " end" for t in texts[:3]]
    rows = [(i, " ".join(base) if i < 0 else texts[i]) for i in range(-1, len(texts))]
    hashed, first = near_dup.word_hashes(*text_bytes(pa.array([t for _, t in rows])))
    packed = [(hashed[a:b] >> np.uint64(32)).astype("<u4").tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
    node = [i.to_bytes(2, "big") for i in range(len(rows))]
    words = spark.createDataFrame([(bytearray(k), bytearray(w)) for k, w in zip(node, packed, strict=True)], "node binary, words binary")
    groups = words.filter(F.col("node") != F.lit(bytearray(node[0]))).selectExpr("unhex('0000') AS leader", "node", "node AS component")
    found = {(int.from_bytes(r.a, "big"), int.from_bytes(r.b, "big")) for r in near_dup._left_pairs(groups, words).collect()}
    assert found >= {(1 + i, 1 + n + i) for i in range(3)}
    assert len(found) < n


def test_joins_send_what_the_runtime_measures(spark, monkeypatch):
    """No side is broadcast by the size of its file, and a plan scans what was compared once, however many turns."""
    plans, write = [], near_dup.stored

    def noted(rows, name):
        plans.append(rows._jdf.queryExecution().sparkPlan().toString())
        return write(rows, name)

    monkeypatch.setattr(near_dup, "stored", noted)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(f"x{i}" if i in range(4, 4 + n) else w for i, w in enumerate(base)) for n in range(0, 18, 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    assert near_dup.duplicate_classes(docs).count() == len(texts)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before
    assert sum("Join" in p for p in plans) > 5 and not any("BroadcastHashJoin" in p for p in plans)
    assert max(len(re.findall(r"FileScan parquet \[a#\d+,b#\d+,same#", p)) for p in plans) in (1, 2, 3)
