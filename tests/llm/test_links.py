"""Hard negatives, token alignment and SimHash against plain versions."""

import random
from collections import Counter

import brute
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from made_up import near_copies

from lienflow.llm import hard_negatives, queries, simhash, token_alignment
from lienflow.llm.common import stored
from lienflow.llm.components import connected

SF = "/root/testdata/sf0.001"
MODELS = "byte_bpe_50k.json", "piece_bpe_32k.model"
ALIGNED = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
MINED = "anchor_id positive_id rank negative_id positive_score negative_score".split()


def models():
    return [queries.tokenizer_path(m) for m in MODELS]


def counted(frame, columns):
    return Counter(tuple(r) for r in frame.select(*columns).collect())


def table(name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{SF}/{name}.parquet'").fetchall()


# -- hard negatives ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("shape", [(1, 1, 1), (128, 64, 700), (37, 65, 301), (17, 1, 40), (33, 33, 33), (0, 5, 7), (40, 0, 40)])
def test_strassen(shape):
    rng = np.random.default_rng(3)
    m, k, n = shape
    a, b = rng.integers(-(2**25), 2**25, (m, k)), rng.integers(-(2**25), 2**25, (k, n))
    assert (hard_negatives.strassen(a, b) == a @ b).all()


def test_hard_negatives_query(spark):
    found = queries.op11_hard_negatives(spark, SF)
    rows = table("embeddings", "vec_id, embedding, label")
    expected = Counter(brute.hard_negatives(rows))
    assert counted(found, MINED) == expected
    sql = queries.ORACLES["op11_hard_negatives"].replace("FROM embeddings", f"FROM '{SF}/embeddings.parquet'")
    names = [c[0] for c in duckdb.sql(sql).description]
    assert Counter(tuple(dict(zip(names, r))[c] for c in MINED) for r in duckdb.sql(sql).fetchall()) == expected


def test_hard_negatives_of_odd_rows(spark, monkeypatch):
    """Ties, repeated rows and anchors, a hot label, short, empty and broken vectors, many small tiles."""
    monkeypatch.setattr(hard_negatives, "TILE_BYTES", 8 * 5 * 16)
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 2)
    rng = random.Random(4)
    rows = []
    for i in range(400):
        vector = [rng.choice([-0.5, 0.0, 0.25, 0.3, 1.0]) for _ in range(5 if i % 9 else 3)]
        rows.append((i, vector, 1 if i % 3 == 0 else rng.randrange(10)))
    rows += [rows[100], rows[200], rows[201], rows[7]]
    rows += [(500, None, 1), (501, [1.0, None], 1), (502, [float("nan")], 1), (503, [float("inf")], 2), (504, [1.0], None)]
    rows += [(None, [1.0], 1), (600, [], 3), (-100, [1.0, 1.0, 1.0, 1.0, 1.0], 1)]
    schema = "vec_id bigint, embedding array<float>, label int, tile string, v string, score string"
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], schema)
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], n) for i, v, n in rows]
    assert counted(hard_negatives.hard_negatives(frame), MINED) == Counter(brute.hard_negatives(single))
    assert hard_negatives.hard_negatives(frame.limit(0)).count() == 0
    assert hard_negatives.hard_negatives(frame.filter("vec_id = 600")).count() == 0
    with pytest.raises(ValueError, match="do not fit"):
        hard_negatives.hard_negatives(spark.createDataFrame([(0, [1e30], 1), (1, [1e30], 1)], "vec_id int, embedding array<float>, label int"))


# -- token alignment --------------------------------------------------------------------------------------


def test_alignment_query(spark):
    found = queries.op12_token_alignment(spark, SF)
    assert counted(found, ALIGNED) == Counter(brute.token_alignment(table("documents", "doc_id, text")))


def test_alignment_of_odd_rows(frame, empty, docs):
    assert counted(token_alignment.align_tokens(frame, *models()), ALIGNED) == Counter(brute.token_alignment(docs))
    assert token_alignment.align_tokens(empty, *models()).count() == 0


def test_alignment_in_many_runs(spark, monkeypatch):
    """Hundreds of runs, merged in several passes; a text of one word that has a third of all links."""
    for name, value in (("RUN_BYTES", 256), ("FAN_IN", 4), ("FRAME_PAIRS", 3), ("TABLE_CHUNKS", 50)):
        monkeypatch.setattr(token_alignment, name, value)
    rng = random.Random(8)
    bits = list("ab é\n\t ,.'s日😀") + ["  ", " ", " ", "\u0085", "　", " ", " the", " don't", "<|endoftext|>", "<s>", "▁", "́"]
    docs = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 30)))) for i in range(900)]
    docs += [(1000 + i, "the " * 40) for i in range(100)]
    found = token_alignment.align_tokens(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), *models())
    assert counted(found, ALIGNED) == Counter(brute.token_alignment(docs))


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 9)), max_size=30), max_size=6), st.integers(1, 5))
def test_merge_runs(runs, frame_pairs):
    packed, expected = [], Counter()
    for run in runs:
        own = Counter()
        for key, n in run:
            own[key] += n
        keys = np.array(sorted(own), np.int64)
        counts = np.array([own[k] for k in keys.tolist()], np.int64)
        cuts = range(0, len(keys), frame_pairs)
        packed.append(
            ([token_alignment.pack(np.diff(keys[i : i + frame_pairs], prepend=0)) for i in cuts], [token_alignment.pack(counts[i : i + frame_pairs]) for i in cuts])
        )
        expected.update(own)
    merged = [(k, n) for keys, counts in token_alignment.merge_runs(packed) for k, n in zip(keys.tolist(), counts.tolist())]
    assert merged == sorted(expected.items())


def test_cuts_are_safe():
    """Chunks cut into tokens by themselves give the tokens of the whole text."""
    table = token_alignment.ChunkLinks(*models())
    rng = random.Random(1)
    bits = list("abé\n\t ,.'1_") + [" "] * 6 + [" ", " ", "​", " ", "﻿", "日"]
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(20))
        padded = (" " + text).encode()
        cuts = token_alignment.cut_points(np.frombuffer(padded, np.uint8), np.array([0])).tolist()
        chunks = [padded[a:b].decode() for a, b in zip(cuts, [*cuts[1:], len(padded)])]
        a = [i for c in chunks for i in table.a.encode(c, add_special_tokens=False).ids]
        b = [i for c in chunks for i in table.b.encode(c[1:])]
        assert a == table.a.encode(" " + text, add_special_tokens=False).ids and b == table.b.encode(text)


# -- SimHash ----------------------------------------------------------------------------------------------


def test_simhash_query(spark):
    found = queries.op13_simhash(spark, SF)
    expected = Counter(brute.simhash(table("documents", "doc_id, text")))
    assert counted(found, ["doc_id", "fingerprint", "component_id"]) == expected


def test_simhash_of_odd_rows(spark, frame, empty, docs):
    columns = ["doc_id", "fingerprint", "component_id"]
    assert counted(simhash.near_components(frame), columns) == Counter(brute.simhash(docs))
    assert simhash.near_components(empty).count() == 0
    copies = near_copies(6, 12)
    copies += [(900 + i, copies[5][1]) for i in range(30)]
    found = simhash.near_components(spark.createDataFrame(copies, "doc_id bigint, text string"))
    assert counted(found, columns) == Counter(brute.simhash(copies))


def test_hard_negatives_in_blocks(spark, monkeypatch):
    """The driver holds one block of anchors, and the heaps of a task merge over all its tiles."""
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 1)
    monkeypatch.setattr(hard_negatives, "TILE_BYTES", 8 * 3 * 16)
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 2)
    rng = random.Random(6)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.3, 1.0]) for _ in range(3)], rng.randrange(4)) for i in range(300)]
    rows += [rows[100], rows[200]]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    held, blocks = [], hard_negatives._blocks
    monkeypatch.setattr(hard_negatives, "_blocks", lambda anchors: (held.append(len(b)) or b for b in blocks(anchors)))
    single = [(i, [float(np.float32(x)) for x in v], n) for i, v, n in rows]
    assert counted(hard_negatives.hard_negatives(frame, 50), MINED) == Counter(brute.hard_negatives(single, 50))
    assert len(held) > 2 and set(held) == {1}


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("most", [4, 64, 10**9])
def test_links_of_a_hot_family(spark, monkeypatch, most):
    """A family that many probes meet, values with most bits alike and others: probes and centres lose no link."""
    monkeypatch.setattr(simhash, "MOST_CANDIDATES", most)
    rng = random.Random(2)
    base = rng.getrandbits(64)
    prints = {base}
    for _ in range(700):
        near = base
        for _ in range(rng.randint(0, 5)):
            near ^= 1 << rng.randrange(64)
        prints.add(near)
    prints |= {rng.getrandbits(16) for _ in range(300)} | {rng.getrandbits(64) for _ in range(500)} | {0, (1 << 64) - 1, 1 << 63}
    rows = stored(spark.createDataFrame([(signed(f),) for f in prints], "fingerprint bigint"), "prints")
    found = {r.node: r.component for r in connected(stored(simhash.links(rows), "links")).collect()}
    expected = brute.components([signed(f) & ((1 << 64) - 1) for f in prints])
    groups = {}
    for f in prints:
        groups.setdefault(expected[f], []).append(signed(f))
    for members in groups.values():
        assert {found.get(f, f) for f in members} == {min(members)}


def test_thresholds_are_general_pigeonhole():
    rng = np.random.default_rng(5)
    cost = np.cumsum(rng.random((50, 3, 3)) * 100, axis=2)
    found = simhash.allocate(cost)
    assert ((found + 1).sum(axis=1) == simhash.DISTANCE + 1).all() and (found >= -1).all()
    every = [(a, b, c) for a in range(4) for b in range(4) for c in range(4) if a + b + c == simhash.DISTANCE + 1]
    for i in range(50):
        price = lambda units: sum(cost[i, k, u - 1] for k, u in enumerate(units) if u)
        assert price(found[i] + 1) == pytest.approx(min(map(price, every)))


def test_groups_hold_correlated_bits():
    rng = np.random.default_rng(6)
    seeds = rng.integers(0, 2, (4000, 3))
    bits = np.zeros((4000, 64), np.int64)
    for b in range(64):
        bits[:, b] = np.where(rng.random(4000) < 0.9, seeds[:, b % 3], 1 - seeds[:, b % 3])
    groups = simhash.group_bits(4000, bits.T @ bits)
    assert sorted(sum(groups, [])) == list(range(64))
    alike = sum(sum(x % 3 == y % 3 for x in g for y in g) for g in groups) / sum(len(g) ** 2 for g in groups)
    assert alike > 0.9


def test_tiles_keep_all_rows(spark):
    rows = spark.range(1000).selectExpr("id AS vec_id", "1L AS label", "array(id, 1L) AS v").repartition(3)
    tiles = hard_negatives._tiles(rows, 2, 64, "tiles").collect()
    ids = np.concatenate([np.frombuffer(t.ids, np.int64) for t in tiles])
    assert sorted(ids.tolist()) == list(range(1000)) and max(t.n for t in tiles) <= 64
    assert len({t.tile for t in tiles}) == len(tiles)
    assert pa.array(ids).null_count == 0
