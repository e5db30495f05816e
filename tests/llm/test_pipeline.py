"""The pipeline and the registered queries."""

from collections import Counter

import brute
import corpus_pipeline
import duckdb
import pytest

import __spark_entry__
from lienflow.llm import queries

SF = "/root/testdata/sf0.001"


def table(name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{SF}/{name}.parquet'").fetchall()


def test_registered():
    names = __spark_entry__.queries()
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert "pipeline" in names and set(__spark_entry__.oracle_sql()) <= set(names)


@pytest.mark.parametrize(
    "name, columns, make",
    [
        ("op1_token_store", "doc_id start n_tokens ids_crc32", brute.token_store),
        ("op2_pii", "doc_id n_email n_ip n_card n_phone base_sha256", brute.pii),
        ("op6_pieces", "doc_id n_tokens ids_sha256 decoded_sha256", brute.piece_digests),
        ("op7_quality_rules", "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed", brute.rule_counts),
        ("op8_repeated_bytes", "doc_id n_bytes n_removed n_spans kept_sha256", brute.removal),
        ("op5_near_dup", "doc_id class_id", brute.classes),
    ],
)
def test_queries(spark, name, columns, make):
    found = queries.QUERIES[name](spark, SF).select(*columns.split()).collect()
    assert Counter(map(tuple, found)) == Counter(make(table("documents", "doc_id, text")))


def test_decontamination_query(spark):
    found = Counter(map(tuple, queries.op3_decontamination(spark, SF).collect()))
    assert found == Counter(brute.contamination(table("documents", "doc_id, text"), table("benchmark", "item_id, text")))


@pytest.mark.parametrize("name", ["op4_quality_sampling", "op9_licences", "op10_placement"])
def test_whole_tables(spark, name):
    ids = Counter(r["doc_id"] for r in queries.QUERIES[name](spark, SF).collect())
    assert ids == Counter(r[0] for r in table("documents", "doc_id"))


def test_stages(spark):
    """Each stage, on what the one before kept, against plain versions."""
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    before = documents
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        after[name] = stage(spark, before, SF).cache()
        if name != "tokens":
            assert after[name].columns == documents.columns
        before = after[name]
    texts = {name: {r["doc_id"]: r["text"] for r in after[name].collect()} for name in after if name != "tokens"}
    classes = brute.classes(list(texts["quality"].items()))
    assert set(texts["near_duplicates"]) == {c for _, c in classes}
    dirty = brute.contamination(texts["decontamination"].items(), table("benchmark", "item_id, text"))
    assert not any(r[5] for r in dirty)
    assert all(not brute.base_spans(t) for t in texts["personal_data"].values())
    tokens = Counter(tuple(r) for r in after["tokens"].collect())
    assert tokens == Counter(brute.piece_digests(texts["personal_data"].items()))


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_stages_take_odd_rows(spark, frame, empty):
    for start in (frame, empty):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            if name != "tokens":
                assert docs.columns == frame.columns
        assert docs.count() <= start.count()
