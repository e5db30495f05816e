"""Operators that look at each text by itself."""

import random
from collections import Counter
from functools import partial

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from lienflow.llm import decontaminate, near_dup, pieces, pii, quality_rules, queries, token_store
from lienflow.llm.common import text_bytes


def rows(frame, *columns):
    return Counter(tuple(r) for r in frame.select(*columns).collect())


def test_pieces(frame, empty, docs):
    model = queries.tokenizer_path("piece_bpe_32k.model")
    found = pieces.encoded_digests(frame, model)
    assert rows(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == Counter(brute.piece_digests(docs))
    whole = pieces.encode_documents(frame, model).filter("doc_id = 220").first()
    assert ",".join(map(str, whole["ids"])) and whole["decoded"] == dict(docs)[220].replace("▁", " ")
    assert pieces.encoded_digests(empty, model).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab é▁\n\t<s>日😀​İ", max_size=12), max_size=8))
def test_chunk_table(texts):
    table = pieces.chunk_table(queries.tokenizer_path("piece_bpe_32k.model"))
    for text, numbers in zip(texts, table.chunks(pa.array(texts, pa.string())), strict=True):
        ids = table.processor.encode(text)
        assert table.ids_of(numbers).tolist() == ids
        assert table.text_of(numbers) == table.processor.decode(ids)


def test_rules(frame, empty, docs):
    judged = quality_rules.judge(frame)
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert rows(judged, "doc_id", *base) == Counter(brute.rule_counts(docs))
    kept = {r["doc_id"]: r["kept"] for r in judged.collect()}
    assert kept[0] is not None and not kept[200] and not kept[224]
    assert quality_rules.judge(empty).count() == 0


def test_posteriors_find_the_good_rules():
    rng = np.random.default_rng(1)
    good = rng.random(4000) < 0.8
    # Three rules that are mostly right, two that guess.
    votes = np.array([np.where(rng.random(4000) < c, np.where(good, 1, -1), np.where(good, -1, 1)) for c in (0.95, 0.9, 0.9, 0.5, 0.5)]).T
    votes[rng.random(votes.shape) < 0.2] = 0
    found = quality_rules.posteriors(votes, np.ones(4000)) >= 0.5
    assert (found == good).mean() > 0.95


def test_pii_base(frame, empty, docs, spark):
    found = pii.find_spans(frame)
    counts = {}
    for row in found.collect():
        base = [(s["kind"], s["start"], s["end"]) for s in row["found"] if s["kind"] in pii.BASE]
        counts.setdefault(row["doc_id"], []).append(base)
    for doc_id, text in docs:
        assert brute.base_spans(text) in counts[doc_id]
    assert pii.find_spans(empty).count() == 0


@pytest.mark.parametrize("alphabet", ["a@.-_1", "0123.+ -(", "4 1-", "+1 2.()"])
def test_pii_base_on_random_texts(spark, alphabet):
    rng = random.Random(alphabet)
    texts = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    found = {r["doc_id"]: r["found"] for r in pii.find_spans(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    for doc_id, text in texts:
        base = [(s["kind"], s["start"], s["end"]) for s in found[doc_id] if s["kind"] in pii.BASE]
        assert base == brute.base_spans(text), text


def test_pii_checksums_and_context(spark):
    texts = [
        (1, "transfer to DE89 3704 0044 0532 0130 00 today"),
        (2, "transfer to DE89 3704 0044 0532 0130 01 today"),
        (3, "social security 123-45-6789"),
        (4, "part number 123-45-6789"),
        (5, "password=b7db7aa4a5fcc78305 etc"),
        (6, "see b7db7aa4a5fcc78305 etc"),
    ]
    found = {r["doc_id"]: [s["kind"] for s in r["found"]] for r in pii.find_spans(spark.createDataFrame(texts, "doc_id int, text string")).collect()}
    assert found[3] == ["ssn"] and found[4] == [] and found[5] == ["secret"] and found[6] == []
    assert "iban" in found[1] and "iban" not in found[2]


def test_masking(frame, empty, docs):
    masked = pii.mask_documents(frame)
    assert masked.columns == frame.columns and masked.schema["text"].dataType == frame.schema["text"].dataType
    by_id = {r["doc_id"]: r for r in masked.filter("doc_id IS NOT NULL").collect()}
    text = by_id[221]["text"]
    assert text == "mail [EMAIL], ip [IP] and 1.2.3.256, card [CARD], call [PHONE]."
    assert by_id[221]["n_chars"] == len(text) and by_id[200]["text"] is None and by_id[0]["text"] == docs[0][1]
    assert pii.mask_documents(empty).count() == 0


def test_contamination(spark, frame, empty, docs):
    words = dict(docs)[130].split()
    items = [(1, " ".join(words[10:25])), (2, "one TWO"), (3, None), (4, "..."), (None, "no id"), (5, " ".join(words[12:40])), (1, " ".join(words[10:25]))]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.contamination(frame, benchmark)
    # An item without an id is hit and not named.
    want = brute.contamination(docs, [i for i in items if i[1] is not None])
    assert rows(found, *found.columns) == Counter(want) and (None, 3, 2, 0) in {row[:4] for row in want}
    assert not decontaminate.contamination(frame, benchmark.limit(0)).filter("contaminated").count()
    assert decontaminate.contamination(empty, benchmark).count() == 0


def test_removed_passages(spark, frame, docs):
    words = dict(docs)[130].split()
    benchmark = spark.createDataFrame([(1, " ".join(words[10:25])), (2, dict(docs)[1])], "item_id bigint, text string")
    kept = decontaminate.remove_contamination(frame, benchmark)
    assert kept.columns == frame.columns
    texts = {r["doc_id"]: r for r in kept.filter("doc_id IS NOT NULL").collect()}
    assert 1 not in texts and texts[2]["text"] == dict(docs)[2] and texts[200]["text"] is None
    assert texts[130]["n_chars"] == len(texts[130]["text"]) < len(dict(docs)[130])
    assert not decontaminate.contamination(kept, benchmark).filter("contaminated").count()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="abc ", max_size=30), max_size=5), st.lists(st.text(alphabet="abcd ", max_size=60), max_size=5))
def test_automaton(items, texts):
    machine = decontaminate.SuffixAutomaton([(i, t.encode()) for i, t in enumerate(items)], window=3)
    want = brute.contamination(list(enumerate(texts)), list(enumerate(items)), window=3)
    for text, row in zip(texts, want, strict=True):
        words = decontaminate.words_of(text.encode())
        hit, found = machine.stream(decontaminate._numbers(machine, words))
        assert (len(words), int(hit.sum()), len(found), decontaminate.item_digest(found)) == row[1:5]


def test_several_automata_answer_as_one(spark, frame, docs, monkeypatch):
    texts = [t.split() for _, t in docs if t and len(t.split()) > 60][:12]
    items = [(i, " ".join(t[5 * i % 40 : 5 * i % 40 + 8 + i])) for i, t in enumerate(texts)] + [(None, " ".join(texts[0][:9]))]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(decontaminate, "automata", partial(decontaminate.automata, block_bytes=150))
    assert len(list(decontaminate.automata(benchmark))) > 3
    found = decontaminate.contamination(frame, benchmark)
    assert rows(found, *found.columns) == Counter(brute.contamination(docs, items))


def test_benchmark_in_several_automata(spark, frame):
    items = [(i, f"first{i} " + "one two " * 6) for i in range(20)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    assert len(list(decontaminate.automata(benchmark, block_bytes=100))) > 5


@pytest.mark.parametrize("size", [1024, 2048, 4096])
def test_regular_words_are_told_apart(spark, size):
    """Two long words whose plain sums are equal: as words, as lines, and as texts of other words."""
    one, two = brute.thue_morse(size), brute.thue_morse(size, "b", "a")
    docs = [(1, f"{one} x {two}"), (2, f"{one}\n{two}\n{one}"), (3, two), (4, one), (5, " ".join([one, two] * 12))]
    docs += [(6, " ".join([f"w{i}" for i in range(30)] + [one])), (7, " ".join([f"w{i}" for i in range(30)] + [two]))]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    stored = token_store.stored_documents(frame, queries.tokenizer_path("word_bpe_49k.json"))
    assert rows(stored, "doc_id", "start", "n_tokens", "ids_crc32") == Counter(brute.token_store(docs))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert rows(quality_rules.judge(frame), "doc_id", *base) == Counter(brute.rule_counts(docs))
    hashed, first = near_dup.word_hashes(*text_bytes(pa.array([one, two])))
    assert first.tolist() == [0, 1, 2] and hashed[0] != hashed[1]
