"""One query per corpus operator, over whole tables with production parameters, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lienflow.llm import (
    decontaminate,
    hard_negatives,
    licences,
    near_dup,
    pieces,
    pii,
    placement,
    quality_rules,
    quality_sampling,
    repeated_bytes,
    simhash,
    token_alignment,
    token_store,
)
from lienflow.llm.common import read_table
from lienflow.session import configure

Query = Callable[[SparkSession, str], DataFrame]

#: Shards that op10 places documents in.
SHARDS = [f"shard-{i:03d}" for i in range(100)]

#: The documents table has no paths: one made of its columns; in every directory some files are licence files.
PATH = "concat_ws('/', source, lang, doc_id div 1000, if(doc_id % 50 = 0, concat('LICENSE.', doc_id), concat(doc_id, '.txt')))"
LICENCE_FILE = "path rlike '(?i)(^|/)(licen[sc]e|copying|notice)[^/]*$'"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return token_store.stored_documents(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(read_table(configure(spark), sf_dir, "documents"))
    named = "concat_ws(':', s.kind, s.start, s.end)"
    base = "array_join(transform(filter(found, s -> s.kind IN ('email', 'ip', 'card', 'phone')), s -> " + named + "), ',')"
    return found.selectExpr(
        "doc_id",
        *[f"cast(size(filter(found, s -> s.kind = '{kind}')) AS bigint) AS n_{kind}" for kind in pii.BASE],
        f"sha2({base}, 256) AS base_sha256",
        f"array_join(transform(found, s -> {named}), ',') AS spans",
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_quality_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    _, scored = quality_sampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scored


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_dup.duplicate_classes(read_table(configure(spark), sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "class_size", "kept")


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return pieces.encoded_digests(read_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(read_table(configure(spark), sf_dir, "documents"))
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select("doc_id", *columns, F.round("p_good", 6).alias("p_good"))


def op8_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes.removal_digests(read_table(configure(spark), sf_dir, "documents"))


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(read_table(configure(spark), sf_dir, "documents"), PATH, LICENCE_FILE)


def op10_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placement.place(read_table(configure(spark), sf_dir, "documents"), SHARDS)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(read_table(configure(spark), sf_dir, "embeddings"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    return token_alignment.align_tokens(read_table(configure(spark), sf_dir, "documents"), *models)


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(read_table(configure(spark), sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(configure(spark), sf_dir)


QUERIES: dict[str, Query] = {
    make.__name__: make
    for make in (
        op1_token_store,
        op2_pii,
        op3_decontamination,
        op4_quality_sampling,
        op5_near_dup,
        op6_pieces,
        op7_quality_rules,
        op8_repeated_bytes,
        op9_licences,
        op10_placement,
        op11_hard_negatives,
        op12_token_alignment,
        op13_simhash,
        pipeline,
    )
}



def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_TEMPLATE_ROWS = ", ".join(
    f"({_text(name)}, {i}, {_text(text)})" for name, texts in licences.TEMPLATES.items() for i, text in enumerate(texts)
)
_TERMS = "unnest(regexp_extract_all(lower({}), '[a-z0-9]+(?:[.-][a-z0-9]+)*'))"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_UPPER, _UPPER.lower())

ORACLES: dict[str, str] = {
    "op3_decontamination": f"""
        WITH texts AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
        items AS (
            SELECT item_id, words, least({decontaminate.WINDOW}, len(words)) AS size
            FROM (SELECT item_id, {_WORDS} AS words FROM benchmark) WHERE len(words) > 0
        ), windows AS (
            SELECT DISTINCT item_id, size, unnest(list_transform(range(1, len(words) - size + 2),
                lambda p: array_to_string(words[p : p + size - 1], ' '))) AS run FROM items
        ), places AS (
            SELECT r, size, unnest(list_transform(range(1, len(words) - size + 2),
                lambda p: struct_pack(p := p, run := array_to_string(words[p : p + size - 1], ' '))), recursive := true)
            FROM texts, (SELECT DISTINCT size FROM windows)
        ), found AS (
            SELECT r, p, size, item_id FROM places JOIN windows USING (size, run)
        ), hits AS (
            SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(p, p + size)) AS place FROM found) GROUP BY r
        ), named AS (
            SELECT r, count(DISTINCT item_id) AS n, string_agg(DISTINCT cast(item_id AS varchar), ',' ORDER BY cast(item_id AS varchar)) AS ids
            FROM found GROUP BY r
        )
        SELECT doc_id, len(words) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256, hits.n IS NOT NULL AS contaminated
        FROM texts LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
    """,
    "op9_licences": f"""
        WITH templates(licence, variant, text) AS (VALUES {_TEMPLATE_ROWS}),
        model AS (
            SELECT licence, variant, term, count(*) AS tf
            FROM (SELECT licence, variant, {_TERMS.format("text")} AS term FROM templates) GROUP BY ALL
        ), idf AS (
            SELECT term, ln((1 + (SELECT count(*) FROM templates)) / (1 + count(*))) + 1 AS idf FROM model GROUP BY term
        ), sides AS (
            SELECT licence, variant, term, tf * idf AS weight,
                sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY licence, variant)) AS length
            FROM model JOIN idf USING (term)
        ), files AS (
            SELECT doc_id, source || '/' || lang || '/' || doc_id // 1000 AS directory, doc_id % 50 = 0 AS is_licence,
                CASE WHEN doc_id % 50 = 0 THEN 'LICENSE.' || doc_id ELSE doc_id || '.txt' END AS file,
                nullif(trim(array_to_string(list_filter(string_split(coalesce(text, ''), chr(10)),
                    lambda l: regexp_matches(l, {_text("(?i)" + licences.NOTICE)})), ' ')), '') AS notice
            FROM documents
        ), counted AS (
            SELECT notice, term, count(*) AS tf
            FROM (SELECT notice, {_TERMS.format("notice")} AS term FROM (SELECT DISTINCT notice FROM files WHERE notice IS NOT NULL))
            GROUP BY ALL
        ), weighed AS (
            SELECT notice, term, tf * coalesce(idf, ln(1 + (SELECT count(*) FROM templates)) + 1) AS weight
            FROM counted LEFT JOIN idf USING (term)
        ), cosines AS (
            SELECT w.notice, licence, variant, round(sum(w.weight * s.weight / length) / any_value(norm), 6) AS cosine
            FROM weighed w JOIN sides s USING (term)
                JOIN (SELECT notice, sqrt(sum(weight ** 2)) AS norm FROM weighed GROUP BY notice) n ON n.notice = w.notice
            GROUP BY w.notice, licence, variant
        ), nearest AS (
            SELECT notice, licence, cosine FROM cosines WHERE cosine >= {licences.LEAST_COSINE}
            QUALIFY row_number() OVER (PARTITION BY notice ORDER BY cosine DESC, licence) = 1
        ), own AS (
            SELECT doc_id, directory, directory || '/' || file AS path, is_licence, licence, cosine
            FROM files LEFT JOIN nearest ON files.notice = nearest.notice
        ), governing AS (
            SELECT directory, licence FROM own WHERE is_licence AND licence IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY directory ORDER BY cosine DESC, path) = 1
        )
        SELECT doc_id, path, coalesce(own.licence, g.licence) AS licence, cosine,
            CASE WHEN own.licence IS NOT NULL THEN 'own' WHEN g.licence IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin
        FROM own LEFT JOIN governing g USING (directory)
    """,
    "op11_hard_negatives": """
        WITH usable AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS alike,
                CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
            FROM usable a JOIN usable c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
        ), positives AS (
            SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE alike
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
        )
        SELECT anchor_id, positive_id,
            CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
            other AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10
    """,
}
