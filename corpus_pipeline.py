"""The corpus pipeline: each stage takes the rows that the one before kept, written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lienflow.llm import decontaminate, near_dup, pieces, pii, quality_sampling
from lienflow.llm.common import read_table, stored
from lienflow.llm.queries import tokenizer_path
from lienflow.session import configure

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling selects; the others go."""
    configure(spark)
    ratio, _ = quality_sampling.resample(docs, read_table(spark, sf_dir, "labels"))
    return quality_sampling.keep_selected(docs, ratio)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of exact and near copies."""
    configure(spark)
    return near_dup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    configure(spark)
    return decontaminate.remove_contamination(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    configure(spark)
    return pii.mask_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and hashes of the piece ids and of the text that they decode to."""
    configure(spark)
    return pieces.encoded_digests(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: No stage can be expressed in SQL; tests/llm holds each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
