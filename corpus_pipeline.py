"""A training corpus in five stages: quality rules, language, near copies,
benchmark passages, packed sequences.

Each stage works on all that the stage before it kept and is written to the
shared folder before the next one reads it; its own tables go then.

Every stage takes null, repeated and clashing values as its operator documents
them: a null text has no words and goes with the first stage, rows that repeat a
key are judged one by one, extra columns pass through, an empty table stays
empty, and very long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marginalia.llm import decontamination, language_id, near_copies, packing, quality_rules
from marginalia.llm.storage import materialize, release, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers, each by its own
    text, language and source."""
    return quality_rules.keep_good(docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose n-grams resemble a learned language, each
    by its own text."""
    return language_id.keep_known(docs)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least doc_id, of each group of copies that
    share 80 % of their five-word shingles; candidates come from the anchors of
    the SimHash operator and from MinHash bands, links are checked exactly."""
    return near_copies.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item, each by its own text."""
    return decontamination.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_stage),
    ("language ID", language_stage),
    ("SimHash near-dedup", near_copies_stage),
    ("benchmark decontamination", benchmark_stage),
    ("best-fit packing", packing_stage),
]

#: Robust estimation, hyperdimensional profiles, XXH64 votes and packing have
#: no SQL form; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        since, tag = written(), name.replace(" ", "-")
        docs = materialize(stage(spark, docs, sf_dir), tag)
        release(spark, since, tag)
    return STAGES[-1][1](spark, docs, sf_dir)
