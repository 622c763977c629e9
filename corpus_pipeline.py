"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Every stage but the last returns the columns of ``documents`` and works on all rows that its predecessor kept.

1. ``language_id`` drops documents whose language is rejected (no letters, or dictionaries that fit equally well).
2. ``line_dedup`` cuts repeated lines out of texts; ``n_chars`` is counted anew. No document is dropped.
3. ``near_duplicates`` keeps of each group of linked documents the one with the smallest id (of repeated rows one).
   Documents link at a Jaccard similarity of at least ``NEAR_PERCENT`` of their runs of ``NEAR_WORDS`` words.
4. ``mixture`` repeats or drops documents so that sources come near their target weights.
5. ``byte_bpe`` encodes and decodes: doc_id, source, n_tokens and digests of the ids and the decoded bytes, a row a copy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.llm import bpe, jaccard, langid, line_dedup, mixing
from clickloom.llm.common import documents, register, tuned
from clickloom.session import write_and_read

NEAR_WORDS, NEAR_PERCENT = 5, 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.representatives(docs, width=NEAR_WORDS, percent=NEAR_PERCENT)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, *bpe.default_tokenizer(), keep=("doc_id", "source"))


def _stage(run: Stage) -> Stage:
    def configured(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return run(tuned(spark), docs, sf_dir)

    configured.__doc__ = run.__doc__
    return configured


STAGES: list[tuple[str, Stage]] = [
    ("language_id", _stage(language_id)),
    ("line_dedup", _stage(dedup_lines)),
    ("ngram_jaccard", _stage(near_duplicates)),
    ("source_mixture", _stage(mixture)),
    ("byte_bpe", _stage(byte_bpe)),
]

# No SQL: compression, tokenisation and connected components have none.
ORACLE_SQL = None


@register("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = write_and_read(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
