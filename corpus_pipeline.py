"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rostra.llm.exact_dedup import kept_documents
from rostra.llm.language_id import known_language
from rostra.llm.packing import best_fit_packing
from rostra.llm.simhash import one_of_each
from rostra.llm.suffix_dedup import without_repeats
from rostra.session import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose text is in some language; those without letters go."""
    return known_language(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first of each group of equal texts."""
    return kept_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first of each group of near copies: SimHash fingerprints of three-word shingles that differ in at most three bits."""
    return one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out of the texts what an earlier text, or an earlier part of the same one, already has."""
    return without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place every document, or the pieces of a long one, in a training sequence."""
    return best_fit_packing(docs)


STAGES = [("language", language), ("exact", exact), ("near", near), ("repeats", repeats), ("pack", pack)]

#: SQL has no linking of near copies, suffix sorting or best-fit packing: run() is tested against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
