"""A training corpus from raw documents: each stage is written as Parquet and read by the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stage, table
from tidemark.llm.decontaminate import drop_contaminated
from tidemark.llm.language_id import keep_identified, learn_dictionaries
from tidemark.llm.mixing import mix_sources
from tidemark.llm.near_dedup import drop_near_duplicates
from tidemark.llm.pii import pseudonymise
from tidemark.llm.queries import EXAMPLE_KEY


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows stay whose language can be told; lang is that of the source, and is what the dictionaries learn from."""
    return keep_identified(docs, learn_dictionaries(docs))


def dedupe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity of 0.8: the smallest id of each group stays, as one row; null ids come last."""
    return drop_near_duplicates(docs, one_row=True)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows stay that don't hold half of a benchmark item, in whatever order."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays, with pseudonyms in the text; n_chars follows the text."""
    hidden = pseudonymise(docs, EXAMPLE_KEY, details=False)
    changed = F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)
    return hidden.withColumn("n_chars", changed).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: documents as often as their source's weight asks for, with their places in it."""
    return mix_sources(docs).drop("mix_key")


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", dedupe),
    ("decontaminate", decontaminate),
    ("pii", hide_private),
    ("mix", mix),
]

#: Compressed sizes, hash draws and keyed permutations have no SQL form; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
