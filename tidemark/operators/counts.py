"""Counts the jobs report: per partition, per batch, per update."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F


def count_all(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def partition_counts(df: DataFrame, columns: Sequence[str] = ("year", "month")) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def affected_rows(df: DataFrame, predicate: Column) -> DataFrame:
    """How many rows an update would change, in one pass with no filter step."""
    return df.agg(F.count_if(predicate).alias("n_updated"))


def counted(df: DataFrame, **more: Column) -> tuple[DataFrame, Observation]:
    """Count rows while another job reads them; the result is there once it has run."""
    seen = Observation()
    extra = [c.alias(name) for name, c in more.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *extra), seen


def observed(seen: Observation) -> dict:
    """Observed values, with zeros where an empty input left nothing to observe."""
    return {name: value or 0 for name, value in seen.get.items()} or {"rows": 0}
