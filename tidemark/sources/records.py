"""Test-record generator: ids with a sort key and a letter column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import letter


def generated_records(
    spark: SparkSession,
    start: int,
    count: int,
    increment: int = 0,
    partitions: int | None = None,
    **extra: Column,
) -> DataFrame:
    """``count`` records from ``start`` on: id, sk = id + increment, txt = A..Z in turn.

    ``extra`` adds columns computed from ``id``.  Made on the executors, so any
    size costs the driver nothing.
    """
    ids = spark.range(start, start + count, 1, partitions)
    return ids.select(
        "id",
        (F.col("id") + increment).alias("sk"),
        letter("id").alias("txt"),
        *[column.alias(name) for name, column in extra.items()],
    )


def spread_month(key: str = "id") -> Column:
    """A month 1..12 that looks random but is the same on every run and retry."""
    return (F.pmod(F.xxhash64(key), F.lit(12)) + 1).cast("bigint")
