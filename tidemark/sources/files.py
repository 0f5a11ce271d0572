"""Batch readers: Parquet by glob or file list, JSON, database tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..functions.keys import lowercase_columns


def full_load(spark: SparkSession, pattern: str) -> DataFrame:
    """Parquet files matching a glob, column names lowered."""
    return lowercase_columns(spark.read.parquet(pattern))


def read_files(spark: SparkSession, paths: Sequence[str], schema: StructType | None = None) -> DataFrame:
    """Parquet from an explicit list of files, read as one distributed scan.

    The files may differ in their columns: all come out, null where a file lacks one. A column of two types raises,
    and so does one that a given ``schema`` doesn't have, as its values would be lost.
    """
    if not paths:
        if schema is None:
            raise ValueError("an empty file list needs a schema")
        return spark.createDataFrame([], schema)
    found = spark.read.option("mergeSchema", "true").parquet(*paths)
    if schema is None:
        return found
    known = {name.lower() for name in schema.names}
    unknown = [name for name in found.columns if name.lower() not in known]
    if unknown:
        raise ValueError(f"the files have columns that the schema lacks: {', '.join(unknown)}")
    return spark.read.schema(schema).parquet(*paths)


def json_records(
    spark: SparkSession, source: str | Sequence[Mapping], schema: StructType | str | None = None
) -> DataFrame:
    """JSON lines from a path, or in-memory records with a declared schema.

    Without a schema Spark infers one from the files; the columns then come in
    name order.
    """
    if isinstance(source, str):
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.json(source)
    if schema is None:
        raise ValueError("in-memory records need a schema")
    struct = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = [tuple(record.get(name) for name in struct.names) for record in source]
    return spark.createDataFrame(rows, struct)


def jdbc_options(
    url: str,
    table: str,
    column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    **properties: str,
) -> dict[str, str]:
    """Options for a database read, split by key range when a column and bounds are given."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **properties}
    bounds = (column, lower, upper, partitions)
    if any(b is not None for b in bounds):
        if any(b is None for b in bounds):
            raise ValueError("a parallel read needs column, lower, upper and partitions")
        options.update(
            partitionColumn=column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return options


def read_jdbc(spark: SparkSession, **arguments) -> DataFrame:
    """A database table; filters and columns are pushed down by Spark."""
    return lowercase_columns(spark.read.format("jdbc").options(**jdbc_options(**arguments)).load())
