"""Helpers that the corpus operators share: staging, tokens and 64-bit mixing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scratch import scratch_dir

MASK = (1 << 64) - 1
#: Bytes of texts that go to Python together.
BATCH = "4m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared work folder and read it back.

    The copy survives lost executors, cuts the lineage, and its file sizes tell Spark's planner whether the
    frame is small enough to broadcast.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, make, schema) -> DataFrame:
    """``mapInArrow`` over batches of ``BATCH`` at most, as 10,000 long texts at once take too much memory on both sides.

    A size that the session names in spark.sql.execution.arrow.maxBytesPerBatch is left as it is; else it is set there,
    since Spark reads it when the result is computed.
    """
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    if df.sparkSession.conf.get(setting, None) is None:
        df.sparkSession.conf.set(setting, BATCH)
    return df.mapInArrow(make, schema)


def row_key(*columns) -> F.Column:
    """128 bits that tell rows apart by the given columns, nulls included."""
    parts = F.concat_ws(",", *[F.coalesce(F.length(c.cast("string")), F.lit(-1)).cast("string") for c in columns])
    return F.unhex(F.md5(F.concat(parts, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser over an array of uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in order; empty when there are fewer words."""
    if len(words) < size:
        return np.empty(0, np.uint64)
    n = len(words) - size + 1
    out = words[:n]
    for i in range(1, size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n])
    return mix(out)


def rows_of(batches: Iterator[pa.RecordBatch], *names: str, size: int = 4_000_000) -> Iterator[tuple[list, ...]]:
    """Columns as Python lists, in pieces of about ``size`` bytes, so that long texts don't pile up."""
    for batch in batches:
        step = max(1, batch.num_rows * size // max(size, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield tuple(part.column(batch.schema.get_field_index(n)).to_pylist() for n in names)
