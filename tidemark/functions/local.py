"""Small frames from values the driver already holds."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def local_frame(spark: SparkSession, rows: Sequence[Sequence], schema: StructType | str) -> DataFrame:
    """Rows as a local relation: its size is known, so Spark decides whether to broadcast it."""
    struct = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) if rows else [() for _ in struct]
    arrow = to_arrow_schema(struct)
    table = pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, struct)
