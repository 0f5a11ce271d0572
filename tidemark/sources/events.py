"""Streams of change events.

An event is a small JSON message naming a Parquet file of changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def parse_events(df: DataFrame, schema: StructType | str, value: str = "value") -> DataFrame:
    """JSON text in ``value`` to columns of the declared schema."""
    return df.withColumn("_event", event_struct(value, schema)).select("_event.*")


def event_struct(value: str | Column, schema: StructType | str) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.from_json(column.cast("string"), schema)


def kafka_options(
    brokers: str,
    topic: str,
    starting: str = "latest",
    security_protocol: str | None = None,
    group_prefix: str | None = None,
    max_offsets: int | None = 10_000,
    **more: str,
) -> dict[str, str]:
    """Options of a Kafka subscription; progress is kept in the query's checkpoint.

    A batch takes at most ``max_offsets`` messages, as the files they name are listed on the driver; None takes all there are.
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting,
        **more,
    }
    if security_protocol:
        options["kafka.security.protocol"] = security_protocol
    if group_prefix:
        options["groupIdPrefix"] = group_prefix
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_events(spark: SparkSession, **arguments) -> DataFrame:
    """Message values of a Kafka topic (needs the Kafka connector on the classpath)."""
    reader = spark.readStream.format("kafka").options(**kafka_options(**arguments))
    return reader.load().select(F.col("value").cast("string").alias("value"))


def file_events(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """The same messages as text files dropped in a folder, one message per line."""
    return (
        spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).load(folder)
    )
