"""Numbers about commits and batches, and a hook to send them somewhere."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from .functions.text import metric_name, metric_table, to_number
from .tables import KeyedTable

Sink = Callable[[str, str, float], None]


def commit_metrics(table: KeyedTable) -> DataFrame:
    """Rows inserted, updated and deleted by each commit, one row per non-zero count."""
    counts = table.commits().filter("rows_inserted IS NOT NULL").select(
        "commit_id",
        F.col("rows_inserted").alias("insert"),
        F.col("rows_updated").alias("update"),
        F.col("rows_deleted").alias("delete"),
    )
    return counts.unpivot("commit_id", ["insert", "update", "delete"], "action", "n").filter("n > 0")


def table_metrics(table: KeyedTable, name: str) -> DataFrame:
    """The same as key/value rows: ``<table>.commit.<action>`` -> number."""
    return commit_metrics(table).select(
        F.concat(F.lit(f"{name}.commit."), "action").alias("key"),
        F.col("n").cast("string").alias("value"),
    )


def split_metrics(df: DataFrame) -> DataFrame:
    """Key/value text to table, metric and number; rows with no dot or no number drop out of neither."""
    return df.select(
        metric_table("key").alias("table"),
        metric_name("key").alias("metric"),
        to_number("value").alias("value"),
    )


def push(df: DataFrame, sink: Sink) -> int:
    """Hand each metric to a sink function; a few rows per commit, read one by one."""
    n = 0
    for row in split_metrics(df).toLocalIterator():
        if row["metric"] is not None and row["value"] is not None:
            sink(row["table"], row["metric"], row["value"])
            n += 1
    return n


def batch_sink(table: KeyedTable, name: str, sink: Sink) -> Callable[[str, int], None]:
    """A hook for ``ChangeStream.on_commit``: sends the number of records that the batch's files held."""

    def send(commit_id: str, batch_id: int) -> None:
        for row in table.batches().filter(F.col("commit_id") == commit_id).collect():
            sink(name, "batch.records", float(row["rows_received"]))

    return send


class BatchListener(StreamingQueryListener):
    """Sends the number of messages of every micro-batch to a sink; ``batch_sink`` counts the records they lead to."""

    def __init__(self, name: str, sink: Sink):
        self._name = name
        self._sink = sink

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self._sink(self._name, "batch.rows", float(event.progress.numInputRows))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
