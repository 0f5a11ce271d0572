"""The change stream: event messages -> change files -> keyed upsert."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryProgress
from pyspark.sql.types import StructType

from ..functions.keys import lowercase_columns
from ..functions.local import local_frame
from ..sources.events import parse_events
from ..sources.files import read_files
from ..tables import KeyedTable

_QUERY_ID = "sql.streaming.queryId"


OFFSETS = "query_id string, batch_id bigint, source string, start_offset string, end_offset string, n_rows bigint"


def offset_ranges(spark: SparkSession, progress: Iterable[StreamingQueryProgress]) -> DataFrame:
    """What each batch took from each source: one row with the offsets it began and ended at, as the source writes them.

    A first batch has no start.  Rows are those of the messages read; batches without any are left out.
    """
    def written(offset) -> str | None:
        return None if offset is None else json.dumps(offset)

    rows = [
        (said["id"], said["batchId"], s["description"], written(s["startOffset"]), written(s["endOffset"]), s["numInputRows"])
        for said in (json.loads(p.json) for p in progress)
        for s in said["sources"]
        if s["numInputRows"]
    ]
    return local_frame(spark, rows, OFFSETS)


@dataclass
class ChangeStream:
    """Applies change files to a table as their event messages arrive.

    ``prepare`` shapes the rows of the change files (derive keys, partition
    columns …).  Every committed batch records the query and batch id, so a batch
    replayed after a failure is recognised and skipped.  A new checkpoint means a
    new query id: its batches are new even though their numbers start at 0.
    """

    table: KeyedTable
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df
    event_schema: StructType | str = "path string"
    path_column: str = "path"
    drop: tuple[str, ...] = ("op",)
    file_schema: StructType | None = None
    commit_id: Callable[[int], str] | None = None
    on_commit: Callable[[str, int], None] | None = None
    query: StreamingQuery | None = None

    def paths(self, batch: DataFrame) -> list[str]:
        """Files named by a batch of messages, each once.

        File names only, as many as the trigger admits per batch.  A message
        without a path stops the stream rather than losing a file.
        """
        events = parse_events(batch, self.event_schema).select(F.col(self.path_column).alias("path"))
        named = [r["path"] for r in events.distinct().collect()]
        if None in named:
            raise ValueError("an event message names no file")
        return sorted(named)

    def changes(self, batch: DataFrame) -> DataFrame:
        return self._read(batch.sparkSession, self.paths(batch))

    def _read(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        rows = lowercase_columns(read_files(spark, paths, self.file_schema))
        return self.prepare(rows.drop(*self.drop))

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """The foreachBatch handler: one keyed upsert per non-empty batch.  The messages are read once."""
        paths = self.paths(batch)
        if not paths:
            return
        query_id = batch.sparkSession.sparkContext.getLocalProperty(_QUERY_ID)
        committed = self.table.upsert(
            self._read(batch.sparkSession, paths),
            commit_id=self.commit_id(batch_id) if self.commit_id else None,
            query_id=query_id,
            batch_id=batch_id,
        )
        if committed and self.on_commit:
            self.on_commit(committed, batch_id)

    def start(
        self,
        events: DataFrame,
        checkpoint: str,
        interval: str = "120 seconds",
        available_now: bool = False,
    ) -> StreamingQuery:
        """Run the stream; offsets live in the checkpoint and advance after the commit."""
        writer = events.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint)
        trigger = {"availableNow": True} if available_now else {"processingTime": interval}
        self.query = writer.trigger(**trigger).start()
        return self.query

    def offsets(self) -> DataFrame:
        """Offset ranges of the batches this stream has run, each with the commit it led to.

        Spark keeps the progress of the last batches (``spark.sql.streaming.numRecentProgressUpdates``); those of
        longer ago are in the checkpoint only.
        """
        if self.query is None:
            raise ValueError("the stream has not been started")
        ranges = offset_ranges(self.table.spark, self.query.recentProgress)
        return ranges.join(self.table.batches(), ["query_id", "batch_id"], "left")
