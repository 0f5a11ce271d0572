"""The commit log: two small Parquet folders beside the data.

``log/commits`` holds one row per commit, ``log/files`` the data files each added
and removed.  A writer puts its data first, then its file rows, then its commit
row; readers look only at files of commits that have a row, so an unfinished
write is invisible and can simply be repeated.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ..functions.local import local_frame
from ..functions.scratch import path_exists

COMMIT_SCHEMA = (
    "kind string, operation string, target string, query_id string, batch_id bigint, "
    "rows_received bigint, rows_pending bigint, rows_inserted bigint, rows_updated bigint, rows_deleted bigint, n_files bigint, "
    "table_schema string, commit_id string"
)
FILE_SCHEMA = (
    "action string, layer string, path string, partition_path string, bytes bigint, commit_id string"
)

COMMIT = "commit"
DELTACOMMIT = "deltacommit"
COMPACTION = "compaction"
ROLLBACK = "rollback"
CLEAN = "clean"
DATA_KINDS = (COMMIT, DELTACOMMIT, COMPACTION)


class CommitLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self._commits = f"{root}/log/commits"
        self._files = f"{root}/log/files"

    def _read(self, schema: str, folder: str) -> DataFrame:
        if not path_exists(self.spark, folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(folder)

    def commits(self) -> DataFrame:
        return self._read(COMMIT_SCHEMA, self._commits)

    def files(self, commit_ids: Iterable[str]) -> DataFrame:
        """File rows of the given commits; other commits' folders are pruned."""
        ids = list(commit_ids)
        if not ids:
            return self.spark.createDataFrame([], FILE_SCHEMA)
        return self._read(FILE_SCHEMA, self._files).filter(F.col("commit_id").isin(ids))

    def rows(self) -> list[Row]:
        """All commit rows in commit order: one row per commit, a few hundred bytes each."""
        return sorted(self.commits().collect(), key=lambda r: r.commit_id)

    def write_files(self, commit_id: str, files: DataFrame) -> None:
        """Record files; replaces what an unfinished attempt at the commit may have left."""
        files.write.mode("overwrite").parquet(f"{self._files}/commit_id={commit_id}")

    def write(self, commit_id: str, **header) -> None:
        """Add the commit row, which makes the commit visible."""
        schema = COMMIT_SCHEMA.removesuffix(", commit_id string")
        names = [part.split()[0] for part in schema.split(", ")]
        row = local_frame(self.spark, [tuple(header.get(n) for n in names)], schema)
        row.write.mode("error").parquet(f"{self._commits}/commit_id={commit_id}")


def rolled_back(rows: Iterable[Row]) -> set[str]:
    return {r.target for r in rows if r.kind == ROLLBACK}


def live_rows(rows: list[Row], as_of: str | None = None) -> list[Row]:
    """Commits that changed data, were not rolled back, and are not later than ``as_of``."""
    undone = rolled_back(rows)
    return [
        r
        for r in rows
        if r.kind in DATA_KINDS
        and r.commit_id not in undone
        and (as_of is None or r.commit_id <= as_of)
    ]
