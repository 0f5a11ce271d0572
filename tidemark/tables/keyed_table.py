"""A keyed, versioned Parquet table.

Data lives in ``base/_version=<commit>/<partitions>`` (and, for merge-on-read
tables, ``delta/_version=<commit>/…``).  A change rewrites only the files that
hold a changed key: a key-column scan finds them, and each is replaced by one new
file in a new version folder.  One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, MapType, StringType, StructField, StructType, VariantType

from ..functions.keys import any_null, lowercase_columns, partition_path, record_key
from ..functions.local import local_frame
from ..functions.scratch import delete_files, delete_path, path_bytes, path_exists, path_uri, scratch_dir, whole_files
from ..operators.counts import counted, observed
from ..operators.merge import (
    DELETED,
    FORCED,
    blank_values,
    merge_on_read,
    newest_delta,
    offered_order,
    pending_actions,
    pending_changes,
)
from ..operators.precombine import precombine, tied_keys
from ..operators.schema import conform, widen
from ..spec import (
    COMMIT_SEQNO,
    COMMIT_TIME,
    DELETE,
    EVENT_TIME,
    FILE_NAME,
    METADATA_COLUMNS,
    MOR,
    PARTITION_PATH,
    RECORD_KEY,
    TableSpec,
)
from .log import CLEAN, COMMIT, COMPACTION, DATA_KINDS, DELTACOMMIT, ROLLBACK, CommitLog, live_rows, rolled_back

BASE = "base"
DELTA = "delta"
_FILE = "_file"
_ROW = "_row"
_SLOT = "_slot"
_TAG = "_tag"
_STORED, _GONE, _CHANGED = 0, 1, 2
# the sequence number is stored as a plain number and shown as <commit>_<number>
_META_FIELDS = [StructField(COMMIT_TIME, StringType()), StructField(COMMIT_SEQNO, LongType())]


#: File and partition names that a plan spells out; where there are more, they are joined.
NAMED = 2_000
#: Touched partitions whose key ranges are looked up one by one; where there are more, neighbours share a range.
RANGES = 32
_REMOVED = "action string, layer string, path string, partition_path string, bytes bigint"


@dataclass
class _Layer:
    """The live part of the base or of the deltas: a folder for each commit, and what in them is not to be read."""

    name: str
    folders: list[str]
    skipped: list[str] | str  # replaced files, and files that no commit has listed; a stored list if there are many


@dataclass
class _Matches:
    """Stored rows that share a key with a change set."""

    pairs: DataFrame | None  # keys, partition and file of each stored row to be replaced
    beaten: DataFrame | None  # keys whose stored row stays because it is newer


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str, spec: TableSpec):
        self.spark = spark
        self.root = root.rstrip("/")
        self.spec = spec
        self.log = CommitLog(spark, self.root)
        #: Called with the table and the commit id after each commit, rollback and clean.
        self.hooks: list[Callable[[KeyedTable, str], None]] = []

    # ---- opening -------------------------------------------------------------------

    @classmethod
    def create(cls, spark: SparkSession, root: str, spec: TableSpec) -> "KeyedTable":
        table = cls(spark, root, spec)
        properties = local_frame(spark, [(spec.to_json(),)], "value string")
        properties.write.mode("error").text(f"{table.root}/properties")
        return table

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> "KeyedTable":
        text = spark.read.text(f"{root.rstrip('/')}/properties").first()["value"]
        return cls(spark, root, TableSpec.from_json(text))

    def describe(self) -> DataFrame:
        """Table properties, one row each."""
        rows = self.log.rows()
        live = live_rows(rows)
        facts = {
            "location": self.root,
            "storage": self.spec.storage,
            "keys": ",".join(self.spec.keys),
            "order_by": ",".join(self.spec.order_by),
            "partition_by": ",".join(self.spec.partition_by),
            "policy": self.spec.policy,
            "commits": str(len(live)),
            "latest_commit": live[-1].commit_id if live else "",
            "schema": self._schema(live).simpleString() if live else "",
        }
        return local_frame(self.spark, list(facts.items()), "property string, value string")

    # ---- reading -------------------------------------------------------------------

    def schema(self, as_of: str | None = None) -> StructType:
        """Data columns of the table, in order."""
        return self._schema(live_rows(self.log.rows(), as_of))

    def snapshot(
        self, view: str | None = None, as_of: str | None = None, metadata: bool = False
    ) -> DataFrame:
        """The table as of a commit, by default the latest.

        ``view``: ``ro`` reads the base files only, ``rt`` merges pending changes in.
        The plan is bound to the files live now; later commits do not disturb it.
        """
        rows = self.log.rows()
        live = live_rows(rows, as_of)
        if not live:
            raise ValueError(f"{self.root} has no commit" + (f" up to {as_of}" if as_of else ""))
        view = view or ("rt" if self.spec.storage == MOR else "ro")
        schema = self._schema(live)
        base_files, delta_files = self._layers(live, deltas=view == "rt")
        if delta_files.folders:
            behind = self._behind(live)
            base = self._rows(base_files, schema, metadata, behind)
            base = merge_on_read(base, self._rows(delta_files, schema, metadata), self.spec)
            if behind is not None:
                base = base.unionByName(self._rows(base_files, schema, metadata, ~behind))
        else:
            base = self._rows(base_files, schema, metadata)
        if not metadata:
            return base.select(*schema.names)
        return base.withColumns(
            {
                COMMIT_SEQNO: F.concat(COMMIT_TIME, F.lit("_"), COMMIT_SEQNO),
                RECORD_KEY: record_key(self.spec.keys),
                PARTITION_PATH: partition_path(self.spec.partition_by),
            }
        ).select(*METADATA_COLUMNS, *schema.names)

    def _rows(self, layer: _Layer, schema, named: bool, where: Column | None = None) -> DataFrame:
        df = self._scan(layer, schema, located=named)
        df = df if where is None else df.filter(where)
        return df.withColumn(FILE_NAME, F.element_at(F.split(_FILE, "/"), -1)).drop(_FILE) if named else df

    def _behind(self, live: list[Row]) -> Column | None:
        """Whether a row's partition has pending changes; None where that leaves out nothing."""
        if self.spec.global_key or not self.spec.partition_by:
            return None
        pending = self._live_file_rows(live).filter(F.col("layer") == DELTA).select("partition_path").distinct()
        hit = [r[0] for r in pending.limit(NAMED + 1).collect()]
        return partition_path(self.spec.partition_by).isin(hit) if len(hit) <= NAMED else None

    def pending(self, column: str) -> DataFrame:
        """Keys whose base value of a column differs from the pending one."""
        base, delta, _ = self._base_and_deltas()
        return pending_changes(base, delta, self.spec, column)

    def pending_actions(self) -> DataFrame:
        """What a compaction would do now: the number of keys to insert, update and delete.

        Only key and ordering columns are read.
        """
        base, delta, _ = self._base_and_deltas()
        return pending_actions(base, delta, self.spec)

    def _base_and_deltas(self) -> tuple[DataFrame, DataFrame, list[Row]]:
        live = live_rows(self.log.rows())
        schema = self._schema(live)
        base_files, delta_files = self._layers(live)
        base, behind = self._scan(base_files, schema), self._behind(live)
        return base if behind is None else base.filter(behind), self._scan(delta_files, schema), live

    def files(self, as_of: str | None = None) -> DataFrame:
        """Live data files: layer, commit_id, path, partition_path, bytes."""
        return self._live_file_rows(live_rows(self.log.rows(), as_of))

    def partitions(self) -> DataFrame:
        """Partitions that hold files, from the log alone."""
        return self.files().select("partition_path").distinct()

    # ---- history -------------------------------------------------------------------

    def commits(self) -> DataFrame:
        """Every commit with its kind, counts and whether it still counts."""
        undone = F.col("commit_id").isin(sorted(rolled_back(self.log.rows())) or [""])
        state = F.when(undone, F.lit("rolled_back")).otherwise(F.lit("completed"))
        return self.log.commits().select(
            "commit_id",
            "kind",
            "operation",
            state.alias("state"),
            "rows_inserted",
            "rows_updated",
            "rows_deleted",
            "rows_pending",
        )

    def batches(self) -> DataFrame:
        """Batches that streams have committed: query_id, batch_id, commit_id and the rows each brought."""
        return self.log.commits().filter("query_id IS NOT NULL").select("query_id", "batch_id", "commit_id", "rows_received")

    def compactions(self) -> DataFrame:
        """Compactions asked for, with their state."""
        done = self.commits().filter(F.col("kind") == COMPACTION)
        done = done.select("commit_id", "state", (F.col("rows_inserted") + F.col("rows_updated")).alias("n_rows"))
        if not path_exists(self.spark, f"{self.root}/log/requests"):
            return done
        asked = self.spark.read.schema("commit_id string").json(f"{self.root}/log/requests")
        waiting = asked.join(done, "commit_id", "left_anti")
        return done.unionByName(
            waiting.select("commit_id", F.lit("requested").alias("state"), F.lit(0).cast("bigint").alias("n_rows"))
        )

    def versions(self, as_of: str | None = None) -> DataFrame:
        """Which commits changed which partition."""
        live = live_rows(self.log.rows(), as_of)
        touched = self.log.files([r.commit_id for r in live]).filter(F.col("action") != "expire")
        return touched.select("partition_path", F.col("commit_id").alias("version")).distinct()

    def latest_versions(self, as_of: str | None = None) -> DataFrame:
        return self.versions(as_of).groupBy("partition_path").agg(F.max("version").alias("version"))

    def retained_versions(self, retain: int) -> DataFrame:
        """Per partition, its current version and the ``retain`` before it."""
        newest_first = Window.partitionBy("partition_path").orderBy(F.desc("version"))
        ranked = self.versions().withColumn("_rank", F.dense_rank().over(newest_first))
        return ranked.filter(F.col("_rank") <= retain + 1).drop("_rank")

    def rollback(self, target: str, commit_id: str | None = None) -> str:
        """Undo the latest live commit; its files stay on disk until the next clean."""
        rows = self.log.rows()
        live = live_rows(rows)
        if not live or live[-1].commit_id != target:
            raise ValueError(f"only the latest live commit can be rolled back, not {target}")
        self._layers(live[:-1])  # refuses to bring back files that are gone
        commit_id = self._new_id(rows, commit_id)
        self.log.write(commit_id, kind=ROLLBACK, operation="rollback", target=target)
        self._tell(commit_id)
        return commit_id

    def clean(self, retain: int, commit_id: str | None = None) -> int:
        """Delete files no retained version needs.  Returns the number of files deleted.

        A file goes when the commit that replaced it is not newer than the oldest
        retained version of its partition.  At least one older version always
        stays, so the latest commit can still be rolled back.  Tasks delete the files.
        """
        if retain < 1:
            raise ValueError("retain at least one older version")
        rows = self.log.rows()
        live = live_rows(rows)
        commit_id = self._new_id(rows, commit_id)
        history = self.log.files([r.commit_id for r in rows if r.kind in (*DATA_KINDS, CLEAN)])
        ids = [r.commit_id for r in live]
        removed = history.filter(F.col("commit_id").isin(ids) & (F.col("action") == "remove"))
        expired = history.filter(F.col("action") == "expire").select("path")
        oldest = self.retained_versions(retain).groupBy("partition_path").agg(F.min("version").alias("oldest"))
        due = (
            removed.join(oldest, "partition_path")
            .filter(F.col("commit_id") <= F.col("oldest"))
            .join(expired, "path", "left_anti")
        )
        undone = [i for i in rolled_back(rows)]
        orphans = history.filter(F.col("commit_id").isin(undone or [""]) & (F.col("action") == "add"))
        orphans = orphans.join(expired, "path", "left_anti")
        doomed = due.select("layer", "path", "partition_path", "bytes").unionByName(
            orphans.select("layer", "path", "partition_path", "bytes")
        )
        doomed = doomed.withColumn("action", F.lit("expire"))
        if doomed.isEmpty():
            return 0
        # The list is stored once, gone through by tasks, and only then does a commit row say so: a clean that was cut
        # short is simply repeated, and files that are gone by then are no error.
        self.log.write_files(commit_id, doomed)
        listed = self.log.files([commit_id])
        named = F.concat(F.lit(f"{path_uri(self.spark, self.root)}/"), "layer", F.lit("/_version="), "path")
        delete_files(listed.select(named.alias("file")))
        n = listed.count()
        self.log.write(commit_id, kind=CLEAN, operation="clean", n_files=n)
        self._tell(commit_id)
        return n

    # ---- writing -------------------------------------------------------------------

    def bulk_insert(self, df: DataFrame, commit_id: str | None = None, n_files: int | None = None) -> str | None:
        """Load rows without matching them, sorted by partition and key.

        With ``n_files`` the rows are range-partitioned into that many files, so each
        file covers a key range and later lookups skip the others.  A hash of the
        row ends the range key, so a key that repeats without end fills several files.
        """
        return self._load(df, commit_id, "bulk_insert", n_files=n_files)

    def insert(self, df: DataFrame, commit_id: str | None = None, overwrite: bool = False) -> str | None:
        """Add rows without matching them; ``overwrite`` replaces the whole table."""
        return self._load(df, commit_id, "insert_overwrite" if overwrite else "insert", overwrite=overwrite)

    def upsert(
        self,
        changes: DataFrame,
        commit_id: str | None = None,
        policy: str | None = None,
        query_id: str | None = None,
        batch_id: int | None = None,
    ) -> str | None:
        """Apply a change batch.  Returns the commit id, or None for an empty or repeated batch."""
        if policy == DELETE:
            return self.delete(changes, commit_id, query_id, batch_id)
        rows = self.log.rows()
        if _seen(rows, query_id, batch_id):
            return None
        live = live_rows(rows)
        if live:
            stored = self._schema(live)
            incoming = conform(changes, stored, partial=(*self.spec.identity, *self.spec.order_by))
            schema = widen(stored, incoming.schema)
        else:
            incoming = lowercase_columns(changes)
            schema = _nullable(incoming.schema)
        return self._apply(
            incoming.select(*schema.names).withColumn(DELETED, F.lit(False)),
            schema, rows, self._new_id(rows, commit_id), "upsert",
            policy=policy, query_id=query_id, batch_id=batch_id,
        )

    def delete(
        self,
        keys: DataFrame,
        commit_id: str | None = None,
        query_id: str | None = None,
        batch_id: int | None = None,
    ) -> str | None:
        """Remove the listed records; only key (and partition) columns are needed."""
        rows = self.log.rows()
        live = live_rows(rows)
        if not live or _seen(rows, query_id, batch_id):
            return None
        schema = self._schema(live)
        keys = lowercase_columns(keys)
        on = self._listed_columns(keys)
        listed = keys.select(*on)
        if set(on) != set(self.spec.identity):
            # no partition given: look the records up to learn where they are
            listed = self.snapshot().join(listed, on, "left_semi").select(*self.spec.identity)
        if self.spec.partition_by and self.spec.global_key and self.spec.storage == MOR:
            listed = self.snapshot().join(listed, on, "left_semi").select(*self.spec.identity, *self.spec.partition_by)
        types = {f.name: f.dataType for f in schema.fields}
        doomed = listed.select(
            *[
                (F.col(c) if c in listed.columns else F.lit(None)).cast(types[c]).alias(c)
                for c in schema.names
            ],
            F.lit(True).alias(DELETED),
        )
        return self._apply(
            doomed, schema, rows, self._new_id(rows, commit_id), "delete",
            query_id=query_id, batch_id=batch_id,
        )

    def soft_delete(
        self, keys: DataFrame, commit_id: str | None = None, values: Mapping[str, object] | None = None
    ) -> str | None:
        """Keep the listed records but blank their other fields."""
        current = self.snapshot()
        keys = lowercase_columns(keys)
        on = self._listed_columns(keys)
        rows = current.join(keys.select(*on), on, "left_semi")
        return self.upsert(rows.withColumns(blank_values(current, self.spec, values)), commit_id)

    def delete_where(self, predicate: Column, commit_id: str | None = None) -> str | None:
        """Remove the rows a predicate selects; no join, the filter reaches the scan."""
        if self.spec.storage == MOR:
            return self.delete(self.snapshot().filter(predicate).select(*self.spec.identity), commit_id)
        return self._rewrite_where(predicate, None, commit_id, "delete")

    def update_where(
        self, predicate: Column, assignments: Mapping[str, Column], commit_id: str | None = None
    ) -> str | None:
        """SET columns on the rows a predicate selects."""
        fixed = sorted({*self.spec.keys, *self.spec.partition_by}.intersection(assignments))
        if fixed:
            raise ValueError(f"cannot update key or partition columns: {', '.join(fixed)}")
        types = {f.name: f.dataType for f in self.schema().fields}
        sets = {c: v.cast(types[c]) for c, v in assignments.items()}
        if self.spec.storage == MOR:
            return self.upsert(self.snapshot().filter(predicate).withColumns(sets), commit_id)
        return self._rewrite_where(predicate, sets, commit_id, "update")

    def schedule_compaction(self, commit_id: str | None = None) -> str:
        """Ask for a compaction of the deltas committed so far."""
        commit_id = self._new_id(self.log.rows(), commit_id)
        request = local_frame(self.spark, [(commit_id,)], "commit_id string")
        request.write.mode("append").json(f"{self.root}/log/requests")
        return commit_id

    def compact(self, commit_id: str | None = None) -> str | None:
        """Fold deltas into new base files.

        Given the id of a scheduled compaction, folds the deltas up to that moment.
        """
        rows = self.log.rows()
        scheduled = commit_id is not None and commit_id in {
            r.commit_id for r in self.compactions().filter("state = 'requested'").collect()
        }
        if not scheduled:
            commit_id = self._new_id(rows, commit_id)
        if any(r.kind in (COMMIT, COMPACTION) and r.commit_id > commit_id for r in live_rows(rows)):
            raise ValueError(f"the base has changed since compaction {commit_id} was scheduled")
        live = live_rows(rows, commit_id)
        _, deltas = self._layers(live)
        if not deltas.folders:
            return None
        schema = self._schema(live)
        folded = self._live_file_rows(live).filter(F.col("layer") == DELTA)
        return self._apply(
            newest_delta(self._scan(deltas, schema), self.spec), schema, rows, commit_id, "compact",
            kind=COMPACTION, as_of=commit_id, folded=folded,
        )

    # ---- how changes reach the files -------------------------------------------------

    def _load(self, df, commit_id, operation, n_files=None, overwrite=False):
        rows = self.log.rows()
        live = live_rows(rows)
        df = lowercase_columns(df)
        if live and not overwrite:
            stored = self._schema(live)
            df = conform(df, stored, partial=self.spec.identity)
            schema = widen(stored, df.schema)
        else:
            schema = _nullable(df.schema)
        commit_id = self._new_id(rows, commit_id)
        stage = None
        try:
            if not n_files:
                # stored once: its size says how many files it fills, and the ranges are drawn from it
                stage = scratch_dir(self.spark, "load")
                staging, sized = counted(df.select(*schema.names), held=_held(schema))
                staging.write.parquet(stage)
                df = self.spark.read.schema(schema).parquet(stage)
            stamped = self._stamp(df.select(*schema.names), commit_id)
            if n_files:
                placed = self._clustered(stamped, n_files, True)
            else:
                placed = self._clustered(stamped, *self._n_files(path_bytes(self.spark, stage), observed(sized).get("held", 0)))
            counts = self._write(placed, BASE, commit_id, bad=F.count_if(self._unusable()))
        finally:
            if stage:
                delete_path(self.spark, stage)
        self._refuse_bad_keys(counts, BASE, commit_id)
        removed = self._live_file_rows(live) if overwrite and live else None
        if not counts["rows"] and (removed is None or removed.isEmpty()):
            delete_path(self.spark, self._version(BASE, commit_id))
            return None
        self._commit(
            commit_id, BASE, schema, counts["rows"], removed, kind=COMMIT, operation=operation,
            rows_received=counts["rows"], rows_inserted=counts["rows"], rows_updated=0, rows_deleted=0,
        )
        return commit_id

    def _n_files(self, n_bytes: int, held: float) -> tuple[int, bool]:
        """How many files a load fills, by its bytes and the memory its rows take in a sort, and whether to range them.

        Partitions that fill no file are left to Spark, which splits the large ones among tasks.
        """
        by_bytes = -(-n_bytes // self.spec.target_file_bytes)
        if by_bytes <= 1 and self.spec.partition_by:
            return 1, False
        return max(by_bytes, self._sorts(held)), True

    def _sorts(self, held: float) -> int:
        """How many tasks share a sort of rows that take so much memory."""
        return max(1, int(-(-held // self.spec.sort_bytes)))

    def _clustered(self, df: DataFrame, n_files: int, exact: bool) -> DataFrame:
        """Rows dealt to about ``n_files`` files by ranges of partition and key, sorted within each.

        The ranges hold equally many rows; a hash of the row ends the range key, so that a key that repeats without end
        fills several files.  Where no file would be full, each partition goes to one task.
        """
        order = [*self.spec.partition_by, *self.spec.keys]
        if n_files <= 1 and not exact and self.spec.partition_by:
            return df.hint("rebalance", *self.spec.partition_by).sortWithinPartitions(*order)
        data = [c for c in df.columns if c not in (COMMIT_TIME, COMMIT_SEQNO)]
        return df.repartitionByRange(max(1, n_files), *order, F.xxhash64(*data)).sortWithinPartitions(*order)

    def _apply(
        self, changes, schema, rows, commit_id, operation, policy=None, kind=COMMIT, as_of=None,
        folded=None, query_id=None, batch_id=None,
    ):
        """Stage a change set once, then place it: in deltas, or into rewritten base files."""
        policy = policy or self.spec.policy
        live = live_rows(rows, as_of)
        deltas = self.spec.storage == MOR and kind != COMPACTION
        stage = scratch_dir(self.spark, "changes")
        if self.spec.strict_ties and operation == "upsert":
            tied = tied_keys(changes, self.spec.identity, self.spec.order_by, self.spec.tie_breakers)
            if not tied.isEmpty():
                raise ValueError(
                    f"{tied.count()} keys have rows tied on {', '.join(self.spec.order_by)}; declare tie_breakers"
                )
        # a rewrite sees the change set several times, so it is computed and stored once
        if kind == COMPACTION:
            ready, seen = counted(changes, held=_held(schema))
        else:
            checked, seen = counted(changes, bad=F.count_if(self._unusable(operation == "delete")), held=_held(schema))
            ready = self._stamp(
                precombine(checked, self.spec.identity, self.spec.order_by, self.spec.tie_breakers),
                commit_id,
            )
        header = dict(kind=kind, operation=operation, query_id=query_id, batch_id=batch_id)
        if deltas:
            written = self._write(ready.hint("rebalance", *self.spec.partition_by), DELTA, commit_id)
            counts = observed(seen)
            if not counts["rows"]:
                delete_path(self.spark, self._version(DELTA, commit_id))
                return None
            self._refuse_bad_keys(counts, DELTA, commit_id)
            # whether a pending row is new is not known before it meets the base; the compaction counts it then
            n = written["rows"]
            header.update(
                kind=DELTACOMMIT, rows_received=counts["rows"], rows_pending=n, rows_inserted=0, rows_updated=0, rows_deleted=0
            )
            self._commit(commit_id, DELTA, schema, n, None, **header)
            return commit_id
        try:
            if kind != COMPACTION:
                ready = ready.withColumn(FORCED, F.col(DELETED))  # a key-only delete has no ordering value
            ready.write.parquet(stage)
            counts = observed(seen)
            if not counts["rows"]:
                return None
            self._refuse_bad_keys(counts, None, commit_id)
            header["rows_received"] = counts["rows"]
            flags = [StructField(DELETED, BooleanType()), StructField(FORCED, BooleanType())]
            staged = self.spark.read.schema(StructType([*schema.fields, *_META_FIELDS, *flags])).parquet(stage)
            self._merge_into_base(
                staged, path_bytes(self.spark, stage), counts["held"] / counts["rows"], schema, live, commit_id, policy, folded, header
            )
        finally:
            delete_path(self.spark, stage)
        return commit_id

    def _merge_into_base(self, staged, staged_bytes, row_held, schema, live, commit_id, policy, folded, header):
        """Replace every file that holds a staged key, and find room for new records.

        The wide rows are shuffled once: each goes straight to a task that writes
        a part of its file's successor, where markers for replaced keys cancel the stored
        rows.  No join ever sees the stored rows' other columns.  Mere deletions shuffle nothing.
        """
        on = list(self.spec.identity)
        parts = list(self.spec.partition_by)
        layer, _ = self._layers(live, deltas=False)
        pairs_path = scratch_dir(self.spark, "matches")
        matches = self._match(staged, schema, layer, policy, pairs_path)
        files = self._live_file_rows(live).filter(F.col("layer") == BASE)
        touched = self._touched(matches.pairs, files)
        n_matched = sum(r.n for r in touched)
        try:
            if header["operation"] == "delete" and self._small_enough(pairs_path):
                written = self._write_without(pairs_path, touched, layer, schema, commit_id) if touched else {"rows": 0}
                header.update(rows_inserted=0, rows_updated=0, rows_deleted=n_matched)
                self._commit(commit_id, BASE, schema, written["rows"], self._removals(touched), **header)
                return
            changed = staged.filter(~F.col(DELETED)).drop(DELETED, FORCED)
            home = [_FILE, "_home", _ROW]
            if matches.pairs is None:
                homes = local_frame(self.spark, [], StructType([schema[c] for c in on])).withColumns(
                    {_FILE: F.lit(None).cast("string"), "_home": F.lit(None).cast("string"), _ROW: F.lit(None).cast("bigint")}
                )
            else:
                if policy == EVENT_TIME:
                    changed = changed.join(matches.beaten, on, "left_anti")
                first = F.min(F.struct(*home)).alias("_first_match")
                homes = matches.pairs.groupBy(*on).agg(first).select(*on, *[f"_first_match.{c}" for c in home])
            changed = changed.join(homes, on, "left").withColumn(PARTITION_PATH, partition_path(parts))
            is_new = F.col(_FILE).isNull()
            stays = ~is_new & F.col("_home").eqNullSafe(F.col(PARTITION_PATH))
            # per partition: rows that arrive, that have no file to go back to, that are new records
            arriving = changed.groupBy(PARTITION_PATH).agg(
                F.count("*").alias("n"), F.count_if(~stays).alias("n_homeless"), F.count_if(is_new).alias("n_new")
            )
            room = files.filter(F.col("bytes") < self.spec.small_file_bytes).groupBy("partition_path")
            room = room.agg(F.min(F.struct("bytes", "path")).alias("smallest")).withColumnRenamed("partition_path", "_room")
            arriving = arriving.join(room, F.col(PARTITION_PATH) == F.col("_room"), "left").drop("_room").collect()
            row_bytes = staged_bytes / max(1, sum(r.n for r in arriving))
            touched, slots, homes_of_new, n_slots = self._slots(touched, arriving, row_bytes, row_held, layer, schema)
            slot_of_path = local_frame(self.spark, homes_of_new, f"{PARTITION_PATH} string, _first int, _n int")
            slot_of_file = local_frame(self.spark, slots, f"{_FILE} string, {_SLOT} int, _parts int, _rows bigint")
            # rows of a large file go to one of its parts by their place in it, which is a range of keys
            own_slot = F.col(_SLOT) + F.least(F.col("_parts") - 1, F.floor(F.col(_ROW) * F.col("_parts") / F.col("_rows"))).cast("int")
            spread = F.col("_first") + F.pmod(F.xxhash64(*self.spec.keys), F.col("_n")).cast("int")
            columns = [*schema.names, COMMIT_TIME, COMMIT_SEQNO]
            out = (
                changed.withColumn(_FILE, F.when(stays, F.col(_FILE)))
                .join(slot_of_file, _FILE, "left")
                .join(slot_of_path, PARTITION_PATH, "left")
                .select(*columns, F.coalesce(own_slot, spread).alias(_SLOT), F.lit(_CHANGED).alias(_TAG))
            )
            if touched:
                split = any(n > 1 for _, _, n, _ in slots)
                kept = self._scan(layer, schema, located=True, placed=split, only=[r.path for r in touched])
                kept = kept if split else kept.withColumn(_ROW, F.lit(0))
                kept = kept.join(slot_of_file, _FILE).select(*columns, own_slot.alias(_SLOT), F.lit(_STORED).alias(_TAG))
                out = kept.unionByName(out)
            if n_matched:
                gone = matches.pairs.join(slot_of_file, _FILE)
                gone = gone.select(*dict.fromkeys((*parts, *self.spec.keys)), own_slot.alias(_SLOT), F.lit(_GONE).alias(_TAG))
                out = out.unionByName(gone, allowMissingColumns=True)
            out = out.repartitionById(max(n_slots, 1), F.col(_SLOT))
            order = list(dict.fromkeys((*parts, *self.spec.keys)))
            if n_matched:
                # sorted by partition and key, as the files are written; the newest tag leads its key
                same_record = Window.partitionBy(*order, _SLOT).orderBy(F.desc(_TAG))
                leading = F.max(_TAG).over(same_record.rowsBetween(Window.unboundedPreceding, Window.currentRow))
                survives = (F.col(_TAG) == _CHANGED) | (F.col("_leading") == _STORED)
                out = out.withColumn("_leading", leading).filter(survives)
            else:
                out = out.sortWithinPartitions(*order)
            written = self._write(out.select(*columns), BASE, commit_id)
            n_new = sum(r.n_new for r in arriving)
            n_changed = sum(r.n for r in arriving)
            header.update(
                rows_inserted=n_new, rows_updated=n_changed - n_new, rows_deleted=n_matched - (n_changed - n_new)
            )
            removed = self._removals(touched)
            removed = removed if folded is None else removed.unionByName(folded.select(F.lit("remove").alias("action"), *removed.columns[1:]))
            self._commit(commit_id, BASE, schema, written["rows"], removed, **header)
        finally:
            delete_path(self.spark, pairs_path)

    def _match(self, staged, schema, layer: _Layer, policy, pairs_path) -> _Matches:
        """Find stored rows with a staged key, reading key columns of candidate files only.

        Candidates are the files of partitions the change set touches; the range of
        its keys there prunes row groups.  The staged side is broadcast by Spark if small.
        """
        on = list(self.spec.identity)
        parts = list(self.spec.partition_by)
        if not layer.folders:
            return _Matches(None, None)
        ranges = [
            f(c).alias(f"{name}_{i}")
            for i, c in enumerate(self.spec.keys)
            for name, f in (("lo", F.min), ("hi", F.max))
        ]
        by_path = F.lit("") if self.spec.global_key else partition_path(parts)
        bounds = staged.groupBy(by_path.alias("_path")).agg(*ranges).collect()
        stored = self._candidates(self._scan(layer, schema, located=True, placed=True), bounds)
        found = [*dict.fromkeys((*parts, *self.spec.keys)), _FILE, _ROW, partition_path(parts).alias("_home")]
        offered = staged.select(*on)
        if policy == EVENT_TIME:
            found.append(F.struct(*self.spec.order_by).alias("_stored"))
            offered = staged.select(*on, offered_order(staged, self.spec).alias("_offered"))
        pairs = stored.select(*found).join(offered, on)
        pairs.write.parquet(pairs_path)
        pairs = self.spark.read.schema(pairs.schema).parquet(pairs_path)
        beaten = None
        if policy == EVENT_TIME:
            beaten = pairs.filter("_stored > _offered").select(*on)
            pairs = pairs.join(beaten, on, "left_anti")
        return _Matches(pairs, beaten)

    def _candidates(self, stored: DataFrame, bounds: list[Row]) -> DataFrame:
        """Stored rows that lie in the key range of their own partition's changes.

        ``bounds``: per touched partition, the smallest and largest value of each key column.  Partitions whose ranges
        overlap share a filter; the others get one each, so that a range in one partition opens no files of another.
        """
        groups: list[list[Row]] = []
        end = None
        for r in sorted(bounds, key=lambda r: r["lo_0"]):
            if groups and r["lo_0"] <= end:
                groups[-1].append(r)
                end = max(end, r["hi_0"])
            else:
                groups.append([r])
                end = r["hi_0"]
        size = -(-len(groups) // RANGES)
        groups = [sum(groups[at : at + size], []) for at in range(0, len(groups), size or 1)]
        branches = []
        for group in groups:
            branch = stored
            for i, key in enumerate(self.spec.keys):
                branch = branch.filter(F.col(key).between(F.lit(min(r[f"lo_{i}"] for r in group)), F.lit(max(r[f"hi_{i}"] for r in group))))
            if self.spec.partition_by and not self.spec.global_key and len(group) <= NAMED:
                branch = branch.filter(partition_path(self.spec.partition_by).isin([r["_path"] for r in group]))
            branches.append(branch)
        out = branches[0] if branches else stored.limit(0)
        for branch in branches[1:]:
            out = out.unionByName(branch)
        return out

    def _touched(self, pairs: DataFrame | None, files: DataFrame) -> list[Row]:
        """The files a change set touches, with the number of rows to be replaced: path, partition_path, bytes, n."""
        if pairs is None:
            return []
        counts = pairs.groupBy(_FILE).agg(F.count("*").alias("n"))
        rows = files.join(counts, F.col("path") == F.col(_FILE)).select("layer", "path", "partition_path", "bytes", "n").collect()
        return sorted(rows, key=lambda r: r.path)

    def _removals(self, touched: list[Row]) -> DataFrame:
        return local_frame(self.spark, [("remove", r.layer, r.path, r.partition_path, r.bytes) for r in touched], _REMOVED)

    def _small_enough(self, path: str) -> bool:
        """Whether Spark would broadcast a stored frame."""
        limit = self.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        if limit.lstrip("-").isdigit():
            limit = int(limit)
        else:
            limit = self.spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)
        return path_exists(self.spark, path) and path_bytes(self.spark, path) <= limit

    def _write_without(self, pairs_path, touched, layer, schema, commit_id) -> dict:
        """Write the successors of the touched files without the matched keys: each file is read and written by one task.

        Nothing is shuffled.  Only a file larger than ``rewrite_bytes`` is dealt to several tasks, each of which
        takes a stretch of it.
        """
        on = list(self.spec.identity)
        apart = whole_files(self.spark, self.spec.rewrite_bytes)
        kept = self._scan(layer, schema, only=[r.path for r in touched], session=apart)
        gone = apart.read.parquet(pairs_path).select(*on)
        return self._write_in_order(kept.join(gone, on, "left_anti"), schema, commit_id)

    def _write_in_order(self, df, schema, commit_id, **more) -> dict:
        """Write rows that come file by file in key order; only folders of partitions ask for a sort of their own."""
        df = df.select(*schema.names, COMMIT_TIME, COMMIT_SEQNO)
        order = list(dict.fromkeys((*self.spec.partition_by, *self.spec.keys)))
        return self._write(df.sortWithinPartitions(*order) if self.spec.partition_by else df, BASE, commit_id, **more)

    def _slots(self, touched: list[Row], arriving: list[Row], row_bytes: float, row_held: float, layer: _Layer, schema: StructType):
        """Number the new files: parts of each replaced file, then room for new rows by partition.

        New rows join their partition's smallest file while that stays small; otherwise they get files of
        the target size of their own, however many the partition needs.  A file has as many parts as its bytes,
        and the memory of the rows that are sorted for it, ask for.  Gives the replaced files, their rows
        (path, first number, parts, rows), the numbers for new rows by partition, and how many there are.
        """
        touched = {r.path: r for r in touched}
        joins, apart = {}, {}
        lengths = {}
        if paths := sorted({*touched, *[r.smallest.path for r in arriving if r.n_homeless and r.smallest]}):
            counted_rows = self._scan(layer, schema, located=True, only=paths).groupBy(_FILE).agg(F.count("*").alias("n"))
            lengths = {r[_FILE]: r.n for r in counted_rows.collect()}
        # a stored row that is replaced meets a marker and its successor
        sorted_rows = {p: lengths.get(p, 0) + (2 * touched[p].n if p in touched else 0) for p in paths}
        for r in arriving:
            need = r.n_homeless * row_bytes
            fits = r.n_homeless and r.smallest and r.smallest.bytes + need <= self.spec.target_file_bytes
            if fits and self._sorts((sorted_rows[r.smallest.path] + r.n_homeless) * row_held) == 1:
                path = r.smallest.path
                joins[r[PARTITION_PATH]] = path
                touched.setdefault(path, Row(layer=BASE, path=path, partition_path=r[PARTITION_PATH], bytes=r.smallest.bytes, n=0))
            elif r.n_homeless:
                apart[r[PARTITION_PATH]] = max(self._sorts(r.n_homeless * row_held), -int(-need // self.spec.target_file_bytes))
        parts = {p: max(self._sorts(sorted_rows[p] * row_held), -(-r.bytes // self.spec.rewrite_bytes)) for p, r in touched.items()}
        slots, following = [], 0
        for path in sorted(touched):
            slots.append((path, following, parts[path], max(1, lengths.get(path, 1))))
            following += parts[path]
        first = {path: at for path, at, _, _ in slots}
        homes = [(p, first[path], 1) for p, path in joins.items()]
        for p, n in sorted(apart.items()):
            homes.append((p, following, n))
            following += n
        return list(touched.values()), slots, homes, following

    def _rewrite_where(self, predicate, sets, commit_id, operation):
        rows = self.log.rows()
        live = live_rows(rows)
        schema = self._schema(live)
        layer, _ = self._layers(live, deltas=False)
        chosen = F.coalesce(predicate, F.lit(False))
        files = self._live_file_rows(live).filter(F.col("layer") == BASE)
        hits = self._scan(layer, schema, located=True).filter(predicate).select(_FILE)
        touched = self._touched(hits, files)
        if not touched:
            return None
        commit_id = self._new_id(rows, commit_id)
        part = self._scan(layer, schema, only=[r.path for r in touched], session=whole_files(self.spark, self.spec.rewrite_bytes))
        # counted where the rows are changed, so that the numbers are those of this very pass
        marked, seen = counted(part.withColumn(_TAG, chosen), chosen=F.count_if(F.col(_TAG)))
        if sets is None:
            out = marked.filter(~F.col(_TAG))
        else:
            stamp = {COMMIT_TIME: F.lit(commit_id), COMMIT_SEQNO: F.monotonically_increasing_id()}
            out = marked.withColumns({c: F.when(F.col(_TAG), v).otherwise(F.col(c)) for c, v in {**sets, **stamp}.items()})
        written = self._write_in_order(out, schema, commit_id)
        n = observed(seen)["chosen"]
        self._commit(
            commit_id, BASE, schema, written["rows"], self._removals(touched), kind=COMMIT, operation=operation,
            rows_inserted=0, rows_updated=0 if sets is None else n, rows_deleted=n if sets is None else 0,
        )
        return commit_id

    # ---- files and log ---------------------------------------------------------------

    def _listed_columns(self, keys: DataFrame) -> list[str]:
        """Identity columns a key list has; it must have every key column."""
        absent = [c for c in self.spec.keys if c not in keys.columns]
        if absent:
            raise ValueError(f"key list lacks {', '.join(absent)}")
        return [c for c in self.spec.identity if c in keys.columns]

    def _unusable(self, keys_only: bool = False) -> Column:
        """Rows with no usable key or partition value."""
        parts = () if keys_only and self.spec.global_key else self.spec.partition_by
        test = any_null([*self.spec.keys, *parts])
        for name in parts:
            test = test | (F.col(name).cast("string") == "")
        return test

    def _refuse_bad_keys(self, counts: dict, layer: str | None, commit_id: str) -> None:
        if counts.get("bad"):
            if layer:
                delete_path(self.spark, self._version(layer, commit_id))
            names = ", ".join((*self.spec.keys, *self.spec.partition_by))
            raise ValueError(f"{counts['bad']} rows have NULL in a key or partition column ({names})")

    def _stamp(self, df: DataFrame, commit_id: str) -> DataFrame:
        return df.withColumns({COMMIT_TIME: F.lit(commit_id), COMMIT_SEQNO: F.monotonically_increasing_id()})

    def _version(self, layer: str, commit_id: str) -> str:
        return f"{self.root}/{layer}/_version={commit_id}"

    def _write(self, df: DataFrame, layer: str, commit_id: str, **more: Column) -> dict:
        """Write one version folder; returns the number of rows, seen by the writing tasks."""
        checked, seen = counted(df, **more)
        writer = checked.write.mode("overwrite").option("compression", "snappy")
        if self.spec.partition_by:
            writer = writer.partitionBy(*self.spec.partition_by)
        writer.parquet(self._version(layer, commit_id))
        return observed(seen)

    def _stored_schema(self, schema: StructType, layer: str) -> StructType:
        extra = [StructField(DELETED, BooleanType())] if layer == DELTA else []
        return StructType([*schema.fields, *_META_FIELDS, *extra])

    def _scan(
        self, layer: _Layer, schema: StructType, located: bool = False, placed: bool = False,
        only: list[str] | None = None, session: SparkSession | None = None,
    ) -> DataFrame:
        """Read a layer's live files as one native Parquet scan of its version folders.

        Files that are not live are left out by their name, while Spark lists the folders; a list too long for a plan
        is joined instead.  ``only`` keeps the named ones of them.  ``located`` adds each row's file and ``placed`` its
        place there, on request only: Spark reads row numbers as well when the file metadata ends up unused.
        """
        spark = session or self.spark
        stored = self._stored_schema(schema, layer.name)
        if not layer.folders:
            extra = [StructField(_FILE, StringType())] * located + [StructField(_ROW, LongType())] * placed
            return spark.createDataFrame([], StructType([*stored.fields, *extra]))
        df = spark.read.schema(stored).option("basePath", f"{self.root}/{layer.name}").parquet(*layer.folders)
        own = _logged(F.col("_metadata.file_path"))
        if isinstance(layer.skipped, list):
            if layer.skipped:
                df = df.filter(~own.isin(layer.skipped))
            if only is not None and len(only) <= NAMED:
                df = df.filter(own.isin(only))
                only = None
        join_skipped = not isinstance(layer.skipped, list)
        if located or join_skipped or only is not None:
            df = df.withColumn(_FILE, own)
        if placed:
            df = df.withColumn(_ROW, F.col("_metadata.row_index"))
        if join_skipped:
            df = df.join(spark.read.schema("path string").parquet(layer.skipped), F.col(_FILE) == F.col("path"), "left_anti")
        if only is not None:
            df = df.join(local_frame(spark, [(p,) for p in only], "_only string"), F.col(_FILE) == F.col("_only"), "left_semi")
        return df.drop("_version") if located else df.drop("_version", _FILE)

    def _commit(self, commit_id, layer, schema, n_rows: int, removed: DataFrame | None, **header) -> None:
        """Log a finished write.  Its files are listed by the executors; none is opened.

        A version left without rows has no file worth logging (and no partition folders).
        """
        gone = local_frame(self.spark, [], _REMOVED) if removed is None else removed
        gone = gone.select(F.lit("remove").alias("action"), "layer", "path", "partition_path", "bytes")
        changed = self._listing(layer, [self._version(layer, commit_id)], schema).unionByName(gone) if n_rows else gone
        files, seen = counted(changed.hint("rebalance"), n_added=F.count_if(F.col("action") == "add"))
        self.log.write_files(commit_id, files)
        n_files = observed(seen).get("n_added", 0)
        self.log.write(commit_id, n_files=n_files, table_schema=schema.json(), **header)
        self._tell(commit_id)

    def _tell(self, commit_id: str) -> None:
        for hook in self.hooks:
            hook(self, commit_id)

    def _listing(self, layer: str, folders: list[str], schema: StructType | None) -> DataFrame:
        """The files of version folders; without a schema, their paths only."""
        parts = "" if schema is None else ", ".join(f"`{c}` {schema[c].dataType.simpleString()}" for c in self.spec.partition_by)
        listing = "path string, modificationTime timestamp, length bigint, content binary"
        written = (
            self.spark.read.format("binaryFile")
            .schema(f"{listing}, {parts}" if parts else listing)
            .option("basePath", f"{self.root}/{layer}")
            .option("pathGlobFilter", "*.parquet")
            .load(folders)
        )
        path = _logged(F.col("_metadata.file_path")).alias("path")
        if schema is None:
            return written.select(path)
        return written.select(
            F.lit("add").alias("action"),
            F.lit(layer).alias("layer"),
            path,
            partition_path(self.spec.partition_by).alias("partition_path"),
            F.col("_metadata.file_size").alias("bytes"),
        )

    def _live_file_rows(self, live: list[Row]) -> DataFrame:
        rows = self.log.files([r.commit_id for r in live])
        removed = rows.filter(F.col("action") == "remove").select("path")
        added = rows.filter(F.col("action") == "add").join(removed, "path", "left_anti")
        return added.select("layer", "commit_id", "path", "partition_path", "bytes")

    def _layers(self, live: list[Row], deltas: bool = True) -> tuple[_Layer, _Layer]:
        """Base and deltas of a version, once what lies in the folders is found to agree with the log.

        Names are compared by Spark.  A listed file that is not there raises; a file that is there but not
        listed is not read, whether it was replaced or never belonged.  To the driver come a row for each commit and
        the names that differ, as long as a plan can hold them.
        """
        listed = self._live_file_rows(live)
        listed = listed if deltas else listed.filter(F.col("layer") == BASE)
        held = sorted((r.layer, r.commit_id) for r in listed.select("layer", "commit_id").distinct().collect())
        folders = {name: [self._version(layer, c) for layer, c in held if layer == name] for name in (BASE, DELTA)}
        flag = lambda name: [F.lit(int(name == f)).alias(f) for f in ("live", "there", "expired")]
        both = listed.select("path", *flag("live"))
        try:
            for name, paths in folders.items():
                if paths:
                    both = both.union(self._listing(name, paths, None).select("path", *flag("there")))
        except AnalysisException as error:
            raise FileNotFoundError(f"{self.root} has lost a version folder: {error}") from error
        cleans = [r.commit_id for r in self.log.rows() if r.kind == CLEAN] if held else []
        if cleans:
            # An old version can be read, or returned to, only while retention has left its files in place.
            expired = self.log.files(cleans).filter(F.col("action") == "expire")
            both = both.union(expired.select("path", *flag("expired")))
        odd = both.groupBy("path").agg(*[F.max(f).alias(f) for f in ("live", "there", "expired")])
        odd = odd.filter("live <> there OR live + expired = 2")
        found = odd.limit(NAMED + 1).collect() if held else []
        bad = [r for r in found if r.live] if len(found) <= NAMED else odd.filter("live = 1").limit(1).collect()
        if any(r.expired for r in bad):
            raise ValueError("this version needs files that retention has removed")
        if bad:
            raise FileNotFoundError(f"{self.root} has lost data files, {bad[0].path} among them")
        skipped: list[str] | str = [r.path for r in found]
        if len(found) > NAMED:
            skipped = scratch_dir(self.spark, "skipped")
            odd.select("path").write.parquet(skipped)
        return _Layer(BASE, folders[BASE], skipped), _Layer(DELTA, folders[DELTA], skipped)

    def _schema(self, live: list[Row]) -> StructType:
        if not live:
            raise ValueError(f"{self.root} has no commit")
        return StructType.fromJson(json.loads(live[-1].table_schema))

    def _new_id(self, rows: list[Row], commit_id: str | None) -> str:
        """A commit id later than every other; made from the clock unless one is given."""
        last = max((r.commit_id for r in rows), default="")
        if commit_id is None:
            commit_id = datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")[: len(last) or 17]
            if commit_id <= last:
                commit_id = str(int(last) + 1).zfill(len(last))
            if commit_id <= last:
                commit_id = f"{last}0"  # ids compare as text, and one of this length is not left
        if commit_id <= last:
            raise ValueError(f"commit id {commit_id} is not later than {last}")
        return commit_id


def _seen(rows: list[Row], query_id: str | None, batch_id: int | None) -> bool:
    """Whether a streaming batch is already committed."""
    return query_id is not None and any(r.query_id == query_id and r.batch_id == batch_id for r in rows)


def _held(schema: StructType) -> Column:
    """Memory that rows take in a sort: a word a column, what values of no fixed length need, and the table's own columns."""
    wide = F.lit(8 * (len(schema.fields) + 3) + 48).cast("bigint")
    for f in schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType)):
            value = F.to_json(F.struct(value))
        elif not isinstance(f.dataType, (StringType, BinaryType)):
            continue
        wide = wide + F.coalesce(F.octet_length(value), F.lit(0))
    return F.sum(wide)


def _nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])


def _logged(file_path: Column) -> Column:
    """A file's path below its layer's version folders, as the log names it."""
    return F.substring_index(file_path, "/_version=", -1)

