"""Make a table queryable by name through Spark's own catalog.

Catalog tables ``<name>__files``, ``<name>__deltas`` and ``<name>__log`` cover the version folders and the list of
their files; a view ``<name>`` on top of them shows the live base rows, and ``<name>_rt``, for a table that merges on
read, those with their pending changes.  The views name commits, never files.  ``keep_synced`` follows every commit.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from ..functions.scratch import path_exists
from ..operators.merge import DELETED
from ..operators.schema import diff_schemas
from ..spec import COMMIT_TIME, EVENT_TIME, MOR, TableSpec
from ..tables import KeyedTable
from ..tables.log import FILE_SCHEMA, live_rows

_LOGGED_PATH = "substring_index(_metadata.file_path, '/_version=', -1)"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_ddl(name: str, schema: StructType, partition_by: tuple[str, ...], location: str) -> str:
    """CREATE TABLE statement of the file table: data columns, then version and partitions."""
    parts = ["_version", *partition_by]
    types = {f.name: f.dataType.simpleString() for f in schema.fields} | {"_version": "string"}
    data = [c for c in schema.names if c not in parts]
    columns = ", ".join(f"`{c}` {types[c]}" for c in [*data, *parts])
    listed = ", ".join(f"`{c}`" for c in parts)
    return f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({listed}) LOCATION {_quoted(location)}"


def _sync_table(spark: SparkSession, name: str, schema: StructType, partition_by: tuple[str, ...], location: str) -> None:
    """Create or widen a file table, and add the folders that are new."""
    if spark.catalog.tableExists(name):
        stored = StructType([f for f in spark.table(name).schema.fields if f.name != "_version"])
        # a renamed sort of columns is harmless: the view lists them by name
        diff = diff_schemas(schema, stored)
        if diff.retyped or diff.missing:
            spark.sql(f"DROP TABLE {name}")
        elif diff.added:
            added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in diff.added)
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
    if not spark.catalog.tableExists(name):
        spark.sql(create_ddl(name, schema, partition_by, location))
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def sync_catalog(table: KeyedTable, name: str) -> None:
    """Create or update the catalog entry of a table for its latest commit."""
    spark, spec = table.spark, table.spec
    schema = table.schema().add(COMMIT_TIME, "string")
    _sync_table(spark, f"{name}__files", schema, spec.partition_by, f"{table.root}/base")
    log = f"{name}__log"
    if not spark.catalog.tableExists(log):
        columns = FILE_SCHEMA.replace(", commit_id string", "")
        spark.sql(f"CREATE TABLE {log} ({columns}, commit_id string) USING parquet PARTITIONED BY (commit_id) LOCATION {_quoted(table.root + '/log/files')}")
    spark.sql(f"MSCK REPAIR TABLE {log} SYNC PARTITIONS")
    spark.catalog.refreshTable(log)
    columns = ", ".join(f"`{c}`" for c in table.schema().names)
    base = _live_query(table, "base", f"{name}__files", log, table.schema().names)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {base}")
    if spec.storage != MOR:
        return
    pending = table.schema().names
    if path_exists(spark, f"{table.root}/delta"):
        _sync_table(spark, f"{name}__deltas", schema.add(DELETED, "boolean"), spec.partition_by, f"{table.root}/delta")
        deltas = _live_query(table, "delta", f"{name}__deltas", log, [*pending, COMMIT_TIME, DELETED])
        spark.sql(f"CREATE OR REPLACE VIEW {name}_rt AS {_realtime_query(spec, columns, base, deltas)}")
    else:
        spark.sql(f"CREATE OR REPLACE VIEW {name}_rt AS {base}")


def keep_synced(table: KeyedTable, name: str) -> None:
    """Sync now, and again after every commit, clean or rollback that this table object makes."""
    sync_catalog(table, name)
    table.hooks.append(lambda changed, commit_id: sync_catalog(changed, name))


def _live_query(table: KeyedTable, layer: str, files: str, log: str, columns: list[str]) -> str:
    """Rows of the layer's live files: those that a live commit added and none removed."""
    live = [r.commit_id for r in live_rows(table.log.rows())]
    held = [r.commit_id for r in table.files().filter(f"layer = '{layer}'").select("commit_id").distinct().collect()]
    names = ", ".join(f"`{c}`" for c in columns)
    if not held:
        return f"SELECT {names} FROM {files} WHERE false"
    listed = lambda ids: ", ".join(map(_quoted, sorted(ids)))
    of_layer = f"SELECT *, {_LOGGED_PATH} AS `_path` FROM {files} WHERE `_version` IN ({listed(held)})"
    kept = f"SELECT path FROM {log} WHERE commit_id IN ({listed(live)}) GROUP BY path HAVING count_if(action = 'remove') = 0"
    return f"SELECT {names} FROM ({of_layer}) f LEFT SEMI JOIN ({kept}) k ON f.`_path` = k.path"


def _realtime_query(spec: TableSpec, columns: str, base: str, deltas: str) -> str:
    """Base rows without a pending change, and the newest pending change of each key.

    The same rules as ``merge_on_read``: the last commit wins, or under ``event_time`` the largest ordering value, where a
    delete ends what came before it and it, and what follows it, wins over the base.
    """
    on = ", ".join(f"`{c}`" for c in spec.identity)
    order = ", ".join(f"`{c}`" for c in spec.order_by)
    same = lambda a, b: " AND ".join(f"{a}.`{c}` = {b}.`{c}`" for c in spec.identity)
    if spec.policy == EVENT_TIME:
        source = f"""SELECT *, max(CASE WHEN {DELETED} THEN {COMMIT_TIME} END) OVER (PARTITION BY {on}) AS `_ended` FROM ({deltas})"""
        source = f"SELECT *, `_ended` IS NOT NULL AS `_wins` FROM ({source}) WHERE `_ended` IS NULL OR {COMMIT_TIME} >= `_ended`"
        ranking = f"struct({order}, {COMMIT_TIME})"
    else:
        source, ranking = f"SELECT *, true AS `_wins` FROM ({deltas})", COMMIT_TIME
    newest = f"SELECT max_by(struct({columns}, {DELETED}, `_wins`), {ranking}) AS r FROM ({source}) GROUP BY {on}"
    newest = f"SELECT r.* FROM ({newest})"
    if spec.policy == EVENT_TIME:
        stored = f"SELECT {on}, struct({order}) AS `_stored` FROM ({base})"
        newest = f"SELECT n.* FROM ({newest}) n LEFT ANTI JOIN ({stored}) s ON {same('n', 's')} AND NOT n.`_wins` AND s.`_stored` > struct({', '.join(f'n.`{c}`' for c in spec.order_by)})"
    names = ", ".join(f"b.{c}" for c in columns.split(", "))
    return f"""WITH pending AS ({newest})
        SELECT {names} FROM ({base}) b LEFT ANTI JOIN pending p ON {same('b', 'p')}
        UNION ALL SELECT {columns} FROM pending WHERE NOT {DELETED}"""


def register_view(table: KeyedTable, name: str, **options) -> None:
    """A session view of a snapshot; takes the options of ``KeyedTable.snapshot``."""
    table.snapshot(**options).createOrReplaceTempView(name)


def drop_from_catalog(spark: SparkSession, name: str) -> None:
    """Forget a synced table; its data stays."""
    for view in (f"{name}_rt", name):
        spark.sql(f"DROP VIEW IF EXISTS {view}")
    for part in ("files", "deltas", "log"):
        spark.sql(f"DROP TABLE IF EXISTS {name}__{part}")
