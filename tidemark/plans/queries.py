"""One runnable query per operator, each over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.keys import derive_keys, lowercase_columns, partition_values
from ..functions.scratch import scratch_dir
from ..functions.text import metric_name, metric_table, parse_list, parse_timestamp, to_number
from ..metrics import commit_metrics as metrics_of
from ..operators import counts, merge, schema
from ..operators.precombine import precombine, precombine_window
from ..sinks import keep_synced, manifest_counts, manifest_text, read_manifest, sync_catalog, write_manifest
from ..sources import event_struct, file_events, full_load, json_records, parse_events, read_files
from ..spec import EVENT_TIME, METADATA_COLUMNS, MOR, TableSpec
from ..streaming import ChangeStream
from ..tables import KeyedTable
from . import sales
from .sales import BATCH, FLAT, KEYS, ORDER, PARTITIONED, R, RP, TIES

C1, C2, C3, C4, C5 = (f"2024010100000{i}" for i in range(1, 6))
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name; a trailing underscore only avoids a clash with an import."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


# ---- shared set-up -----------------------------------------------------------------


def _sets(spark, sf, *columns):
    """Base, updates and inserts, each with the wanted columns."""
    wanted = columns or R
    plain = sales.base(spark, sf, "quantity", "flag", "discount", *wanted)
    if "year" in wanted:
        plain = sales.with_partitions(plain)
    return [df.select(*wanted) for df in (plain, sales.updates(plain), sales.inserts(plain))]


def _new_table(spark, spec: TableSpec) -> KeyedTable:
    return KeyedTable.create(spark, scratch_dir(spark, "table"), spec)


def _loaded(spark, sf, spec: TableSpec, *columns) -> tuple[KeyedTable, DataFrame, DataFrame]:
    """A table holding the base as commit C1, with the two change sets."""
    base, updates, inserts = _sets(spark, sf, *(columns or (RP if spec.partition_by else R)))
    table = _new_table(spark, spec)
    table.insert(base, C1)
    return table, updates, inserts


def _upserted(spark, sf, spec: TableSpec, *columns) -> KeyedTable:
    table, updates, inserts = _loaded(spark, sf, spec, *columns)
    table.upsert(updates.unionByName(inserts), C2)
    return table


# ---- scans and sources ---------------------------------------------------------------


@query
def full_load_scan(spark, sf):
    df = full_load(spark, f"{sf}/lineitem*.parquet")
    return df.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_shipdate").cast("date").alias("order_date"),
    )


@query
def file_list_scan(spark, sf):
    folder = scratch_dir(spark, "files")
    for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
        rows = sales.table(spark, sf, name).select(F.col(key).alias("key"), F.lit(name).alias("source"))
        rows.write.parquet(f"{folder}/{name}")
    written = spark.read.parquet(f"{folder}/lineitem", f"{folder}/orders")
    # the paths travel as event messages, as the stream receives them
    messages = (
        written.select(F.col("_metadata.file_path").alias("path"))
        .distinct()
        .select(F.to_json(F.struct("path")).alias("value"))
    )
    paths = [r["path"] for r in parse_events(messages, "path string").collect()]
    return read_files(spark, paths).groupBy("source").agg(F.count("*").alias("n"))


@query
def snapshot_read(spark, sf):
    return _upserted(spark, sf, PARTITIONED).snapshot()


@query
def catalog_scan(spark, sf):
    name = f"sales_{uuid.uuid4().hex}"
    sync_catalog(_upserted(spark, sf, PARTITIONED), name)
    return spark.sql(f"SELECT {', '.join(RP)} FROM {name} WHERE order_id IN (101, 202, 303)")


@query
def catalog_realtime(spark, sf):
    """The pending changes by name, with no sync asked for after the commit that brought them."""
    table, updates, inserts = _loaded(spark, sf, PARTITIONED.with_(storage=MOR))
    name = f"sales_{uuid.uuid4().hex}"
    keep_synced(table, name)
    table.upsert(updates.unionByName(inserts), C2)
    return spark.sql(f"SELECT {', '.join(RP)} FROM {name}_rt")


@query
def json_infer_scan(spark, sf):
    folder = scratch_dir(spark, "json")
    sales.table(spark, sf, "events").select("props").write.text(folder)
    return json_records(spark, folder).groupBy("k").agg(F.count("*").alias("n"))


@query
def json_event_parse(spark, sf):
    events = sales.table(spark, sf, "events")
    return events.select("event_id", event_struct("props", "k bigint")["k"].alias("k"))


def _change_events(spark, *changes: DataFrame) -> str:
    """Write change rows as Parquet files and one event message per file; returns the folder."""
    folder = scratch_dir(spark, "changes")
    for k, rows in enumerate(changes):
        as_received = rows.withColumn("Op", F.lit("U")).withColumnsRenamed({c: c.upper() for c in rows.columns})
        as_received.write.parquet(f"{folder}/data/{k}")
    files = spark.read.parquet(f"{folder}/data/*").select(F.col("_metadata.file_path").alias("path")).distinct()
    files.repartition("path").select(F.to_json(F.struct("path"))).write.text(f"{folder}/events")
    return folder


def _yearly_events(spark, changes: DataFrame) -> str:
    """The same, with a folder and one event message for each year; a year fills as many files as its rows need."""
    folder = scratch_dir(spark, "changes")
    yearly = changes.withColumn("by_year", F.year("order_date"))
    yearly.hint("rebalance", "by_year").write.partitionBy("by_year").parquet(f"{folder}/data")
    within = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    years = spark.read.parquet(f"{folder}/data").select(within.alias("path")).distinct()
    years.select(F.to_json(F.struct("path"))).write.text(f"{folder}/events")
    return folder


def _run_stream(spark, table: KeyedTable, folder: str, files_per_batch: int = 2, **options) -> ChangeStream:
    stream = ChangeStream(table, **options)
    running = stream.start(
        file_events(spark, f"{folder}/events", files_per_batch),
        checkpoint=scratch_dir(spark, "offsets"),
        available_now=True,
    )
    running.awaitTermination()
    return stream


@query
def stream_upsert(spark, sf):
    table, updates, inserts = _loaded(spark, sf, FLAT)
    _run_stream(spark, table, _change_events(spark, updates.unionByName(inserts)))
    return table.snapshot()


@query
def stream_added_column(spark, sf):
    """Files with and without the new column arrive in one batch."""
    table, updates, inserts = _loaded(spark, sf, FLAT)
    folder = _change_events(spark, updates, inserts.withColumn("new_col", F.col("quantity") * 2))
    _run_stream(spark, table, folder, files_per_batch=1000)
    return table.snapshot()


@query
def stream_mor(spark, sf):
    table, updates, inserts = _loaded(spark, sf, FLAT.with_(storage=MOR))
    _run_stream(spark, table, _change_events(spark, updates.unionByName(inserts)))
    return table.snapshot(view="rt")


@query
def stream_replay_idempotent(spark, sf):
    table, updates, inserts = _loaded(spark, sf, FLAT)
    folder = _change_events(spark, updates.unionByName(inserts))
    _run_stream(spark, table, folder, files_per_batch=4)
    _run_stream(spark, table, folder, files_per_batch=4)
    return table.snapshot()


# ---- sinks and writes ------------------------------------------------------------------


@query
def bulk_insert(spark, sf):
    table = _new_table(spark, BATCH)
    table.bulk_insert(sales.lines(spark, sf).select(*R, *TIES), C1, n_files=3)
    files = table.files().groupBy("commit_id").agg(F.count("*").alias("files"))
    return table.commits().join(files, "commit_id").select(F.col("rows_inserted").alias("n"), "files")


@query
def insert_overwrite(spark, sf):
    table = _new_table(spark, FLAT)
    table.insert(sales.lines(spark, sf).select(*R), C1)
    table.insert(sales.base(spark, sf, "quantity").select(*R), C2, overwrite=True)
    return table.snapshot()


@query
def partitioned_write(spark, sf):
    return _loaded(spark, sf, PARTITIONED)[0].snapshot()


@query
def upsert_cow(spark, sf):
    base, updates, inserts = _sets(spark, sf, *RP)
    return merge.upsert(base, updates.unionByName(inserts), PARTITIONED)


@query
def upsert_nonpartitioned(spark, sf):
    base, updates, inserts = _sets(spark, sf)
    return merge.upsert(base, updates.unionByName(inserts), FLAT)


@query
def upsert_idempotent(spark, sf):
    table, updates, inserts = _loaded(spark, sf, FLAT)
    changes = updates.unionByName(inserts)
    table.upsert(changes, C2)
    table.upsert(changes, C3)
    return table.snapshot()


@query
def upsert_event_time(spark, sf):
    plain = sales.base(spark, sf, "quantity", "status")
    return merge.upsert(plain.select(*R), sales.stale(plain).select(*R), FLAT, policy=EVENT_TIME)


def _widened(spark, sf):
    plain = sales.base(spark, sf, "quantity", "flag", "part_id")
    wide = sales.updates(plain).withColumn("new_col", F.col("part_id")).select(*R, "new_col")
    return merge.upsert(plain.select(*R), wide, FLAT)


@query
def upsert_added_column(spark, sf):
    return _widened(spark, sf)


@query
def partition_extract(spark, sf):
    keyed = derive_keys(sales.base(spark, sf)).select("partition_key")
    return keyed.groupBy(*partition_values("partition_key", ["year", "month"])).agg(F.count("*").alias("n"))


@query
def manifest_files(spark, sf):
    """Rows of each partition, counted through the files that the manifest lists for it."""
    table = _upserted(spark, sf, PARTITIONED)
    folder = write_manifest(table)
    listed = manifest_counts(spark, folder, PARTITIONED.partition_by).drop("n_files")
    counted = counts.partition_counts(read_manifest(spark, folder, table))
    return counted.join(listed, [*PARTITIONED.partition_by], "left_semi")


@query
def manifest_text_(spark, sf):
    """The same, by the file names in each partition's text."""
    table = _upserted(spark, sf, PARTITIONED)
    text = manifest_text(spark, write_manifest(table), PARTITIONED.partition_by)
    names = text.select(F.explode(F.split("files", "\n")).alias("file")).select(F.element_at(F.split("file", "/"), -1).alias("_file_name"))
    rows = table.snapshot(metadata=True).join(names, "_file_name", "left_semi")
    return counts.partition_counts(rows)


@query
def manifest_read(spark, sf):
    table = _upserted(spark, sf, PARTITIONED)
    return read_manifest(spark, write_manifest(table), table)


# ---- projections and filters -------------------------------------------------------------


@query
def lowercase_columns_(spark, sf):
    shouting = sales.lines(spark, sf).select(*[F.col(c).alias(c.upper()) for c in R])
    return lowercase_columns(shouting)



@query
def drop_metadata(spark, sf):
    return _loaded(spark, sf, FLAT)[0].snapshot(metadata=True).drop(*METADATA_COLUMNS)


@query
def derive_keys_(spark, sf):
    return derive_keys(sales.lines(spark, sf).select(*KEYS, *ORDER))



@query
def filter_in_list(spark, sf):
    return sales.base(spark, sf, "quantity").filter(F.col("order_id").isin(101, 202, 303)).select(*R)


@query
def filter_between(spark, sf):
    return sales.base(spark, sf, "quantity").filter(F.col("order_id").between(300, 310)).select(*R)


@query
def point_lookup(spark, sf):
    # the raw key column carries the filter into the scan; the record key alone could not
    keyed = derive_keys(sales.base(spark, sf, "quantity"))
    return keyed.filter((F.col("order_id") == 100) & (F.col("record_key") == "100#6")).select(*R)


@query
def filter_null(spark, sf):
    return _widened(spark, sf).filter(F.col("new_col").isNull())


@query
def update_where(spark, sf):
    df = sales.base(spark, sf, "quantity", "flag")
    return merge.update_where(df, F.col("flag") == "R", {"quantity": F.col("quantity") + 1}).select(*R)


@query
def update_where_count(spark, sf):
    return counts.affected_rows(sales.base(spark, sf, "flag"), F.col("flag") == "R")


# ---- joins ---------------------------------------------------------------------------------


@query
def delete_candidates(spark, sf):
    base = sales.base(spark, sf, "quantity").select(*R)
    return merge.delete_candidates(base, sales.erasures(spark, sf), ["order_id"])


@query
def delete_candidates_semi(spark, sf):
    base = sales.base(spark, sf, "quantity").select(*R)
    twice = sales.erasures(spark, sf).unionByName(sales.erasures(spark, sf))
    return merge.delete_candidates_semi(base, twice, ["order_id"])


# ---- aggregations, ranking, limit ------------------------------------------------------------


@query
def count_all(spark, sf):
    return counts.count_all(sales.base(spark, sf))


@query
def partition_counts(spark, sf):
    return counts.partition_counts(upsert_cow(spark, sf)).orderBy("year", "month")


@query
def precombine_batch(spark, sf):
    return precombine(sales.lines(spark, sf).select(*R, *TIES), KEYS, ORDER, TIES).select(*R)


@query
def precombine_window_(spark, sf):
    return precombine_window(sales.lines(spark, sf).select(*R, *TIES), KEYS, ORDER, TIES).select(*R)



@query
def limit_rows(spark, sf):
    return sales.base(spark, sf, "quantity").select(*R).orderBy(*KEYS).limit(5)


@query
def batch_counts(spark, sf):
    """Records of each batch of a stream, as the stream recorded them."""
    table, updates, inserts = _loaded(spark, sf, FLAT)
    _run_stream(spark, table, _change_events(spark, updates, inserts), files_per_batch=1000)
    return table.batches().select("batch_id", F.col("rows_received").alias("n"))


@query
def commit_metrics(spark, sf):
    table = _upserted(spark, sf, FLAT)
    table.delete(table.snapshot().join(sales.erasures(spark, sf), "order_id", "left_semi").select(*KEYS), C3)
    return metrics_of(table)


@query
def commit_metrics_mor(spark, sf):
    """Pending rows are counted when a compaction has told which of them are new."""
    table = _upserted(spark, sf, FLAT.with_(storage=MOR))
    table.delete(table.snapshot().join(sales.erasures(spark, sf), "order_id", "left_semi").select(*KEYS), C3)
    table.compact(C4)
    return metrics_of(table)


@query
def pending_actions(spark, sf):
    table = _upserted(spark, sf, FLAT.with_(storage=MOR))
    table.delete(table.snapshot().join(sales.erasures(spark, sf), "order_id", "left_semi").select(*KEYS), C3)
    return table.pending_actions()


@query
def stream_offsets(spark, sf):
    """Where each batch of a stream began and ended, and the messages in between: one for each year with changes."""
    table, updates, inserts = _loaded(spark, sf, FLAT)
    folder = _yearly_events(spark, updates.unionByName(inserts))
    stream = _run_stream(spark, table, folder, files_per_batch=1000, commit_id=lambda batch: str(int(C2) + batch))
    number = lambda c: F.get_json_object(c, "$.logOffset").cast("bigint").alias(c)
    return stream.offsets().select("batch_id", number("start_offset"), number("end_offset"), "n_rows", "commit_id", "rows_received")


# ---- scalar functions ----------------------------------------------------------------------


@query
def metric_key_split(spark, sf):
    orders = sales.table(spark, sf, "orders")
    table = F.concat(F.lit("table_"), "o_orderstatus")
    key = F.when(F.col("o_orderstatus") == "P", table).otherwise(F.concat(table, F.lit(".commit."), "o_orderpriority"))
    value = F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(F.col("o_custkey").cast("string"))
    keyed = orders.select("o_orderkey", key.alias("key"), value.alias("value"))
    return keyed.select(
        "o_orderkey",
        metric_table("key").alias("table"),
        metric_name("key").alias("metric"),
        to_number("value").alias("value"),
    )


@query
def config_list_parse(spark, sf):
    text = F.concat(F.lit(" "), "o_orderstatus", F.lit(" , "), "o_orderpriority", F.lit(",, "))
    items = sales.table(spark, sf, "orders").select(F.explode(parse_list(text)).alias("item"))
    return items.groupBy("item").agg(F.count("*").alias("n"))


@query
def parse_timestamp_(spark, sf):
    text = F.substring(F.col("ts").cast("string"), 1, 19)
    return sales.table(spark, sf, "events").select(
        "event_id", parse_timestamp(text).cast("timestamp_ntz").alias("ts")
    )



# ---- keyed-table operators -------------------------------------------------------------------


@query
def soft_delete_null(spark, sf):
    base = sales.base(spark, sf, "quantity").select(*R)
    return merge.soft_delete(base, sales.erasures(spark, sf), FLAT, on=["order_id"])


@query
def soft_delete_value(spark, sf):
    base = sales.base(spark, sf, "quantity").select(*R)
    return merge.soft_delete(base, sales.erasures(spark, sf), FLAT, {"quantity": -1}, on=["order_id"])


@query
def hard_delete(spark, sf):
    base = sales.base(spark, sf, "quantity").select(*R)
    return merge.hard_delete(base, sales.erasures(spark, sf), ["order_id"])


@query
def delete_where(spark, sf):
    table, _, _ = _loaded(spark, sf, FLAT, *R, "flag")
    table.delete_where(F.col("flag") == "R", C2)
    return table.snapshot().select(*R)


def _with_deltas(spark, sf, spec=FLAT) -> KeyedTable:
    return _upserted(spark, sf, spec.with_(storage=MOR))


@query
def mor_read_optimized(spark, sf):
    return _with_deltas(spark, sf).snapshot(view="ro")


@query
def mor_realtime(spark, sf):
    return _with_deltas(spark, sf, PARTITIONED).snapshot(view="rt")


@query
def mor_pending_changes(spark, sf):
    return _with_deltas(spark, sf).pending("quantity")


@query
def compact(spark, sf):
    table = _with_deltas(spark, sf)
    table.compact(C3)
    return table.snapshot(view="ro")


@query
def compactions_show(spark, sf):
    table, updates, inserts = _loaded(spark, sf, FLAT.with_(storage=MOR))
    table.upsert(updates, C2)
    table.schedule_compaction(C3)
    table.compact(C3)
    table.upsert(inserts, C4)
    table.schedule_compaction(C5)
    return table.compactions()


def _rolled_back(spark, sf) -> KeyedTable:
    table = _upserted(spark, sf, FLAT)
    table.rollback(C2, C3)
    return table


@query
def commits_show(spark, sf):
    return _rolled_back(spark, sf).commits().select("commit_id", "kind", "state", "rows_inserted", "rows_updated")


@query
def rollback_latest(spark, sf):
    return _rolled_back(spark, sf).snapshot()


@query
def rollback_after_clean(spark, sf):
    table, updates, inserts = _loaded(spark, sf, FLAT)
    table.upsert(updates, C2)
    table.upsert(inserts, C3)
    table.clean(1, C4)
    table.rollback(C3, C5)
    return table.snapshot()


@query
def snapshot_as_of(spark, sf):
    table = _upserted(spark, sf, FLAT)
    table.delete_where(F.col("quantity") > 10, C3)
    return table.snapshot(as_of=C1)


@query
def latest_version_per_partition(spark, sf):
    return _upserted(spark, sf, PARTITIONED).latest_versions()


@query
def retained_versions(spark, sf):
    table = _upserted(spark, sf, PARTITIONED)
    doomed = table.snapshot().join(sales.erasures(spark, sf), "order_id", "left_semi")
    table.delete(doomed.select(*PARTITIONED.identity), C3)
    table.update_where(F.col("quantity") >= 50, {"quantity": F.lit(0)}, C4)
    return table.retained_versions(2)


@query
def metadata_columns(spark, sf):
    rows = _upserted(spark, sf, PARTITIONED).snapshot(metadata=True)
    return rows.select(*KEYS, "_commit_time", "_record_key", "_partition_path")


@query
def list_partitions(spark, sf):
    return _upserted(spark, sf, PARTITIONED).partitions()


# ---- schema operators ------------------------------------------------------------------------


def _retyped(spark, sf, *columns):
    """Incoming rows whose quantity is text, unreadable where there is no discount."""
    text = F.when(F.col("discount") == 0, "n/a").otherwise(F.col("quantity").cast("bigint").cast("string"))
    df = sales.base(spark, sf, "quantity", "discount", "part_id")
    return df.withColumn("quantity", text).withColumn("new_col", F.col("part_id")).select(*columns)


def _stored_schema(spark, sf):
    return sales.lines(spark, sf).select(*R).schema


@query
def schema_validate(spark, sf):
    return schema.validate(_retyped(spark, sf, *R, "new_col"), _stored_schema(spark, sf))


@query
def schema_diff(spark, sf):
    incoming = _retyped(spark, sf, *KEYS, "new_col", "quantity")
    return schema.changes_report(incoming, _stored_schema(spark, sf))


@query
def evolve_schema(spark, sf):
    incoming = _retyped(spark, sf, "order_id", "new_col", "line_id", "quantity")
    return schema.evolve(incoming, _stored_schema(spark, sf))[1]


@query
def evolve_strict(spark, sf):
    incoming = _retyped(spark, sf, *KEYS, "new_col", "quantity")
    stored = _stored_schema(spark, sf)
    ok, unchanged = schema.evolve(incoming, stored, strict=True)
    return unchanged.agg(F.count("*").alias("n_refused")).select(
        F.lit(ok).alias("ok"),
        F.lit(schema.diff_schemas(incoming.schema, stored).describe()).alias("report"),
        "n_refused",
    )


@query
def evolve_no_cast(spark, sf):
    incoming = _retyped(spark, sf, "order_id", "new_col", "line_id", "quantity")
    return schema.evolve(incoming, _stored_schema(spark, sf), force_cast=False)[1]


@query
def force_cast(spark, sf):
    stored = _stored_schema(spark, sf)
    return schema.evolve(_retyped(spark, sf, *R), stored)[1].select(*KEYS, "quantity")


@query
def null_fill_dropped(spark, sf):
    dropped = sales.base(spark, sf).select(*KEYS, *ORDER)
    return schema.fill_missing(dropped, _stored_schema(spark, sf)).select(*R)
