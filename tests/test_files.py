"""What a version reads, and how its files are written."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import Row, functions as F

from tests.test_plans import plan
from tidemark import MOR, KeyedTable, TableSpec
from tidemark.functions import scratch
from tidemark.sinks import drop_from_catalog, keep_synced, read_manifest, write_manifest
from tidemark.sources import generated_records, spread_month
from tidemark.tables import keyed_table

FLAT = TableSpec(keys="id", order_by="sk")
MONTHLY = FLAT.with_(partition_by=("year", "month"))


def monthly(spark, start, count, increment=0):
    return generated_records(spark, start, count, increment, year=F.lit("2019"), month=spread_month())


def version_files(root, commit):
    return sorted(Path(root).glob(f"base/_version={commit}/**/*.parquet"))


@pytest.fixture
def loaded(spark, root):
    table = KeyedTable.create(spark, root, FLAT)
    table.bulk_insert(generated_records(spark, 0, 1000), "1", n_files=4)
    return table


def test_a_stray_file_is_not_read(loaded, root):
    own = version_files(root, 1)
    shutil.copy(own[0], own[0].with_name("part-99999-stray.snappy.parquet"))
    rows = loaded.snapshot()
    assert rows.count() == 1000 and rows.select("id").distinct().count() == 1000


def test_a_stray_file_does_not_hide_a_lost_one(loaded, root):
    own = version_files(root, 1)
    shutil.copy(own[0], own[0].with_name("part-99999-stray.snappy.parquet"))
    own[1].unlink()
    with pytest.raises(FileNotFoundError, match="lost data files"):
        loaded.snapshot()


def test_the_reader_is_given_folders(spark, root):
    table = KeyedTable.create(spark, root, FLAT)
    table.bulk_insert(generated_records(spark, 0, 5000), "1", n_files=50)
    table.upsert(generated_records(spark, 7, 1, 1), "2")
    df = table.snapshot()
    text = plan(df)
    assert "InMemoryFileIndex(2 paths)" in text
    assert df.count() == 5000 and df.filter("sk = id + 1").count() == 1
    # the replaced file is left out while folders are listed
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().get("numFiles").get().value() == 50


def test_lists_too_long_for_a_plan_are_joined(spark, root, monkeypatch):
    monkeypatch.setattr(keyed_table, "NAMED", 2)
    table = KeyedTable.create(spark, root, FLAT)
    table.bulk_insert(generated_records(spark, 0, 1000), "1", n_files=8)
    table.upsert(generated_records(spark, 0, 700, 1), "2")
    table.delete(spark.range(300, 900), "3")
    df = table.snapshot()
    assert "LeftAnti" in plan(df)
    assert df.count() == 400 and df.filter("sk = id + 1").count() == 300
    table.update_where(F.col("id") < 950, {"sk": F.lit(-1)}, "4")
    assert table.snapshot().filter("sk = -1").count() == 350


def test_loads_without_a_number_of_files_are_clustered(spark, root):
    spec = FLAT.with_(target_file_bytes=20_000, small_file_bytes=0)
    table = KeyedTable.create(spark, root, spec)
    table.insert(generated_records(spark, 0, 60_000), "1")
    files = table.files().collect()
    assert len(files) > 12
    sizes = sorted(r.bytes for r in files)
    assert sizes[-1] <= 2 * spec.target_file_bytes and sizes[0] >= spec.target_file_bytes / 2
    table.upsert(generated_records(spark, 30_000, 100, 1), "2")
    rewritten = table.log.files(["2"]).filter("action = 'remove'").count()
    assert 1 <= rewritten <= 2 and table.snapshot().filter("sk = id + 1").count() == 100


def test_a_large_file_is_rewritten_by_several_tasks(spark, root):
    spec = FLAT.with_(rewrite_bytes=40_000)
    table = KeyedTable.create(spark, root, spec)
    table.bulk_insert(generated_records(spark, 0, 60_000), "1", n_files=1)
    table.upsert(generated_records(spark, 100, 5, 1).unionByName(generated_records(spark, 59_000, 5, 1)), "2")
    added = table.log.files(["2"]).filter("action = 'add'").count()
    assert added == -(-table.files(as_of="1").first().bytes // spec.rewrite_bytes) > 1
    per_file = table.snapshot(metadata=True).groupBy("_file_name").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).orderBy("lo").collect()
    assert all(a.hi < b.lo for a, b in zip(per_file, per_file[1:]))
    assert table.snapshot().count() == 60_000 and table.snapshot().filter("sk = id + 1").count() == 10


@pytest.mark.parametrize("spec", [FLAT, MONTHLY])
def test_deletions_shuffle_nothing(spark, root, monkeypatch, spec):
    table = KeyedTable.create(spark, root, spec)
    table.bulk_insert(monthly(spark, 0, 3000), "1", n_files=3)
    seen = []
    write = table._write
    monkeypatch.setattr(table, "_write", lambda df, *a, **k: seen.append(plan(df)) or write(df, *a, **k))
    before = {r.path for r in table.files().collect()}
    table.delete(table.snapshot().filter("id IN (5, 7, 2000)").select(*spec.identity), "2")
    table.delete_where(F.col("id").between(10, 12), "3")
    table.update_where(F.col("id") == 20, {"sk": F.lit(-1)}, "4")
    assert len(seen) == 3 and not any("Exchange hashpartitioning" in t or "Exchange SinglePartition" in t or "shufflepartitionid" in t for t in seen)
    assert "BroadcastHashJoin" in seen[0]
    assert table.snapshot().count() == 2994 and table.snapshot().filter("sk = -1").count() == 1
    assert len({r.path for r in table.files().collect()} - before) <= len(before)
    rows = {r.operation: r for r in table.log.rows()}
    assert rows["update"].rows_updated == 1 and [r.rows_deleted for r in table.log.rows()][1:3] == [3, 3]


def test_many_deleted_keys_go_through_the_shuffle(spark, root):
    table = KeyedTable.create(spark, root, FLAT)
    table.bulk_insert(generated_records(spark, 0, 3000), "1", n_files=3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table.delete(spark.range(0, 2500), "2")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(r.id for r in table.snapshot().collect()) == list(range(2500, 3000))


def test_each_partition_has_its_own_key_range(spark, root):
    table = KeyedTable.create(spark, root, FLAT.with_(partition_by="part"))
    rows = spark.range(4000).select("id", F.lit(0).alias("sk"), F.when(F.col("id") < 2000, "a").otherwise("b").alias("part"))
    table.bulk_insert(rows, "1", n_files=8)
    layer, _ = table._layers([r for r in table.log.rows()], deltas=False)
    stored = table._scan(layer, table.schema(), located=True)
    bounds = [Row(_path="part=a", lo_0=0, hi_0=10), Row(_path="part=b", lo_0=3990, hi_0=3999)]
    found = table._candidates(stored, bounds)
    assert found.select("_file").distinct().count() == 2 and found.count() == 21
    overlapping = [Row(_path="part=a", lo_0=0, hi_0=3000), Row(_path="part=b", lo_0=10, hi_0=2001)]
    assert sorted(r.id for r in table._candidates(stored, overlapping).collect()) == list(range(0, 3001))
    table.upsert(rows.filter("id IN (3, 3995)").withColumn("sk", F.lit(1)), "2")
    assert table.snapshot().filter("sk = 1").count() == 2 and table.snapshot().count() == 4000


def test_more_ranges_than_filters(spark, root, monkeypatch):
    monkeypatch.setattr(keyed_table, "RANGES", 2)
    table = KeyedTable.create(spark, root, FLAT.with_(partition_by="part"))
    rows = spark.range(1000).select("id", F.lit(0).alias("sk"), F.concat(F.lit("p"), F.floor(F.col("id") / 100)).alias("part"))
    table.insert(rows, "1")
    table.upsert(rows.filter("id % 100 = 50").withColumn("sk", F.lit(1)), "2")
    assert table.snapshot().filter("sk = 1").count() == 10 and table.snapshot().count() == 1000


def test_a_clean_that_was_cut_short_is_repeated(spark, root, monkeypatch):
    table = KeyedTable.create(spark, root, MONTHLY)
    table.insert(monthly(spark, 0, 200), "1")
    for i in "234":
        table.upsert(monthly(spark, 0, 30, int(i)), i)
    now = table.snapshot().collect()
    with monkeypatch.context() as patch:
        def some(files):
            scratch.delete_files(files.limit(2))
            raise RuntimeError("lost")

        patch.setattr(keyed_table, "delete_files", some)
        with pytest.raises(RuntimeError, match="lost"):
            table.clean(1, "5")
    assert sorted(table.snapshot().collect()) == sorted(now)
    n = table.clean(1, "5")
    assert n > 2 and table.clean(1, "6") == 0
    assert sorted(table.snapshot().collect()) == sorted(now)
    held = sum(len(version_files(root, c)) for c in "1234")
    assert held == len({r.path for c in "34" for r in table.files(as_of=c).collect()})


def test_a_manifest_that_lists_a_lost_file_raises(spark, loaded, root):
    folder = write_manifest(loaded)
    version_files(root, 1)[0].unlink()
    with pytest.raises(FileNotFoundError):
        read_manifest(spark, folder, loaded)


@pytest.mark.parametrize("policy", ["overwrite_latest", "event_time"])
def test_the_catalog_follows_every_commit(spark, root, policy):
    spec = MONTHLY.with_(storage=MOR, policy=policy)
    table = KeyedTable.create(spark, root, spec)
    table.insert(monthly(spark, 0, 300), "1")
    name = f"followed_{policy}"
    drop_from_catalog(spark, name)
    keep_synced(table, name)

    def check():
        for view, of in ((name, "ro"), (f"{name}_rt", "rt")):
            shown, kept = spark.table(view), table.snapshot(view=of)
            assert shown.columns == kept.columns
            assert sorted(map(repr, shown.collect())) == sorted(map(repr, kept.collect()))

    check()
    table.upsert(monthly(spark, 5, 10, 3), "2")
    check()
    table.upsert(monthly(spark, 8, 10, -3), "3")
    check()
    table.delete(table.snapshot().filter("id IN (9, 200)").select(*spec.identity), "4")
    table.upsert(monthly(spark, 9, 1, -9).withColumn("new_col", F.col("id")), "5")
    check()
    table.compact("6")
    check()
    table.clean(1, "7")
    check()
    files = spark.sql(f"SHOW CREATE TABLE {name}").first()[0]
    assert ".parquet" not in files
    drop_from_catalog(spark, name)


@pytest.mark.parametrize("policy", ["overwrite_latest", "event_time"])
def test_pending_actions_are_what_the_compaction_then_counts(spark, root, policy):
    spec = FLAT.with_(storage=MOR, policy=policy)
    table = KeyedTable.create(spark, root, spec)
    table.insert(generated_records(spark, 0, 100), "1")
    table.upsert(generated_records(spark, 90, 20, 1), "2")
    table.delete(spark.range(95, 105), "3")
    table.upsert(generated_records(spark, 0, 5, -1), "4")
    pending = table.pending_actions().first()
    updates = 5 if policy == "event_time" else 10
    assert tuple(pending) == (5, updates, 5)
    table.compact("5")
    row = table.log.rows()[-1]
    assert (row.rows_inserted, row.rows_deleted) == (5, 5) and row.rows_updated == updates
    assert [r.rows_pending for r in table.log.rows()] == [None, 20, 10, 5, None]


def test_no_task_sorts_more_rows_than_memory_has_room_for(spark, root):
    """Rows that pack well fill few bytes; files end by the memory of their sort, in loads and in rewrites."""
    spec = FLAT.with_(sort_bytes=400_000)
    table = KeyedTable.create(spark, root, spec)
    longest = lambda: table.snapshot(metadata=True).groupBy("_file_name").count().agg(F.max("count")).first()[0]
    rows = lambda start, n, add: spark.range(start, start + n).select("id", (F.col("id") + add).alias("sk"), F.lit("x").alias("txt"))
    table.insert(rows(0, 20_000, 0), "1")
    assert longest() <= 6_000 and table.files().count() >= 4
    table.upsert(rows(10_000, 30_000, 1), "2")
    assert longest() <= 6_000
    assert table.snapshot().count() == 40_000 and table.snapshot().filter("sk = id + 1").count() == 30_000
    per_file = table.snapshot(metadata=True).filter("id < 20000").groupBy("_file_name").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).orderBy("lo").collect()
    assert all(a.hi < b.lo for a, b in zip(per_file, per_file[1:]))
    table.insert(rows(0, 20_000, 2), "3", overwrite=True)
    assert longest() <= 6_000 and table.snapshot().count() == 20_000
