import random

import pytest
from pyspark.sql import functions as F

from tidemark import EVENT_TIME, MOR, KeyedTable, TableSpec
from tidemark.functions import path_exists
from tidemark.metrics import commit_metrics, push, table_metrics
from tidemark.operators import SchemaMismatch
from tidemark.sources import generated_records, spread_month

FLAT = TableSpec(keys="id", order_by="sk")
MONTHLY = FLAT.with_(partition_by=("year", "month"))
ROW = "id bigint, sk bigint, txt string"
PART = ROW + ", p string"
BY_P = FLAT.with_(partition_by="p")


def monthly(spark, start, count, increment=0):
    return generated_records(spark, start, count, increment, year=F.lit("2019"), month=spread_month())


def rows(df):
    return sorted(map(tuple, df.collect()))


def stored_files(table):
    """Data files on disk, dead ones included."""
    return table.spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.parquet"
    ).load(f"{table.root}/base").select("path").count()


def test_file_counts_over_three_upserts(spark, root):
    table = KeyedTable.create(spark, root, FLAT)
    table.bulk_insert(generated_records(spark, 0, 40_000), "1", n_files=3)
    assert stored_files(table) == 3
    seen = []
    for i in (2, 4, 6):
        table.upsert(generated_records(spark, 30_000, 1_000, 2), str(i))
        table.clean(retain=2, commit_id=str(i + 1))
        seen.append(stored_files(table))
    assert seen == [4, 5, 5]
    assert table.files().count() == 3
    out = table.snapshot()
    assert out.count() == 40_000 and out.filter("sk = id + 2").count() == 1_000
    commits = table.commits().filter("kind = 'commit'").collect()
    counts = {r.commit_id: (r.rows_inserted, r.rows_updated) for r in commits}
    assert counts == {"1": (40_000, 0), "2": (0, 1_000), "4": (0, 1_000), "6": (0, 1_000)}


def test_only_touched_files_are_rewritten(spark, root):
    table = KeyedTable.create(spark, root, FLAT)
    table.bulk_insert(generated_records(spark, 0, 40_000), "1", n_files=8)
    before = {r.path for r in table.files().collect()}
    table.delete(spark.range(20_000, 20_010), "2")
    after = {r.path for r in table.files().collect()}
    assert len(before - after) == 1 and len(after - before) == 1
    assert table.snapshot().count() == 39_990
    assert table.snapshot().filter("id BETWEEN 20000 AND 20009").count() == 0
    assert [(r.action, r.n) for r in commit_metrics(table).filter("commit_id = '2'").collect()] == [("delete", 10)]


def test_partitioned_upsert_and_history(spark, root):
    KeyedTable.create(spark, root, MONTHLY)
    table = KeyedTable.open(spark, root)
    table.insert(monthly(spark, 0, 2_000), "1")
    table.upsert(monthly(spark, 1_500, 1_000, 2), "2")
    out = table.snapshot()
    assert out.count() == 2_500 and out.filter("sk = id + 2").count() == 1_000
    assert rows(table.snapshot(as_of="1").select("id", "sk")) == [(i, i) for i in range(2_000)]
    assert table.partitions().count() == 12
    meta = table.snapshot(metadata=True).filter("id = 1").first()
    assert (meta._commit_time, meta._record_key) == ("1", "1")
    assert meta._partition_path == f"year=2019/month={meta.month}" and meta._file_name.endswith(".parquet")
    assert dict(table.describe().collect())["latest_commit"] == "2"
    table.rollback("2", "3")
    assert table.snapshot().count() == 2_000
    with pytest.raises(ValueError, match="latest live commit"):
        table.rollback("2", "4")
    with pytest.raises(ValueError, match="not later"):
        table.upsert(monthly(spark, 0, 1), "2")


def test_insert_overwrite_and_append(spark, root):
    table = KeyedTable.create(spark, root, FLAT)
    table.insert(generated_records(spark, 0, 10), "1")
    table.insert(generated_records(spark, 5, 10), "2")
    assert table.snapshot().count() == 20  # inserts do not match stored rows
    table.upsert(generated_records(spark, 7, 1, 5), "3")
    assert rows(table.snapshot().filter("id = 7").select("sk")) == [(12,)]
    assert table.snapshot().count() == 19  # both stored copies of 7 gave way to one
    table.insert(generated_records(spark, 100, 3), "4", overwrite=True)
    assert rows(table.snapshot().select("id")) == [(100,), (101,), (102,)]


def test_empty_batches_make_no_commit(spark, root):
    table = KeyedTable.create(spark, root, FLAT)
    table.insert(generated_records(spark, 0, 10), "1")
    assert table.upsert(generated_records(spark, 0, 0), "2") is None
    assert table.upsert(spark.createDataFrame([], ROW), "2") is None
    assert table.delete(spark.range(0), "2") is None
    assert table.log.commits().count() == 1


def test_replayed_batch_is_skipped_but_a_new_query_is_not(spark, root):
    table = KeyedTable.create(spark, root, FLAT)
    assert table.upsert(generated_records(spark, 0, 5), "1", query_id="q", batch_id=0) == "1"
    assert table.upsert(generated_records(spark, 0, 5, 9), "2", query_id="q", batch_id=0) is None
    assert table.upsert(generated_records(spark, 9, 5), "2", query_id="other", batch_id=0) == "2"
    assert table.snapshot().count() == 10


def test_null_keys_and_partitions_fail_with_a_count(spark, root):
    table = KeyedTable.create(spark, root, BY_P)
    bad = spark.createDataFrame([(1, 1, "a", None), (None, 1, "a", "x"), (3, 1, "c", "x")], PART)
    for write in (table.insert, table.upsert):
        with pytest.raises(ValueError, match="^2 rows"):
            write(bad, "1")
    assert table.log.commits().count() == 0
    assert not path_exists(spark, f"{root}/base/_version=1")


def test_equal_order_takes_incoming_and_policies_differ_below(spark, tmp_path):
    stored = spark.createDataFrame([(1, 5, "old"), (2, 5, "old")], ROW)
    change = spark.createDataFrame([(1, 5, "new"), (2, 4, "new"), (3, 1, "new")], ROW)
    for policy, second in (("overwrite_latest", (2, 4, "new")), (EVENT_TIME, (2, 5, "old"))):
        for storage in ("cow", MOR):
            spec = FLAT.with_(policy=policy, storage=storage)
            table = KeyedTable.create(spark, str(tmp_path / f"{policy}-{storage}"), spec)
            table.insert(stored, "1")
            table.upsert(change, "2")
            want = [(1, 5, "new"), second, (3, 1, "new")]
            assert rows(table.snapshot()) == want
            if storage == MOR:
                assert rows(table.snapshot(view="ro")) == rows(stored)
                table.compact("3")
                assert rows(table.snapshot(view="ro")) == want


def test_keys_that_change_partition(spark, tmp_path):
    stored = spark.createDataFrame([(1, 1, "a", "x"), (2, 1, "b", "x")], PART)
    moved = spark.createDataFrame([(1, 2, "a", "y")], PART)
    for global_key, want in ((False, [(1, 1, "a", "x"), (1, 2, "a", "y"), (2, 1, "b", "x")]),
                             (True, [(1, 2, "a", "y"), (2, 1, "b", "x")])):
        table = KeyedTable.create(spark, str(tmp_path / str(global_key)), BY_P.with_(global_key=global_key))
        table.insert(stored, "1")
        table.upsert(moved, "2")
        assert rows(table.snapshot()) == want
        last = table.commits().filter("commit_id = '2'").first()
        assert (last.rows_inserted, last.rows_updated) == ((0, 1) if global_key else (1, 0))


def test_a_partition_emptied_by_deletes(spark, root):
    table = KeyedTable.create(spark, root, BY_P)
    table.insert(spark.createDataFrame([(1, 1, "a", "x"), (2, 1, "b", "y")], PART), "1")
    table.delete(spark.createDataFrame([(2, "y"), (2, "y"), (99, "y")], "id bigint, p string"), "2")
    assert rows(table.snapshot()) == [(1, 1, "a", "x")]
    assert [r.partition_path for r in table.partitions().collect()] == ["p=x"]
    assert {r.partition_path: r.version for r in table.latest_versions().collect()} == {"p=x": "1", "p=y": "2"}
    table.delete(spark.createDataFrame([(1,)], "id bigint"), "3")  # partition looked up
    assert table.snapshot().count() == 0 and table.snapshot().columns == ["id", "sk", "txt", "p"]
    table.upsert(spark.createDataFrame([(5, 1, "e", "y")], PART), "4")
    assert rows(table.snapshot()) == [(5, 1, "e", "y")]


def test_predicate_changes(spark, root):
    table = KeyedTable.create(spark, root, FLAT)
    table.bulk_insert(generated_records(spark, 0, 1_000), "1", n_files=4)
    table.update_where(F.col("id") == 10, {"txt": F.lit("changed")}, "2")
    assert rows(table.snapshot().filter("txt = 'changed'").select("id")) == [(10,)]
    assert table.delete_where(F.col("id") < 0, "3") is None
    table.delete_where(F.col("id").isin(1, 2, 3), "3")
    assert table.snapshot().count() == 997
    table.soft_delete(spark.range(20, 22), "4")
    assert rows(table.snapshot().filter("txt IS NULL").select("id", "sk")) == [(20, 20), (21, 21)]
    kinds = {r.commit_id: (r.rows_updated, r.rows_deleted) for r in table.commits().collect()}
    assert kinds["2"] == (1, 0) and kinds["3"] == (0, 3) and kinds["4"] == (2, 0)
    sent = []
    assert push(table_metrics(table, "t"), lambda *metric: sent.append(metric)) == 4
    assert ("t", "commit.delete", 3.0) in sent
    with pytest.raises(ValueError, match="key or partition"):
        table.update_where(F.col("id") == 1, {"id": F.lit(2)})


def test_merge_on_read_life_cycle(spark, root):
    table = KeyedTable.create(spark, root, MONTHLY.with_(storage=MOR))
    table.insert(monthly(spark, 0, 1_000), "1")
    assert table.compact("2") is None
    table.upsert(monthly(spark, 900, 200, 2), "2")
    table.delete(monthly(spark, 0, 10).select("id", "year", "month"), "3")
    ro, rt = table.snapshot(view="ro"), table.snapshot(view="rt")
    assert ro.count() == 1_000 and ro.filter("sk <> id").count() == 0
    assert rt.count() == 1_090 and rt.filter("sk = id + 2").count() == 200
    assert table.pending("sk").count() == 210
    want = rows(rt)
    table.schedule_compaction("4")
    table.upsert(monthly(spark, 500, 1, 7), "5")  # arrives after the request
    assert [(r.commit_id, r.state) for r in table.compactions().collect()] == [("4", "requested")]
    table.compact("4")
    assert [(r.commit_id, r.state) for r in table.compactions().collect()] == [("4", "completed")]
    assert rows(table.snapshot(view="ro")) == want
    assert table.pending("sk").count() == 1
    table.compact("6")
    assert rows(table.snapshot(view="ro")) == rows(table.snapshot(view="rt"))
    table.rollback("6", "7")
    assert table.snapshot(view="ro").filter("sk = id + 7").count() == 0
    assert table.snapshot(view="rt").filter("sk = id + 7").count() == 1


def test_pending_deletes_under_event_time(spark, root):
    table = KeyedTable.create(spark, root, FLAT.with_(policy=EVENT_TIME, storage=MOR))
    table.insert(spark.createDataFrame([(1, 9, "base"), (2, 9, "base"), (3, 9, "base")], ROW), "1")
    table.upsert(spark.createDataFrame([(1, 10, "late"), (3, 1, "stale")], ROW), "2")
    table.delete(spark.createDataFrame([(1,), (2,)], "id bigint"), "3")
    table.upsert(spark.createDataFrame([(2, 1, "again")], ROW), "4")
    want = [(2, 1, "again"), (3, 9, "base")]
    assert rows(table.snapshot()) == want
    table.compact("5")
    assert rows(table.snapshot(view="ro")) == want


def test_an_overtaken_compaction_is_refused(spark, root):
    table = KeyedTable.create(spark, root, FLAT.with_(storage=MOR))
    table.insert(generated_records(spark, 0, 5), "1")
    table.upsert(generated_records(spark, 0, 1, 1), "2")
    table.schedule_compaction("3")
    table.compact("4")
    with pytest.raises(ValueError, match="has changed"):
        table.compact("3")
    with pytest.raises(ValueError, match="lacks id"):
        table.soft_delete(spark.createDataFrame([("x",)], "txt string"))


def test_realtime_view_with_a_column_the_base_lacks(spark, root):
    table = KeyedTable.create(spark, root, FLAT.with_(storage=MOR))
    table.insert(generated_records(spark, 0, 3), "1")
    table.upsert(generated_records(spark, 2, 1, new_col=F.col("id")), "2")
    assert rows(table.snapshot(view="rt").select("id", "new_col").na.fill(-1)) == [(0, -1), (1, -1), (2, 2)]
    assert table.snapshot(view="ro").filter("new_col IS NOT NULL").count() == 0


def test_schema_on_write(spark, root):
    table = KeyedTable.create(spark, root, FLAT)
    table.insert(generated_records(spark, 0, 10), "1")
    with pytest.raises(SchemaMismatch, match="retyped txt"):
        table.upsert(generated_records(spark, 0, 1).withColumn("txt", F.col("id")), "2")
    table.upsert(generated_records(spark, 0, 2, new_col=F.col("id")).select("ID", "new_col", "SK", "txt"), "2")
    assert table.snapshot().columns == ["id", "sk", "txt", "new_col"]
    assert table.snapshot().filter("new_col IS NULL").count() == 8
    table.upsert(generated_records(spark, 3, 1).drop("txt"), "3")
    assert table.snapshot().filter("txt IS NULL").count() == 1
    with pytest.raises(SchemaMismatch, match="lacks sk"):
        table.upsert(spark.range(1), "4")
    assert table.snapshot(as_of="1").columns == ["id", "sk", "txt"]


def test_strict_ties(spark, root):
    table = KeyedTable.create(spark, root, FLAT.with_(strict_ties=True))
    tied = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (2, 1, "c")], ROW)
    with pytest.raises(ValueError, match="1 keys have rows tied"):
        table.upsert(tied, "1")
    table.upsert(tied.filter("txt <> 'a'"), "1")
    assert table.snapshot().count() == 2


def test_retention_keeps_what_it_promises(spark, root):
    table = KeyedTable.create(spark, root, FLAT)
    table.insert(generated_records(spark, 0, 100), "1")
    for i in "234":
        table.upsert(generated_records(spark, 0, 1, int(i)), i)
    now = rows(table.snapshot())
    assert [r.version for r in table.retained_versions(2).orderBy("version").collect()] == ["2", "3", "4"]
    assert table.clean(2, "5") == 1
    assert table.clean(2, "6") == 0
    assert rows(table.snapshot()) == now
    assert table.snapshot(as_of="2").filter("sk = 2").count() == 2
    with pytest.raises(ValueError, match="retention has removed"):
        table.snapshot(as_of="1")
    table.rollback("4", "7")
    assert table.snapshot().filter("id = 0").first().sk == 3
    assert table.clean(2, "8") == 1  # the rolled-back commit's file
    with pytest.raises(ValueError):
        table.clean(0)


def test_unfinished_write_is_invisible_and_repeatable(spark, root, monkeypatch):
    table = KeyedTable.create(spark, root, FLAT)
    table.insert(generated_records(spark, 0, 10), "1")
    with monkeypatch.context() as patch:
        patch.setattr(table.log, "write", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            table.upsert(generated_records(spark, 0, 5, 1), "2")
    assert table.snapshot().filter("sk <> id").count() == 0
    table.upsert(generated_records(spark, 0, 5, 1), "2")
    assert table.snapshot().count() == 10 and table.snapshot().filter("sk = id + 1").count() == 5


def test_odd_partition_values(spark, root):
    table = KeyedTable.create(spark, root, BY_P)
    values = ["a b", "x/y", "50%", "a+b", "é", "k=v", "[1]*", "{q}"]
    table.insert(spark.createDataFrame([(i, 1, "t", v) for i, v in enumerate(values)], PART), "1")
    table.upsert(spark.createDataFrame([(2 * i, 2, "u", v) for i, v in enumerate(values[::2])], PART), "2")
    assert rows(table.snapshot()) == [(i, 2 - i % 2, "ut"[i % 2], v) for i, v in enumerate(values)]


def test_new_rows_of_a_large_partition_get_several_files(spark, root):
    table = KeyedTable.create(spark, root, FLAT.with_(small_file_bytes=0, target_file_bytes=20_000))
    table.bulk_insert(generated_records(spark, 0, 20_000), "1", n_files=2)
    table.upsert(generated_records(spark, 20_000, 20_000), "2")
    assert table.files().count() > 4 and table.snapshot().count() == 40_000
    assert table.snapshot().select("id").distinct().count() == 40_000


def test_a_key_with_a_third_of_all_rows_fills_several_files(spark, root):
    table = KeyedTable.create(spark, root, FLAT)
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("bigint")
    df = generated_records(spark, 0, 60_000).withColumn("sk", F.col("id")).withColumn("id", hot)
    table.bulk_insert(df, "1", n_files=6)
    per_file = [r.n for r in table.snapshot(metadata=True).groupBy("_file_name").agg(F.count("*").alias("n")).collect()]
    assert len(per_file) == 6 and max(per_file) < 15_000
    table.upsert(spark.createDataFrame([(7, 99_999, "Z")], ROW), "2")
    assert rows(table.snapshot().filter("id = 7")) == [(7, 99_999, "Z")]
    assert table.snapshot().count() == 40_000  # the other keys are as they were


@pytest.mark.parametrize("seed", range(3))
def test_random_changes_against_a_dictionary(spark, tmp_path, seed):
    rnd = random.Random(seed)
    storage = MOR if seed == 1 else "cow"
    spec = BY_P.with_(storage=storage, global_key=seed == 2)
    table = KeyedTable.create(spark, str(tmp_path / "t"), spec)
    model: dict = {}

    def key(row):
        return row[0] if spec.global_key else (row[3], row[0])

    for commit in range(10, 16):
        picked = rnd.sample(range(30), 10)
        batch = [(k, rnd.randrange(5), rnd.choice("abc"), rnd.choice("xyz")) for k in picked]
        if model and rnd.random() < 0.35:
            table.delete(spark.createDataFrame([(r[0], r[3]) for r in batch], "id bigint, p string"), str(commit))
            for r in batch:
                model.pop(key(r), None)
        else:
            table.upsert(spark.createDataFrame(batch, PART), str(commit))
            model.update({key(r): r for r in batch})
        assert rows(table.snapshot()) == sorted(model.values())
    if storage == MOR:
        table.compact("20")
        assert rows(table.snapshot(view="ro")) == sorted(model.values())


def test_rollback_never_brings_back_expired_files(spark, root):
    spec = TableSpec(keys=("id",), order_by=("sk",))
    table = KeyedTable.create(spark, root, spec)
    table.bulk_insert(generated_records(spark, 0, 1000), "1", n_files=4)
    table.upsert(generated_records(spark, 0, 10, 1), "2")
    table.upsert(generated_records(spark, 0, 10, 2), "3")
    table.clean(1, "4")
    table.rollback("3", "5")
    assert table.snapshot().count() == 1000
    with pytest.raises(ValueError, match="retention"):
        table.rollback("2", "6")
    with pytest.raises(ValueError, match="retention"):
        table.snapshot(as_of="1")
    assert table.snapshot().count() == 1000


def test_lost_data_file_raises(spark, root):
    from pathlib import Path

    table = KeyedTable.create(spark, root, TableSpec(keys=("id",), order_by=("sk",)))
    table.bulk_insert(generated_records(spark, 0, 1000), "1", n_files=4)
    next(Path(root).rglob("_version=1/*.parquet")).unlink()
    with pytest.raises(FileNotFoundError):
        table.snapshot()


def test_automatic_id_after_a_short_one(spark, root):
    table = KeyedTable.create(spark, root, TableSpec(keys=("id",), order_by=("sk",)))
    table.insert(generated_records(spark, 0, 10), "9")
    ids = [table.upsert(generated_records(spark, 0, 10, k)) for k in (1, 2)]
    assert "9" < ids[0] < ids[1] and table.snapshot().count() == 10


def test_merge_on_read_leaves_other_partitions_alone(spark, root):
    spec = TableSpec(keys=("id",), order_by=("sk",), partition_by=("part",), storage=MOR)
    table = KeyedTable.create(spark, root, spec)
    rows = spark.range(1000).select("id", F.lit(0).alias("sk"), F.concat(F.lit("p"), F.col("id") % 5).alias("part"))
    table.insert(rows, "1")
    table.upsert(rows.filter("part = 'p3'").withColumn("sk", F.lit(1)), "2")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shown = table.snapshot(view="rt")
        assert {tuple(r) for r in shown.groupBy("part", "sk").count().collect()} == {(f"p{k}", int(k == 3), 200) for k in range(5)}
        plan = shown._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Union" in plan and "SortMergeJoin" in plan.split("Union", 1)[1]
