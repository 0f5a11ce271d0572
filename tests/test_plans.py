"""The plans that matter at scale: what is read, what is shuffled, what is broadcast."""

import re

from tests.conftest import SF
from tidemark import KeyedTable, TableSpec
from tidemark.operators import merge_on_read, precombine, upsert
from tidemark.plans import sales
from tidemark.sources import generated_records

FLAT = TableSpec(keys="id", order_by="sk")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def nodes(df, name):
    return len(re.findall(rf"(?<![A-Za-z]){name}\b", plan(df)))


def stored(spark, path, df):
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_precombine_reads_its_columns_and_combines_before_the_shuffle(spark):
    df = precombine(sales.lines(spark, SF).select(*sales.R), sales.KEYS, sales.ORDER)
    text = plan(df)
    assert "partial_max" in text and text.count("Exchange") == 1
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"}


def test_a_small_change_set_leaves_the_base_unshuffled(spark, tmp_path):
    base = stored(spark, str(tmp_path / "b"), generated_records(spark, 0, 1000))
    changes = stored(spark, str(tmp_path / "c"), generated_records(spark, 0, 10))
    df = upsert(base, changes, FLAT, deduplicated=True)
    assert nodes(df, "BroadcastHashJoin") == 1 and "LeftAnti" in plan(df)
    assert "hashpartitioning" not in plan(df)
    realtime = merge_on_read(base, changes, FLAT)
    assert nodes(realtime, "BroadcastHashJoin") == 1
    # only the delta is aggregated
    assert plan(realtime).count("hashpartitioning") <= 2


def test_a_large_change_set_is_joined_by_key(spark, tmp_path):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = stored(spark, str(tmp_path / "b"), generated_records(spark, 0, 1000))
        df = upsert(base, base, FLAT, deduplicated=True)
        assert nodes(df, "BroadcastHashJoin") == 0 and nodes(df, "SortMergeJoin") == 1
        table = KeyedTable.create(spark, str(tmp_path / "t"), FLAT)
        table.bulk_insert(base, "1", n_files=3)
        table.upsert(generated_records(spark, 500, 1000, 1), "2")
        assert table.snapshot().count() == 1500
        assert table.snapshot().filter("sk = id + 1").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_filters_and_columns_reach_the_files(spark, tmp_path):
    table = KeyedTable.create(spark, str(tmp_path / "t"), FLAT.with_(partition_by="txt"))
    table.insert(generated_records(spark, 0, 1000), "1")
    text = plan(table.snapshot().filter("id = 5 AND txt = 'F'").select("sk"))
    assert re.search(r"PushedFilters: \[.*EqualTo\(id,5\)", text)
    assert re.search(r"PartitionFilters: \[.*txt.* = F", text)
    assert "ReadSchema: struct<id:bigint,sk:bigint>" in text


def test_a_rewrite_shuffles_its_rows_once(spark, tmp_path, monkeypatch):
    table = KeyedTable.create(spark, str(tmp_path / "t"), FLAT)
    table.bulk_insert(generated_records(spark, 0, 1000), "1", n_files=3)
    seen = []
    write = table._write
    monkeypatch.setattr(table, "_write", lambda df, *a: seen.append(plan(df)) or write(df, *a))
    table.upsert(generated_records(spark, 0, 900, 1), "2")
    (text,) = seen
    assert text.count("shufflepartitionidpassthrough") == 1
    # nothing but the small change set is shuffled by hash
    scans = [line for line in text.split("\n") if "FileScan" in line]
    assert len([s for s in scans if "txt:string" in s]) == 2  # touched files, staged changes
    assert "SortMergeJoin" not in text

