from pyspark.sql import functions as F

from tidemark import KeyedTable, TableSpec
from tidemark.sinks import (
    drop_from_catalog,
    latest_files,
    manifest_entries,
    manifest_text,
    read_manifest,
    register_view,
    sync_catalog,
    write_manifest,
)
from tidemark.sources import generated_records, spread_month

FLAT = TableSpec(keys="id", order_by="sk")
MONTHLY = FLAT.with_(partition_by=("year", "month"))


def monthly(spark, start, count, increment=0, **extra):
    return generated_records(spark, start, count, increment, year=F.lit("2019"), month=spread_month(), **extra)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_catalog_follows_the_table(spark, root):
    table = KeyedTable.create(spark, root, MONTHLY)
    table.bulk_insert(monthly(spark, 0, 500), "1", n_files=2)
    drop_from_catalog(spark, "synced")
    sync_catalog(table, "synced")
    assert same(spark.table("synced"), table.snapshot())
    # a change to one record leaves most old files in place and one dead file beside them
    table.upsert(monthly(spark, 7, 1, 5), "2")
    sync_catalog(table, "synced")
    assert same(spark.table("synced"), table.snapshot())
    table.upsert(monthly(spark, 8, 1, 5, new_col=F.col("id")), "3")
    sync_catalog(table, "synced")
    assert spark.table("synced").columns == table.snapshot().columns
    assert same(spark.table("synced"), table.snapshot())
    ddl = spark.sql("SHOW CREATE TABLE synced__files").first()[0]
    assert "PARTITIONED BY (_version, year, month)" in ddl.replace("`", "")
    assert spark.sql("SHOW PARTITIONS synced__files").count() >= 14
    assert {r.tableName for r in spark.sql("SHOW TABLES").collect()} >= {"synced", "synced__files"}
    counts = spark.sql("SELECT year, month, count(*) AS n FROM synced GROUP BY year, month ORDER BY month")
    assert sum(r.n for r in counts.collect()) == 500
    table.clean(1, "4")
    sync_catalog(table, "synced")
    assert same(spark.table("synced"), table.snapshot())
    drop_from_catalog(spark, "synced")
    assert not spark.catalog.tableExists("synced")


def test_catalog_of_an_unpartitioned_table_and_views(spark, root):
    table = KeyedTable.create(spark, root, FLAT)
    table.bulk_insert(generated_records(spark, 0, 100), "1", n_files=2)
    table.upsert(generated_records(spark, 0, 1, 5), "2")
    sync_catalog(table, "flat_synced")
    assert same(spark.table("flat_synced"), table.snapshot())
    register_view(table, "flat_then", as_of="1")
    assert spark.sql("SELECT sk FROM flat_then WHERE id = 0").first().sk == 0
    assert spark.sql("SELECT sk FROM flat_synced WHERE id = 0").first().sk == 5
    drop_from_catalog(spark, "flat_synced")


def test_manifest_names_exactly_the_live_files(spark, root):
    table = KeyedTable.create(spark, root, MONTHLY)
    table.bulk_insert(monthly(spark, 0, 300), "1", n_files=3)
    first = write_manifest(table)
    table.upsert(monthly(spark, 0, 5, 5), "2")
    second = write_manifest(table)
    assert first != second
    listed = {r["file"] for r in manifest_entries(spark, second, ["year", "month"]).collect()}
    assert listed == {r["file"] for r in latest_files(table).collect()}
    live = {r.path for r in table.files().collect()}
    assert all(any(path.endswith(p) for p in live) for path in listed)
    assert same(read_manifest(spark, second, table), table.snapshot())
    assert same(read_manifest(spark, first, table), table.snapshot(as_of="1"))
    texts = manifest_text(spark, second, ["year", "month"]).collect()
    assert len(texts) == 12 and sum(len(r.files.split("\n")) for r in texts) == len(listed)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(second)
    assert files.select("path").count() == 12


def test_manifest_of_an_unpartitioned_table(spark, root):
    table = KeyedTable.create(spark, root, FLAT)
    table.bulk_insert(generated_records(spark, 0, 30), "1", n_files=3)
    assert same(read_manifest(spark, write_manifest(table), table), table.snapshot())


def test_partition_values_with_slashes(spark):
    from tidemark.functions.keys import partition_path, partition_values

    df = spark.createDataFrame([("a/b", "x%2Fy"), ("a", "%"), ("p=q/p=r", "")], "p string, `q.x` string").withColumnRenamed("q.x", "q")
    back = df.select("p", "q", partition_path(["p", "q"]).alias("path")).select("p", "q", *[c.alias(f"{n}2") for c, n in zip(partition_values("path", ["p", "q"]), "pq")])
    assert all((r.p, r.q or None) == (r.p2, r.q2) for r in back.collect())
