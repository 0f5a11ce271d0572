import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import (
    derive_keys,
    lowercase_columns,
    metric_name,
    metric_table,
    parse_list,
    parse_timestamp,
    partition_path,
    partition_values,
    record_key,
    require_keys,
    scratch_dir,
    to_number,
)
from tidemark.sources import generated_records, jdbc_options, json_records, kafka_options, parse_events, spread_month


def test_keys_and_paths_are_not_padded(spark):
    df = spark.createDataFrame(
        [(7, 1, dt.datetime(2019, 1, 31, 5)), (7, 2, dt.datetime(2019, 12, 1))],
        "order_id bigint, line_id int, order_date timestamp",
    )
    rows = derive_keys(df).orderBy("line_id").collect()
    assert [r.record_key for r in rows] == ["7#1", "7#2"]
    assert [r.partition_key for r in rows] == ["year=2019/month=1", "year=2019/month=12"]
    assert rows[0].order_date == dt.date(2019, 1, 31)


def test_partition_values_come_back(spark):
    df = spark.createDataFrame([("2019", "1"), ("2020", "12")], "year string, month string")
    back = df.select(partition_path(["year", "month"]).alias("p")).select(*partition_values("p", ["year", "month"]))
    assert sorted(map(tuple, back.collect())) == [("2019", "1"), ("2020", "12")]
    assert df.select(partition_path([])).first()[0] == ""


def test_null_key_parts(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "k bigint, p string")
    assert df.filter(record_key(["k", "p"]).isNull()).count() == 2
    with pytest.raises(ValueError, match="^2 rows"):
        require_keys(df, ["k", "p"])
    assert require_keys(df.filter("k = 1"), ["k", "p"]).count() == 1


def test_names_equal_but_for_case(spark):
    df = spark.range(1).select(F.col("id"), F.lit(1).alias("ID"))
    with pytest.raises(ValueError, match="differ only in case: id"):
        lowercase_columns(df)


def test_metric_keys(spark):
    df = spark.createDataFrame(
        [("sales.commit.totalRows", "16292"), ("nodot", "x"), ("a.b", "1.5")], "key string, value string"
    )
    rows = df.select(metric_table("key"), metric_name("key"), to_number("value")).collect()
    assert list(map(tuple, rows)) == [("sales", "commit.totalRows", 16292.0), ("nodot", None, None), ("a", "b", 1.5)]


def test_lists_and_times(spark):
    df = spark.createDataFrame([("year, month,,", "2020-02-30 00:00:00"), (" ", "2020-02-29 23:59:59")], "l string, t string")
    rows = df.select(parse_list("l").alias("l"), parse_timestamp("t").alias("t")).collect()
    assert [r.l for r in rows] == [["year", "month"], []]
    assert [r.t for r in rows] == [None, dt.datetime(2020, 2, 29, 23, 59, 59)]


def test_generated_records(spark):
    rows = generated_records(spark, 24, 4, 2, month=spread_month()).collect()
    assert [(r.id, r.sk, r.txt) for r in rows] == [(24, 26, "Y"), (25, 27, "Z"), (26, 28, "A"), (27, 29, "B")]
    assert all(1 <= r.month <= 12 for r in rows)
    again = generated_records(spark, 24, 4, 2, month=spread_month()).collect()
    assert rows == again


def test_json_sources(spark, tmp_path):
    spark.createDataFrame([('{"b": 1, "a": "x"}',)], "value string").write.text(str(tmp_path / "j"))
    assert json_records(spark, str(tmp_path / "j")).columns == ["a", "b"]
    assert json_records(spark, [{"id": 1, "txt": None}], "id bigint, txt string").first().txt is None
    events = spark.createDataFrame([('{"path": "/x"}',), ("broken",)], "value string")
    assert [r.path for r in parse_events(events, "path string").collect()] == ["/x", None]


def test_reader_options():
    assert jdbc_options("u", "t", column="id", lower=1, upper=9, partitions=4)["numPartitions"] == "4"
    assert "partitionColumn" not in jdbc_options("u", "t")
    with pytest.raises(ValueError):
        jdbc_options("u", "t", column="id")
    options = kafka_options("b:1", "topic", security_protocol="SSL", max_offsets=10)
    assert options["startingOffsets"] == "latest" and options["kafka.security.protocol"] == "SSL"


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark).startswith(shared) and scratch_dir(spark) != scratch_dir(spark)
