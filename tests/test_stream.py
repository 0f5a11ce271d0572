import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import MOR, KeyedTable, TableSpec
from tidemark.functions import derive_keys
from tidemark.metrics import BatchListener, batch_sink
from tidemark.plans import queries
from tidemark.sources import file_events
from tidemark.streaming import ChangeStream

SPEC = TableSpec(keys="record_key", order_by="order_date", partition_by=("year", "month"))
RAW = "ORDER_ID bigint, LINE_ID int, QUANTITY int, ORDER_DATE string, Op string"


def write_change(spark, folder, n, rows):
    """One change file plus the message that names it."""
    path = f"{folder}/data/{n}"
    spark.createDataFrame(rows, RAW).coalesce(1).write.parquet(path)
    events = folder / "events"
    events.mkdir(exist_ok=True)
    (events / f"{n}.json").write_text(json.dumps({"path": path, "size": 1}) + "\n")


def prepare(df):
    return derive_keys(df).drop("partition_key")


def run(stream, spark, folder, checkpoint, per_batch=1):
    query = stream.start(
        file_events(spark, str(folder / "events"), per_batch), str(folder / checkpoint), available_now=True
    )
    query.awaitTermination(120)
    assert query.exception() is None
    return query


@pytest.mark.parametrize("storage", ["cow", MOR])
def test_files_arrive_batch_by_batch(spark, tmp_path, storage):
    table = KeyedTable.create(spark, str(tmp_path / "t"), SPEC.with_(storage=storage))
    write_change(spark, tmp_path, 1, [(1, 1, 5, "2020-01-31", "I"), (1, 2, 6, "2020-02-01", "I")])
    done, sent = [], []
    tell = batch_sink(table, "t", lambda *metric: sent.append(metric))
    stream = ChangeStream(table, prepare, on_commit=lambda commit, batch: (done.append(batch), tell(commit, batch)))
    run(stream, spark, tmp_path, "c1")
    lookup = table.snapshot().filter("order_id = 1 AND record_key = '1#1'")
    assert [r.quantity for r in lookup.collect()] == [5]
    write_change(spark, tmp_path, 2, [(1, 1, 50, "2020-01-31", "U"), (2, 1, 7, "2020-02-01", "I")])
    run(stream, spark, tmp_path, "c1")
    out = table.snapshot()
    assert "op" not in out.columns
    rows = sorted((r.record_key, r.quantity, r.year, r.month) for r in out.collect())
    assert rows == [("1#1", 50, "2020", "1"), ("1#2", 6, "2020", "2"), ("2#1", 7, "2020", "2")]
    # the frame made earlier still reads the version it was bound to
    assert [r.quantity for r in lookup.collect()] == [5]
    assert done == [0, 1] and sent == [("t", "batch.records", 2.0)] * 2
    # nothing new: no batch, no commit
    run(stream, spark, tmp_path, "c1")
    assert done == [0, 1] and len({r.query_id for r in table.log.rows()}) == 1
    # a new checkpoint starts at batch 0 again; its batches are not mistaken for old ones
    write_change(spark, tmp_path, 3, [(9, 1, 1, "2021-12-01", "I")])
    run(stream, spark, tmp_path, "c2", per_batch=10)
    assert sorted(r.quantity for r in table.snapshot().collect()) == [1, 6, 7, 50]


def test_handler_skips_empty_and_replayed_batches(spark, tmp_path):
    table = KeyedTable.create(spark, str(tmp_path / "t"), SPEC)
    stream = ChangeStream(table, prepare)
    write_change(spark, tmp_path, 1, [(1, 1, 5, "2020-01-31", "I")])
    batch = spark.read.text(str(tmp_path / "events"))
    stream.apply(batch.limit(0), 0)
    assert table.log.commits().count() == 0
    context = spark.sparkContext
    context.setLocalProperty("sql.streaming.queryId", "q1")
    try:
        stream.apply(batch, 0)
        stream.apply(batch, 0)  # the commit happened, the offsets were lost
        assert table.log.commits().count() == 1
    finally:
        context.setLocalProperty("sql.streaming.queryId", None)


def test_a_message_without_a_file_stops_the_stream(spark, tmp_path):
    table = KeyedTable.create(spark, str(tmp_path / "t"), SPEC)
    batch = spark.createDataFrame([("not json",)], "value string")
    with pytest.raises(ValueError, match="names no file"):
        ChangeStream(table, prepare).apply(batch, 0)


def test_listener_reports_rows(spark, tmp_path):
    seen = []
    listener = BatchListener("t", lambda *metric: seen.append(metric))
    spark.streams.addListener(listener)
    try:
        spark.range(7).select(F.col("id").cast("string")).coalesce(1).write.text(str(tmp_path / "in"))
        query = (
            spark.readStream.text(str(tmp_path / "in"))
            .writeStream.format("noop")
            .option("checkpointLocation", str(tmp_path / "c"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination(60)
        for _ in range(50):
            if seen:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert ("t", "batch.rows", 7.0) in seen


def test_files_of_one_batch_may_differ_in_columns(spark, tmp_path):
    from tidemark.sources import read_files

    one, two, three = (str(tmp_path / f"f{k}") for k in range(3))
    spark.range(3).selectExpr("id", "id AS sk").write.parquet(one)
    spark.range(3, 5).selectExpr("id", "id AS sk", "'x' AS new_col").write.parquet(two)
    spark.range(5, 6).selectExpr("id", "'y' AS sk").write.parquet(three)
    rows = read_files(spark, [one, two])
    assert sorted((r.id, r.new_col) for r in rows.collect()) == [(0, None), (1, None), (2, None), (3, "x"), (4, "x")]
    with pytest.raises(ValueError, match="new_col"):
        read_files(spark, [one, two], spark.read.parquet(one).schema)
    with pytest.raises(Exception):
        read_files(spark, [one, three])


def test_offset_ranges_lead_from_batch_to_batch(spark, tmp_path):
    table = KeyedTable.create(spark, str(tmp_path / "t"), SPEC)
    stream = ChangeStream(table, prepare)
    with pytest.raises(ValueError, match="not been started"):
        stream.offsets()
    for n in (1, 2, 3):
        write_change(spark, tmp_path, n, [(n, 1, 5, "2020-01-31", "I"), (n, 2, 6, "2020-02-01", "I")])
    run(stream, spark, tmp_path, "c", per_batch=2)
    found = stream.offsets().orderBy("batch_id").collect()
    assert [(r.batch_id, r.n_rows, r.rows_received) for r in found] == [(0, 2, 4), (1, 1, 2)]
    assert found[0].start_offset is None and json.loads(found[0].end_offset) == json.loads(found[1].start_offset)
    assert [r.commit_id for r in found] == [r.commit_id for r in table.log.rows()]


def test_no_task_writes_all_changes_of_a_year(spark, tmp_path):
    """A year's changes fill several files where they are many; the stream still gets one message for each year."""
    spec = TableSpec(keys=("order_id", "line_id"), order_by="order_date")
    days = F.expr("CASE WHEN id < 60000 THEN DATE'1995-01-01' WHEN id < 60010 THEN DATE'1996-01-01' END")
    changes = spark.range(60_010).select(
        F.col("id").alias("order_id"), F.lit(1).alias("line_id"), F.rand(1).alias("quantity"), days.alias("order_date")
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "100k")
    try:
        folder = Path(queries._yearly_events(spark, changes))
    finally:
        spark.conf.unset(size)
    assert len([*folder.glob("data/by_year=1995/*.parquet")]) > 1
    table = KeyedTable.create(spark, str(tmp_path / "table"), spec)
    run(ChangeStream(table), spark, folder, "checkpoint", per_batch=1000)
    assert [r.rows_received for r in table.batches().collect()] == [60_010]
    assert table.snapshot().columns == changes.columns
    assert table.snapshot().exceptAll(changes).isEmpty() and table.snapshot().count() == 60_010
    assert spark.read.text(f"{folder}/events").count() == 2
