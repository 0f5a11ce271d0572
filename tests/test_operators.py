import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark import EVENT_TIME, TableSpec
from tidemark.operators import (
    blank_values,
    delete_candidates,
    delete_candidates_semi,
    delete_where,
    hard_delete,
    merge_on_read,
    pending_changes,
    precombine,
    precombine_window,
    soft_delete,
    tied_keys,
    update_where,
    upsert,
)

SPEC = TableSpec(keys="id", order_by="ts")
SCHEMA = "id bigint, ts bigint, v string"
LAWS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
ROWS = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 3), st.sampled_from("abc")), max_size=12)


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def newest(rows):
    best = {}
    for row in rows:
        if row[0] not in best or row[1:] > best[row[0]][1:]:
            best[row[0]] = row
    return best


@LAWS
@given(ROWS)
def test_precombine_two_ways(spark, rows):
    want = sorted(newest(rows).values())
    df = frame(spark, rows)
    assert got(precombine(df, ["id"], ["ts"])) == want
    assert got(precombine_window(df, ["id"], ["ts"])) == want


@LAWS
@given(ROWS, ROWS)
def test_upsert_laws(spark, stored, incoming):
    base = list(newest(stored).values())
    changes = newest(incoming)
    want = sorted((newest(stored) | changes).values())
    once = upsert(frame(spark, base), frame(spark, incoming), SPEC)
    assert got(once) == want
    assert got(upsert(once, frame(spark, incoming), SPEC)) == want
    assert got(merge_on_read(frame(spark, base), frame(spark, incoming), SPEC)) == want
    timed = dict(newest(stored))
    for key, row in changes.items():
        if key not in timed or row[1] >= timed[key][1]:
            timed[key] = row
    assert got(upsert(frame(spark, base), frame(spark, incoming), SPEC, policy=EVENT_TIME)) == sorted(timed.values())
    survivors = sorted(r for r in base if r[0] not in changes)
    assert got(hard_delete(frame(spark, base), frame(spark, incoming), ["id"])) == survivors
    assert got(upsert(frame(spark, base), frame(spark, incoming), SPEC, policy="delete")) == survivors


def test_three_versions_of_a_key(spark):
    df = frame(spark, [(1, 1, "a"), (1, 3, "c"), (1, 2, "b")])
    assert got(precombine(df, ["id"], ["ts"])) == [(1, 3, "c")]
    tied = frame(spark, [(1, 3, "a"), (1, 3, "b"), (1, 1, "z"), (2, 1, "q"), (2, 2, "r")])
    assert got(tied_keys(tied, ["id"], ["ts"])) == [(1, 2)]
    assert got(tied_keys(tied, ["id"], ["ts"], ["v"])) == []
    assert got(precombine(tied, ["id"], ["ts"])) == [(1, 3, "b"), (2, 2, "r")]


def test_wider_changes_leave_old_rows_null(spark):
    wide = spark.createDataFrame([(2, 5, "n", 9)], SCHEMA + ", extra int")
    out = upsert(frame(spark, [(1, 1, "a"), (2, 1, "b")]), wide, SPEC)
    assert out.columns == ["id", "ts", "v", "extra"]
    assert got(out) == [(1, 1, "a", None), (2, 5, "n", 9)]


def test_delete_lists(spark):
    base = frame(spark, [(1, 1, "a"), (2, 1, "b"), (3, 1, None)])
    twice = spark.createDataFrame([(1,), (1,), (77,)], "id bigint")
    assert got(delete_candidates(base, twice, ["id"])) == [(1, 1, "a"), (1, 1, "a")]
    assert got(delete_candidates_semi(base, twice, ["id"])) == [(1, 1, "a")]
    assert got(hard_delete(base, twice, ["id"])) == [(2, 1, "b"), (3, 1, None)]
    assert got(delete_where(base, F.col("v") == "a")) == [(2, 1, "b"), (3, 1, None)]


def test_soft_delete_keeps_key_and_order(spark):
    base = frame(spark, [(1, 1, "a"), (2, 2, "b")])
    listed = spark.createDataFrame([(2,), (2,)], "id bigint")
    assert got(soft_delete(base, listed, SPEC)) == [(1, 1, "a"), (2, 2, None)]
    assert got(soft_delete(base, listed, SPEC, {"v": "-"})) == [(1, 1, "a"), (2, 2, "-")]
    with pytest.raises(ValueError, match="ts"):
        blank_values(base, SPEC, {"ts": None})


def test_update_where_keeps_types(spark):
    df = update_where(frame(spark, [(1, 1, "a"), (2, None, "b")]), F.col("ts") > 0, {"ts": F.col("ts") + 1})
    assert got(df) == [(1, 2, "a"), (2, None, "b")] and df.schema["ts"].dataType.simpleString() == "bigint"


def test_merge_on_read_with_deletes_and_commits(spark):
    base = frame(spark, [(1, 1, "a"), (2, 1, "b"), (3, 1, "c")])
    delta = spark.createDataFrame(
        [
            (1, 5, "first", "c1", False),
            (1, 4, "second", "c2", False),
            (2, None, None, "c1", True),
            (9, 1, "new", "c1", False),
        ],
        SCHEMA + ", _commit_time string, _deleted boolean",
    )
    stamped = base.withColumn("_commit_time", F.lit("c0"))
    out = merge_on_read(stamped, delta, SPEC).drop("_commit_time")
    assert got(out) == [(1, 4, "second"), (3, 1, "c"), (9, 1, "new")]
    timed = SPEC.with_(policy=EVENT_TIME)
    assert (1, 5, "first") in got(merge_on_read(stamped, delta, timed).drop("_commit_time"))
    pending = pending_changes(stamped, delta, SPEC, "v")
    assert got(pending) == [(1, "a", "second"), (2, "b", None), (9, None, "new")]


def test_spec_rules():
    with pytest.raises(ValueError):
        TableSpec(keys=())
    with pytest.raises(ValueError):
        TableSpec(keys="id", policy=EVENT_TIME)
    spec = TableSpec(keys="ID", partition_by=("Year",))
    assert spec.identity == ("year", "id") and spec.with_(global_key=True).identity == ("id",)
    assert TableSpec.from_json(spec.to_json()) == spec


def test_precombine_carries_maps(spark):
    rows = [(1, 1, {"a": 1}), (1, 2, {"b": 2}), (2, 1, {"c": 3}), (2, 1, {"d": 4}), (3, 1, None)]
    df = spark.createDataFrame(rows, "id long, sk long, m map<string,int>")
    got = {r.id: (r.sk, r.m) for r in precombine(df.repartition(3), ["id"], ["sk"]).collect()}
    assert got == {1: (2, {"b": 2}), 2: (1, {"d": 4}), 3: (1, None)}
