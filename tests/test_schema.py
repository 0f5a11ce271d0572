from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import (
    SchemaMismatch,
    changes_report,
    conform,
    diff_schemas,
    evolve,
    fill_missing,
    is_valid,
    validate,
    widen,
)
from tidemark.sources import generated_records

STORED = (
    StructType().add("_commit_time", "string").add("id", "long").add("sk", "long").add("txt", "string")
)


def records(spark, **extra):
    return generated_records(spark, 0, 100, **extra)


def test_added_in_the_middle(spark):
    df = records(spark, new_col=F.col("id")).select("id", "new_col", "sk", "txt")
    assert not is_valid(df, STORED)
    diff = diff_schemas(df.schema, STORED)
    assert [f.name for f in diff.added] == ["new_col"] and not diff.missing and not diff.retyped
    ok, out = evolve(df, STORED)
    assert ok and out.columns == ["id", "sk", "txt", "new_col"]
    assert widen(STORED, df.schema).names[-1] == "new_col"


def test_retyped_fails_unless_cast(spark):
    df = records(spark).withColumn("txt", F.col("id"))
    assert not is_valid(df, STORED)
    with pytest.raises(SchemaMismatch, match="retyped txt string -> bigint"):
        conform(df, STORED)
    assert dict(evolve(df, STORED)[1].dtypes)["txt"] == "string"
    assert dict(evolve(df, STORED, force_cast=False)[1].dtypes)["txt"] == "bigint"


def test_dropped_becomes_typed_null(spark):
    df = records(spark).drop("txt")
    assert [f.name for f in diff_schemas(df.schema, STORED).missing] == ["txt"]
    for out in (evolve(df, STORED)[1], fill_missing(df, STORED), conform(df, STORED)):
        assert dict(out.dtypes)["txt"] == "string" and out.filter("txt IS NOT NULL").count() == 0


def test_retyped_and_added_and_reordered(spark):
    df = records(spark, new=F.col("id")).withColumn("txt", F.col("id")).select("txt", "new", "sk", "id")
    ok, out = evolve(df, STORED)
    assert ok and out.dtypes == [("id", "bigint"), ("sk", "bigint"), ("txt", "string"), ("new", "bigint")]
    assert evolve(out.drop("new"), STORED)[1].schema == out.drop("new").schema
    refused, same = evolve(df, STORED, strict=True)
    assert not refused and same.columns == df.columns


def test_values_that_do_not_cast(spark):
    stored = StructType.fromDDL("id bigint, n bigint")
    df = spark.createDataFrame([(1, "A"), (2, "7"), (3, None)], "id bigint, n string")
    report = validate(df, stored).first()
    assert (report.ok, report.n_retyped, report.n_uncastable) == (False, 1, 1)
    assert [r.n for r in evolve(df, stored)[1].orderBy("id").collect()] == [None, 7, None]
    assert changes_report(df, stored).first().asDict() == {"column": "n", "change": "retyped", "n_values": 2}
    assert changes_report(df, df.schema).count() == 0


def test_decimal_keeps_its_scale(spark):
    stored = StructType.fromDDL("id bigint, price decimal(12,2)")
    df = spark.createDataFrame([(1, "3.75")], "id bigint, price string")
    assert evolve(df, stored)[1].first().price == Decimal("3.75")


def test_nullability_is_reported_but_not_enforced(spark):
    df = spark.range(3).select("id", F.lit(1).cast("bigint").alias("sk"), F.lit("x").alias("txt"))
    assert is_valid(df, STORED) and not is_valid(df, STORED, exact=True)
