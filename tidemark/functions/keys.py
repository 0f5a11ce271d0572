"""Record keys, partition paths and column-name clean-up."""

from __future__ import annotations

import re

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def record_key(columns: Sequence[str], separator: str = "#") -> Column:
    """``a#b`` over the key columns; NULL when any part is NULL."""
    parts = [F.col(columns[0]).cast("string")]
    for name in columns[1:]:
        parts += [F.lit(separator), F.col(name).cast("string")]
    return F.concat(*parts)


def partition_path(columns: Sequence[str]) -> Column:
    """``year=2019/month=1``: Hive-style path, no zero padding, '' when unpartitioned.

    A slash in a value is written %2F, and a per cent sign %25, so that values can be told apart again.
    """
    if not columns:
        return F.lit("")
    parts = []
    for i, name in enumerate(columns):
        value = F.replace(F.col(name).cast("string"), F.lit("%"), F.lit("%25"))
        parts += [F.lit(("/" if i else "") + name + "="), F.replace(value, F.lit("/"), F.lit("%2F"))]
    return F.concat(*parts)


def _plain(value: Column) -> Column:
    return F.replace(F.replace(value, F.lit("%2F"), F.lit("/")), F.lit("%25"), F.lit("%"))


def partition_values(path: str | Column, columns: Sequence[str]) -> list[Column]:
    """The values behind a Hive-style partition path, one string column each."""
    path = F.col(path) if isinstance(path, str) else path
    return [
        F.nullif(_plain(F.regexp_extract(path, f"(?:^|/){re.escape(name)}=([^/]*)", 1)), F.lit("")).alias(name)
        for name in columns
    ]


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name; refuse names that would become equal."""
    lowered = [name.lower() for name in df.columns]
    clashes = sorted(name for name, n in Counter(lowered).items() if n > 1)
    if clashes:
        raise ValueError(f"column names differ only in case: {', '.join(clashes)}")
    return df.toDF(*lowered)


def derive_keys(
    df: DataFrame,
    keys: Sequence[str] = ("order_id", "line_id"),
    date: str = "order_date",
    key_column: str = "record_key",
    path_column: str = "partition_key",
) -> DataFrame:
    """Add the record key, the date, its year and month, and the partition path."""
    return (
        df.withColumn(key_column, record_key(keys))
        .withColumn(date, F.col(date).cast("date"))
        .withColumn("year", F.year(date).cast("string"))
        .withColumn("month", F.month(date).cast("string"))
        .withColumn(path_column, partition_path(["year", "month"]))
    )


def any_null(columns: Sequence[str]) -> Column:
    """True where at least one of the columns is NULL."""
    test = F.lit(False)
    for name in columns:
        test = test | F.col(name).isNull()
    return test


def require_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail, with a count, when a key or partition column holds NULL."""
    bad = df.select(F.count_if(any_null(columns)).alias("n")).first()["n"]
    if bad:
        raise ValueError(f"{bad} rows have NULL in one of {', '.join(columns)}")
    return df
