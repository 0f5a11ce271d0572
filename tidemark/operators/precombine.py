"""One row per key: the newest record of a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def _ranking(keys, order_by, tie_breakers) -> list[str]:
    return [c for c in dict.fromkeys((*order_by, *tie_breakers)) if c not in keys]


def _has_map(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, MapType) or isinstance(kind, ArrayType) and _has_map(kind.elementType)


def precombine(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """Keep, for each key, the row with the largest ordering value.

    One aggregation: ``max`` of a struct that starts with the ordering columns.
    It combines on the map side, so a key that repeats for a third of the input
    reaches the shuffle as one row per map task.  Columns after the ordering ones
    settle what is still tied, so the result never depends on row order.
    """
    ranking = _ranking(keys, order_by, tie_breakers)
    rest = [c for c in df.columns if c not in keys and c not in ranking]
    if not ranking and not rest:
        return df.distinct()
    unordered = [c for c in rest if _has_map(df.schema[c].dataType)]
    if unordered:
        # Maps have no order: they are carried along, and their text settles ties between them.
        ranked = F.struct(*ranking, *[F.to_json(F.struct(c)).alias(c) if c in unordered else F.col(c) for c in rest])
        newest = F.max_by(F.struct(*ranking, *rest), ranked).alias("_newest")
    else:
        newest = F.max(F.struct(*ranking, *rest)).alias("_newest")
    return (
        df.groupBy(*keys)
        .agg(newest)
        .select(*[F.col(c) if c in keys else F.col(f"_newest.{c}").alias(c) for c in df.columns])
    )


def precombine_window(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """The same rows through ``row_number``; Spark limits each group before the shuffle."""
    ranking = _ranking(keys, order_by, tie_breakers)
    rest = [c for c in df.columns if c not in keys and c not in ranking]
    newest_first = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in (*ranking, *rest)])
    return df.withColumn("_rank", F.row_number().over(newest_first)).filter("_rank = 1").drop("_rank")


def tied_keys(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """Keys whose largest ordering value is shared by several rows, with their number."""
    ranking = _ranking(keys, order_by, tie_breakers)
    counted = df.groupBy(*keys, *ranking).agg(F.count("*").alias("n"))
    return (
        counted.groupBy(*keys)
        .agg(F.max(F.struct(*ranking, "n")).alias("_top"))
        .select(*keys, F.col("_top.n").alias("n"))
        .filter("n > 1")
    )
