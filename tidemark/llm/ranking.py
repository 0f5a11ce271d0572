"""Places of rows in an order, within groups of any size, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: Rows that one task sorts, at least; with more rows there are more tasks.
ROWS_A_TASK = 200_000


def n_ranges(df: DataFrame) -> int:
    """Ranges to sort a staged frame in: the session's shuffle partitions, more if these would get large."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_A_TASK))


def ranked(df: DataFrame, group: str, order: list[Column], label: str, rank: str = "rank") -> DataFrame:
    """A staged frame with each row's place in its group, from 0; ``group`` has no nulls, ``order`` should leave no ties.

    Rows are sorted by ranges of (group, order), so that a large group is many ranges. Rows of a range are numbered where
    they are written; a small table of (range, group) says how many rows of the group come before.
    """
    keys = [F.col(group), *order]
    placed = df.repartitionByRange(n_ranges(df), *keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id())
    placed = stage(placed, label)
    part = F.shiftright("__at", 33)
    runs = placed.groupBy(F.col(group).alias("__group"), part.alias("__part")).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    earlier = F.sum("__n").over(Window.partitionBy("__group").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    runs = stage(runs.withColumn("__before", F.coalesce(earlier, F.lit(0))).drop("__n"), f"{label}-runs")
    joined = placed.join(runs, (F.col(group) == F.col("__group")) & (part == F.col("__part")))
    return joined.withColumn(rank, F.col("__before") + F.col("__at") - F.col("__first")).drop("__at", "__group", "__part", "__first", "__before")
