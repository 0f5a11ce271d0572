"""The order-line workload the registered queries run on.

``lineitem`` plays the sales table.  Its (order, line) pairs repeat, so the whole
table is itself a change batch that needs one row per key: that result is the
base.  The change sets are chosen by business attributes of the rows:

* updates  - returned lines, quantity + 1
* inserts  - undiscounted lines, copied under new (negative) order ids
* erasures - orders whose status is 'P' and whose priority is '1-URGENT'
* stale    - lines of status 'F' with an older date and another quantity
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.keys import derive_keys
from ..operators.precombine import precombine
from ..spec import TableSpec

KEYS = ("order_id", "line_id")
ORDER = ("order_date",)
TIES = ("part_id", "supp_id")
PARTS = ("year", "month")
R = ("order_id", "line_id", "quantity", "order_date")
RP = (*R, *PARTS)

FLAT = TableSpec(keys=KEYS, order_by=ORDER, tie_breakers=())
PARTITIONED = FLAT.with_(partition_by=PARTS)
BATCH = FLAT.with_(tie_breakers=TIES)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Every order line, under the names the jobs use."""
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_shipdate").cast("date").alias("order_date"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("supp_id"),
        F.col("l_discount").alias("discount"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
    )


def base(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """One line per key: the wanted columns, pruned before the shuffle.

    Keys are never NULL; saying so here gives every branch that starts from the
    base the same scan and shuffle, so Spark runs them once and reuses them.
    """
    wanted = [c for c in dict.fromkeys((*KEYS, *ORDER, *TIES, *columns)) if c not in PARTS]
    keyed = lines(spark, sf).select(*wanted).dropna(subset=list(KEYS))
    return precombine(keyed, KEYS, ORDER, TIES)


def with_partitions(df: DataFrame) -> DataFrame:
    return derive_keys(df).drop("record_key", "partition_key")


def updates(df: DataFrame) -> DataFrame:
    return df.filter(F.col("flag") == "R").withColumn("quantity", F.col("quantity") + 1)


def inserts(df: DataFrame) -> DataFrame:
    return df.filter(F.col("discount") == 0).withColumn("order_id", -1 - F.col("order_id"))


def stale(df: DataFrame) -> DataFrame:
    older = df.filter(F.col("status") == "F")
    return older.withColumns(
        {"order_date": F.date_sub("order_date", 1), "quantity": F.col("quantity") + 100}
    )


def erasures(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    chosen = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    return orders.filter(chosen).select(F.col("o_orderkey").alias("order_id"))
