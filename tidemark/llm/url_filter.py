"""URL rules by a sort-merge range join, in DataFrame operations only.

A host is turned round (``m.example.org`` becomes ``org.example.m.``), so that a rule for a host and all its
subdomains is an interval of keys: those that start with the rule's own key. Hosts and rules are sorted together and
swept. Intervals are nested or apart, so the rules that are active at a key are the last rule that began before it
and some of that rule's own ancestors: the stack is kept with the rule, and the sweep only carries its top.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.local import local_frame
from .common import stage


def url_host(url) -> F.Column:
    """What follows the first :// up to /, ?, # or the end, with A-Z lower-cased; empty without ://."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url) -> F.Column:
    """What follows the host up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host) -> F.Column:
    """Labels in reverse order, each followed by a dot; a key starts with the keys of all its parent domains."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _stacks(rules: DataFrame) -> DataFrame:
    """key, stack: for every host with rules, the hosts at or above it that have rules, and the lengths of their paths.

    A host has as many ancestors as labels, and paths have few lengths, so a stack stays small however many rules
    one host has; the rules themselves are looked up by equality.
    """
    lengths = rules.select(F.col("key").alias("above"), F.length("path").alias("length")).distinct()
    labels = F.split(F.rtrim("key", F.lit(".")), r"\.")
    up = rules.select("key").distinct().select("key", F.explode(F.sequence(F.lit(1), F.size(labels))).alias("depth"), labels.alias("labels"))
    up = up.select("key", F.concat(F.array_join(F.slice("labels", F.lit(1), F.col("depth")), "."), F.lit(".")).alias("above"))
    return up.join(lengths, "above").groupBy("key").agg(F.collect_list(F.struct("above", "length")).alias("stack"))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame | Sequence[tuple[str, str, str]],
    otherwise: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``rules`` holds (host, path, verdict); a rule fits its host and all subdomains if the url's path starts with the
    rule's. The longest rule that fits wins; of equally long ones that of the longer host, then the first in the
    order of (rule, verdict). Without one, rule is null and the verdict is ``otherwise``. A null url, or one without
    ://, has an empty host and path and fits no rule. Null ids and repeated rows give a row each; an empty table
    gives none. Rules with a null or empty host are refused by being no prefix of any host.

    Pages are swept by distinct host, so a host with a third of all pages is one row of the sweep. Parts of the
    sorted table are swept on their own, each starting from the last rule of the parts before it.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = local_frame(spark, list(rules), "host string, path string, verdict string")
    rules = rules.filter("host <> ''").select(
        host_key(F.lower("host")).alias("key"), F.coalesce("path", F.lit("")).alias("path"), "verdict", F.concat("host", F.coalesce("path", F.lit(""))).alias("rule")
    )
    stacks = _stacks(rules)

    read = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    hosts = read.filter("host <> ''").select("host").distinct().select(host_key(F.col("host")).alias("key"), "host", F.lit(None).cast("string").alias("begins"))
    starts = stacks.select("key", F.lit(None).cast("string").alias("host"), F.col("key").alias("begins"))
    # Written once, so that the part numbers of all later reads are those of one sort.
    swept = stage(hosts.union(starts).repartitionByRange("key").select("*", F.spark_partition_id().alias("part")), "sweep")
    carried = swept.groupBy("part").agg(F.max("begins").alias("last"))
    carried = carried.select("part", F.max("last").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    # Keys sort by code point, so a rule's key comes before all keys it is a prefix of; ties put the rule first.
    sweep = Window.partitionBy("part").orderBy("key", F.col("host").isNotNull())
    top = F.last("begins", ignorenulls=True).over(sweep.rowsBetween(Window.unboundedPreceding, 0))
    topped = swept.withColumn("top", top).filter("host is not null").join(F.broadcast(carried), "part")
    topped = topped.select("key", "host", F.coalesce("top", "carried").alias("top"))
    inside = F.filter("stack", lambda r: F.startswith(F.col("key"), r["above"]))
    active = topped.join(stacks.withColumnRenamed("key", "top"), "top").select(F.col("host").alias("on"), inside.alias("active"))

    asked = read.join(active, F.col("host") == F.col("on"), "left").select("page_id", "host", "path", F.filter("active", lambda r: r["length"] <= F.length("path")).alias("active"))
    asked = asked.select("page_id", "host", "path", F.posexplode_outer("active").alias("n", "r"))
    asked = asked.select("page_id", "host", "path", F.col("n"), F.col("r.above").alias("above"), F.expr("substring(path, 1, r.length)").alias("prefix"))
    # The smallest: longest rule, then longest host, then the first in order.
    rank = F.struct((-F.length("rule")).alias("length"), (-F.length("key")).alias("depth"), "rule", "verdict")
    best = rules.groupBy(F.col("key").alias("above"), F.col("path").alias("prefix")).agg(F.min(rank).alias("best"))
    judged = asked.join(best, ["above", "prefix"], "left").groupBy("page_id", "host", "path")
    judged = judged.agg(F.min("best").alias("best"), F.count_if(F.coalesce(F.col("n"), F.lit(0)) == 0).alias("copies"))
    judged = judged.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"))
