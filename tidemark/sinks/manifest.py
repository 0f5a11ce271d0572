"""Publish the latest files of a table for readers that know nothing of its log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.keys import partition_values
from ..tables import KeyedTable


def _decoded(path: Column) -> Column:
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _below_version(path: Column) -> Column:
    return F.substring_index(path, "/_version=", -1)


def latest_files(table: KeyedTable, as_of: str | None = None) -> DataFrame:
    """Full paths of the base files live at a commit, with their partition values."""
    files = table.files(as_of).filter("layer = 'base'")
    return files.select(
        F.concat(F.lit(f"{table.root}/base/_version="), _decoded(F.col("path"))).alias("file"),
        *partition_values("partition_path", table.spec.partition_by),
    )


def write_manifest(table: KeyedTable, as_of: str | None = None, folder: str | None = None) -> str:
    """One text file per partition, one file path per line; returns the folder.

    Each commit gets a folder of its own, so a reader of an older manifest is not
    disturbed.  The executors write the files.
    """
    latest = as_of or table.log.commits().agg(F.max("commit_id")).first()[0]
    folder = folder or f"{table.root}/manifest/{latest}"
    parts = list(table.spec.partition_by)
    files = latest_files(table, as_of)
    if parts:
        files.repartition(*parts).write.mode("overwrite").partitionBy(*parts).text(folder)
    else:
        files.coalesce(1).write.mode("overwrite").text(folder)
    return folder


def manifest_entries(spark: SparkSession, folder: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Lines of a manifest: the file and the partition it belongs to."""
    schema = ", ".join(["file string", *[f"{c} string" for c in partition_by]])
    return spark.read.schema(schema).text(folder)


def manifest_counts(spark: SparkSession, folder: str, partition_by: Sequence[str]) -> DataFrame:
    entries = manifest_entries(spark, folder, partition_by)
    return entries.groupBy(*partition_by).agg(F.count("*").alias("n_files"))


def manifest_text(spark: SparkSession, folder: str, partition_by: Sequence[str]) -> DataFrame:
    """Each partition's paths joined into one newline-separated value."""
    entries = manifest_entries(spark, folder, partition_by)
    lines = F.array_join(F.array_sort(F.collect_list("file")), "\n")
    return entries.groupBy(*partition_by).agg(lines.alias("files"))


def read_manifest(spark: SparkSession, folder: str, table: KeyedTable) -> DataFrame:
    """The rows behind a manifest: a scan of the version folders it names, semi-joined with its list of files.

    To the driver come the versions, one for each commit.  A listed file that is gone raises.
    """
    schema = table.schema()
    listed = manifest_entries(spark, folder, table.spec.partition_by).select(_below_version(F.col("file")).alias("_listed"))
    versions = sorted(r[0] for r in listed.select(F.substring_index("_listed", "/", 1)).distinct().collect())
    if not versions:
        return spark.createDataFrame([], schema)
    folders = [f"{table.root}/base/_version={v}" for v in versions]
    there = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folders)
    there = there.select(_decoded(_below_version(F.col("_metadata.file_path"))).alias("_there"))
    lost = listed.join(there, F.col("_listed") == F.col("_there"), "left_anti").first()
    if lost:
        raise FileNotFoundError(f"{folder} lists files that are gone, {lost[0]} among them")
    scan = spark.read.schema(schema).option("basePath", f"{table.root}/base").parquet(*folders)
    scan = scan.withColumn("_own", _decoded(_below_version(F.col("_metadata.file_path"))))
    return scan.join(listed, F.col("_own") == F.col("_listed"), "left_semi").select(*schema.names)
