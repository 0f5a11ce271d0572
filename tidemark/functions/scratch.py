"""Working folders for staged data.

A cluster names a shared folder in ``spark.checkpoint.dir``; only a local session
without one (a test) gets a temporary folder of its own; on a cluster it is an error.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession, label: str = "work") -> str:
    """A new, unused folder path below the session's shared checkpoint folder."""
    shared = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"name a folder that all executors share in {_SETTING}")
        shared = tempfile.mkdtemp(prefix="tidemark-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder through the file system that owns it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files below a path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(target).getLength()


def path_uri(spark: SparkSession, path: str) -> str:
    """The full, escaped address of a path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toUri().toString()


def delete_files(files: DataFrame) -> None:
    """Remove the files that the one text column names; tasks do it, and a file that is gone already is no error.

    Names are escaped addresses, as ``path_uri`` and Spark's file metadata have them.
    """
    column = files.columns[0]

    def remove(rows: Iterator[Row]) -> None:
        from pyarrow import fs

        for row in rows:
            scheme, _, rest = row[column].partition(":")
            address = f"file:///{rest.lstrip('/')}" if scheme == "file" else f"{'s3' if scheme == 's3a' else scheme}:{rest}"
            owner, path = fs.FileSystem.from_uri(address)
            try:
                owner.delete_file(path)
            except FileNotFoundError:
                pass

    files.foreachPartition(remove)


def whole_files(spark: SparkSession, most_bytes: int) -> SparkSession:
    """A session like this one in which a scan gives each file to a task of its own, in pieces of ``most_bytes`` at most."""
    apart = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            apart.conf.set(key, value)
    # Opening a file counts as much as a full piece, so that no second one fits beside it.
    apart.conf.set("spark.sql.files.maxPartitionBytes", str(most_bytes))
    apart.conf.set("spark.sql.files.openCostInBytes", str(most_bytes))
    return apart


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty when there is no such folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in fs.listStatus(target)] if fs.exists(target) else []
