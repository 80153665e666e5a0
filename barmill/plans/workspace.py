"""Where intermediate tables go, and how they are removed."""

from __future__ import annotations

import re
import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def work_dir(spark: SparkSession, label: str) -> str:
    """New directory in the shared folder that ``spark.checkpoint.dir`` names.

    Only a local session may do without that setting; executors of a cluster could not see a
    folder of the driver's machine.
    """
    return f"{_home(spark)}/{label}-{uuid4().hex}"


def _home(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="barmill-")
    return f"{shared.rstrip('/')}/barmill"


def _located(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name, in whatever store it lies."""
    files, there = _located(spark, path)
    return files.exists(there)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, in order; none if it is not there."""
    files, there = _located(spark, path)
    if not files.exists(there):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(there) if s.isDirectory())


def make_folder(spark: SparkSession, path: str) -> None:
    files, there = _located(spark, path)
    files.mkdirs(there)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and all in it, if it is there."""
    files, there = _located(spark, path)
    files.delete(there, True)


def move(spark: SparkSession, path: str, folder: str) -> None:
    """Move a file into a folder, below which it keeps its whole path; nothing if it is gone already."""
    files, there = _located(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}{there.toUri().getPath()}")
    if files.exists(there):
        files.mkdirs(target.getParent())
        files.rename(there, target)


def clean_up(spark: SparkSession) -> None:
    """Remove the work folders of earlier runs and the tables that lie in them.

    For the end of a job: results that were not written elsewhere cannot be read any more.
    """
    for table in spark.catalog.listTables():
        if table.name.startswith("barmill_") and not table.isTemporary:
            spark.sql(f"DROP TABLE IF EXISTS {table.name}")
    remove(spark, _home(spark))
