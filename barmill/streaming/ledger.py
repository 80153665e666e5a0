"""Ingest of feed dumps by a ledger: a table of the files that were taken.

In a folder of their own lie ``lines`` (a folder per batch), ``ledger`` (a row per file taken, a file per batch)
and, while a batch is under way, ``open``: the files it consists of. A batch is named by its files, so
doing it again writes the same folder once more. Its ledger file commits it. What a stopped run has
left open is done first by the next one, and readers leave it out until then.

The driver holds the files of one batch, a bounded number. What was taken before is compared in Spark.
One writer at a time; any number of readers.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barmill.plans.workspace import exists, make_folder, move, remove
from barmill.schema import DUMP_LINE
from barmill.sources.files import with_identity

FILE = "path string, length bigint, modificationTime timestamp"
#: What makes a file: one that was replaced under its name is another.
_FILE = ["path", "length", "modificationTime"]
#: Most files of a batch, whose names the driver holds.
MOST_FILES = 5_000


def landed(spark: SparkSession, landing: str) -> DataFrame:
    """Files below a folder, by path, length and time; none of them is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing)
    return files.select(*_FILE)


def ledger(spark: SparkSession, home: str) -> DataFrame:
    """The files taken so far, each with its ``batch``."""
    if not exists(spark, f"{home}/ledger"):
        return spark.createDataFrame([], f"{FILE}, batch string")
    return spark.read.schema(f"{FILE}, batch string").parquet(f"{home}/ledger")


def not_taken(spark: SparkSession, landing: str, home: str) -> DataFrame:
    """Files that have landed and are not in the ledger.

    Of the ledger only what is no older than the oldest file that still lies in the landing folder can
    be among them; with an archive that is little, and the rest is left out by its files' statistics.
    """
    files = landed(spark, landing)
    if not exists(spark, f"{home}/ledger"):
        return files
    oldest = files.agg(F.min("modificationTime").alias("oldest")).first()["oldest"]
    taken = ledger(spark, home).where(F.col("modificationTime") >= F.lit(oldest)).select(*_FILE)
    return files if oldest is None else files.join(taken, _FILE, "left_anti")


@dataclass(frozen=True)
class Batch:
    """Name (a digest of the files), paths and files of the batch that is under way."""

    name: str
    paths: list[str]
    files: DataFrame


def _batch(files: DataFrame) -> Batch | None:
    """A bounded number of files as a batch; none if there are none."""
    each = F.xxhash64(*_FILE)
    digest = F.concat_ws("-", F.hex(F.bit_xor(each)), F.hex(F.bit_xor(F.hash(*_FILE))), F.count(F.lit(1)))
    row = files.agg(digest.alias("name"), F.collect_list(F.struct(*_FILE)).alias("files")).first()
    if not row["files"]:
        return None
    return Batch(row["name"], [f["path"] for f in row["files"]], files.sparkSession.createDataFrame(row["files"], FILE))


def opened(spark: SparkSession, home: str) -> Batch | None:
    """The batch that is under way, as it was written down; none if there is none."""
    if not exists(spark, f"{home}/open/_whole"):
        return None
    return _batch(spark.read.schema(FILE).parquet(f"{home}/open/files"))


def open_batch(
    spark: SparkSession, landing: str, home: str, most_files: int = MOST_FILES, most_bytes: int | None = None
) -> Batch | None:
    """Write down the files of the next batch, the oldest first; none if nothing has landed.

    A batch has at least one file, however large.
    """
    order = Window.orderBy("modificationTime", "path")
    # Spark takes the first rows of each task before it numbers them.
    numbered = not_taken(spark, landing, home).withColumn("_n", F.row_number().over(order))
    first = numbered.where(F.col("_n") <= most_files)
    if most_bytes:
        before = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
        first = first.withColumn("_before", F.coalesce(before, F.lit(0))).where(F.col("_before") < most_bytes)
    batch = _batch(first.select(*_FILE))
    if batch:
        batch.files.coalesce(1).write.mode("overwrite").parquet(f"{home}/open/files")
        make_folder(spark, f"{home}/open/_whole")
    return batch


def _plain(path: str) -> str:
    """A path whose name has no signs of a glob."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def write_batch(spark: SparkSession, home: str, batch: Batch) -> None:
    """Write the lines of a batch to its folder, whatever a stopped run has left there."""
    lines = with_identity(spark.read.text([_plain(p) for p in batch.paths]))
    dumped = lines.select(F.col("value").alias("line"), "symbol", "snapshot")
    dumped.write.mode("overwrite").parquet(f"{home}/lines/batch={batch.name}")


def commit_batch(spark: SparkSession, home: str, batch: Batch) -> None:
    """Enter the files of a batch into the ledger: one file, so they are all in or none."""
    batch.files.coalesce(1).write.mode("overwrite").parquet(f"{home}/ledger/batch={batch.name}")


def close_batch(spark: SparkSession, home: str, batch: Batch, archive: str | None = None) -> None:
    """Move the files away, if asked for, and take the mark from the batch."""
    if archive:
        for path in batch.paths:
            move(spark, path, archive)
    remove(spark, f"{home}/open")


def ingest_by_ledger(
    spark: SparkSession,
    landing: str,
    home: str,
    most_files: int = MOST_FILES,
    most_bytes: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Take what has landed since the last run, batch by batch, and return all lines.

    ``most_files`` and ``most_bytes`` bound a batch, such as the first over a long history. ``archive`` is
    a folder that files are moved to once they are in the ledger, which keeps the listing of the landing
    folder short. Dumps must be moved into place whole. Lines of a file whose name is not that of a
    dump have neither symbol nor snapshot. Before anything has landed there are no lines.
    """
    left_open = opened(spark, home)
    while batch := left_open or open_batch(spark, landing, home, most_files, most_bytes):
        write_batch(spark, home, batch)
        commit_batch(spark, home, batch)
        close_batch(spark, home, batch, archive)
        if not left_open and len(batch.paths) < most_files and not most_bytes:
            break  # those were all
        left_open = None
    return ingested(spark, home)


def ingested(spark: SparkSession, home: str) -> DataFrame:
    """Lines of all batches that are done, with symbol and snapshot; no join and no shuffle."""
    if not exists(spark, f"{home}/lines"):
        return spark.createDataFrame([], DUMP_LINE)
    lines = spark.read.schema(T.StructType([*DUMP_LINE, T.StructField("batch", T.StringType())])).parquet(f"{home}/lines")
    under_way = opened(spark, home)
    return (lines.where(F.col("batch") != under_way.name) if under_way else lines).drop("batch")
