"""Incremental ingest of feed dumps as they land."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barmill.plans.workspace import exists
from barmill.schema import DUMP_LINE
from barmill.sources.files import with_identity


def landing_stream(
    spark: SparkSession,
    landing: str,
    max_bytes_per_batch: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Lines of new dumps with the symbol and snapshot of their file name.

    ``max_bytes_per_batch`` keeps a first run over a long history from being one single batch.
    ``archive`` is a folder that dumps are moved to after the batch they were taken in, so that
    the listing of the landing folder stays short however many have passed through it.
    """
    reader = spark.readStream.format("text").option("recursiveFileLookup", True)
    if max_bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    lines = with_identity(reader.load(landing))
    return lines.select(F.col("value").alias("line"), "symbol", "snapshot")


def ingest_landing(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    max_bytes_per_batch: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Append what has landed since the last run and return the whole table.

    The checkpoint knows the files already taken, and the file sink commits each batch once, so
    a run that dies is simply started again. A stateless append: no shuffle, nothing is kept
    between batches but the list of files. Dumps must be moved into place whole. Lines of a file
    whose name is not that of a dump have neither symbol nor snapshot; the load counts them.
    Before anything has landed the table is empty.
    """
    query = (
        landing_stream(spark, landing, max_bytes_per_batch, archive)
        .writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not exists(spark, table):
        return spark.createDataFrame([], DUMP_LINE)
    return spark.read.schema(DUMP_LINE).parquet(table)
