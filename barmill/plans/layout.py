"""Warehouse layout by day, statistics, compaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barmill.functions.times import with_day
from barmill.plans.exchange import exchange_days, finish, rows_of_days, table_files
from barmill.schema import DAY


def by_day(bars: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows of one day together, sorted by time, in partitions of about the advisory size.

    ``rebalance`` is one hash exchange and, unlike a range partitioning, reads its input once.
    Adaptive execution merges small days and splits a day that is too large for one task, so a
    day with a third of the rows becomes many files and not one long task. It sees that whatever
    the number of partitions, since the session keeps the true size of large blocks. The local sort
    gives every file and row group a narrow time range. ``partitions`` is the number of partitions
    before merging, by default that of all shuffles.
    """
    dated = bars if DAY in bars.columns else with_day(bars)
    spread = dated.hint("rebalance", *([partitions] if partitions else []), DAY)
    return spread.sortWithinPartitions(DAY, "tstamp")


def write_warehouse(
    bars: DataFrame,
    path: str,
    table: str | None = None,
    volume_lookup: int | None = None,
    days_only: bool = False,
    partitions: int | None = None,
) -> None:
    """Write the warehouse table of ``bars``, partitioned by day.

    Replaces the whole table, or with ``days_only`` just the days that ``bars`` has, which must
    then be complete. ``volume_lookup`` is the expected number of distinct volumes per file; given
    it, the files carry a bloom filter for equality lookups on the volume.
    """
    writer = by_day(bars, partitions).write.mode("overwrite").format("parquet")
    # Set either way, so that it does not depend on the session which days are replaced.
    writer = writer.option("partitionOverwriteMode", "dynamic" if days_only else "static")
    if volume_lookup:
        writer = writer.option("parquet.bloom.filter.enabled#volume", "true").option(
            "parquet.bloom.filter.expected.ndv#volume", str(volume_lookup)
        )
    spark = bars.sparkSession
    writer = writer.partitionBy(DAY)
    if table and not (days_only and spark.catalog.tableExists(table)):
        writer.option("path", path).saveAsTable(table)
        return
    writer.save(path)
    if table:  # the catalog learns of new days
        spark.catalog.recoverPartitions(table)
        spark.catalog.refreshTable(table)


def refresh_stats(spark: SparkSession, table: str, columns: list[str] | None = None) -> DataFrame:
    """Bring the planner's statistics of a table up to date and return the row count.

    Takes in all columns unless some are named; only those are read.
    """
    which = f"COLUMNS {', '.join(columns)}" if columns else "ALL COLUMNS"
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR {which}")
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Statistics'")
    rows = F.regexp_extract("data_type", r"(\d+) rows", 1).cast("bigint")
    return detail.select(rows.alias("n_rows"))


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """A row per data file below a path, with its size and its day if the path is laid out by day.

    Lists files only; a filter on the day is a partition filter, so other days are not listed twice.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.drop("content", "modificationTime")


def days_of_small_files(spark: SparkSession, table: str, small: int) -> DataFrame:
    """Days that have more than one file, and files of less than ``small`` bytes on average."""
    files = table_files(spark, table).where("current")
    sizes = files.groupBy(DAY).agg(F.count(F.lit(1)).alias("files"), F.avg("length").alias("size"))
    return sizes.where((F.col("files") > 1) & (F.col("size") < small)).select(DAY)


def compacted_days(spark: SparkSession, table: str, small: int) -> DataFrame:
    """Rows of the days of small files, laid out anew; no other day is read, and each goes through
    one exchange."""
    return by_day(rows_of_days(spark, table, days_of_small_files(spark, table, small)))


def compact(spark: SparkSession, table: str, small: int = 64 << 20) -> DataFrame:
    """Rewrite the days of a day-partitioned table that have small files, and only those.

    They are exchanged one by one (``exchange.exchange_days``): readers see every day as it was or as it is
    then, and a run that stops anywhere is made good by the next one. What is out of use stays until
    ``exchange.vacuum``. Returns the row count of the refreshed statistics.
    """
    finish(spark, table)
    if not days_of_small_files(spark, table, small).isEmpty():
        exchange_days(compacted_days(spark, table, small), table)
    return refresh_stats(spark, table, ["tstamp", "volume"])
