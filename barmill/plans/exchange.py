"""Days of a warehouse table exchanged as wholes, and folders that are out of use removed.

Readers go by the table's name, so what they see of a day is the folder that the catalog names for
it. New rows of a day are written to a folder of their own, below ``_days`` in the table's place,
and the catalog is switched to it when they are whole. Nothing that a reader may have open is
written over or removed, until ``vacuum`` takes what has been out of use for long enough.

One writer at a time; any number of readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barmill.plans.workspace import exists, folders, make_folder, remove
from barmill.schema import DAY

VERSIONS = "_days"
#: Marks of a version: its files are all there; the catalog names all its days.
WHOLE, DONE = "_whole", "_done"
# Fixed value: the folder name of days that are NULL.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
WEEK = 7 * 24 * 3600


def location(spark: SparkSession, table: str) -> str:
    """Where the table lies. One row of the catalog."""
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    return row["data_type"]


def _versions(spark: SparkSession, home: str) -> list[str]:
    """Names of the versions, oldest first: one for each exchange since the last vacuum."""
    return sorted(n for n in folders(spark, f"{home}/{VERSIONS}") if n.isdigit())


def rows_of_days(spark: SparkSession, table: str, days: DataFrame) -> DataFrame:
    """Rows of the table on the days of ``days``; folders of other days are not read.

    The days are broadcast: there are no more than dates in the calendar. A comparison that all
    dates pass makes Spark prune by them, which it does for sides with a filter only. Days that are
    NULL would not survive an equality; they are asked for by themselves, if there are any.
    """
    rows = spark.table(table)
    dates = days.select(DAY).where(F.col(DAY) >= F.lit("0001-01-01").cast("date")).distinct()
    dated = rows.join(F.broadcast(dates), DAY, "left_semi").select(*rows.columns)
    if days.where(F.col(DAY).isNull()).isEmpty():
        return dated
    return dated.union(rows.where(F.col(DAY).isNull()))


def stage_days(rows: DataFrame, table: str) -> str:
    """Write a new version of the days in ``rows`` (laid out by day) and return its folder."""
    spark = rows.sparkSession
    home = location(spark, table)
    number = max([int(n) for n in _versions(spark, home)], default=0) + 1
    folder = f"{home}/{VERSIONS}/{number:010d}"
    stored = [c for c in spark.table(table).columns if c != DAY]
    rows.select(*stored, DAY).write.partitionBy(DAY).parquet(folder)
    return folder


def mark_whole(spark: SparkSession, folder: str) -> None:
    """From now on the exchange will be finished, if not by this run then by the next."""
    make_folder(spark, f"{folder}/{WHOLE}")


def _place(folder: str, name: str) -> tuple[str, str]:
    """A day as a partition and its folder as a location, in SQL."""
    day = name.removeprefix(f"{DAY}=")
    which = f"{DAY} = null" if day == NO_DAY else f"{DAY} = '{day}'"
    path = f"{folder}/{name}".replace("\\", "\\\\").replace("'", "\\'")
    return f"PARTITION ({which})", f"LOCATION '{path}'"


def switch_day(spark: SparkSession, table: str, folder: str, name: str) -> None:
    """Make the catalog name ``folder``/``name`` for that day; readers see it from then on."""
    which, place = _place(folder, name)
    spark.sql(f"ALTER TABLE {table} {which} SET {place}")


def switch_days(spark: SparkSession, table: str, folder: str) -> None:
    """Switch all days of a whole version: those the table did not have at once, the others one after the other."""
    names = [name for name in folders(spark, folder) if name.startswith(f"{DAY}=")]
    # Names of days, of which there are few.
    known = {row["partition"] for row in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator()}
    added = [" ".join(_place(folder, name)) for name in names if name not in known]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(added)}")
    for name in names:
        if name in known:
            switch_day(spark, table, folder, name)
    make_folder(spark, f"{folder}/{DONE}")


def finish(spark: SparkSession, table: str) -> None:
    """Switch the days of a version that a stopped run has left whole."""
    home = location(spark, table)
    for name in _versions(spark, home):
        folder = f"{home}/{VERSIONS}/{name}"
        if exists(spark, f"{folder}/{WHOLE}") and not exists(spark, f"{folder}/{DONE}"):
            switch_days(spark, table, folder)


def exchange_days(rows: DataFrame, table: str) -> None:
    """Put ``rows``, which have a ``DAY`` and all rows of their days, in the place of these days.

    Stopped before the mark, the table is as it was and the new folder is left to ``vacuum``; after it,
    each day is old or new, and the next exchange, compaction or vacuum, or ``finish``, switches the
    rest. Repeated runs give the same table. ``rows`` may come from the table itself.
    """
    spark = rows.sparkSession
    finish(spark, table)
    folder = stage_days(rows, table)
    mark_whole(spark, folder)
    switch_days(spark, table, folder)


def table_files(spark: SparkSession, table: str) -> DataFrame:
    """A row per data file below the table's place, opened by none: ``path``, ``length``, ``modificationTime``,
    ``folder``, ``tstamp_date`` (NULL where it is), ``version`` (0: of no exchange) and whether it is ``current``.

    Of a day the last whole version is current. Call ``finish`` first.
    """
    home = location(spark, table)
    whole = [int(n) for n in _versions(spark, home) if exists(spark, f"{home}/{VERSIONS}/{n}/{WHOLE}")]
    places = [home, f"{home}/{VERSIONS}"] if exists(spark, f"{home}/{VERSIONS}") else [home]
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    files = reader.option("recursiveFileLookup", True).load(places).drop("content")
    version = F.regexp_extract("path", rf"/{VERSIONS}/(\d+)/{DAY}=[^/]+/[^/]+$", 1)
    day = F.regexp_extract("path", rf"{DAY}=([^/]+)/[^/]+$", 1)
    named = files.select(
        "*",
        F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("folder"),
        F.when(day != NO_DAY, day).cast("date").alias(DAY),
        F.when(version == "", "0").otherwise(version).cast("int").alias("version"),
    )
    usable = F.col("version").isin([0, *whole])
    last = F.max(F.when(usable, F.col("version"))).over(Window.partitionBy(DAY))
    return named.withColumn("current", F.coalesce(usable & (F.col("version") == last), F.lit(False)))


def vacuum(spark: SparkSession, table: str, keep_seconds: int = WEEK) -> None:
    """Remove folders of days that no reader can come to any more.

    These are the folders that the catalog does not name and that nothing was written to for
    ``keep_seconds``, which must be more than the longest query or load takes. The rows of the table
    are the same before and after, and a run that stops is made good by the next.
    """
    finish(spark, table)
    home = location(spark, table)
    written = F.max("modificationTime") < F.current_timestamp() - F.make_dt_interval(secs=F.lit(keep_seconds))
    unused = table_files(spark, table).where("NOT current").groupBy("folder").agg(written.alias("old"))
    # One folder of one day at a time; files are not listed on the driver.
    for row in unused.where("old").select("folder").toLocalIterator():
        remove(spark, row["folder"])
    for name in _versions(spark, home)[:-1]:  # the last one keeps the count
        folder = f"{home}/{VERSIONS}/{name}"
        if exists(spark, f"{folder}/{DONE}") and not any(n.startswith(DAY) for n in folders(spark, folder)):
            remove(spark, folder)
