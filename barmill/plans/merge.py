"""Loading only what is new: lines merged into the days they touch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barmill.functions.times import with_day
from barmill.operators.bars import traded, typed_bars
from barmill.operators.strict import newest_snapshot, strict_counters
from barmill.plans.exchange import exchange_days, finish, rows_of_days
from barmill.plans.layout import by_day
from barmill.plans.load import newest_lines
from barmill.plans.workspace import remove, work_dir
from barmill.schema import BAR, DAY, FIELDS, SYMBOL

_TEXTS = [T.StructField(name, T.StringType()) for name in (SYMBOL, "key", "snapshot", "line")]

#: The newest line of each symbol and key, with its snapshot and its fields; all lines are kept, also those
#: without volume, since a later snapshot may only be told from an earlier one by what was seen of it.
HISTORY = T.StructType([*_TEXTS, *BAR, T.StructField(DAY, T.DateType())])


def create_history(spark: SparkSession, table: str, path: str) -> None:
    """An empty history at a path, unless the table is there."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({HISTORY.toDDL()}) USING parquet "
        f"PARTITIONED BY ({DAY}) LOCATION '{path}'"
    )


def new_rows(lines: DataFrame, column: str = "value", strict_timestamps: bool = False) -> DataFrame:
    """Raw lines with symbol and snapshot as rows of a history, one per symbol and key."""
    newest = newest_lines(lines, column).withColumn("_line", F.col("line"))
    return with_day(typed_bars(newest, "_line", strict_timestamps)).select(*HISTORY.names)


def merged_days(spark: SparkSession, table: str, rows: DataFrame) -> DataFrame:
    """The days that ``rows`` touch as they are with them: per symbol and key the newest snapshot.

    Of the table only these days are read. Old and new rows of a key are of the same day, since the
    key is the text that the day is taken from. The order among rows of one key is that of a load of
    all lines at once, so the order of the loads does not matter.
    """
    old = rows_of_days(spark, table, rows.select(DAY))
    return newest_snapshot(old.select(*HISTORY.names).union(rows.select(*HISTORY.names)), [SYMBOL, "key"])


def merge_lines(
    lines: DataFrame,
    table: str,
    path: str,
    column: str = "value",
    strict_timestamps: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Merge new raw lines (with ``symbol`` and ``snapshot``) into a history table.

    The lines are parsed once, their days found, the old rows of those days united with them, and
    the days exchanged as wholes; the cost goes with the days touched and not with the history. Loads
    in any order, repeated or stopped anywhere and run again, leave the table that one load of all
    lines would. Returns one row: how many ``lines``, ``headers``, ``malformed`` and ``unnamed`` there were, and
    the ``days`` and ``keys`` they touched.
    """
    spark = lines.sparkSession
    create_history(spark, table, path)
    finish(spark, table)
    counted = Observation("merge")
    observed = lines.observe(counted, *strict_counters(F.col(column), True))
    staged = work_dir(spark, "merge")
    new_rows(observed, column, strict_timestamps).write.parquet(staged)
    rows = spark.read.schema(HISTORY).parquet(staged)
    touched = rows.agg(F.count(F.lit(1)).alias("keys"), F.count_distinct(F.coalesce(DAY, F.lit("0001-01-01").cast("date"))).alias("days")).first()
    if touched["keys"]:
        exchange_days(by_day(merged_days(spark, table, rows), partitions), table)
    remove(spark, staged)
    found = {**counted.get, "days": touched["days"], "keys": touched["keys"]}
    return spark.range(1).select(*(F.lit(n).cast("bigint").alias(name) for name, n in found.items()))


def history_bars(spark: SparkSession, table: str) -> DataFrame:
    """The traded bars of a history, with their day, by which a time range is pruned."""
    return traded(spark.table(table)).select(SYMBOL, *FIELDS, DAY)
