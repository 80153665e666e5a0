"""Bars built as ticks land, each final once.

A stream keeps the ticks of the bars that may still change as one state per bar. When the watermark, the
latest time seen less a delay, has passed the end of a bar, the bar is written and its state let go; ticks that
come for it later are late and change nothing. Everything is exactly once: a run that dies is started
again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barmill.functions.times import utc_instant, utc_time
from barmill.operators.bars import bar_aggregates
from barmill.plans.workspace import exists
from barmill.schema import BAR_OF_SYMBOL, FIELDS, SYMBOL

#: A single price as it lands.
TICK = T.StructType(
    [
        T.StructField(SYMBOL, T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("tick_id", T.LongType()),
    ]
)

# What the state of a bar holds, in the order of the aggregates; its own names repeat.
_STATE = (
    "struct<open:double, open_at:decimal(38,0), high:double, low:double, close:double, "
    "close_at:decimal(38,0), volume:bigint>"
)


def bar_stream(ticks: DataFrame, interval: str, delay: str) -> DataFrame:
    """Final bars of a stream of ticks; each task sends one state per bar it has ticks of.

    A tick without a time is of no bar. Watermarks want instants; times are taken as UTC, so that the
    session's zone plays no part.
    """
    timed = ticks.where(F.col("ts").isNotNull()).withColumn("_at", utc_instant(F.col("ts"))).withWatermark("_at", delay)
    grouped = timed.groupBy(F.window("_at", interval).alias("window"), SYMBOL)
    bars = grouped.agg(*bar_aggregates(ticks, "ts", "price", "tick_id"))
    return bars.withColumn("tstamp", utc_time(F.col("window.start"))).select(SYMBOL, *FIELDS)


def build_bars(
    spark: SparkSession,
    landing: str,
    home: str,
    interval: str = "5 minutes",
    delay: str = "10 minutes",
    most_files: int | None = None,
) -> DataFrame:
    """Take the ticks that have landed since the last run and return all final bars (R2).

    ``interval`` and ``delay`` must be the same in all runs. ``most_files`` bounds a batch; the watermark moves
    from batch to batch, so ticks are late only against batches before theirs. State is a row per open
    bar, spread over ``spark.sql.shuffle.partitions`` as it was at the first run. Tick files are Parquet
    and must be moved into place whole.
    """
    reader = spark.readStream.schema(TICK).option("recursiveFileLookup", True)
    if most_files:
        reader = reader.option("maxFilesPerTrigger", most_files)
    query = (
        bar_stream(reader.parquet(landing), interval, delay)
        .writeStream.format("parquet")
        .option("path", f"{home}/bars")
        .option("checkpointLocation", f"{home}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return final_bars(spark, home)


def final_bars(spark: SparkSession, home: str) -> DataFrame:
    """Bars that no tick will change any more."""
    if not exists(spark, f"{home}/bars"):
        return spark.createDataFrame([], BAR_OF_SYMBOL)
    return spark.read.schema(BAR_OF_SYMBOL).parquet(f"{home}/bars")


def open_bars(spark: SparkSession, home: str) -> DataFrame:
    """Bars as they stand of which the end has not been passed, read from the state of the last batch."""
    if not exists(spark, f"{home}/checkpoint/state"):
        return spark.createDataFrame([], BAR_OF_SYMBOL)
    state = spark.read.format("statestore").load(f"{home}/checkpoint")
    bars = state.select(utc_time(F.col("key.window.start")).alias("tstamp"), f"key.{SYMBOL}", F.col("value").cast(_STATE).alias("bar"))
    return bars.select(SYMBOL, "tstamp", "bar.*").select(SYMBOL, *FIELDS)


def late_ticks(ticks: DataFrame, bars: DataFrame, interval: str) -> DataFrame:
    """Bars that ticks came too late for, and how many: ``symbol``, ``tstamp``, ``n_late``.

    ``ticks`` are all that were taken, ``bars`` the final and the open ones. Every tick is in the volume of
    its bar or late, so the count is exact; both sides are summed up in each task before the one exchange.
    """
    timed = ticks.where(F.col("ts").isNotNull()).withColumn("at", F.window(utc_instant(F.col("ts")), interval))
    due = timed.select(SYMBOL, utc_time(F.col("at.start")).alias("tstamp"), F.lit(1).cast("bigint").alias("n"))
    counted = due.union(bars.select(SYMBOL, "tstamp", -F.col("volume")))
    late = counted.groupBy(SYMBOL, "tstamp").agg(F.sum("n").alias("n_late"))
    return late.where(F.col("n_late") > 0)
