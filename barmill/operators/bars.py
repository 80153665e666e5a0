"""Typed bars: parsing from lines, the volume filter, the load order, counts, bar building."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmill.functions.times import micros_of, parse_timestamp
from barmill.schema import BAR, FIELDS


def typed_bars(
    cleaned: DataFrame, column: str = "line", strict_timestamps: bool = False
) -> DataFrame:
    """Cleaned lines as typed bars, by the rules of the permissive CSV scan.

    A field that does not parse is NULL and its row is kept; ``strict_timestamps`` stops the job
    at a timestamp that does not. Same parser as reading the lines
    back from files, without having to write them first. ``inline`` keeps later filters above the
    parser; pushed below it they would parse every line a second time.
    """
    others = [c for c in cleaned.columns if c != column]
    parsed = F.from_csv(F.col(column), BAR.toDDL(), {"sep": ","})
    if strict_timestamps:
        message = F.concat(F.lit("no timestamp: "), F.col(column))
        fault = F.raise_error(message).cast("timestamp_ntz")
        parsed = parsed.withField("tstamp", F.coalesce(parsed["tstamp"], fault))
    return cleaned.select(*others, F.inline(F.array(parsed))).select(*FIELDS, *others)


def parse_tstamp(bars: DataFrame) -> DataFrame:
    """Bars with a text timestamp, parsed by the bar format."""
    return bars.withColumn("tstamp", parse_timestamp(F.col("tstamp")))


def traded(bars: DataFrame) -> DataFrame:
    """Bars with a positive volume; NULL volumes go too."""
    return bars.where(F.col("volume") > 0)


def in_time_order(bars: DataFrame, column: str = "tstamp", partitions: int | None = None) -> DataFrame:
    """Global ascending order by time, NULL first (O2).

    A plain sort by time sends all rows of one timestamp to one task. Here the ranges are cut
    over the time, then a hash of the row, then the map partition, so that a timestamp with a
    third of the rows, or a third of the rows being copies of one, is still spread. All three
    are the same when a lost task is rerun. The rows of one timestamp stay in adjacent
    partitions, hence the order over all partitions is the one asked for.

    ``partitions`` is the number of ranges, by default that of all shuffles. Adaptive execution
    does not split a range, so give enough that one fits a task.
    """
    others = [c for c in bars.columns if c != column]
    salted = bars.select(
        "*", F.xxhash64(*(others or [column])).alias("_row"), F.spark_partition_id().alias("_task")
    )
    keys = [column, "_row", "_task"]
    ranged = salted.repartitionByRange(*([partitions] if partitions else []), *keys)
    return ranged.sortWithinPartitions(F.col(column).asc_nulls_first()).drop("_row", "_task")


def row_count(rows: DataFrame) -> DataFrame:
    """Number of rows."""
    return rows.agg(F.count(F.lit(1)).alias("n_rows"))


_WHOLE = {"tinyint", "smallint", "int", "bigint"}


def _packed(time: str, tie_break: str) -> Column:
    """Microseconds, then the tie-break moved above zero, as one number in the same order; a tie-break
    that is missing comes first."""
    high = micros_of(F.col(time)).cast("decimal(19,0)") * F.lit(str(2**64)).cast("decimal(20,0)")
    low = F.col(tie_break).cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")
    return (high + F.coalesce(low, F.lit(0).cast("decimal(20,0)"))).cast("decimal(38,0)")


def interval_bars(
    ticks: DataFrame,
    interval: str = "5 minutes",
    symbol: str = "symbol",
    time: str = "ts",
    price: str = "price",
    tie_break: str = "tick_id",
) -> DataFrame:
    """Bars of a given interval from single prices (R2).

    Open and close are the prices at the least and greatest ``(time, tie_break)``, volume is the
    number of ticks. Each task sends one buffer per symbol and interval. A tie-break of whole
    numbers is packed with the time into one number, which a hash aggregate can keep; others make
    a struct, for which ticks are sorted first.
    """
    started = ticks.withColumn("tstamp", F.window(time, interval).start)
    grouped = started.groupBy("tstamp", F.col(symbol).alias("symbol"))
    return grouped.agg(*bar_aggregates(ticks, time, price, tie_break)).select("symbol", *FIELDS)


def bar_aggregates(ticks: DataFrame, time: str, price: str, tie_break: str) -> list[Column]:
    """What makes a bar of the ticks of a group, in the order of ``FIELDS``."""
    moment = _packed(time, tie_break) if dict(ticks.dtypes)[tie_break] in _WHOLE else F.struct(time, tie_break)
    value = F.col(price)
    return [
        F.min_by(value, moment).alias("open"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.max_by(value, moment).alias("close"),
        F.count(F.lit(1)).alias("volume"),
    ]
