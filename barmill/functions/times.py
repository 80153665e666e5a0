"""Column expressions over bar timestamps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmill.schema import DAY

# Fixed value: the shape of a text in TIMESTAMP_FORMAT.
_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def parse_timestamp(text: Column) -> Column:
    """Text in the bar format to a timestamp without zone; anything else gives NULL.

    The shape check and the cast together accept what the pattern accepts. A pattern parse would
    go through the session zone and lose the hour that a change to summer time skips.
    """
    return F.when(text.rlike(_SHAPE), text.try_cast("timestamp_ntz"))


def retype_timestamp(bars: DataFrame, column: str = "tstamp") -> DataFrame:
    """Change a text column to a timestamp; a text that is none stops the job in any session."""
    text = F.col(column)
    parsed = text.try_cast("timestamp_ntz")
    message = F.concat(F.lit("not a timestamp: "), text.cast("string"))
    fault = F.raise_error(message).cast("timestamp_ntz")
    return bars.withColumn(column, F.when(text.isNotNull() & parsed.isNull(), fault).otherwise(parsed))


def with_day(bars: DataFrame, column: str = "tstamp") -> DataFrame:
    """Add the day of the bar, the column tables are partitioned by."""
    return bars.withColumn(DAY, F.to_date(column))


def micros_of(time: Column) -> Column:
    """Microseconds from 1970 to a timestamp without zone. ``timestampdiff`` would go through the session's zone
    and put an hour that summer time skips after the next one."""
    plain = time.cast("timestamp_ntz")
    day = F.unix_date(plain.cast("date")).cast("bigint")
    seconds = F.extract(F.lit("SECOND"), plain) * F.lit(1_000_000)  # a decimal, with its fraction
    minutes = day * 1440 + F.hour(plain) * 60 + F.minute(plain)
    return minutes * F.lit(60_000_000) + seconds.cast("bigint")


def utc_instant(time: Column) -> Column:
    """A timestamp without zone as the instant it is in UTC, whatever the session's zone."""
    return F.timestamp_micros(micros_of(time))


def utc_time(instant: Column) -> Column:
    """The timestamp without zone that an instant is in UTC, whatever the session's zone."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def moment(value: str | datetime) -> Column:
    """Timestamp literal without zone; a value that has one is refused, since bars have none."""
    if isinstance(value, datetime) and value.tzinfo is not None:
        raise ValueError(f"{value!r} has a time zone")
    text = value.isoformat(" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def time_range(
    bars: DataFrame,
    after: str | datetime | None = None,
    before: str | datetime | None = None,
    column: str = "tstamp",
) -> DataFrame:
    """Bars strictly later than ``after`` and strictly earlier than ``before`` (F8).

    Where the table has a day column the same bounds are put on the day too, since Spark prunes
    partitions only by predicates that name the partition column.
    """
    by_day = DAY in bars.columns
    kept = bars
    if after is not None:
        kept = kept.where(F.col(column) > moment(after))
        if by_day:
            kept = kept.where(F.col(DAY) >= F.to_date(moment(after)))
    if before is not None:
        kept = kept.where(F.col(column) < moment(before))
        if by_day:
            kept = kept.where(F.col(DAY) <= F.to_date(moment(before)))
    return kept
