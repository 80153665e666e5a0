"""Mean close per timestamp. All variants aggregate partially before their one exchange, so a
timestamp with any share of the rows arrives as one buffer per map task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmill.schema import SYMBOL


def exact_mean(value: str, precision: int, scale: int) -> Column:
    """Mean of a column of at most ``scale`` decimals, summed as decimals.

    Sums of doubles depend on the order of the rows, and with it on the partitioning; decimal
    sums do not. A value that is too large or has more decimals stops the job, whatever the
    session's settings: nothing is rounded, and what is counted has been summed.
    """
    checked = checked_decimal(value, precision, scale)
    return F.sum(checked).cast("double") / F.count(checked)


def checked_decimal(value: str, precision: int, scale: int) -> Column:
    """A column as a decimal; a value that is too large or has more decimals stops the job."""
    kind = f"decimal({precision},{scale})"
    number = F.col(value)
    whole = number.try_cast(kind)
    fits = number.isNull() | (whole.isNotNull() & (whole.cast("double") == number))
    message = F.concat(F.lit(f"no {kind}: "), number.cast("string"))
    return F.when(fits, whole).otherwise(F.raise_error(message).cast(kind))


def avg_close(
    bars: DataFrame, key: str = "tstamp", exact: tuple[int, int] | None = None
) -> DataFrame:
    """``(timestamp, avg_close)`` (A3, P10), and ``symbol`` before them where bars have one.

    NULL closes do not count; a timestamp that has only those is kept with a NULL mean. ``exact``
    gives the precision and scale that closes are summed in; without it they are summed as doubles.
    """
    mean = exact_mean("close", *exact) if exact else F.avg("close")
    symbol = [F.col(SYMBOL)] if SYMBOL in bars.columns else []
    return bars.groupBy(*symbol, F.col(key).alias("timestamp")).agg(mean.alias("avg_close"))


def mean_states(bars: DataFrame, exact: tuple[int, int], key: str = "tstamp") -> DataFrame:
    """What a mean is made of, per timestamp (and symbol): ``close_sum``, an exact decimal, and ``close_count``.

    States of different rows can be merged in any order and number (``merged_states``), which doubles could
    not without a difference in the last digits. A timestamp without any close has a count of 0.
    """
    closes = checked_decimal("close", *exact)
    symbol = [F.col(SYMBOL)] if SYMBOL in bars.columns else []
    total = F.sum(closes).cast(f"decimal(38,{exact[1]})")
    return bars.groupBy(*symbol, F.col(key).alias("timestamp")).agg(
        total.alias("close_sum"), F.count("close").alias("close_count")
    )


def merged_states(states: DataFrame) -> DataFrame:
    """One state per timestamp (and symbol) from several. A sum beyond 38 digits stops the job."""
    kind = states.schema["close_sum"].dataType
    keys = [c for c in states.columns if c in (SYMBOL, "timestamp")]
    total = F.sum("close_sum")
    lost = total.isNull() & (F.sum("close_count") > 0)
    fault = F.raise_error(F.lit("a sum of closes has more than 38 digits")).cast(kind)
    return states.groupBy(*keys).agg(
        F.when(lost, fault).otherwise(total).cast(kind).alias("close_sum"), F.sum("close_count").alias("close_count")
    )


def mean_of_states(states: DataFrame) -> DataFrame:
    """``(timestamp, avg_close)``, and ``symbol``, of merged states; NULL where there was no close."""
    keys = [c for c in states.columns if c in (SYMBOL, "timestamp")]
    mean = F.when(F.col("close_count") > 0, F.col("close_sum").cast("double") / F.col("close_count"))
    return states.select(*keys, mean.alias("avg_close"))


def with_close(bars: DataFrame) -> DataFrame:
    """Bars that have a close."""
    return bars.where(F.col("close").isNotNull())


def avg_close_present(
    bars: DataFrame, key: str = "tstamp", exact: tuple[int, int] | None = None
) -> DataFrame:
    """As ``avg_close``, but timestamps without any close are absent."""
    return avg_close(with_close(bars), key, exact)


def avg_close_float32(pairs: DataFrame, key: str = "tstamp") -> DataFrame:
    """32-bit mean of 32-bit closes, accumulated in 64 bits (A2)."""
    mean = F.avg(F.col("close").cast("float")).cast("float")
    return pairs.groupBy(key).agg(mean.alias("avg_close"))


def in_key_order(averages: DataFrame) -> DataFrame:
    """Global ascending order of the means (O1); their keys are unique."""
    return averages.orderBy("timestamp")
