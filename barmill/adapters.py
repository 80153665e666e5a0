"""The given tables in the shapes the operators work on.

Price dumps are not among the test data, so ``lineitem`` and ``events`` stand in for them: every
row becomes a bar, a raw line (whole or with a fault), a tick or a timing log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barmill.schema import TIMESTAMP_FORMAT


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed bar for every row of ``lineitem``; many share a timestamp, some have no volume."""
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("tstamp"),
        price.alias("open"),
        (price + F.col("l_tax")).alias("high"),
        (price - F.col("l_discount")).alias("low"),
        price.alias("close"),
        (F.col("l_quantity").cast("bigint") % 10).alias("volume"),
    )


def whole_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time and a close in whole numbers for every row of ``lineitem``; sums of such are exact."""
    close = F.col("l_quantity").alias("close")
    return table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").alias("tstamp"), close)


def bars_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bars`` with closes missing: all of them on every seventh day, and one in three else."""
    day = F.dayofyear("l_shipdate")
    dropped = (day % 7 == 0) | (F.col("l_linenumber") % 3 == 0)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("tstamp"),
        F.when(~dropped, F.col("l_extendedprice")).alias("close"),
    )


def _money(value: Column) -> Column:
    """Two decimals. Printed doubles differ between engines, decimals do not."""
    return value.cast("decimal(12,2)").cast("string")


def _line(tstamp: Column, price: Column, high: Column, low: Column, volume: Column, fault: Column) -> Column:
    """A raw line whose fault, if any, goes by a number from 0 to 10."""
    before = F.when(fault == 7, " ").when(fault == 8, "\t").otherwise("")
    close = F.when(fault == 4, "abc").when(fault == 5, "").otherwise(_money(price))
    padding = F.when(fault == 9, " ").otherwise("")
    count = F.when(fault == 2, "").otherwise(F.concat(F.lit(","), volume.cast("string")))
    after = F.when(fault == 3, ",x").when(fault == 6, ",").when(fault == 8, " ").otherwise("")
    head = F.concat_ws(",", tstamp, _money(price), _money(high), _money(low), F.lit(""))
    line = (
        F.when(fault == 0, "timestamp,open,high,low,close,volume")
        .when(fault == 1, "")
        .otherwise(F.concat(before, head, padding, close, count, after))
    )
    return line.alias("value")


def _as_scanned(lines: DataFrame) -> DataFrame:
    """Make the line a column as a text scan would.

    Without ``explode`` the optimizer puts the whole expression that makes up the line wherever
    an operator mentions the line.
    """
    others = [c for c in lines.columns if c != "value"]
    return lines.select(F.explode(F.array("value")).alias("value"), *others)


def _lineitem_line() -> Column:
    price = F.col("l_extendedprice")
    return _line(
        F.col("l_shipdate").cast("string"),
        price,
        price + F.col("l_tax"),
        price - F.col("l_discount"),
        F.col("l_quantity").cast("bigint") % 10,
        F.col("l_orderkey") % 11,
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw line for every row of ``lineitem``; hundreds share a day and no line has an hour."""
    return _as_scanned(table(spark, sf_dir, "lineitem").select(_lineitem_line()))


def symbol_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``intraday_bars`` with a symbol, the kind of event."""
    price = F.col("value")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        F.col("ts").alias("tstamp"),
        price.alias("open"),
        (price + 1).alias("high"),
        (price - 1).alias("low"),
        price.alias("close"),
        (F.col("user_id") % 10).alias("volume"),
    )


def intraday_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed bar for every row of ``events``: few days, many times of day."""
    return symbol_bars(spark, sf_dir).drop("symbol")


def intraday_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw line for every row of ``events``, its time cut to seconds."""
    price = F.col("value")
    tstamp = F.date_trunc("second", "ts").cast("timestamp_ntz").cast("string")
    line = _line(tstamp, price, price + 1, price - 1, F.col("user_id") % 10, F.col("event_id") % 11)
    return _as_scanned(table(spark, sf_dir, "events").select(line))


def mixed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of several kinds as text, for every row of ``lineitem``, and the ``part`` (0 to 2) it comes in.

    Some fields change their kind in the last part only.
    """
    line, late = F.col("l_linenumber"), F.col("l_orderkey") % 3 == 2
    time = F.date_format("l_shipdate", TIMESTAMP_FORMAT)
    whole, money = (F.col("l_quantity").cast("bigint") + 1).cast("string"), _money(F.col("l_extendedprice"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("key"),
        money.alias("price"),
        F.when(late & (line == 1), money).otherwise(whole).alias("quantity"),
        time.alias("tstamp"),
        F.when(late & (line == 2), "unknown").otherwise(time).alias("arrived"),
        F.when(line % 2 == 0, whole).alias("sometimes"),
        F.lit(None).cast("string").alias("never"),
        F.when(line == 3, time).otherwise(whole).alias("either"),
        (F.col("l_orderkey") % 3).alias("part"),
    )


#: Symbols and snapshots of the dumps. Some symbols are encoded in a path, one looks like two.
SYMBOLS = ("BRK_B", "^GSPC", "A+ B%")
SNAPSHOTS = ("20250901_040000", "20250902_040000", "20250903_040000")


def _one_of(values: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


def feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_lines`` with the symbol and the snapshot of the dump they come in.

    Three symbols and three snapshots, so that the dumps overlap in almost every timestamp.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        _lineitem_line(),
        _one_of(SYMBOLS, F.col("l_orderkey")).alias("symbol"),
        _one_of(SNAPSHOTS, F.col("l_linenumber")).alias("snapshot"),
    )
    return _as_scanned(lines)


def intraday_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw line for every row of ``events``, its time cut to minutes, with symbol and snapshot.

    All symbols have bars at the same times, and dumps of one symbol overlap.
    """
    price = F.col("value")
    tstamp = F.date_trunc("minute", "ts").cast("timestamp_ntz").cast("string")
    line = _line(tstamp, price, price + 1, price - 1, F.col("user_id") % 10, F.col("event_id") % 11)
    lines = table(spark, sf_dir, "events").select(
        line,
        _one_of(SYMBOLS, F.col("user_id")).alias("symbol"),
        _one_of(SNAPSHOTS, F.col("event_id")).alias("snapshot"),
    )
    return _as_scanned(lines)


def write_dumps(lines: DataFrame, folder: str, snapshots: tuple[str, ...] = SNAPSHOTS) -> None:
    """Lines as dumps of their symbols, each under the name that a dump has."""
    for symbol in SYMBOLS:
        for snapshot in snapshots:
            one = lines.where((F.col("symbol") == symbol) & (F.col("snapshot") == snapshot))
            one.select("value").write.text(f"{folder}/stock_{symbol}_{snapshot}.csv")


def timestamp_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as text: most in the bar format, some not, some no dates at all."""
    text = F.date_format("o_orderdate", TIMESTAMP_FORMAT)
    fault = F.col("o_orderkey") % 7
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(fault == 0, "unknown")
        .when(fault == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(fault == 2, F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-02-30 00:00:00")))
        .when(fault == 3, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(text)
        .alias("tstamp"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tick for every event; the kind of event is the symbol."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        "ts",
        F.col("value").alias("price"),
        F.col("event_id").alias("tick_id"),
    )


def ticks_in_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ticks`` with the ``landing``, 0 to 2, they come in: ten days each, but for some that come later.

    Of the first ten days one in 97 comes with the last, far too late, and of the last hour before the
    third part one in five, which is still in time.
    """
    ts, tick = F.col("ts"), F.col("tick_id")

    def until(text: str) -> Column:
        return ts < F.lit(text).cast("timestamp_ntz")

    landing = (
        F.when(until("2024-01-11"), F.when(tick % 97 == 0, 2).otherwise(0))
        .when(until("2024-01-21") & ~until("2024-01-20 23:00:00") & (tick % 5 == 0), 2)
        .when(until("2024-01-21"), 1)
        .otherwise(2)
    )
    return ticks(spark, sf_dir).withColumn("landing", landing)


def timing_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of a pair of timing logs for every event, some without a timing, some absent."""
    event = F.col("event_id")
    before = F.col("value").cast("decimal(12,3)").cast("string")
    after = (F.col("user_id") % 400 + F.col("value")).cast("decimal(12,3)").cast("string")

    def text(ms: Column) -> Column:
        plan = F.lit("Seq Scan on bars\nPlanning Time: 0.071 ms\nExecution Time: ")
        return F.concat(plan, ms, F.lit(" ms\nExecution Time: 1.000 ms"))

    return table(spark, sf_dir, "events").select(
        event.alias("run"),
        F.when(event % 7 == 0, "connection refused").otherwise(text(before)).alias("before_log"),
        F.when(event % 11 == 0, None)
        .when(event % 13 == 0, text(F.lit("0")))
        .when(event % 17 == 0, text(F.lit("1.2.3")))
        .otherwise(text(after))
        .alias("after_log"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of two logs for every kind of event, which is the run; a line or more per event.

    All timings of a log are the same, so the first does not depend on the order of the lines.
    Clicks have no second log, and the first log of signups has no timing.
    """
    kind = F.col("event_type")
    before, after = F.length(kind) * 1.5, F.length(kind) * 0.5
    plan = F.concat(F.lit("Index Scan, row "), F.col("event_id").cast("string"))

    def text(name: str, ms: Column, timed: Column):
        timing = F.concat(F.lit("Execution Time: "), ms.cast("string"), F.lit(" ms"))
        shown = timed & (F.col("event_id") % 3 == 0)
        return F.struct(F.lit(name).alias("log"), F.concat_ws("\n", plan, F.when(shown, timing)).alias("line"))

    pair = F.array(
        text("before.log", before, kind != "signup"),
        text("after.log", after, F.lit(True)),
    )
    events = table(spark, sf_dir, "events").select(kind.alias("run"), F.inline(pair))
    return events.where((F.col("run") != "click") | (F.col("log") == "before.log"))
