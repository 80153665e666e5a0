"""Column names, types and text formats of price bars."""

from __future__ import annotations

from pyspark.sql import types as T

# Field order of a bar line, the header prefix, the timestamp text format
# and the name of a feed dump (a symbol, which may hold anything but a slash, and a time).
FIELDS = ["tstamp", "open", "high", "low", "close", "volume"]
HEADER_PREFIX = "timestamp"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
FEED_FILE = r"(?:^|/)stock_([^/]+_\d{8}_\d{6})\.csv(?:/|$)"
SNAPSHOT_LENGTH = len("yyyyMMdd_HHmmss")

_VALUES = [T.StructField(name, T.DoubleType()) for name in FIELDS[1:5]] + [
    T.StructField("volume", T.LongType())
]

#: A typed bar. The timestamp carries no zone, so no session zone can shift it.
BAR = T.StructType([T.StructField("tstamp", T.TimestampNTZType()), *_VALUES])

#: A bar whose timestamp is still text, as in the external tables.
BAR_TEXT_KEY = T.StructType([T.StructField("tstamp", T.StringType()), *_VALUES])

#: Mean close per timestamp.
AVERAGE = T.StructType(
    [T.StructField("timestamp", T.TimestampNTZType()), T.StructField("avg_close", T.DoubleType())]
)

#: Bars of several symbols.
SYMBOL = "symbol"
BAR_OF_SYMBOL = T.StructType([T.StructField(SYMBOL, T.StringType()), *BAR])

#: A line with the dump it came in.
DUMP_LINE = T.StructType([T.StructField(name, T.StringType()) for name in ("line", "symbol", "snapshot")])

DAY = "tstamp_date"
