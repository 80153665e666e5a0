"""Strict cleaning of raw lines: header out, exactly six fields, one line per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmill.functions.text import drop_trailing_commas, fields_of, first_field
from barmill.schema import FIELDS, HEADER_PREFIX


def clean_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines of six fields as ``(key, line)`` plus the other input columns.

    The header test looks at the untrimmed line wherever it stands in the file. The key is the
    first field as it is, blanks included. Everything here is a filter and a projection: no
    shuffle, and nothing else than the line is read.
    """
    line = F.col(column)
    kept = lines.where(~line.startswith(HEADER_PREFIX)).where(F.size(fields_of(line)) == len(FIELDS))
    others = [c for c in lines.columns if c != column]
    return kept.select(first_field(line).alias("key"), drop_trailing_commas(line).alias("line"), *others)


def strict_counters(line: Column, identity: bool = False) -> list[Column]:
    """How many lines there are, and how many fall out for which reason."""
    header = line.startswith(HEADER_PREFIX)
    whole = F.size(fields_of(line)) == len(FIELDS)
    named = F.col("snapshot").isNotNull() & F.col("symbol").isNotNull() if identity else F.lit(True)
    return [
        F.count(F.lit(1)).alias("lines"),
        F.count_if(header).alias("headers"),
        F.count_if(~header & ~whole).alias("malformed"),
        F.count_if(~header & whole & ~named).alias("unnamed"),
    ]


def first_per_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the least by all remaining columns in turn (A1).

    The order is total, so that reruns and other partitionings pick the same row; rows that still
    tie are copies of one another.

    The least row is an aggregate, found in part before the exchange: a key with any share of the
    input arrives as one row per map task. Unlike a window it sorts by the key alone. Text keys
    are led by their hash, since texts that all begin with the same year are slow to sort.
    """
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    text = [c for c, kind in rows.dtypes if c in keys and kind == "string"]
    lead = [F.xxhash64(*text).alias("_hash")] if text else []
    least = rows.groupBy(*lead, *keys).agg(F.min(F.struct(*rest)).alias("_least"))
    return least.select(*keys, "_least.*").select(*rows.columns)


def newest_snapshot(rows: DataFrame, keys: list[str], snapshot: str = "snapshot") -> DataFrame:
    """One row per key across overlapping snapshots, from the newest; then as ``first_per_key``.

    Spark limits each task's rows to one per key before the exchange (WindowGroupLimit). Text keys
    are led by their hash, as there. A row without a snapshot stops the job: it cannot be ranked.
    """
    text = [c for c, kind in rows.dtypes if c in keys and kind == "string"]
    lead = [F.xxhash64(*text)] if text else []
    missing = F.raise_error(F.lit("a row has no snapshot")).cast(rows.schema[snapshot].dataType)
    rows = rows.withColumn(snapshot, F.coalesce(snapshot, missing))
    rest = [F.col(c) for c in rows.columns if c not in (*keys, snapshot)]
    window = Window.partitionBy(*lead, *keys).orderBy(F.col(snapshot).desc(), *rest)
    return rows.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def sorted_lines(cleaned: DataFrame) -> DataFrame:
    """Cleaned lines in bytewise key order (O3). Keys are unique after ``first_per_key``."""
    return cleaned.orderBy("key").select("line")
