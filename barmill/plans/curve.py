"""A layout that serves filters on time, volume and symbol alike, and zones to choose its folders by.

Days serve filters on time alone. Here each row gets the place of its time, volume and symbol on a
Z-order curve: their ranks' bits interleaved, the highest first. A folder is a stretch of the curve, a
cell, so it is narrow in all three. What each file holds is kept in a table of zones, and a scan takes
the folders whose zones can meet its filter, before any file is opened.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barmill.functions.times import moment, time_range
from barmill.schema import SYMBOL

CELL = "cell"
#: Bits of a rank, so 2**BITS quantiles of each column are told apart.
BITS = 6
#: Leading bits of the curve that make a cell; at most 2**CELL_BITS folders.
CELL_BITS = 6


def quantiles(bars: DataFrame, columns: list[str], bits: int = BITS) -> list[list]:
    """Cuts that part each column into 2**bits shares of rows. One aggregate; as many numbers reach the driver."""
    shares = [(n + 1) / 2**bits for n in range(2**bits - 1)]
    row = bars.agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in columns]).first()
    return [list(row[c] or []) for c in columns]


def rank(value: Column, cuts: list) -> Column:
    """How many of the ascending cuts are no greater than the value; 0 for NULL.

    A search by halves in generated code. Values that many rows share are several cuts, so that rows
    are spread over all ranks however the values are.
    """
    if not cuts:
        return F.lit(0)
    distinct = sorted(set(cuts))
    below = {c: sum(1 for d in cuts if d <= c) for c in distinct}

    def between(lo: int, hi: int) -> Column:  # the answer is one of those before distinct[lo] to distinct[hi - 1]
        if lo == hi:
            return F.lit(below[distinct[lo - 1]] if lo else 0)
        middle = (lo + hi) // 2
        at_least = value >= F.lit(distinct[middle])
        return F.when(at_least, between(middle + 1, hi)).otherwise(between(lo, middle))

    return between(0, len(distinct))


def interleaved(ranks: list[Column], bits: int = BITS) -> Column:
    """Place on the Z-order curve: the highest bits of all ranks first."""
    code = F.lit(0).cast("bigint")
    for bit in range(bits):
        for n, value in enumerate(ranks):
            place = (bits - 1 - bit) * len(ranks) + len(ranks) - 1 - n
            one = F.shiftright(value.cast("bigint"), bits - 1 - bit).bitwiseAND(F.lit(1))
            code = code.bitwiseOR(F.shiftleft(one, place))
    return code


def on_curve(bars: DataFrame, cell_bits: int = CELL_BITS, partitions: int | None = None) -> DataFrame:
    """Bars with their ``cell``, the rows of a cell together and sorted along the curve.

    The cuts are found in one aggregate, then the rows go through one exchange, which adaptive
    execution merges and splits as for days: a cell with most of the rows becomes several files.
    """
    time_cuts, volume_cuts = quantiles(bars, ["tstamp", "volume"])
    ranks = [rank(F.col("tstamp"), time_cuts), rank(F.col("volume"), volume_cuts)]
    if SYMBOL in bars.columns:
        ranks.append(F.pmod(F.xxhash64(SYMBOL), F.lit(2**BITS)).cast("int"))
    names = [f"_rank{n}" for n in range(len(ranks))]
    # ``inline`` keeps a rank from being looked up anew for each of its bits.
    ranked = bars.select("*", F.inline(F.array(F.struct(*(r.alias(n) for r, n in zip(ranks, names))))))
    coded = ranked.withColumn("_code", interleaved([F.col(n) for n in names])).drop(*names)
    cell = F.shiftright("_code", BITS * len(ranks) - cell_bits).cast("int")
    spread = coded.withColumn(CELL, cell).hint("rebalance", *([partitions] if partitions else []), CELL)
    return spread.sortWithinPartitions(CELL, "_code", "tstamp").drop("_code")


def write_curve(bars: DataFrame, path: str, cell_bits: int = CELL_BITS, partitions: int | None = None) -> None:
    """Write bars by cells of the curve, replacing what was there."""
    writer = on_curve(bars, cell_bits, partitions).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "static").partitionBy(CELL).parquet(path)


def zones(rows: DataFrame, by: str) -> DataFrame:
    """What each file of a table in folders by ``by`` holds: least and greatest time and volume, and its rows.

    One aggregate over the name of the file, of which each task sends a row for each file it reads.
    """
    return rows.groupBy(by, F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("tstamp").alias("least_time"),
        F.max("tstamp").alias("greatest_time"),
        F.min("volume").alias("least_volume"),
        F.max("volume").alias("greatest_volume"),
    )


def write_zones(spark: SparkSession, path: str, by: str, zone_path: str) -> None:
    """Write the zones of the table at ``path``; after each change of it."""
    zones(spark.read.parquet(path), by).coalesce(1).write.mode("overwrite").parquet(zone_path)


def meets(
    after: str | datetime | None = None,
    before: str | datetime | None = None,
    volumes: tuple[int, int] | None = None,
) -> Column:
    """Whether a zone can have rows later than ``after``, earlier than ``before``, of ``volumes`` (both included)."""
    tests = [F.lit(True)]
    if after is not None:
        tests.append(F.col("greatest_time") > moment(after))
    if before is not None:
        tests.append(F.col("least_time") < moment(before))
    if volumes is not None:
        tests += [F.col("greatest_volume") >= volumes[0], F.col("least_volume") <= volumes[1]]
    met = tests[0]
    for test in tests[1:]:
        met = met & test
    return met


def rows_by_zones(
    rows: DataFrame,
    zone_rows: DataFrame,
    by: str,
    after: str | datetime | None = None,
    before: str | datetime | None = None,
    volumes: tuple[int, int] | None = None,
) -> DataFrame:
    """Rows of a time range and of volumes, from the folders whose zones can have any (F8).

    The folders are joined to the table, whose scan is pruned by them; there are no more than cells
    or days, so they are broadcast. No list of files is put together. Rows of the folder for NULL are
    asked for by themselves, if its zones meet the filter.
    """
    met = zone_rows.where(meets(after, before, volumes)).select(by)
    chosen = F.broadcast(met.where(F.col(by).isNotNull()).distinct())
    found = rows.join(chosen, by, "left_semi").select(*rows.columns)
    if not met.where(F.col(by).isNull()).isEmpty():
        found = found.union(rows.where(F.col(by).isNull()))
    found = time_range(found, after, before)
    return found if volumes is None else found.where(F.col("volume").between(*volumes))
