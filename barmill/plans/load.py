"""The daily load: raw dumps to the warehouse table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barmill.operators.averages import avg_close
from barmill.operators.bars import in_time_order, row_count, traded, typed_bars
from barmill.operators.strict import clean_lines, first_per_key, newest_snapshot, strict_counters
from barmill.plans.exchange import exchange_days
from barmill.plans.layout import by_day, refresh_stats, write_warehouse
from barmill.schema import FIELDS, SYMBOL
from barmill.sources.sinks import save_table, write_jdbc


def newest_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Cleaned lines with symbol and snapshot, one per symbol and key, from the newest dump.

    Those of a dump whose name told neither symbol nor snapshot are left out; ``strict_counters``
    counts them.
    """
    cleaned = clean_lines(lines, column)
    symbol = [SYMBOL] if SYMBOL in cleaned.columns else []
    for name in (*symbol, "snapshot"):
        cleaned = cleaned.where(F.col(name).isNotNull())
    return newest_snapshot(cleaned.select(*symbol, "key", "line", "snapshot"), [*symbol, "key"])


def clean_once(lines: DataFrame, column: str = "value") -> DataFrame:
    """Cleaned lines, one per key, or per symbol and key where lines have a symbol.

    Lines that come with their snapshot are taken from the newest dump, as by ``newest_lines``.
    """
    symbol = [SYMBOL] if SYMBOL in lines.columns else []
    if "snapshot" not in lines.columns:
        return first_per_key(clean_lines(lines, column).select(*symbol, "key", "line"), [*symbol, "key"])
    return newest_lines(lines, column).select(*symbol, "key", "line")


def load_bars(
    lines: DataFrame, column: str = "value", strict_timestamps: bool = False, partitions: int | None = None
) -> DataFrame:
    """Raw lines to traded bars in time order, in one plan and nothing written in between."""
    once = clean_once(lines, column).drop("key")
    return in_time_order(traded(typed_bars(once, "line", strict_timestamps)), partitions=partitions)


@dataclass(frozen=True)
class LoadTargets:
    """Where the stages of a load write. Each has its own path and replaces what was there.

    With ``jdbc`` options the bars go to a relational table instead of the warehouse. With
    ``days_only`` only the days that were loaded are replaced in a warehouse table that is there
    already, each as a whole (``exchange.exchange_days``).
    """

    cleaned: str
    warehouse: str
    averages: str
    warehouse_table: str = "bars"
    averages_table: str = "close_means"
    jdbc: dict[str, str] | None = None
    days_only: bool = False


def run_daily_load(
    lines: DataFrame,
    to: LoadTargets,
    column: str = "value",
    strict_timestamps: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Clean, average and load the lines of all dumps.

    Returns one row: ``n_rows`` loaded, and how many ``lines`` there were, how many were
    ``headers``, ``malformed`` or ``unnamed`` (of a dump whose name does not fit). These are taken
    as the lines are read; a task that runs again may count its lines twice.

    ``lines`` is a scan of the dumps or the table that landing dumps are ingested into. They are
    parsed once; each stage reads what the stage before it wrote, so a lost executor or job costs
    one stage at most, and every stage can be run again by itself. Three exchanges in all: one row
    per key, means, layout. Nothing is put in a global order, since no reader asks for one.
    """
    spark = lines.sparkSession
    found = write_cleaned(lines, to, column, strict_timestamps)
    write_means(spark, to)
    loaded = write_bars(spark, to, partitions)
    return spark.createDataFrame([(loaded["n_rows"],)], "n_rows bigint").select(
        "n_rows", *(F.lit(found[name]).alias(name) for name in found)
    )


def write_cleaned(
    lines: DataFrame, to: LoadTargets, column: str = "value", strict_timestamps: bool = False
) -> dict[str, int]:
    """First stage: lines cleaned, one per key, and typed, as Parquet; how many fell out for what reason."""
    spark = lines.sparkSession
    counted = Observation("load")
    identity = {"symbol", "snapshot"} <= set(lines.columns)
    observed = lines.observe(counted, *strict_counters(F.col(column), identity))
    typed = typed_bars(clean_once(observed, column), "line", strict_timestamps)
    typed.write.mode("overwrite").parquet(to.cleaned)
    return dict(counted.get)


def _cleaned(spark: SparkSession, to: LoadTargets) -> DataFrame:
    return spark.read.parquet(to.cleaned)


def write_means(spark: SparkSession, to: LoadTargets) -> dict[str, int]:
    """Second stage: means of what was cleaned."""
    save_table(avg_close(_cleaned(spark, to), "key"), to.averages_table, to.averages)
    return {}


def write_bars(spark: SparkSession, to: LoadTargets, partitions: int | None = None) -> dict[str, int]:
    """Third stage: traded bars to the warehouse; how many the table has."""
    cleaned = _cleaned(spark, to)
    symbol = [SYMBOL] if SYMBOL in cleaned.columns else []
    bars = traded(cleaned).select(*symbol, *FIELDS)
    if to.jdbc:
        write_jdbc(bars, to.jdbc)
        loaded = row_count(bars)
    elif to.days_only and spark.catalog.tableExists(to.warehouse_table):
        exchange_days(by_day(bars, partitions), to.warehouse_table)
        loaded = refresh_stats(spark, to.warehouse_table, ["tstamp", "volume"])
    else:
        write_warehouse(bars, to.warehouse, to.warehouse_table, partitions=partitions)
        loaded = refresh_stats(spark, to.warehouse_table, ["tstamp", "volume"])
    return {"n_rows": loaded.first()["n_rows"]}
