"""The range query on two layouts: time, files, reduction."""

from __future__ import annotations

from time import perf_counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barmill.functions.times import moment, time_range
from barmill.functions.timings import percent_reduction, percent_text
from barmill.plans.layout import data_files
from barmill.schema import DAY
from barmill.sources.files import first_timings, scan_logs

STAGES = ("before", "after")


def files_left(spark: SparkSession, path: str, after: str) -> DataFrame:
    """The files that remain to be opened once the days are pruned; none of them is opened here."""
    files = data_files(spark, path)
    return files.where(F.col(DAY) >= F.to_date(moment(after))) if DAY in files.columns else files


def _run(bars: DataFrame, after: str) -> float:
    start = perf_counter()
    time_range(bars, after).write.format("noop").mode("overwrite").save()
    return (perf_counter() - start) * 1000


def measure(spark: SparkSession, bars: DataFrame, after: str, log: str) -> None:
    """Run the range query to its end, throw the rows away and log its access path and the time."""
    ms = _run(bars, after)
    path = spark.sql("EXPLAIN FORMATTED SELECT * FROM {bars}", bars=time_range(bars, after))
    line = spark.range(1).select(F.lit(f"Execution Time: {ms:.3f} ms").alias("line"))
    path.select(F.col("plan").alias("line")).union(line).coalesce(1).write.mode("overwrite").text(log)


# How the lines of a scan begin in a plan.
_ACCESS = {
    "scan": r"^\(\d+\) Scan (\S+)",
    "partition_filters": r"^PartitionFilters: \[(.*)\]",
    "pushed_filters": r"^PushedFilters: \[(.*)\]",
    "read_schema": r"^ReadSchema: struct<(.*)>",
}


def access_paths(logs: DataFrame) -> DataFrame:
    """How each run got at its rows, from the plan in its log: a row per ``run`` and ``stage`` with the kind of ``scan``,
    ``partition_filters`` (which folders are listed), ``pushed_filters`` (what is tested against row groups) and
    ``read_schema``. What the plan does not have is NULL, as for a log without a plan."""
    found = [F.max(F.nullif(F.regexp_extract("value", p, 1), F.lit(""))).alias(name) for name, p in _ACCESS.items()]
    return logs.groupBy("run", "stage").agg(*found)


def _side_by_side(value: str) -> list[Column]:
    of = F.col("stage")
    return [F.max(F.when(of == stage, F.col(value))).alias(f"{stage}_{value}") for stage in STAGES]


def _reduced(times: DataFrame) -> DataFrame:
    reduction = percent_reduction(F.col("before_ms"), F.col("after_ms"))
    return times.withColumn("reduction_pct", reduction).withColumn(
        "reduction", percent_text(F.col("reduction_pct"))
    )


def report(logs: DataFrame) -> DataFrame:
    """One row per run: both times and by how many percent the second is less.

    A run without one of the logs, or without a timing in it, has NULL there and no percentage.
    """
    return _reduced(first_timings(logs).groupBy("run").agg(*_side_by_side("ms")))


def summary(reports: DataFrame) -> DataFrame:
    """Median times over all runs, their reduction, and the least and greatest one of a run.

    Only if all runs point the same way do the layouts differ by more than the noise.
    """
    medians = reports.agg(
        F.count(F.lit(1)).alias("runs"),
        F.median("before_ms").alias("before_ms"),
        F.median("after_ms").alias("after_ms"),
        F.min("reduction_pct").alias("least_pct"),
        F.max("reduction_pct").alias("most_pct"),
    )
    apart = (F.col("least_pct") > 0) | (F.col("most_pct") < 0)
    return _reduced(medians).withColumn("beyond_noise", F.coalesce(apart, F.lit(False)))


def file_counts(spark: SparkSession, paths: dict[str, str], after: str) -> DataFrame:
    """``before_files`` and ``after_files``: how many the range query opens in either layout."""
    sides = [
        files_left(spark, path, after).select(F.lit(stage).alias("stage")) for stage, path in paths.items()
    ]
    counted = sides[0].union(sides[1]).groupBy("stage").agg(F.count(F.lit(1)).alias("files"))
    files = counted.agg(*_side_by_side("files"))
    return files.select(*(F.coalesce(c, F.lit(0)).alias(c) for c in files.columns))


def compare_layouts(
    spark: SparkSession, plain: str, arranged: str, after: str, log_dir: str, runs: int = 5
) -> DataFrame:
    """Time the range query on the tables at two paths and report times, reduction, files.

    Each side runs once untimed, since the first run pays for generated code and listings. Then
    they run in pairs, in alternating order, each run with a log of its own.
    """
    paths = {"before": plain, "after": arranged}
    bars = {stage: spark.read.parquet(path) for stage, path in paths.items()}
    for stage in STAGES:
        _run(bars[stage], after)
    for n in range(runs):
        for stage in STAGES if n % 2 == 0 else reversed(STAGES):
            measure(spark, bars[stage], after, f"{log_dir}/{n}/{stage}.log")
    times = summary(report(scan_logs(spark, log_dir))).withColumn("all", F.lit(1))
    files = file_counts(spark, paths, after).withColumn("all", F.lit(1))
    return times.join(files, "all").drop("all")  # one row each
