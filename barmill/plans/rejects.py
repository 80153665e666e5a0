"""Lines kept by what became of them: the valid ones to go on with, the others to be looked into."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barmill.operators.lenient import SKIPPED, VALID, class_counts, classify_lines
from barmill.plans.workspace import exists

CLASS = "line_class"

#: A line with the dump it came in, the pair that was read from it, and its class, the folder it lies in.
CLASSIFIED = T.StructType(
    [
        *(T.StructField(name, T.StringType()) for name in ("line", "symbol", "snapshot", "tstamp")),
        T.StructField("close", T.FloatType()),
        T.StructField(CLASS, T.StringType()),
    ]
)


def write_classified(lines: DataFrame, path: str, column: str = "value", load: str | None = None) -> None:
    """Write all lines, valid and rejected, in one pass, a folder for each class.

    Every line is read, split and parsed once, and nothing is shuffled: a task writes one file for each class
    that it meets, of five. ``lines`` may have ``symbol`` and ``snapshot``. Replaces what was there, or with
    ``load``, a name, only what a load of that name had written; other loads stay.
    """
    missing = [F.lit(None).cast("string").alias(c) for c in ("symbol", "snapshot") if c not in lines.columns]
    named = lines.select(F.col(column).alias("line"), *(c for c in ("symbol", "snapshot") if c in lines.columns), *missing)
    classified = classify_lines(named, "line").select(*CLASSIFIED.names)
    target = f"{path}/load={load}" if load else path
    classified.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(CLASS).parquet(target)


def classified_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines that were written, with ``line_class``; a filter on it opens the folders of that class only."""
    if not exists(spark, path):
        return spark.createDataFrame([], CLASSIFIED)
    # The name of a load is one more folder level, which is not returned.
    stored = T.StructType([*CLASSIFIED, T.StructField("load", T.StringType())])
    return spark.read.schema(stored).parquet(path).select(*CLASSIFIED.names)


def rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with a fault: ``line_class`` (the reason), ``symbol``, ``snapshot``, ``line``. Headers and empty lines
    have none."""
    lines = classified_lines(spark, path).where(~F.col(CLASS).isin(VALID, SKIPPED))
    return lines.select(CLASS, "symbol", "snapshot", "line")


def valid_pairs(spark: SparkSession, path: str) -> DataFrame:
    """``(tstamp, close)`` of the valid lines, as ``lenient.close_pairs``, without parsing again."""
    return classified_lines(spark, path).where(F.col(CLASS) == VALID).select("tstamp", "close")


def valid_lines(spark: SparkSession, path: str) -> DataFrame:
    """The valid lines as they came, with symbol and snapshot, to be loaded."""
    return classified_lines(spark, path).where(F.col(CLASS) == VALID).select("line", "symbol", "snapshot")


def counted_lines(spark: SparkSession, path: str) -> DataFrame:
    """Counters as of ``lenient.parse_counters``, from the folders; exact however often tasks were run again."""
    return class_counts(classified_lines(spark, path))


def rejects_by_dump(spark: SparkSession, path: str) -> DataFrame:
    """How many lines of each dump were rejected for which reason, and the least of them as an example."""
    return rejected_lines(spark, path).groupBy("symbol", "snapshot", CLASS).agg(
        F.count(F.lit(1)).alias("n_lines"), F.min("line").alias("example")
    )
