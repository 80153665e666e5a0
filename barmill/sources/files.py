"""Text and CSV scans, feed identity, timing logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barmill.functions.timings import timing_text
from barmill.plans.workspace import exists
from barmill.schema import BAR, FEED_FILE, SNAPSHOT_LENGTH

FILE = "_metadata.file_path"

_LOG = "run string, stage string, position struct<file: string, block: bigint, line: bigint>, value string"


def with_identity(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Lines of a file scan with ``symbol`` and ``snapshot`` of the dump they are from.

    A path is a URL, so blanks and signs in a symbol are decoded; a plus stays one. The snapshot
    is the time part of the name and sorts as text in the order of time. If the name does not fit,
    both are NULL, or with ``strict`` the job stops. ``inline`` keeps the match below all that
    uses it, so that a line is matched once.
    """
    decoded = F.url_decode(F.replace(F.col(FILE), F.lit("+"), F.lit("%2B")))
    matched = F.struct(F.regexp_extract(decoded, FEED_FILE, 1).alias("_name"), decoded.alias("_file"))
    found = lines.select(*lines.columns, F.inline(F.array(matched)))
    name, fits = F.col("_name"), F.col("_name") != ""
    symbol = F.when(fits, F.substring(name, F.lit(1), F.length(name) - SNAPSHOT_LENGTH - 1))
    snapshot = F.when(fits, F.right(name, F.lit(SNAPSHOT_LENGTH)))
    if strict:
        message = F.concat(F.lit("not the name of a dump: "), F.col("_file"))
        snapshot = snapshot.otherwise(F.raise_error(message).cast("string"))
    return found.select(*lines.columns, symbol.alias("symbol"), snapshot.alias("snapshot"))


def scan_lines(
    spark: SparkSession, paths: str | list[str], identity: bool = False, strict: bool = True
) -> DataFrame:
    """Lines of all files of a glob as ``value`` (S1), on request with symbol and snapshot.

    A file whose name is not that of a dump stops the scan, unless ``strict`` is off: then its
    lines have neither, and the load counts them and leaves them out.
    """
    lines = spark.read.text(paths)
    return with_identity(lines, strict) if identity else lines


def scan_bars(
    spark: SparkSession, paths: str | list[str], schema: T.StructType = BAR, sep: str = ","
) -> DataFrame:
    """Headerless delimited bars of a fixed schema (S2). A bad field is NULL, its row stays."""
    return spark.read.schema(schema).csv(paths, header=False, sep=sep)


def scan_inferred(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Delimited files with a header, types inferred (S3).

    Inference reads all the data once more, and the types depend on it: whole-number prices come
    back as integers. Prefer ``scan_bars`` for anything that has to keep working.
    """
    return spark.read.option("header", True).option("inferSchema", True).csv(paths)


def scan_logs(spark: SparkSession, directory: str) -> DataFrame:
    """Lines of the logs ``<run>/<stage>.log`` below a directory, in a known order.

    Both names may be of the form ``column=value``, and a log may be a folder of part files.
    A log that was never written is simply absent, and so are all if there is no directory. Logs are read by line and not as one value
    per file, so their size does not matter; ``position`` orders the lines within a log.
    """
    if not exists(spark, directory):
        return spark.createDataFrame([], _LOG)
    lines = spark.read.option("recursiveFileLookup", True).text(directory)
    name = r"([^/=]+)/(?:[^/=]+=)?([^/=]+)\.log(?:/|$)"
    return lines.select(
        F.regexp_extract(FILE, name, 1).alias("run"),
        F.regexp_extract(FILE, name, 2).alias("stage"),
        F.struct(
            F.col(FILE).alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("position"),
        "value",
    )


def first_timings(logs: DataFrame) -> DataFrame:
    """First timing of each log (P12). Only lines with a timing go into the aggregation."""
    found = logs.withColumn("timing", timing_text(F.col("value"))).where(F.col("timing").isNotNull())
    return (
        found.groupBy("run", "stage")
        .agg(F.min_by("timing", "position").alias("timing"))
        .select("run", "stage", F.col("timing").try_cast("double").alias("ms"))
    )
