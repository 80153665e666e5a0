"""Types of delimited fields, found in one aggregate and kept up to date file by file.

A value is a whole number, a number, a time or a text; a field is the least type that holds all its
values. What was seen is a bitmask per field, and masks of several files are joined by ``bit_or``. So the
types of all files follow from the masks of each, and a new file is read alone, and once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barmill.functions.times import parse_timestamp
from barmill.plans.workspace import exists

# Kinds of values, as bits.
WHOLE, NUMBER, TIME, TEXT = 1, 2, 4, 8

STATES = "position int, field string, mask int, n_values bigint"

_TYPES = {"bigint": T.LongType(), "double": T.DoubleType(), "timestamp_ntz": T.TimestampNTZType(), "string": T.StringType()}


def kind(value: Column) -> Column:
    """The bit of the first kind that a text is of; 0 for NULL and for an empty text, which say nothing.

    Whole numbers are those of 64 bits without blanks, times those in the bar format.
    """
    digits, time = value.rlike(r"^[+-]?\d+$"), parse_timestamp(value)
    # The dearest test, for numbers, is only made of what the patterns have not told.
    return (
        F.when(value.isNull() | (value == ""), 0)
        .when(digits, F.when(value.try_cast("bigint").isNotNull(), WHOLE).otherwise(NUMBER))
        .when(time.isNotNull(), TIME)
        .when(value.try_cast("double").isNotNull(), NUMBER)
        .otherwise(TEXT)
    )


def type_of(mask: Column) -> Column:
    """The type that a field of these kinds has; a field of which nothing was seen is text."""
    return (
        F.when(mask == WHOLE, "bigint")
        .when(mask.isin(NUMBER, WHOLE | NUMBER), "double")
        .when(mask == TIME, "timestamp_ntz")
        .otherwise("string")
    )


def field_states(rows: DataFrame) -> DataFrame:
    """What is seen of each field of ``rows``, all text: ``position``, ``field``, ``mask``, ``n_values``.

    One pass and one row per task, however many fields.
    """
    quoted = [name.replace("`", "``") for name in rows.columns]
    kinds = [kind(F.col(f"`{name}`")).alias(f"_kind{n}") for n, name in enumerate(quoted)]
    # ``inline`` makes each kind a column, which both aggregates of the field read.
    told = rows.select(F.inline(F.array(F.struct(*kinds))))
    seen = []
    for n in range(len(kinds)):
        seen += [F.bit_or(f"_kind{n}").alias(f"_mask{n}"), F.count_if(F.col(f"_kind{n}") > 0).alias(f"_n{n}")]
    fields = [
        F.struct(
            F.lit(n).alias("position"),
            F.lit(name).alias("field"),
            F.coalesce(f"_mask{n}", F.lit(0)).cast("int").alias("mask"),
            F.col(f"_n{n}").alias("n_values"),
        )
        for n, name in enumerate(rows.columns)
    ]
    return told.agg(*seen).select(F.inline(F.array(*fields)))


def merged_states(states: DataFrame) -> DataFrame:
    """The states of several files as one; fields are told apart by their place and name."""
    return states.groupBy("position", "field").agg(F.bit_or("mask").alias("mask"), F.sum("n_values").alias("n_values"))


def scan_texts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Delimited files with a header, every field as text; nothing is read but the first header."""
    return spark.read.option("header", True).csv(paths)


def add_types(spark: SparkSession, paths: str | list[str], home: str, batch: str) -> None:
    """Keep what is seen in some files under the name ``batch``; again under that name replaces it (S3)."""
    field_states(scan_texts(spark, paths)).coalesce(1).write.mode("overwrite").parquet(f"{home}/batch={batch}")


def inferred_types(spark: SparkSession, home: str) -> DataFrame:
    """``position``, ``field``, ``type`` and ``n_values`` over all batches."""
    if not exists(spark, home):
        return spark.createDataFrame([], "position int, field string, type string, n_values bigint")
    states = spark.read.schema(f"{STATES}, batch string").parquet(home).drop("batch")
    return merged_states(states).select("position", "field", type_of(F.col("mask")).alias("type"), "n_values")


def inferred_schema(spark: SparkSession, home: str) -> T.StructType:
    """The same as a schema; a row per field reaches the driver."""
    fields = inferred_types(spark, home).orderBy("position").toLocalIterator()
    return T.StructType([T.StructField(r["field"], _TYPES[r["type"]]) for r in fields])


def scan_by_types(spark: SparkSession, paths: str | list[str], home: str) -> DataFrame:
    """Delimited files with a header, typed by what was seen so far; they are read once."""
    return spark.read.schema(inferred_schema(spark, home)).option("header", True).csv(paths)
