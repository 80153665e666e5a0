"""Lenient reading of raw lines: ``(tstamp, close)`` pairs and counts of what was wrong."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from barmill.functions.text import fields_of, parse_float32, strip_blanks
from barmill.schema import FIELDS, HEADER_PREFIX

# The names of the counters.
SKIPPED, VALID = "Skipped", "ValidLines"
BAD_NUMBER, BAD_LENGTH = "InvalidNumberFormat", "InvalidLineLength"


def classify_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Add ``line_class``, the trimmed ``tstamp`` and the float32 ``close``.

    The arity and emptiness tests look at the fields before they are trimmed one by one. An empty
    close is a length fault, a blank or unreadable one a number fault.

    ``inline`` keeps a later filter on the class from being pushed below the split, where every
    mention of a field would split the line again.
    """
    split = lines.withColumn("_line", strip_blanks(F.col(column))).withColumn(
        "_parts", fields_of(F.col("_line"))
    )
    line, parts = F.col("_line"), F.col("_parts")
    key, number = F.get(parts, F.lit(0)), F.get(parts, F.lit(4))
    skipped = line.startswith(HEADER_PREFIX) | (line == "")
    complete = (F.size(parts) >= len(FIELDS)) & (key != "") & (number != "")
    parsed = split.withColumn("_close", parse_float32(number))
    fields = F.struct(
        F.when(skipped, SKIPPED)
        .when(~complete, BAD_LENGTH)
        .when(F.col("_close").isNull(), BAD_NUMBER)
        .otherwise(VALID)
        .alias("line_class"),
        strip_blanks(key).alias("tstamp"),
        F.col("_close").alias("close"),
    )
    return parsed.select(*lines.columns, F.inline(F.array(fields)))


def close_pairs(lines: DataFrame, column: str = "value") -> DataFrame:
    """``(tstamp, close)`` of the valid lines (P5)."""
    return classify_lines(lines, column).where(F.col("line_class") == VALID).select("tstamp", "close")


def class_counts(classified: DataFrame) -> DataFrame:
    """The counters of ``parse_counters`` from lines that were classified before."""
    return classified.agg(*_counters())


def _counters(line_class: str = "line_class"):
    of = F.col(line_class)
    return [
        F.count(F.lit(1)).alias("ProcessedLines"),
        F.count_if(of == SKIPPED).alias("Skipped"),
        F.count_if(of == VALID).alias("ValidLines"),
        F.count_if(of == BAD_NUMBER).alias("InvalidNumberFormat"),
        # Never raised: a line with a missing field fails the arity test first.
        F.lit(0).cast("bigint").alias("InvalidLineFormat"),
        F.count_if(of == BAD_LENGTH).alias("InvalidLineLength"),
    ]


def parse_counters(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row of parse-quality counters (A5); every task sends one partial row."""
    return classify_lines(lines, column).agg(*_counters())


def observed_pairs(
    lines: DataFrame, column: str = "value", name: str = "parse_counters"
) -> tuple[DataFrame, Observation]:
    """``close_pairs`` with the counters taken in the same pass; read them after the write.

    A stage that is run again after an executor is lost may count lines twice; ``parse_counters``
    is exact in any case.
    """
    counters = Observation(name)
    classified = classify_lines(lines, column).observe(counters, *_counters())
    return classified.where(F.col("line_class") == VALID).select("tstamp", "close"), counters
