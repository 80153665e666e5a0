"""Column expressions over timing logs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how a measured time is written in a log.
TIMING = r"Execution Time: ([\d.]+) ms"


def timing_text(text: Column) -> Column:
    """Digits of the first timing in the text, NULL if there is none."""
    return F.nullif(F.regexp_extract(text, TIMING, 1), F.lit(""))


def timing_ms(text: Column) -> Column:
    """First timing in the text as a number of milliseconds."""
    return timing_text(text).try_cast("double")


def percent_reduction(before: Column, after: Column) -> Column:
    """By how many percent ``after`` is less; NULL if a time is missing or zero."""
    measured = (before > 0) & after.isNotNull() & (after != 0)
    return F.when(measured, (before - after) / before * 100)


def percent_text(reduction: Column) -> Column:
    """Percentage with two decimals, or a note that there is none."""
    return F.when(reduction.isNotNull(), F.format_string("%.2f%%", reduction)).otherwise(
        "not available"
    )
