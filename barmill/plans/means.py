"""Means that are kept up to date: a table of partial states to which each load adds its own.

States lie in ``<path>/<generation>/batch=<name>``. A load writes the folder of its name, so doing it again
adds nothing. Folding merges all batches of a generation into one folder of the next generation, which
counts from the moment it is marked whole; the names of what was folded are kept with it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barmill.operators.averages import mean_of_states, mean_states, merged_states
from barmill.plans.workspace import exists, folders, make_folder, remove

FOLDED = "folded"


def _generations(spark: SparkSession, path: str) -> list[str]:
    """Generations that count, oldest first; more than one only while the old one is being removed."""
    return [g for g in folders(spark, path) if g.isdigit() and (int(g) == 0 or exists(spark, f"{path}/{g}/_whole"))]


def _current(spark: SparkSession, path: str) -> str:
    return f"{path}/{(_generations(spark, path) or ['0'])[-1]}"


def _was_folded(spark: SparkSession, current: str, batch: str) -> bool:
    names = f"{current}/_names"
    return exists(spark, names) and not spark.read.schema("batch string").parquet(names).where(F.col("batch") == batch).isEmpty()


def add_states(bars: DataFrame, path: str, batch: str, exact: tuple[int, int], key: str = "tstamp") -> None:
    """Add the states of ``bars``, the rows of one load that goes by the name ``batch`` (A3).

    One exchange over the new rows alone; what is there already is neither read nor written. A batch
    of a name that was added before takes its place; once it is folded, it is left out.
    """
    if not re.fullmatch(r"[\w.-]+", batch) or batch == FOLDED:
        raise ValueError(f"not the name of a batch: {batch!r}")
    spark = bars.sparkSession
    current = _current(spark, path)
    if not _was_folded(spark, current, batch):
        mean_states(bars, exact, key).write.mode("overwrite").parquet(f"{current}/batch={batch}")


def _states(spark: SparkSession, current: str) -> DataFrame:
    """All batches of a generation; names that look like numbers stay text."""
    batches = [name for name in folders(spark, current) if name.startswith("batch=")]
    if not batches:
        raise ValueError(f"no states in {current}")
    stored = spark.read.parquet(f"{current}/{batches[0]}").schema  # one footer
    return spark.read.schema(stored.add("batch", "string")).parquet(current)


def means(spark: SparkSession, path: str) -> DataFrame:
    """Means over all batches, taken as they are read: ``timestamp``, ``avg_close`` and ``symbol`` if there is one.

    Each task merges the states it reads before the one exchange.
    """
    return mean_of_states(merged_states(_states(spark, _current(spark, path)).drop("batch")))


def fold(spark: SparkSession, path: str) -> None:
    """Merge all batches into one, so that the cost of reading does not grow with the number of loads.

    A run that stops before the mark has changed nothing; one that stops after it is finished by the
    next. Readers that came before keep their files until a second fold.
    """
    generations = _generations(spark, path)
    if not generations:
        return
    number = int(generations[-1])
    current, following = f"{path}/{number}", f"{path}/{number + 1}"
    states = _states(spark, current)
    merged_states(states.drop("batch")).write.mode("overwrite").parquet(f"{following}/batch={FOLDED}")
    names = states.select("batch").distinct().where(F.col("batch") != FOLDED)
    if exists(spark, f"{current}/_names"):
        names = names.union(spark.read.schema("batch string").parquet(f"{current}/_names"))
    names.coalesce(1).write.mode("overwrite").parquet(f"{following}/_names")
    make_folder(spark, f"{following}/_whole")
    for old in generations[:-1]:
        remove(spark, f"{path}/{old}")
