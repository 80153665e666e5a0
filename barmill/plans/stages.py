"""Stages that are left out when what they read has not changed.

Every stage that has ended leaves a record: a fingerprint of the files it read and of its options, and what
it reported. A run compares; a stage whose record fits is not run again. Since a stage writes its files anew
when it runs, the stages after it see that and run too.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barmill.plans.load import LoadTargets, write_bars, write_cleaned, write_means
from barmill.plans.workspace import exists, remove
from barmill.sources.files import scan_lines


def fingerprint(spark: SparkSession, paths: list[str], options: str = "") -> str:
    """A digest of the names, lengths and times of all files below some paths, none of which is opened.

    One aggregate; a row reaches the driver, however many files there are.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    each = ("path", "length", "modificationTime")
    row = files.agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("length"),
        F.bit_xor(F.xxhash64(*each)).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), *each)).alias("y"),
    ).first()
    return f"{row['files']} files, {row['length']} bytes, {row['x']} {row['y']}, {options}"


def _record(spark: SparkSession, path: str) -> dict | None:
    if not exists(spark, f"{path}/_SUCCESS"):
        return None
    row = spark.read.text(path, wholetext=True).first()
    return json.loads(row["value"]) if row else None


def run_stage(
    spark: SparkSession,
    home: str,
    name: str,
    reads: list[str],
    work: Callable[[], dict],
    options: str = "",
    writes: str | None = None,
) -> tuple[dict, bool]:
    """What the stage reported, and whether it had to run.

    ``work`` replaces what the stage wrote before. The record goes before it runs and comes after it has ended,
    so one that was stopped runs again. A stage whose output (``writes``) has gone runs again too.
    """
    record = f"{home}/{name}"
    seen = fingerprint(spark, reads, options)
    before = _record(spark, record)
    if before and before["fingerprint"] == seen and (writes is None or exists(spark, writes)):
        return before["report"], False
    remove(spark, record)
    report = work()
    text = json.dumps({"fingerprint": seen, "report": report})
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.mode("overwrite").text(record)
    return report, True


def run_resumable_load(
    spark: SparkSession,
    paths: list[str],
    to: LoadTargets,
    home: str,
    identity: bool = True,
    strict_timestamps: bool = False,
    partitions: int | None = None,
    until: str | None = None,
) -> DataFrame:
    """The stages of ``run_daily_load`` over the dumps of ``paths``, those left out whose input is as it was.

    ``home`` holds the records. ``until`` names the last stage of this run: ``cleaned``, ``means`` or ``bars``. Returns one row per
    stage: its name, whether it ``ran``, and its ``report`` as JSON. A run that was stopped anywhere goes on with the stage it
    was in.
    """
    options = f"identity={identity} strict={strict_timestamps}"
    cleaned = lambda: write_cleaned(scan_lines(spark, paths, identity), to, "value", strict_timestamps)
    stages = [
        ("cleaned", paths, cleaned, f"{options} to={to.cleaned}", to.cleaned),
        ("means", [to.cleaned], lambda: write_means(spark, to), f"to={to.averages_table}", to.averages),
        ("bars", [to.cleaned], lambda: write_bars(spark, to, partitions), f"to={to.warehouse_table}", to.warehouse),
    ]
    done = []
    for name, reads, work, said, writes in stages:
        report, ran = run_stage(spark, home, name, reads, work, said, None if to.jdbc and name == "bars" else writes)
        done.append((name, ran, json.dumps(report)))
        if name == until:
            break
    return spark.createDataFrame(done, "stage string, ran boolean, report string")
