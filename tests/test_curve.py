"""The layout on a curve, and the choice of folders by zones."""

import random
import re

import duckdb
import pytest
from conftest import plan
from pyspark.sql import functions as F

from barmill.plans import curve
from barmill.plans.curve import CELL, interleaved, meets, on_curve, rank, rows_by_zones, write_curve, write_zones, zones
from barmill.plans.layout import write_warehouse

PLACES = [(0, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 1), (63, 63, 63), (5, 40, 17), (32, 0, 31)]


def woven(ranks, bits=6):
    text = "".join(format(r, f"0{bits}b")[i] for i in range(bits) for r in ranks)
    return int(text, 2)


def test_bits_are_interleaved(spark):
    rows = spark.createDataFrame(PLACES, "a int, b int, c int")
    got = [r[0] for r in rows.select(interleaved([F.col("a"), F.col("b"), F.col("c")])).collect()]
    assert got == [woven(p) for p in PLACES]


@pytest.mark.parametrize("cuts", [[], [5], [1, 2, 2, 2, 7], list(range(0, 126, 2)), [3] * 63])
def test_ranks(spark, cuts):
    values = [None, -1, 0, 1, 2, 3, 5, 6, 7, 8, 50, 200]
    rows = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = [r[0] for r in rows.select(rank(F.col("v"), cuts)).collect()]
    assert got == [0 if v is None else sum(c <= v for c in cuts) for v in values]


def skewed_bars(spark, n=6000):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        minute = 0 if i % 3 == 0 else rng.randrange(30 * 1440)  # a third at one time
        volume = None if i % 50 == 0 else (0 if i % 2 else int(10 ** rng.uniform(0, 6)))  # half of one volume
        rows.append((rng.choice("ABC"), minute, float(i), volume))
    given = spark.createDataFrame(rows, "symbol string, minute int, close double, volume bigint")
    start = F.lit("2025-09-01").cast("timestamp_ntz")
    time = F.when(F.col("minute") % 97 != 0, start + F.make_dt_interval(mins="minute"))
    return given.select("symbol", F.when(F.col("minute") == 0, start).otherwise(time).alias("tstamp"), "close", "volume")


FILTERS = [
    {},
    {"volumes": (100_000, 10**9)},
    {"volumes": (0, 0)},
    {"after": "2025-09-20", "before": "2025-09-22"},
    {"after": "2025-09-25", "volumes": (1, 50)},
    {"volumes": (-5, -1)},
]


@pytest.mark.parametrize("by", [CELL, "tstamp_date"])
def test_rows_by_zones(spark, tmp_path, by):
    bars = skewed_bars(spark)
    home, zone_path = str(tmp_path / "t"), str(tmp_path / "z")
    write_curve(bars, home) if by == CELL else write_warehouse(bars, home)
    write_zones(spark, home, by, zone_path)
    rows, zone_rows = spark.read.parquet(home), spark.read.parquet(zone_path)
    all_bars = bars.collect()
    for asked in FILTERS:
        got = rows_by_zones(rows, zone_rows, by, **asked).collect()
        low, high = asked.get("volumes", (None, None))
        want = [
            r
            for r in all_bars
            if (low is None or (r.volume is not None and low <= r.volume <= high))
            and ("after" not in asked or (r.tstamp is not None and str(r.tstamp) > asked["after"]))
            and ("before" not in asked or (r.tstamp is not None and str(r.tstamp) < asked["before"]))
        ]
        assert sorted(r.close for r in got) == sorted(r.close for r in want), asked


def test_zones_are_those_of_the_files(spark, tmp_path):
    home = str(tmp_path / "t")
    write_curve(skewed_bars(spark), home)
    got = zones(spark.read.parquet(home), CELL).collect()
    con = duckdb.connect()
    want = con.execute(f"""
        SELECT filename, count(*), min(tstamp), max(tstamp), min(volume), max(volume)
        FROM read_parquet('{home}/*/*.parquet', filename = true) GROUP BY 1""").fetchall()
    assert {re.sub("^file:/+", "/", r.file): tuple(r)[2:] for r in got} == {r[0]: tuple(r[1:]) for r in want}
    chosen = con.execute(f"""
        SELECT count(*) FROM (
          SELECT max(volume) AS v FROM read_parquet('{home}/*/*.parquet', filename = true) GROUP BY filename)
        WHERE v >= 100000""").fetchone()[0]
    zone_rows = zones(spark.read.parquet(home), CELL)
    assert zone_rows.where(meets(volumes=(100_000, 10**9))).count() == chosen < len(got) / 2


def test_the_scan_is_pruned_by_the_zones(spark, tmp_path):
    bars, home = skewed_bars(spark), str(tmp_path / "t")
    write_curve(bars, home)
    write_zones(spark, home, CELL, str(tmp_path / "z"))
    rows, zone_rows = spark.read.parquet(home), spark.read.parquet(str(tmp_path / "z"))
    asked = rows_by_zones(rows, zone_rows, CELL, volumes=(100_000, 10**9))
    assert "dynamicpruningexpression(cell" in plan(asked)
    seen = rows_by_zones(rows.withColumn("file", F.col("_metadata.file_path")), zone_rows, CELL)
    everything = seen.select("file").distinct().count()
    chosen = zone_rows.where(meets(volumes=(100_000, 10**9))).select("file").distinct().count()
    assert chosen < everything / 2


def test_one_exchange(spark):
    text = plan(on_curve(skewed_bars(spark)))
    assert text.count("REBALANCE_PARTITIONS_BY_COL") == 1 and "rangepartitioning" not in text


def test_a_volume_that_most_rows_have_is_no_single_cell(spark, tmp_path):
    write_curve(skewed_bars(spark), str(tmp_path / "t"))
    cells = spark.read.parquet(str(tmp_path / "t")).groupBy(CELL).count().collect()
    assert len(cells) > 20 and max(r["count"] for r in cells) < 6000 * 0.3


def test_few_rows(spark, tmp_path):
    empty = skewed_bars(spark).limit(0)
    assert on_curve(empty).count() == 0
    one = skewed_bars(spark).limit(1)
    write_curve(one, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1
    plain = one.drop("symbol").withColumn("volume", F.lit(None).cast("bigint"))
    assert on_curve(plain).drop(CELL).collect() == plain.collect()
    assert curve.quantiles(empty, ["volume"]) == [[]]
