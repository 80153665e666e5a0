"""Bars built as ticks land."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barmill.operators.bars import interval_bars
from barmill.streaming.bars import TICK, build_bars, final_bars, late_ticks, open_bars

START = datetime(2025, 3, 30)  # clocks change in many zones on that day


def tick(minute, symbol="A", price=1.0, number=0):
    return (symbol, START + timedelta(minutes=minute), float(price), number)


@pytest.fixture
def land(spark, tmp_path):
    def land(name, *ticks):
        spark.createDataFrame(list(ticks), TICK).coalesce(1).write.parquet(str(tmp_path / "landing" / name))

    land.paths = (str(tmp_path / "landing"), str(tmp_path / "built"))
    return land


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def taken(spark, land):
    return spark.read.schema(TICK).option("recursiveFileLookup", True).parquet(land.paths[0])


def test_bars_are_final_once(spark, land):
    land("1", tick(1, price=5, number=1), tick(3, price=7, number=2), tick(7, price=1, number=3), tick(31))
    first = rows(build_bars(spark, *land.paths))
    # The watermark is at 21 minutes: bars that end until then are final, that of minute 31 is open.
    assert [(r[1].minute, *r[2:]) for r in first] == [(0, 5.0, 7.0, 5.0, 7.0, 2), (5, 1.0, 1.0, 1.0, 1.0, 1)]
    assert [(r.tstamp.minute, r.volume) for r in open_bars(spark, land.paths[1]).collect()] == [(30, 1)]
    assert rows(build_bars(spark, *land.paths)) == first
    land("2", tick(4, price=99, number=4), tick(22, price=3), tick(32, price=4, number=9), tick(30, price=2, number=9))
    assert rows(build_bars(spark, *land.paths)) == first
    late = late_ticks(taken(spark, land), final_bars(spark, land.paths[1]).union(open_bars(spark, land.paths[1])), "5 minutes")
    assert [(r.symbol, r.tstamp.minute, r.n_late) for r in late.collect()] == [("A", 0, 1)]
    land("3", tick(90, "B"))
    last = rows(build_bars(spark, *land.paths))
    assert len(last) == 4 and set(first) < set(last)
    (half,) = [r for r in last if r[1].minute == 30]
    assert half[2:] == (2.0, 4.0, 1.0, 4.0, 3)


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York"])
def test_same_as_in_one_go_in_any_zone(spark, land, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    rng = random.Random(2)
    ticks = [tick(rng.randrange(2880), rng.choice("ABC"), rng.randrange(100), n) for n in range(400)]
    ticks += [tick(130, "A", rng.randrange(9), 1000 + n) for n in range(300)]  # most of one bar
    ticks += [("A", None, 1.0, 5), (None, START, 2.0, 6)]
    ticks.sort(key=lambda t: (t[1] is not None, t[1]))
    for n in range(3):
        land(str(n), *ticks[n * 240 : (n + 1) * 240])
        build_bars(spark, *land.paths, interval="1 hour", delay="3 hours", most_files=1)
    built = final_bars(spark, land.paths[1]).union(open_bars(spark, land.paths[1]))
    all_ticks = taken(spark, land)
    assert all_ticks.count() == len(ticks)
    expected = interval_bars(all_ticks.where("ts IS NOT NULL"), "1 hour")
    if zone == "UTC":
        assert rows(built) == rows(expected)
    counted = {}
    for symbol, ts, *_ in ticks:
        if ts is not None:
            counted[symbol, ts.replace(minute=0)] = counted.get((symbol, ts.replace(minute=0)), 0) + 1
    assert {(r.symbol, r.tstamp): r.volume for r in built.collect()} == counted
    assert late_ticks(all_ticks, built, "1 hour").isEmpty()


def test_all_late_and_none(spark, land):
    assert final_bars(spark, land.paths[1]).count() == 0
    assert open_bars(spark, land.paths[1]).count() == 0
    land("1", tick(600))
    build_bars(spark, *land.paths)
    land("2", *(tick(n, number=n) for n in range(50)))
    build_bars(spark, *land.paths)
    land("3", tick(1200))
    final = build_bars(spark, *land.paths)
    assert [r.volume for r in final.collect()] == [1]
    late = late_ticks(taken(spark, land), final.union(open_bars(spark, land.paths[1])), "5 minutes")
    assert late.agg(F.sum("n_late")).first()[0] == 50 and late.count() == 10
