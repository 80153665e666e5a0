from datetime import datetime

import pytest
from conftest import plan
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barmill.operators.averages import (
    avg_close,
    avg_close_float32,
    avg_close_present,
    in_key_order,
)
from barmill.operators.bars import (
    in_time_order,
    interval_bars,
    parse_tstamp,
    row_count,
    traded,
    typed_bars,
)
from barmill.operators.strict import clean_lines, first_per_key, newest_snapshot, sorted_lines
from barmill.plans.load import load_bars
from barmill.schema import BAR, FIELDS

# In descending order, so that the sort has something to do.
ROWS = [
    ("2031-03-07 15:30:00", 17.25, 80),
    ("2031-03-07 15:15:00", 17.5, 0),
    ("2031-03-07 15:00:00", 16.75, 300),
]


def test_schema():
    kinds = ["timestamp_ntz", "double", "double", "double", "double", "bigint"]
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in BAR] == [
        (name, kind, True) for name, kind in zip(FIELDS, kinds)
    ]


def test_volume_filter_and_order(bars_of):
    bars = bars_of(*ROWS, ("2031-03-07 15:45:00", 1.0, None), ("2031-03-07 16:00:00", 1.0, -5), ("?", 9.0, 7))
    for partitions in (None, 3):
        got = in_time_order(traded(bars), partitions=partitions).collect()
        assert [r.tstamp for r in got] == [None, datetime(2031, 3, 7, 15), datetime(2031, 3, 7, 15, 30)]
        assert [r.volume for r in got] == [7, 300, 80]


def test_text_timestamps(spark):
    bars = spark.createDataFrame([("2025-09-02 04:00:00", 1), ("?", 2)], "tstamp string, volume bigint")
    assert [r.tstamp for r in parse_tstamp(bars).collect()] == [datetime(2025, 9, 2, 4), None]


def test_order_keeps_all_rows_over_partitions(spark, bars_of):
    many = spark.range(0, 5000, 1, 7).select(
        F.when(F.col("id") % 3 > 0, F.col("id") * 7919 % 1000).cast("string").alias("n")
    )
    bars = many.select(
        (F.lit("2025-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("n").cast("int"))).alias("tstamp"),
        F.lit(1.0).alias("close"),
    )
    got = [r.tstamp for r in in_time_order(bars).collect()]
    assert len(got) == 5000
    assert got == sorted(got, key=lambda t: (t is not None, t or datetime.min))


def test_first_per_key(spark):
    rows = spark.createDataFrame([("t", "b"), ("t", "a"), ("t", "a"), ("u", "c"), (" t", "z")], "key string, line string")
    once = first_per_key(rows, ["key"])
    want = {("t", "a"), ("u", "c"), (" t", "z")}
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in first_per_key(rows.repartition(5), ["key"]).collect()} == want
    assert {tuple(r) for r in first_per_key(once, ["key"]).collect()} == want
    assert first_per_key(rows.select("key"), ["key"]).count() == 3


def test_newest_snapshot_wins(spark):
    rows = spark.createDataFrame(
        [
            ("IBM", "t", 242.38, "20250923_040000"),
            ("IBM", "t", 242.40, "20250924_040000"),
            ("GE", "t", 1.0, "20250923_040000"),
        ],
        "symbol string, tstamp string, close double, snapshot string",
    )
    got = newest_snapshot(rows, ["symbol", "tstamp"]).collect()
    assert {(r.symbol, r.close) for r in got} == {("IBM", 242.40), ("GE", 1.0)}
    unnamed = rows.union(spark.createDataFrame([("IBM", "t", 1.0, None)], rows.schema))
    with pytest.raises(Exception, match="no snapshot"):
        newest_snapshot(unnamed, ["symbol", "tstamp"]).collect()


def test_sorted_lines_by_bytes(spark, lines_of):
    lines = lines_of("b,1,2,3,4,5", "B,1,2,3,4,5", " b,1,2,3,4,5", "é,1,2,3,4,5", "a,1,2,3,4,5")
    got = [r.line[0] for r in sorted_lines(clean_lines(lines)).collect()]
    assert got == sorted(got, key=lambda k: k.encode())


@pytest.mark.parametrize("exact", [None, (12, 2)])
def test_average(bars_of, exact):
    bars = bars_of(("2025-09-02", 1.0, 1), ("2025-09-02", 3.0, 1), ("2025-09-02", None, 1), ("2025-09-03", None, 1))
    means = in_key_order(avg_close(bars, exact=exact)).collect()
    assert [(r.timestamp.day, r.avg_close) for r in means] == [(2, 2.0), (3, None)]
    present = avg_close_present(bars, exact=exact).collect()
    assert [(r.timestamp.day, r.avg_close) for r in present] == [(2, 2.0)]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("close", [1.005, 1e12, float("nan"), float("inf")])
def test_exact_mean_stops_at_what_it_would_round(spark, bars_of, conf, close, ansi):
    conf(spark__sql__ansi__enabled=ansi)
    bars = bars_of(("2025-09-02", close, 1), ("2025-09-02", 0.5, 1))
    with pytest.raises(Exception, match="no decimal"):
        avg_close(bars, exact=(12, 2)).collect()
    if close == 1.005:
        assert avg_close(bars, exact=(12, 3)).first().avg_close == 1.505 / 2


def test_average_per_symbol(spark, bars_of):
    bars = bars_of(("2025-09-02", 1.0, 1), ("2025-09-02", 3.0, 1)).withColumn("symbol", F.concat(F.lit("S"), F.col("close").cast("int")))
    assert {tuple(r)[::2] for r in avg_close(bars).collect()} == {("S1", 1.0), ("S3", 3.0)}


def test_average_after_dedupe_is_the_close(bars_of):
    bars = bars_of(("2025-09-02", 1.0, 1), ("2025-09-02", 3.0, 1))
    assert avg_close(first_per_key(bars, ["tstamp"])).first().avg_close == 1.0


def test_exact_mean_does_not_depend_on_partitions(spark, sf_dir):
    from barmill.adapters import bars

    rows = bars(spark, sf_dir).withColumn("tstamp", F.date_trunc("year", "tstamp"))
    once = {tuple(r) for r in avg_close(rows, exact=(12, 2)).collect()}
    assert {tuple(r) for r in avg_close(rows.repartition(5), exact=(12, 2)).collect()} == once


def test_float32_mean(spark):
    pairs = spark.createDataFrame([("t", 0.1), ("t", 0.2), ("u", float("nan")), ("u", 1.0)], "tstamp string, close float")
    means = avg_close_float32(pairs)
    assert means.schema["avg_close"].dataType.simpleString() == "float"
    got = {r.tstamp: r.avg_close for r in means.collect()}
    assert abs(got["t"] - 0.15) < 1e-7
    assert got["u"] != got["u"]


def test_typed_bars_keep_bad_fields(lines_of):
    lines = lines_of(
        "2025-09-02 04:00:00,1,2,3,4,5",
        " 2025-09-02 04:00:00,1,2,3, 4 ,5",
        "never,1,2,3,abc,5",
        "2025-09-02 04:00:00,1,2,3,,5 ",
        "2025-09-02 04:00:00,NaN,1e3,-1,+1,5.0",
    ).withColumnRenamed("value", "line")
    t = datetime(2025, 9, 2, 4)
    got = [tuple(r) for r in typed_bars(lines).collect()]
    assert got[:4] == [
        (t, 1.0, 2.0, 3.0, 4.0, 5),
        (t, 1.0, 2.0, 3.0, 4.0, 5),
        (None, 1.0, 2.0, 3.0, None, 5),
        (t, 1.0, 2.0, 3.0, None, None),
    ]
    assert got[4][1] != got[4][1] and got[4][2:] == (1000.0, -1.0, 1.0, None)
    with pytest.raises(Exception, match="no timestamp: never"):
        typed_bars(lines, strict_timestamps=True).collect()
    assert typed_bars(lines.where("line NOT LIKE 'never%'"), strict_timestamps=True).count() == 4


def test_typed_bars_agree_with_the_file_scan(spark, sf_dir, tmp_path):
    from barmill.adapters import raw_lines
    from barmill.sources.files import scan_bars

    cleaned = clean_lines(raw_lines(spark, sf_dir)).select("line")
    cleaned.write.text(str(tmp_path / "cleaned"))
    read, parsed = scan_bars(spark, str(tmp_path / "cleaned")), typed_bars(cleaned)
    assert read.exceptAll(parsed).isEmpty() and parsed.exceptAll(read).isEmpty()
    assert read.schema == parsed.schema


_field = st.sampled_from(
    ["1", " 2", "3 ", "", "NaN", "Inf", "inf", "1e5", "1.5f", "--1", '"5"', '"6', '7"', '"a""b"', "\\", "#9", "x"]
    + ["2025-09-02 04:00:00", " 2025-09-02 04:00:00", "2025-09-02", "2025-09-02T04:00:00Z", "now", "9223372036854775808"]
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(_field, min_size=6, max_size=6), min_size=100, max_size=200))
def test_typed_bars_agree_with_the_file_scan_on_odd_fields(spark, tmp_path_factory, rows):
    from barmill.sources.files import scan_bars

    out = str(tmp_path_factory.mktemp("odd") / "lines")
    lines = spark.createDataFrame([(",".join(row),) for row in rows], "value string")
    cleaned = clean_lines(lines).select("line")
    cleaned.write.text(out)
    read = sorted(str(r) for r in scan_bars(spark, out).collect())
    assert sorted(str(r) for r in typed_bars(cleaned).collect()) == read


def test_load(lines_of):
    lines = lines_of(
        "timestamp,open,high,low,close,volume",
        "2025-09-02 04:10:00,1,1,1,1.5,64",
        "2025-09-02 04:05:00,1,1,1,1.5,0",
        "2025-09-02 04:00:00,1,1,1,1.5,522",
        "2025-09-02 04:00:00,1,1,1,1.5,522",
        "bad line",
        "never,1,1,1,1.5,7",
    )
    got = load_bars(lines).collect()
    assert [(r.tstamp, r.volume) for r in got] == [
        (None, 7),
        (datetime(2025, 9, 2, 4), 522),
        (datetime(2025, 9, 2, 4, 10), 64),
    ]
    assert row_count(load_bars(lines)).first().n_rows == 3


def test_interval_bars(spark):
    ticks = spark.createDataFrame(
        [
            ("IBM", "2025-09-02 04:04:59", 5.0, 1),
            ("IBM", "2025-09-02 04:00:00", 2.0, 9),
            ("IBM", "2025-09-02 04:00:00", 3.0, 2),
            ("IBM", "2025-09-02 04:03:00", 9.0, 3),
            ("IBM", "2025-09-02 04:05:00", 1.0, 4),
            ("GE", "2025-09-02 04:00:00", 7.0, 5),
        ],
        "symbol string, ts string, price double, tick_id bigint",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    want = {
        ("IBM", 0): (3.0, 9.0, 2.0, 5.0, 4),
        ("IBM", 5): (1.0, 1.0, 1.0, 1.0, 1),
        ("GE", 0): (7.0, 7.0, 7.0, 7.0, 1),
    }
    as_text = ticks.withColumn("tick_id", F.lpad(F.col("tick_id").cast("string"), 3, "0"))
    for given in (ticks, as_text, ticks.withColumn("tick_id", F.col("tick_id") - 6)):
        got = {(r.symbol, r.tstamp.minute): tuple(r)[2:] for r in interval_bars(given).collect()}
        assert got == want


def test_interval_bars_by_hash_aggregate(spark, sf_dir):
    from barmill.adapters import ticks

    text = plan(interval_bars(ticks(spark, sf_dir)), "simple")
    assert text.count("HashAggregate") == 2 and "Sort" not in text
