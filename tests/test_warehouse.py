import glob
import os
import re
from datetime import date

import duckdb
import pytest
from conftest import plan
from pyspark.sql import functions as F

from barmill.functions.times import time_range, with_day
from barmill.plans import load
from barmill.plans.compare import access_paths, compare_layouts, files_left, measure, report
from barmill.plans.exchange import table_files, vacuum
from barmill.plans.layout import by_day, compact, compacted_days, refresh_stats, write_warehouse
from barmill.plans.load import LoadTargets, load_bars, run_daily_load
from barmill.schema import BAR_OF_SYMBOL
from barmill.sources.files import scan_lines, scan_logs
from barmill.sources.tables import scan_warehouse
from barmill.streaming.landing import ingest_landing

HEADER = "timestamp,open,high,low,close,volume"


@pytest.fixture
def four_days(spark):
    """Bars of every five minutes over four days, in no order."""
    minutes = spark.range(0, 4 * 288, 1, 5).withColumn("m", (F.col("id") * 7 % (4 * 288) * 5).cast("int"))
    start = F.lit("2025-09-29 00:00:00").cast("timestamp_ntz")
    price = F.col("m").cast("double")
    return minutes.select(
        (start + F.make_dt_interval(mins="m")).alias("tstamp"),
        *(price.alias(c) for c in ("open", "high", "low", "close")),
        F.col("id").alias("volume"),
    )


def test_layout_by_day(spark, four_days, tmp_path):
    home = str(tmp_path / "t")
    write_warehouse(four_days, home)
    write_warehouse(four_days, home, volume_lookup=1000)
    days = sorted(os.path.basename(d) for d in glob.glob(f"{home}/tstamp_date=*"))
    assert days == [f"tstamp_date=2025-{d}" for d in ("09-29", "09-30", "10-01", "10-02")]
    stored = scan_warehouse(spark, home)
    assert stored.count() == four_days.count()
    assert stored.where(F.to_date("tstamp") != F.col("tstamp_date")).isEmpty()
    one = spark.read.parquet(glob.glob(f"{home}/tstamp_date=2025-09-30/*.parquet")[0])
    times = [r.tstamp for r in one.collect()]
    assert times == sorted(times)


def test_range_query_prunes_days_and_row_groups(spark, four_days, tmp_path):
    home = str(tmp_path / "t")
    write_warehouse(four_days, home)
    found = time_range(scan_warehouse(spark, home), "2025-10-01 12:00:00").select("tstamp", "close")
    text = plan(found)
    assert "PartitionFilters: [isnotnull(tstamp_date" in text
    assert "GreaterThan(tstamp,2025-10-01T12:00)" in text
    assert "ReadSchema: struct<tstamp:timestamp_ntz,close:double>" in text
    assert found.count() == 144 - 1 + 288
    left = files_left(spark, home, "2025-10-01 12:00:00")
    assert left.count() == 2
    text = plan(left)
    assert "PartitionFilters: [isnotnull(tstamp_date" in text and "ReadSchema: struct<path" in text


def test_missing_timestamps_are_kept(spark, bars_of, tmp_path):
    home = str(tmp_path / "t")
    write_warehouse(bars_of(("2025-09-02", 1.0, 1), ("?", 2.0, 1)), home)
    got = {(r.tstamp_date, r.close) for r in scan_warehouse(spark, home).collect()}
    assert got == {(date(2025, 9, 2), 1.0), (None, 2.0)}


@pytest.mark.parametrize("partitions", [8, 2500])
def test_a_day_with_most_rows_is_split(spark, conf, tmp_path, partitions):
    conf(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__shuffle__partitions=str(partitions),
    )
    hot = F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id") % 50).cast("int")
    bars = spark.range(0, 60000, 1, 12).select(
        (F.lit("2025-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=hot)).alias("tstamp"),
        F.xxhash64("id").alias("volume"),
    )
    write_warehouse(bars, str(tmp_path / "t"))
    files = glob.glob(f"{tmp_path}/t/tstamp_date=2025-01-01/*.parquet")
    assert len(files) >= 6
    assert scan_warehouse(spark, str(tmp_path / "t")).count() == 60000
    assert len(glob.glob(f"{tmp_path}/t/tstamp_date=2025-01-11/*.parquet")) == 1


def test_whole_table_is_replaced(spark, bars_of, conf, tmp_path):
    conf(spark__sql__sources__partitionOverwriteMode="dynamic")
    home = str(tmp_path / "t")
    write_warehouse(bars_of(("2025-09-02", 1.0, 1)), home)
    write_warehouse(bars_of(("2025-09-03", 2.0, 1)), home)
    assert [r.close for r in scan_warehouse(spark, home).collect()] == [2.0]


def test_volume_lookup_writes_bloom_filters(spark, tmp_path):
    bars = spark.range(0, 300000, 1, 2).select(
        F.lit("2025-01-01").cast("timestamp_ntz").alias("tstamp"), F.xxhash64("id").alias("volume")
    )
    write_warehouse(bars, str(tmp_path / "t"), volume_lookup=300000)
    files = duckdb.connect().execute(
        f"SELECT path_in_schema, bloom_filter_offset FROM parquet_metadata('{tmp_path}/t/*/*.parquet')"
    )
    found = {name for name, offset in files.fetchall() if offset is not None}
    assert found == {"volume"}


def test_layout_has_one_exchange(four_days):
    text = plan(by_day(four_days))
    assert "rangepartitioning" not in text
    assert text.count("hashpartitioning") == 1


def test_statistics(spark, four_days, tmp_path):
    write_warehouse(four_days, str(tmp_path / "t"), "bars_stats")
    assert refresh_stats(spark, "bars_stats").first().n_rows == 1152
    column = {r.info_name: r.info_value for r in spark.sql("DESCRIBE EXTENDED bars_stats volume").collect()}
    assert (column["min"], column["max"], column["num_nulls"]) == ("0", "1151", "0")
    write_warehouse(four_days, str(tmp_path / "t"), "bars_stats")
    assert refresh_stats(spark, "bars_stats", ["tstamp", "volume"]).first().n_rows == 1152
    spark.sql("DROP TABLE bars_stats")


def small_files(spark, bars, home, name):
    """A table with a file per day, but for one day that has six."""
    dated = with_day(bars)
    many = F.col("tstamp_date") == "2025-09-30"
    for part in (dated.where(~many).repartition("tstamp_date"), dated.where(many).repartition(6)):
        part.write.mode("append").partitionBy("tstamp_date").option("path", home).saveAsTable(name)


def days_of(home):
    return {d: set(os.listdir(f"{home}/{d}")) for d in os.listdir(home) if d.startswith("tstamp_date")}


def current(spark, name):
    """Files in use by day."""
    files = table_files(spark, name).where("current").collect()
    return {str(r.tstamp_date): {f.path for f in files if f.tstamp_date == r.tstamp_date} for r in files}


def test_compaction_rewrites_days_of_small_files_only(spark, four_days, tmp_path):
    home = str(tmp_path / "small")
    small_files(spark, four_days, home, "bars_small")
    before = current(spark, "bars_small")
    assert compact(spark, "bars_small").first().n_rows == 1152
    after = current(spark, "bars_small")
    assert {d for d in before if before[d] != after[d]} == {"2025-09-30"}
    assert len(before["2025-09-30"]) == 6 and len(after["2025-09-30"]) == 1
    table = spark.table("bars_small")
    assert table.drop("tstamp_date").exceptAll(four_days).isEmpty() and table.count() == 1152
    assert time_range(table, "2025-10-02").count() == 287
    # Nothing is left to do.
    compact(spark, "bars_small")
    assert current(spark, "bars_small") == after
    vacuum(spark, "bars_small", keep_seconds=0)
    assert current(spark, "bars_small") == after and len(glob.glob(f"{home}/**/*.parquet", recursive=True)) == 4
    assert table.count() == 1152
    spark.sql("DROP TABLE bars_small")


def test_compaction_reads_its_days_only_and_shuffles_once(spark, four_days, tmp_path):
    small_files(spark, four_days, str(tmp_path / "small"), "bars_scan")
    rows = compacted_days(spark, "bars_scan", 64 << 20)
    text = plan(rows)
    assert "PartitionFilters: [isnotnull(tstamp_date" in text and "dynamicpruningexpression(tstamp_date" in text
    assert len(set(re.findall(r"REBALANCE_PARTITIONS_BY_COL, \[plan_id=\d+", text))) == 1
    assert "SortMergeJoin" not in text and rows.count() == 288
    spark.sql("DROP TABLE bars_scan")


def test_only_the_days_loaded_are_replaced(spark, bars_of, tmp_path):
    home = str(tmp_path / "t")
    write_warehouse(bars_of(("2025-09-02", 1.0, 1), ("2025-09-03", 2.0, 1)), home, "bars_days")
    write_warehouse(bars_of(("2025-09-03", 3.0, 1), ("2025-09-04", 4.0, 1)), home, "bars_days", days_only=True)
    assert sorted(r.close for r in spark.table("bars_days").collect()) == [1.0, 3.0, 4.0]
    write_warehouse(bars_of(("2025-09-04", 5.0, 1)), home, days_only=True)
    assert sorted(r.close for r in scan_warehouse(spark, home).collect()) == [1.0, 3.0, 5.0]
    spark.sql("DROP TABLE bars_days")


def test_comparison(spark, four_days, tmp_path):
    plain, arranged = str(tmp_path / "plain"), str(tmp_path / "by_day")
    four_days.repartition(6).write.parquet(plain)
    write_warehouse(four_days, arranged)
    (row,) = compare_layouts(spark, plain, arranged, "2025-10-02", str(tmp_path / "logs"), 3).collect()
    assert row.runs == 3 and row.before_ms > 0 and row.after_ms > 0
    assert row.least_pct <= row.most_pct and row.reduction.endswith("%")
    assert (row.before_files, row.after_files) == (6, 1)
    assert sorted(os.listdir(tmp_path / "logs")) == ["0", "1", "2"]


def test_a_table_compared_with_itself_is_no_different(spark, four_days, tmp_path):
    home = str(tmp_path / "t")
    write_warehouse(four_days, home)
    (row,) = compare_layouts(spark, home, home, "2025-10-01", str(tmp_path / "logs"), 9).collect()
    assert not row.beyond_noise and row.least_pct < 0 < row.most_pct
    assert row.before_files == row.after_files == 2


def test_access_paths(spark, four_days, tmp_path):
    plain, arranged, logs = (str(tmp_path / name) for name in ("plain", "by_day", "logs"))
    four_days.repartition(6).write.parquet(plain)
    write_warehouse(four_days, arranged)
    for stage, path in (("before", plain), ("after", arranged)):
        measure(spark, spark.read.parquet(path), "2025-10-02", f"{logs}/1/{stage}.log")
    os.makedirs(f"{logs}/2")
    with open(f"{logs}/2/before.log", "w") as log:
        log.write("Execution Time: 3 ms\n")
    got = {(r.run, r.stage): r for r in access_paths(scan_logs(spark, logs)).collect()}
    assert got["1", "before"].partition_filters is None and "2025-10-02T00:00" in got["1", "before"].pushed_filters
    assert "tstamp_date" in got["1", "after"].partition_filters and got["1", "after"].scan == "parquet"
    assert got["2", "before"].scan is None
    assert report(scan_logs(spark, logs)).where("run = '1'").first().before_ms > 0


def test_report_tolerates_missing_logs(spark, tmp_path):
    for name, text in {
        "a/before": "Execution Time: 0.282 ms",
        "a/after": "Execution Time: 0.131 ms",
        "b/before": "Execution Time: 0.282 ms",
        "c/before": "Execution Time: 0 ms",
        "c/after": "Execution Time: 0.131 ms",
    }.items():
        path = tmp_path / f"{name}.log"
        path.parent.mkdir(exist_ok=True)
        path.write_text(text)
    got = {r.run: r for r in report(scan_logs(spark, str(tmp_path))).collect()}
    assert (got["a"].before_ms, got["a"].after_ms, got["a"].reduction) == (0.282, 0.131, "53.55%")
    assert (got["b"].after_ms, got["b"].reduction) == (None, "not available")
    assert (got["c"].reduction_pct, got["c"].reduction) == (None, "not available")


def test_landing_takes_each_dump_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    args = (spark, str(landing), str(tmp_path / "lines"), str(tmp_path / "checkpoint"))

    def land(name, *lines):
        (landing / name).write_text("".join(f"{line}\n" for line in lines))

    land("stock_IBM_20250923_040000.csv", "a,1", "b,2")
    assert ingest_landing(*args).count() == 2
    assert ingest_landing(*args).count() == 2
    land("stock_IBM_20250924_040000.csv", "b,3")
    land("notes.csv", "?")
    got = {tuple(r) for r in ingest_landing(*args, max_bytes_per_batch=1000).collect()}
    assert got == {
        ("a,1", "IBM", "20250923_040000"),
        ("b,2", "IBM", "20250923_040000"),
        ("b,3", "IBM", "20250924_040000"),
        ("?", None, None),
    }


def test_taken_dumps_are_archived(spark, tmp_path):
    landing, archive = tmp_path / "in" / "landing", tmp_path / "archive"
    landing.mkdir(parents=True)
    args = (spark, str(landing), str(tmp_path / "lines"), str(tmp_path / "checkpoint"))
    for day, lines in ((23, "a\n"), (24, "b\nc\n"), (25, "d\n")):
        (landing / f"stock_IBM_202509{day}_040000.csv").write_text(lines)
        taken = ingest_landing(*args, archive=str(archive))
    assert sorted(r.line for r in taken.collect()) == ["a", "b", "c", "d"]
    moved = [p.name for p in archive.rglob("stock_*.csv")]
    assert "stock_IBM_20250923_040000.csv" in moved
    left = [p.name for p in landing.glob("stock_*.csv")]
    assert len(moved) + len(left) == 3


def test_daily_load(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    first = [HEADER, "2025-09-30 04:00:00,1,1,1,1.5,5", "2025-09-30 04:05:00,1,1,1,2.5,0", "broken"]
    second = [HEADER, "2025-09-30 04:00:00,1,1,1,1.6,6", "2025-10-01 04:00:00,1,1,1,3.5,7"]
    (raw / "stock_IBM_20250930_100000.csv").write_text("\n".join(first))
    (raw / "stock_IBM_20251001_100000.csv").write_text("\n".join(second))
    targets = LoadTargets(
        *(str(tmp_path / d) for d in ("cleaned", "warehouse", "averages")), "bars_loaded", "bars_averaged"
    )
    for _ in range(2):
        lines = scan_lines(spark, str(raw / "stock_IBM_*.csv"), identity=True)
        row = run_daily_load(lines, targets).first()
        assert row.asDict() == {"n_rows": 2, "lines": 7, "headers": 2, "malformed": 1, "unnamed": 0}
    assert sorted(r.volume for r in spark.table("bars_loaded").collect()) == [6, 7]
    means = {r.timestamp: r.avg_close for r in spark.table("bars_averaged").collect()}
    assert means == {"2025-09-30 04:00:00": 1.6, "2025-09-30 04:05:00": 2.5, "2025-10-01 04:00:00": 3.5}
    assert time_range(spark.table("bars_loaded"), "2025-10-01").count() == 1

    # The same from the table that the dumps are ingested into.
    taken = ingest_landing(spark, str(raw), str(tmp_path / "lines"), str(tmp_path / "checkpoint"))
    assert run_daily_load(taken, targets, "line").first().n_rows == 2
    assert sorted(r.volume for r in spark.table("bars_loaded").collect()) == [6, 7]
    with pytest.raises(Exception, match="no timestamp"):
        bad = taken.withColumn("line", F.regexp_replace("line", "^2025-10", "soon"))
        run_daily_load(bad, targets, "line", strict_timestamps=True)
    for table in ("bars_loaded", "bars_averaged"):
        spark.sql(f"DROP TABLE {table}")


def test_symbols_do_not_take_each_others_bars(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for symbol, close in (("IBM", 1.5), ("BRK_B", 2.5)):
        times = ("2025-09-30 04:00:00", "2025-09-30 04:05:00")
        lines = [HEADER, *(f"{t},1,1,1,{close},5" for t in times)]
        (raw / f"stock_{symbol}_20250930_100000.csv").write_text("\n".join(lines))
    (raw / "stock_IBM_20250930_090000.csv").write_text("2025-09-30 04:00:00,1,1,1,9.5,5")
    (raw / "stock_latest.csv").write_text("2025-09-30 04:00:00,1,1,1,7.5,5")
    targets = LoadTargets(*(str(tmp_path / d) for d in ("cleaned", "warehouse", "averages")), "bars_two", "means_two")
    scanned = scan_lines(spark, str(raw), identity=True, strict=False)
    row = run_daily_load(scanned, targets).first()
    assert (row.n_rows, row.unnamed, row.headers) == (4, 1, 2)
    bars = scan_warehouse(spark, targets.warehouse, BAR_OF_SYMBOL)
    assert sorted((r.symbol, r.tstamp.minute, r.close) for r in bars.collect()) == [
        ("BRK_B", 0, 2.5),
        ("BRK_B", 5, 2.5),
        ("IBM", 0, 1.5),
        ("IBM", 5, 1.5),
    ]
    assert load_bars(scanned).count() == 4
    means = {(r.symbol, r.timestamp): r.avg_close for r in spark.table("means_two").collect()}
    assert means["BRK_B", "2025-09-30 04:00:00"] == 2.5 and len(means) == 4
    for table in ("bars_two", "means_two"):
        spark.sql(f"DROP TABLE {table}")


def test_load_into_a_relational_table(spark, lines_of, tmp_path, monkeypatch):
    seen = {}
    monkeypatch.setattr(load, "write_jdbc", lambda bars, options: seen.update(options, rows=bars.count()))
    options = {"url": "jdbc:x:y", "dbtable": "bars", "driver": "a.B", "numPartitions": "4"}
    paths = (str(tmp_path / d) for d in ("cleaned", "warehouse", "averages"))
    targets = LoadTargets(*paths, averages_table="means_jdbc", jdbc=options)
    row = run_daily_load(lines_of("2025-09-30 04:00:00,1,1,1,1.5,5", "2025-09-30 04:05:00,1,1,1,1,0"), targets).first()
    assert row.n_rows == 1 and seen == {**options, "rows": 1}
    assert not os.path.exists(targets.warehouse)
    spark.sql("DROP TABLE means_jdbc")


def test_nothing_landed_nothing_loaded(spark, lines_of, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    args = (spark, str(landing), str(tmp_path / "lines"), str(tmp_path / "checkpoint"))
    taken = ingest_landing(*args)
    assert taken.columns == ["line", "symbol", "snapshot"] and taken.count() == 0
    targets = LoadTargets(*(str(tmp_path / d) for d in ("cleaned", "warehouse", "averages")), "bars_none", "means_none")
    assert run_daily_load(taken, targets, "line").first().n_rows == 0
    assert scan_warehouse(spark, targets.warehouse, BAR_OF_SYMBOL).count() == 0
    (landing / "stock_IBM_20250923_040000.csv").write_text("2025-09-23 04:00:00,1,1,1,1.5,0\n")
    assert run_daily_load(ingest_landing(*args), targets, "line").first().n_rows == 0
    assert time_range(scan_warehouse(spark, targets.warehouse, BAR_OF_SYMBOL), "2025-01-01").count() == 0
    for table in ("bars_none", "means_none"):
        spark.sql(f"DROP TABLE {table}")
