"""Days exchanged as wholes, loads of what is new, and what is left when a run stops."""

import glob
import os
import re

import pytest
from conftest import plan
from pyspark.sql import functions as F

from barmill.functions.times import time_range, with_day
from barmill.plans import exchange, layout, merge
from barmill.plans.exchange import exchange_days, finish, rows_of_days, table_files, vacuum
from barmill.plans.layout import by_day, compact, write_warehouse
from barmill.plans.load import LoadTargets, run_daily_load
from barmill.plans.merge import HISTORY, create_history, history_bars, merge_lines, merged_days, new_rows

HEADER = "timestamp,open,high,low,close,volume"


@pytest.fixture
def table(spark, request):
    name = re.sub(r"\W", "_", request.node.name).lower()
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def closes(spark, table):
    return sorted((str(r.tstamp_date), r.close) for r in spark.table(table).collect())


OLD = [("2025-09-01 10:00:00", 1.0, 1), ("2025-09-02 10:00:00", 2.0, 1), ("2025-09-03 10:00:00", 3.0, 1), ("?", 4.0, 1)]
NEW = [("2025-09-02 10:00:00", 20.0, 1), ("2025-09-03 10:00:00", 30.0, 1), ("2025-09-03 11:00:00", 31.0, 1)]
NEW += [("2025-09-04 10:00:00", 40.0, 1), ("?", 50.0, 1), ("?", 51.0, 1)]
BEFORE = [("2025-09-01", 1.0), ("2025-09-02", 2.0), ("2025-09-03", 3.0), ("None", 4.0)]
AFTER = [("2025-09-01", 1.0), ("2025-09-02", 20.0), ("2025-09-03", 30.0), ("2025-09-03", 31.0), ("2025-09-04", 40.0)]
AFTER += [("None", 50.0), ("None", 51.0)]


def old_and_new(spark, bars_of, tmp_path, table):
    write_warehouse(bars_of(*OLD), str(tmp_path / "t"), table)
    return by_day(bars_of(*NEW))


def test_days_are_exchanged(spark, bars_of, tmp_path, table):
    new = old_and_new(spark, bars_of, tmp_path, table)
    assert closes(spark, table) == BEFORE
    exchange_days(new, table)
    assert closes(spark, table) == AFTER
    # Nothing that a reader may have open has gone.
    assert len(glob.glob(f"{tmp_path}/t/tstamp_date=*/*.parquet")) == 4
    exchange_days(new, table)
    assert closes(spark, table) == AFTER
    assert time_range(spark.table(table), "2025-09-03 10:30:00").count() == 2


def whole_days(seen):
    """Whether each day is as it was before or as it is after."""
    by_day = {}
    for day, close in seen:
        by_day.setdefault(day, []).append(close)
    for day, some in by_day.items():
        old, new = ([c for d, c in rows if d == day] for rows in (BEFORE, AFTER))
        assert some in (old, new)
    assert {d for d, _ in BEFORE} <= set(by_day)


@pytest.mark.parametrize("step", ["in the write", "mark_whole", "before the days", "first day", "third day", "last mark"])
@pytest.mark.parametrize("repair", ["again", "finish", "vacuum"])
def test_readers_never_see_half_a_day(spark, bars_of, tmp_path, table, monkeypatch, step, repair):
    new = old_and_new(spark, bars_of, tmp_path, table)
    switched, seen = [], []
    switch, mark = exchange.switch_day, exchange.make_folder

    def stop(*args):
        raise InterruptedError

    def stop_at_day(spark, name, folder, day):
        seen.append(closes(spark, name))
        if len(switched) == {"before the days": 0, "first day": 1, "third day": 2}[step]:
            raise InterruptedError
        switch(spark, name, folder, day)
        switched.append(day)

    def stop_at_done(spark, path):
        if path.endswith(exchange.DONE):
            raise InterruptedError
        mark(spark, path)

    with monkeypatch.context() as patch:
        if step == "mark_whole":
            patch.setattr(exchange, "mark_whole", stop)
        elif step == "in the write":
            patch.setattr(exchange, "stage_days", lambda rows, name: exchange.make_folder(
                spark, f"{exchange.location(spark, name)}/_days/0000000001/tstamp_date=2025-09-02") or stop())
        elif step == "last mark":
            patch.setattr(exchange, "make_folder", stop_at_done)
        else:
            patch.setattr(exchange, "switch_day", stop_at_day)
        with pytest.raises(InterruptedError):
            exchange_days(new, table)
    for rows in (*seen, closes(spark, table)):
        whole_days(rows)
    committed = step not in ("in the write", "mark_whole")
    if repair == "again":
        exchange_days(new, table)
    elif repair == "finish":
        finish(spark, table)
    else:
        vacuum(spark, table, keep_seconds=0)
    expected = AFTER if committed or repair == "again" else BEFORE
    assert closes(spark, table) == sorted(expected)
    vacuum(spark, table, keep_seconds=0)
    assert closes(spark, table) == sorted(expected)
    files = table_files(spark, table)
    assert files.where("NOT current").isEmpty()
    assert files.select("folder").distinct().count() == len({d for d, _ in expected})


def test_vacuum_leaves_what_is_young(spark, bars_of, tmp_path, table):
    new = old_and_new(spark, bars_of, tmp_path, table)
    exchange_days(new, table)
    vacuum(spark, table)
    assert table_files(spark, table).where("NOT current").count() == 3
    for n in range(3):
        exchange_days(new, table)
    vacuum(spark, table, keep_seconds=0)
    assert closes(spark, table) == AFTER
    assert sorted(os.listdir(tmp_path / "t" / "_days")) == ["0000000004"]
    exchange_days(new, table)
    assert sorted(os.listdir(tmp_path / "t" / "_days")) == ["0000000004", "0000000005"]


@pytest.mark.parametrize("step", ["stage_days", "mark_whole", "switch_days", "refresh_stats"])
def test_a_compaction_that_stops_is_made_good(spark, bars_of, tmp_path, table, monkeypatch, step):
    rows = [(f"2025-09-0{1 + n % 3} 10:00:{n:02}", float(n), 1) for n in range(30)] + [("?", 1.0, 1), ("?", 2.0, 1)]
    dated = with_day(bars_of(*rows))
    dated.where("close < 3 AND tstamp IS NOT NULL").coalesce(1).write.partitionBy("tstamp_date").option(
        "path", str(tmp_path / "t")
    ).saveAsTable(table)
    dated.where("close >= 3 OR tstamp IS NULL").repartition(3).write.mode("append").partitionBy("tstamp_date").option(
        "path", str(tmp_path / "t")
    ).saveAsTable(table)

    def stop(*args):
        raise InterruptedError

    with monkeypatch.context() as patch:
        patch.setattr(layout if step == "refresh_stats" else exchange, step, stop)
        with pytest.raises(InterruptedError):
            compact(spark, table)
    assert spark.table(table).count() == 32
    assert compact(spark, table).first().n_rows == 32
    assert spark.table(table).drop("tstamp_date").exceptAll(bars_of(*rows)).isEmpty()
    files = table_files(spark, table).where("current").groupBy("tstamp_date").count().collect()
    assert len(files) == 4 and all(r["count"] == 1 for r in files)


def lines_at(spark, *rows):
    """(symbol, snapshot, line)"""
    return spark.createDataFrame([(line, symbol, snapshot) for symbol, snapshot, line in rows], "value string, symbol string, snapshot string")


def bar(day, hour, close, volume=5):
    return f"2025-09-{day:02} {hour:02}:00:00,1,1,1,{close},{volume}"


LOADS = [
    [("A", "s1", HEADER), ("A", "s1", bar(1, 10, 1.5)), ("A", "s1", bar(2, 10, 2.5)), ("B", "s1", bar(2, 10, 9.5)), ("A", "s1", "odd,1,1,1,1,1")],
    [("A", "s3", bar(2, 10, 2.7)), ("A", "s3", bar(2, 11, 2.8, 0)), ("A", "s3", "broken"), (None, None, bar(2, 12, 1))],
    [("A", "s2", bar(2, 10, 2.6)), ("A", "s2", bar(2, 11, 2.9)), ("B", "s2", bar(3, 9, 3.5)), ("A", "s2", "odd,1,1,1,2,2")],
    [("B", "s4", bar(2, 10, 7.5, 0))],
]


def history(spark, table):
    return sorted(tuple(r) for r in spark.table(table).select(*HISTORY.names[:4], "close", "volume").collect())


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 2, 1, 0), (2, 0, 0, 3, 1, 2)])
def test_loads_in_any_order_are_one_load(spark, tmp_path, table, order):
    for n in order:
        merge_lines(lines_at(spark, *LOADS[n]), table, str(tmp_path / "h"))
    merged, bars = history(spark, table), sorted(map(tuple, history_bars(spark, table).collect()), key=repr)
    spark.sql(f"DROP TABLE {table}")
    report = merge_lines(lines_at(spark, *(row for some in LOADS for row in some)), table, str(tmp_path / "one"))
    assert merged == history(spark, table)
    assert bars == sorted(map(tuple, history_bars(spark, table).collect()), key=repr)
    assert report.first().asDict() == {"lines": 14, "headers": 1, "malformed": 1, "unnamed": 1, "days": 4, "keys": 6}
    # The bars are those of the plain load.
    targets = LoadTargets(*(str(tmp_path / d) for d in ("cleaned", "warehouse", "means")), f"{table}_plain", f"{table}_means")
    run_daily_load(lines_at(spark, *(row for some in LOADS for row in some)), targets)
    assert sorted(map(tuple, spark.table(f"{table}_plain").select(*history_bars(spark, table).columns).collect()), key=repr) == bars
    for name in ("plain", "means"):
        spark.sql(f"DROP TABLE {table}_{name}")


def test_a_merge_reads_and_writes_only_the_days_it_touches(spark, tmp_path, table):
    merge_lines(lines_at(spark, *LOADS[0]), table, str(tmp_path / "h"))
    before = {r.tstamp_date: r.folder for r in table_files(spark, table).where("current").collect()}
    rows = new_rows(lines_at(spark, ("A", "s5", bar(2, 10, 8.5))))
    rows.write.parquet(str(tmp_path / "staged"))
    staged = spark.read.schema(HISTORY).parquet(str(tmp_path / "staged"))
    text = plan(merged_days(spark, table, staged))
    assert "dynamicpruningexpression(tstamp_date" in text
    assert "(CAST" not in text.split("PartitionFilters")[1].split("\n")[0]
    assert rows_of_days(spark, table, staged.select("tstamp_date")).count() == 2
    merge_lines(lines_at(spark, ("A", "s5", bar(2, 10, 8.5))), table, str(tmp_path / "h"))
    after = {r.tstamp_date: r.folder for r in table_files(spark, table).where("current").collect()}
    assert [str(d) for d in before if before[d] != after[d]] == ["2025-09-02"]


def test_one_symbol_and_day_with_most_lines(spark, tmp_path, table):
    hot = [("A", f"s{n % 7}", bar(2, n % 24, n)) for n in range(600)]
    for some in (hot[:300] + LOADS[0], hot[300:], LOADS[2]):
        merge_lines(lines_at(spark, *some), table, str(tmp_path / "h"))
    merged = history(spark, table)
    best = {}
    for symbol, snapshot, line in [*hot, *LOADS[0], *LOADS[2]]:
        key = (symbol, line.split(",")[0])
        if line != HEADER and (key not in best or (snapshot, ) > best[key][:1] or (snapshot == best[key][0] and line < best[key][1])):
            best[key] = (snapshot, line)
    assert {(r[0], r[1]): (r[2], r[3]) for r in merged} == best and len(merged) == len(best)


def test_nothing_new(spark, tmp_path, table):
    assert merge_lines(lines_at(spark), table, str(tmp_path / "h")).first().days == 0
    assert history_bars(spark, table).count() == 0
    merge_lines(lines_at(spark, *LOADS[0]), table, str(tmp_path / "h"))
    before = history(spark, table)
    merge_lines(lines_at(spark, ("A", "s9", "broken")), table, str(tmp_path / "h"))
    assert history(spark, table) == before


@pytest.mark.parametrize("step", ["stage_days", "mark_whole", "switch_days"])
def test_a_merge_that_stops_is_made_good(spark, tmp_path, table, monkeypatch, step):
    merge_lines(lines_at(spark, *LOADS[0]), table, str(tmp_path / "h"))
    with monkeypatch.context() as patch:
        patch.setattr(exchange, step, lambda *args: (_ for _ in ()).throw(InterruptedError()))
        with pytest.raises(InterruptedError):
            merge_lines(lines_at(spark, *LOADS[1]), table, str(tmp_path / "h"))
    for some in (LOADS[1], LOADS[2], LOADS[3]):
        merge_lines(lines_at(spark, *some), table, str(tmp_path / "h"))
    merged = history(spark, table)
    spark.sql(f"DROP TABLE {table}")
    create_history(spark, table, str(tmp_path / "one"))
    merge_lines(lines_at(spark, *(row for load in LOADS for row in load)), table, str(tmp_path / "one"))
    assert merged == history(spark, table)


def test_a_load_of_some_days_exchanges_them(spark, tmp_path, table):
    targets = LoadTargets(
        *(str(tmp_path / d) for d in ("cleaned", "warehouse", "means")), table, f"{table}_means", days_only=True
    )
    run_daily_load(lines_at(spark, *LOADS[0]), targets)
    assert run_daily_load(lines_at(spark, *LOADS[1][:1], *LOADS[2][2:3]), targets).first().n_rows == 4
    assert sorted(r.close for r in spark.table(table).collect()) == [1.0, 1.5, 2.7, 3.5]
    spark.sql(f"DROP TABLE {table}_means")
