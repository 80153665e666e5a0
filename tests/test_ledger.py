"""Ingest by a ledger: each file once, in bounded batches, whatever a stopped run has left."""

import os

import pytest
from conftest import plan
from pyspark.sql import Window
from pyspark.sql import functions as F

from barmill.plans.load import LoadTargets, run_daily_load
from barmill.streaming import ledger as ops
from barmill.streaming.landing import ingest_landing
from barmill.streaming.ledger import ingest_by_ledger, ingested, ledger


@pytest.fixture
def home(tmp_path):
    (tmp_path / "landing").mkdir()

    class Home:
        landing, taken, archive = (str(tmp_path / d) for d in ("landing", "taken", "archive"))

        @staticmethod
        def land(name, *lines):
            (tmp_path / "landing" / name).write_text("".join(f"{line}\n" for line in lines))

    return Home


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


NAMES = [f"stock_{s}_2025092{d}_040000.csv" for d in range(3) for s in ("IBM", "^GSPC", "A+ B%", "x[1-2]{3}*?")]


def test_each_dump_is_taken_once(spark, home):
    assert ingest_by_ledger(spark, home.landing, home.taken).count() == 0
    for n, name in enumerate(NAMES[:5]):
        home.land(name, f"{n},1", f"{n},2")
    first = rows(ingest_by_ledger(spark, home.landing, home.taken))
    assert len(first) == 10 and ("3,2", "x[1-2]{3}*?", "20250920_040000") in first
    assert rows(ingest_by_ledger(spark, home.landing, home.taken)) == first
    home.land("notes.csv", "?")
    for n, name in enumerate(NAMES[5:], 5):
        home.land(name, f"{n},1", f"{n},2")
    taken = rows(ingest_by_ledger(spark, home.landing, home.taken))
    assert len(taken) == 25 and ("?", None, None) in taken
    assert taken == rows(ingest_landing(spark, home.landing, home.taken + "2", home.taken + "3"))
    files = ledger(spark, home.taken)
    assert files.count() == 13 and files.select("batch").distinct().count() == 2
    assert not os.path.exists(f"{home.taken}/open")


@pytest.mark.parametrize("bound", [{"most_files": 2}, {"most_bytes": 9}, {"most_files": 3, "most_bytes": 1}])
def test_batches_are_bounded(spark, home, bound):
    for n, name in enumerate(NAMES[:5]):
        home.land(name, f"{n},1", f"{n},2")
    assert ingest_by_ledger(spark, home.landing, home.taken, **bound).count() == 10
    sizes = [r["count"] for r in ledger(spark, home.taken).groupBy("batch").count().collect()]
    assert sum(sizes) == 5 and max(sizes) <= bound.get("most_files", 3)
    assert ("most_bytes" not in bound) or max(sizes) <= (3 if bound["most_bytes"] > 1 else 1)


def test_a_file_that_was_replaced_is_another(spark, home):
    home.land(NAMES[0], "a")
    ingest_by_ledger(spark, home.landing, home.taken)
    home.land(NAMES[0], "b", "c")
    assert [r[0] for r in rows(ingest_by_ledger(spark, home.landing, home.taken))] == ["a", "b", "c"]


def test_taken_files_are_archived(spark, home):
    for n, name in enumerate(NAMES):
        home.land(name, f"{n}")
        if n % 5 == 4:
            ingest_by_ledger(spark, home.landing, home.taken, archive=home.archive)
    taken = ingest_by_ledger(spark, home.landing, home.taken, archive=home.archive)
    assert sorted(int(r.line) for r in taken.collect()) == list(range(len(NAMES)))
    assert os.listdir(home.landing) == []
    moved = [f for _, _, files in os.walk(home.archive) for f in files if f.endswith(".csv") and not f.startswith(".")]
    assert sorted(moved) == sorted(NAMES)
    # A file that comes back under its old name with other lines is taken; the ledger is read in part only.
    home.land(NAMES[0], "back")
    assert ingest_by_ledger(spark, home.landing, home.taken).count() == len(NAMES) + 1


STEPS = ["open_batch", "in the lines", "write_batch", "commit_batch", "close_batch"]


@pytest.mark.parametrize("step", STEPS)
def test_a_run_that_stops_is_made_good(spark, home, monkeypatch, step):
    home.land(NAMES[0], "a", "b")
    before = rows(ingest_by_ledger(spark, home.landing, home.taken))
    home.land(NAMES[1], "c")
    home.land(NAMES[2], "d")

    def stop(*args, **kwargs):
        raise InterruptedError

    def half(spark, home_, batch):
        spark.createDataFrame([("c", "?", "?")], "line string, symbol string, snapshot string").write.parquet(
            f"{home_}/lines/batch={batch.name}"
        )
        raise InterruptedError

    with monkeypatch.context() as patch:
        patch.setattr(ops, "write_batch" if step == "in the lines" else step, half if step == "in the lines" else stop)
        with pytest.raises(InterruptedError):
            ingest_by_ledger(spark, home.landing, home.taken)
    # Until it is made good, a reader sees the batches before it, or at the very end this one whole.
    assert rows(ingested(spark, home.taken)) == before
    home.land(NAMES[3], "e")
    taken = ingest_by_ledger(spark, home.landing, home.taken)
    assert [r[0] for r in rows(taken)] == ["a", "b", "c", "d", "e"]
    assert rows(ingest_by_ledger(spark, home.landing, home.taken)) == rows(taken)
    assert ledger(spark, home.taken).count() == 4


def test_a_batch_run_twice_adds_nothing(spark, home):
    home.land(NAMES[0], "a", "b")
    batch = ops.open_batch(spark, home.landing, home.taken)
    for _ in range(2):
        ops.write_batch(spark, home.taken, batch)
        ops.commit_batch(spark, home.taken, batch)
    ops.close_batch(spark, home.taken, batch)
    assert ingested(spark, home.taken).count() == 2 and ledger(spark, home.taken).count() == 1


def test_no_task_gets_all_files_to_number_them(spark):
    files = spark.range(0, 50_000, 1, 10).selectExpr("cast(id AS string) AS path", "id AS length", "timestamp_micros(id) AS modificationTime")
    order = Window.orderBy("modificationTime", "path")
    first = files.withColumn("_n", F.row_number().over(order)).where("_n <= 100")
    assert "TakeOrderedAndProject" in plan(first) or "LocalLimit" in plan(first) or "WindowGroupLimit" in plan(first)


def test_reading_is_a_scan(spark, home):
    home.land(NAMES[0], "a")
    text = plan(ingest_by_ledger(spark, home.landing, home.taken))
    assert "Exchange" not in text and "Join" not in text


def test_what_was_ingested_is_loaded(spark, home, tmp_path):
    home.land(NAMES[0], "2025-09-30 04:00:00,1,1,1,1.5,5", "broken")
    home.land(NAMES[4], "2025-09-30 04:00:00,1,1,1,2.5,5")
    taken = ingest_by_ledger(spark, home.landing, home.taken)
    targets = LoadTargets(*(str(tmp_path / d) for d in ("c", "w", "a")), "bars_ledger", "means_ledger")
    row = run_daily_load(taken, targets, "line").first()
    assert (row.n_rows, row.lines, row.malformed) == (1, 3, 1)
    assert spark.table("bars_ledger").first().close == 2.5
    for name in ("bars_ledger", "means_ledger"):
        spark.sql(f"DROP TABLE {name}")
