from datetime import datetime

import pytest
from conftest import plan
from pyspark.sql import functions as F

from barmill.operators.averages import avg_close, avg_close_present, in_key_order
from barmill.operators.strict import clean_lines, first_per_key
from barmill.schema import AVERAGE, BAR
from barmill.sources import files, sinks, tables

HEADER = "timestamp,open,high,low,close,volume"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())


def test_line_scan_takes_all_dumps_and_line_ends(spark, tmp_path):
    put(tmp_path / "stock_IBM_20250923_040000.csv", f"{HEADER}\r\na,1\r\n\r\nb,2")
    put(tmp_path / "stock_BRK.B_20250924_040000.csv", f"{HEADER}\nc,3\rd,4\n")
    put(tmp_path / "other.csv", "x\n")
    lines = files.scan_lines(spark, str(tmp_path / "stock_*.csv"), identity=True)
    got = sorted((r.symbol, r.snapshot, r.value) for r in lines.collect())
    assert got == [
        ("BRK.B", "20250924_040000", "c,3"),
        ("BRK.B", "20250924_040000", "d,4"),
        ("BRK.B", "20250924_040000", HEADER),
        ("IBM", "20250923_040000", ""),
        ("IBM", "20250923_040000", "a,1"),
        ("IBM", "20250923_040000", "b,2"),
        ("IBM", "20250923_040000", HEADER),
    ]
    assert files.scan_lines(spark, str(tmp_path / "*.csv")).count() == 8


def test_typed_scan_is_permissive(spark, tmp_path):
    put(tmp_path / "a.csv", "2025-09-02 04:00:00,1,2,3,4,5\nnever,1,x,3,4,5.5\n2025-09-02 04:05:00,1,2\n")
    put(tmp_path / "b.csv", "2025-09-02 04:10:00,1,2,3,4,5,6\n\n")
    bars = files.scan_bars(spark, str(tmp_path))
    assert bars.schema == BAR
    got = sorted((tuple(r) for r in bars.collect()), key=str)
    assert got == sorted(
        [
            (datetime(2025, 9, 2, 4), 1.0, 2.0, 3.0, 4.0, 5),
            (None, 1.0, None, 3.0, 4.0, None),
            (datetime(2025, 9, 2, 4, 5), 1.0, 2.0, None, None, None),
            (datetime(2025, 9, 2, 4, 10), 1.0, 2.0, 3.0, 4.0, 5),
        ],
        key=str,
    )


def test_inferred_scan(spark, tmp_path):
    put(tmp_path / "stock_1.csv", f"{HEADER}\n2025-09-02 04:00:00,1,2,3,4,5\n2025-09-02 04:05:00,1,2,3,,5\n")
    put(tmp_path / "stock_2.csv", f"{HEADER}\n2025-09-02 04:00:00,1,2,3,6,5\n")
    bars = files.scan_inferred(spark, str(tmp_path / "stock_*.csv"))
    assert bars.count() == 3
    # The types follow the data: whole-number prices are integers.
    assert dict(bars.dtypes)["close"] == "int"
    means = avg_close_present(bars, "timestamp").collect()
    assert [(r.timestamp.minute, r.avg_close) for r in means] == [(0, 5.0)]


def test_text_sink_replaces(spark, lines_of, tmp_path):
    out = str(tmp_path / "cleaned")
    for lines in (lines_of("a,1,2,3,4,5", "b,1,2,3,4,5"), lines_of("c,1,2,3,4,5,", HEADER)):
        sinks.write_lines(first_per_key(clean_lines(lines), ["key"]), out)
    assert [r.value for r in files.scan_lines(spark, out).collect()] == ["c,1,2,3,4,5"]


def test_tab_sink(spark, bars_of, tmp_path):
    out = str(tmp_path / "means")
    means = avg_close(bars_of(("2025-09-02 04:01:00", 1.1, 1), ("2025-09-03", None, 1)))
    sinks.write_delimited(means, out)
    sinks.write_delimited(means, out)
    assert sorted(r.value for r in spark.read.text(out).collect()) == [
        "2025-09-02 04:01:00\t1.1",
        "2025-09-03 00:00:00\t",
    ]
    back = files.scan_bars(spark, out, AVERAGE, sep="\t")
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in means.collect()}


def test_managed_table_replaces(spark, bars_of):
    sinks.save_table(bars_of(("2025-09-02", 1.0, 1)), "stock")
    sinks.save_table(bars_of(("2025-09-03", 2.0, 1), ("2025-09-04", 3.0, 1)), "stock")
    assert sorted(r.close for r in tables.scan_table(spark, "stock").collect()) == [2.0, 3.0]
    spark.sql("DROP TABLE stock")


def test_external_table(spark, tmp_path):
    put(tmp_path / "stock_1.csv", f"{HEADER}\nt,1,2,3,4,5\n")
    put(tmp_path / "stock_2.csv", "u,1,x,3\n")
    for _ in range(2):
        bars = tables.external_bars(spark, "raw_bars", str(tmp_path / "stock_*.csv"))
    # No header is skipped: it is a row of its own, without values.
    assert {tuple(r) for r in bars.collect()} == {
        ("timestamp", None, None, None, None, None),
        ("t", 1.0, 2.0, 3.0, 4.0, 5),
        ("u", 1.0, None, 3.0, None, None),
    }
    spark.sql("DROP TABLE raw_bars")


@pytest.mark.parametrize("place", [None, "means"])
def test_table_from_query_goes_stale(spark, tmp_path, place):
    location = place and str(tmp_path / place)
    put(tmp_path / "in" / "1.csv", "u,1,1,1,3,1\nt,1,1,1,1,1\nt,1,1,1,2,1\n")
    cleaned = tables.external_bars(spark, "cleaned_bars", str(tmp_path / "in"))
    sinks.create_if_absent(in_key_order(avg_close(cleaned)), "mean_bars", location)
    assert [tuple(r) for r in spark.table("mean_bars").collect()] == [("t", 1.5), ("u", 3.0)]

    put(tmp_path / "in" / "2.csv", "v,1,1,1,9,1\n")
    spark.catalog.refreshTable("cleaned_bars")
    means = avg_close(tables.scan_table(spark, "cleaned_bars"))
    sinks.create_if_absent(means, "mean_bars", location)
    assert spark.table("mean_bars").count() == 2
    sinks.save_table(means, "mean_bars", location)
    assert spark.table("mean_bars").count() == 3
    for table in ("mean_bars", "cleaned_bars"):
        spark.sql(f"DROP TABLE {table}")


def test_view(spark, bars_of):
    sinks.register_view(bars_of(("2025-09-02", 1.0, 1)), "some_bars")
    assert spark.sql("SELECT count(*) FROM some_bars").first()[0] == 1


def test_jdbc_options():
    given = {"url": "jdbc:x:y", "dbtable": "bars", "driver": "a.B", "numPartitions": 8, "truncate": "true"}
    assert sinks.jdbc_options(**given) == {**given, "numPartitions": "8"}
    for name in ("url", "dbtable", "driver", "numPartitions"):
        with pytest.raises(ValueError, match=name):
            sinks.jdbc_options(**{k: v for k, v in given.items() if k != name})


def test_jdbc_writer_gets_the_options():
    seen = {}

    class Writer:
        def format(self, kind):
            seen["format"] = kind
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def mode(self, mode):
            seen["mode"] = mode
            return self

        def save(self):
            seen["saved"] = True

    class Bars:
        write = Writer()

    sinks.write_jdbc(Bars(), {"url": "jdbc:x:y", "dbtable": "bars", "driver": "a.B", "numPartitions": 4})
    assert seen == {
        "numPartitions": "4",
        "format": "jdbc",
        "url": "jdbc:x:y",
        "dbtable": "bars",
        "driver": "a.B",
        "mode": "overwrite",
        "saved": True,
    }


def test_jdbc_scan_gets_the_options():
    seen = {}

    class Reader:
        def format(self, kind):
            seen["format"] = kind
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def load(self):
            return "rows"

    class Session:
        read = Reader()

    options = {"url": "jdbc:x:y", "dbtable": "bars", "numPartitions": "8"}
    with pytest.raises(ValueError, match="partitionColumn, lowerBound, upperBound or single_task"):
        tables.scan_warehouse_jdbc(Session(), options)
    bounded = {**options, "partitionColumn": "volume", "lowerBound": "0", "upperBound": "9"}
    for given, single in ((options, True), (bounded, False)):
        seen.clear()
        assert tables.scan_warehouse_jdbc(Session(), given, single_task=single) == "rows"
        assert seen == {"format": "jdbc", **given}


def test_logs(spark, tmp_path):
    put(tmp_path / "one" / "before.log", "plan\nExecution Time: 0.282 ms\nExecution Time: 7 ms\n")
    put(tmp_path / "one" / "after.log", "Execution Time: 0.131 ms\n")
    put(tmp_path / "two" / "before.log", "Execution Time: 1.2.3 ms\nExecution Time: 5 ms\n")
    put(tmp_path / "three" / "after.log", "connection refused\n")
    logs = files.scan_logs(spark, str(tmp_path))
    got = {(r.run, r.stage): r.ms for r in files.first_timings(logs).collect()}
    assert got == {("one", "before"): 0.282, ("one", "after"): 0.131, ("two", "before"): None}


def test_first_timing_of_a_log_in_many_splits(spark, tmp_path, conf):
    conf(spark__sql__files__maxPartitionBytes="200b", spark__sql__files__openCostInBytes="0")
    times = "".join(f"Execution Time: {i}.5 ms\n" for i in range(500))
    put(tmp_path / "one" / "before.log", "x\n" * 300 + times)
    logs = files.scan_logs(spark, str(tmp_path))
    assert logs.select(F.spark_partition_id()).distinct().count() > 10
    assert [r.ms for r in files.first_timings(logs).collect()] == [0.5]


def test_no_work_folder_of_one_machine_on_a_cluster(spark, conf):
    from barmill.plans.workspace import work_dir

    assert work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

    class Conf:
        def __init__(self, master):
            self.master = master

        def get(self, name, default=None):
            return {"spark.master": self.master}.get(name, default)

    class Session:
        def __init__(self, master):
            self.conf = Conf(master)

    for master in ("yarn", "local-cluster[2,1,1024]", "spark://local:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            work_dir(Session(master), "x")
    for master in ("local", "local[4]", "local[*]"):
        assert "/barmill/x-" in work_dir(Session(master), "x")


def test_clean_up_removes_work_folders_and_their_tables(spark, monkeypatch, tmp_path):
    from barmill.plans import workspace
    from barmill.plans.workspace import clean_up, exists, work_dir

    monkeypatch.setattr(workspace, "_home", lambda spark: str(tmp_path / "shared" / "barmill"))
    home = work_dir(spark, "x")
    spark.range(3).write.option("path", home).saveAsTable("barmill_to_go")
    spark.range(3).write.saveAsTable("not_ours")
    assert exists(spark, home)
    clean_up(spark)
    assert not exists(spark, home) and not spark.catalog.tableExists("barmill_to_go")
    assert spark.catalog.tableExists("not_ours")
    spark.sql("DROP TABLE not_ours")


SYMBOLS = ("BRK_B", "^GSPC", "A B", "C+D%", "IBM")


def test_symbols_of_dump_names(spark, tmp_path):
    for n, symbol in enumerate(SYMBOLS):
        put(tmp_path / f"stock_{symbol}_2025093{n % 2}_100000.csv", f"{n}\n")
    lines = files.scan_lines(spark, str(tmp_path / "stock_*.csv"), identity=True)
    assert {tuple(r) for r in lines.collect()} == {
        (str(n), symbol, f"2025093{n % 2}_100000") for n, symbol in enumerate(SYMBOLS)
    }
    assert plan(lines, "simple").count("regexp_extract") == 1


def test_names_that_do_not_fit_are_refused_or_marked(spark, tmp_path):
    put(tmp_path / "stock_IBM_20250930_100000.csv", "a\n")
    put(tmp_path / "stock_IBM_latest.csv", "b\n")
    with pytest.raises(Exception, match="stock_IBM_latest"):
        files.scan_lines(spark, str(tmp_path), identity=True).collect()
    lines = files.scan_lines(spark, str(tmp_path), identity=True, strict=False)
    assert {tuple(r) for r in lines.collect()} == {("a", "IBM", "20250930_100000"), ("b", None, None)}


def test_no_log_folder_is_an_empty_report(spark, tmp_path):
    from barmill.plans.compare import report

    assert report(files.scan_logs(spark, str(tmp_path / "none"))).collect() == []
