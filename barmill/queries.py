"""The registered queries: every operator on the given tables.

Each takes the session and the folder of the tables and runs over all their rows. Those about
sources and sinks write into a new folder of the shared work folder and read back from there.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barmill import adapters
from barmill.functions.times import parse_timestamp, retype_timestamp, time_range, with_day
from barmill.functions.timings import percent_reduction, timing_ms
from barmill.operators import averages, lenient, strict
from barmill.operators import bars as ops
from barmill.plans.compare import access_paths, compare_layouts, files_left, measure, report
from barmill.plans.curve import CELL, meets, rows_by_zones, write_curve, write_zones, zones
from barmill.plans.exchange import exchange_days, table_files, vacuum
from barmill.plans.layout import by_day, compact, data_files, refresh_stats, write_warehouse
from barmill.plans.load import LoadTargets, load_bars, run_daily_load
from barmill.plans.means import add_states, fold, means
from barmill.plans.merge import history_bars, merge_lines
from barmill.plans import rejects
from barmill.plans.stages import run_resumable_load
from barmill.plans.workspace import make_folder, work_dir
from barmill.schema import AVERAGE, DAY, FIELDS, SYMBOL
from barmill.sources import files, infer, sinks, tables
from barmill.streaming.bars import TICK, build_bars, open_bars
from barmill.streaming.bars import late_ticks as count_late
from barmill.streaming.landing import ingest_landing
from barmill.streaming.ledger import ingest_by_ledger

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

RANGE_START = "2000-01-01"
LATE_START = "2024-01-20 12:00:00"
#: Precision and scale of the closes in ``lineitem``.
MONEY = (12, 2)


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _fresh(name: str) -> str:
    return f"barmill_{name}_{uuid4().hex}"


# --- text to rows


@query
def strict_line_clean(spark, sf_dir):
    return strict.clean_lines(adapters.raw_lines(spark, sf_dir))


@query
def lenient_close_pairs(spark, sf_dir):
    return lenient.close_pairs(adapters.raw_lines(spark, sf_dir))


@query
def parse_counters(spark, sf_dir):
    return lenient.parse_counters(adapters.raw_lines(spark, sf_dir))


def _classified(spark, sf_dir):
    home = work_dir(spark, "classified")
    lines = adapters.feed_lines(spark, sf_dir)
    for part in range(2):
        rejects.write_classified(lines.where(F.length("value") % 2 == part), home, load=f"part-{part}")
    return home


@query
def rejected_lines(spark, sf_dir):
    """Rejected lines with reason, symbol and snapshot, after two loads."""
    return rejects.rejected_lines(spark, _classified(spark, sf_dir))


@query
def reject_counts(spark, sf_dir):
    """The counters, from what the loads have written."""
    return rejects.counted_lines(spark, _classified(spark, sf_dir))


@query
def rejects_by_dump(spark, sf_dir):
    return rejects.rejects_by_dump(spark, _classified(spark, sf_dir))


@query
def first_line_per_key(spark, sf_dir):
    """One line per untrimmed text key."""
    return strict.first_per_key(strict.clean_lines(adapters.raw_lines(spark, sf_dir)), ["key"])


@query
def first_row_per_key(spark, sf_dir):
    """One typed bar per timestamp."""
    return strict.first_per_key(adapters.bars(spark, sf_dir), ["tstamp"])


@query
def newest_snapshot_rows(spark, sf_dir):
    """One line per symbol and key across overlapping snapshots, from the newest one."""
    cleaned = strict.clean_lines(adapters.feed_lines(spark, sf_dir))
    return strict.newest_snapshot(cleaned, ["symbol", "key"])


@query
def typed_line_fields(spark, sf_dir):
    """Cleaned lines typed field by field; what does not parse is NULL."""
    return ops.typed_bars(strict.clean_lines(adapters.raw_lines(spark, sf_dir)).select("line"))


@query
def timestamp_parse(spark, sf_dir):
    texts = adapters.timestamp_texts(spark, sf_dir)
    return texts.withColumn("parsed", parse_timestamp(F.col("tstamp")))


@query
def timestamp_retype(spark, sf_dir):
    text_bars = adapters.bars(spark, sf_dir).withColumn("tstamp", F.col("tstamp").cast("string"))
    return retype_timestamp(text_bars)


@query
def tstamp_date(spark, sf_dir):
    return with_day(adapters.ticks(spark, sf_dir).select("tick_id", "ts"), "ts")


# --- averages


@query
def avg_close(spark, sf_dir):
    return averages.in_key_order(averages.avg_close(adapters.bars(spark, sf_dir), exact=MONEY))


@query
def avg_close_plain(spark, sf_dir):
    """The mean that the load takes, on groups of many rows."""
    return averages.avg_close(adapters.whole_bars(spark, sf_dir))


@query
def avg_close_with_gaps(spark, sf_dir):
    """Days without any close stay, with a NULL mean."""
    gaps = adapters.bars_with_gaps(spark, sf_dir)
    return averages.in_key_order(averages.avg_close(gaps, exact=MONEY))


@query
def avg_close_nonnull(spark, sf_dir):
    """Days without any close vanish."""
    return averages.avg_close_present(adapters.bars_with_gaps(spark, sf_dir), exact=MONEY)


@query
def mean_states(spark, sf_dir):
    """Means from the states of three loads, two of them folded, one of those added a second time."""
    home = work_dir(spark, "states")
    bars = adapters.bars_with_gaps(spark, sf_dir)
    for n, part in enumerate((0, 1, 0, 2)):
        loaded = bars.where(F.pmod(F.xxhash64("tstamp", "close"), F.lit(3)) == part)
        add_states(loaded, home, f"load-{part}", MONEY)
        if n == 1:
            fold(spark, home)
    return means(spark, home)


@query
def avg_close_deduplicated(spark, sf_dir):
    """After one row per timestamp is kept, the mean is the close itself."""
    one_each = strict.first_per_key(adapters.bars(spark, sf_dir), ["tstamp"])
    return averages.in_key_order(averages.avg_close(one_each))


@query
def avg_close_float32(spark, sf_dir):
    return averages.avg_close_float32(lenient.close_pairs(adapters.raw_lines(spark, sf_dir)))


# --- bars


@query
def volume_filter_order(spark, sf_dir):
    return ops.in_time_order(ops.traded(adapters.bars(spark, sf_dir)))


@query
def tstamp_range(spark, sf_dir):
    return time_range(adapters.bars(spark, sf_dir), RANGE_START)


@query
def row_count(spark, sf_dir):
    return ops.row_count(adapters.bars(spark, sf_dir))


@query
def view_count(spark, sf_dir):
    sinks.register_view(adapters.bars(spark, sf_dir), "barmill_bars_view")
    return spark.sql("SELECT count(*) AS n_rows FROM barmill_bars_view")


@query
def interval_bars(spark, sf_dir):
    return ops.interval_bars(adapters.ticks(spark, sf_dir), "1 hour")


@query
def load_traded_bars(spark, sf_dir):
    """The flagship: raw lines to the bars that are loaded, in one plan."""
    return load_bars(adapters.raw_lines(spark, sf_dir))


# --- timings


@query
def timing_extract(spark, sf_dir):
    logs = adapters.timing_logs(spark, sf_dir)
    return logs.select(
        "run",
        timing_ms(F.col("before_log")).alias("before_ms"),
        timing_ms(F.col("after_log")).alias("after_ms"),
    )


@query
def timing_reduction(spark, sf_dir):
    times = timing_extract(spark, sf_dir)
    reduction = percent_reduction(F.col("before_ms"), F.col("after_ms"))
    return times.select("run", reduction.alias("reduction_pct"))


# --- sources, sinks and tables


@query
def text_clean_round_trip(spark, sf_dir):
    """Scan text files, clean, write twice, scan the result."""
    home = work_dir(spark, "text_clean")
    adapters.raw_lines(spark, sf_dir).write.text(f"{home}/raw")
    lines = files.scan_lines(spark, f"{home}/raw/part-*")
    cleaned = strict.sorted_lines(strict.first_per_key(strict.clean_lines(lines), ["key"]))
    sinks.write_lines(cleaned, f"{home}/cleaned")
    sinks.write_lines(cleaned, f"{home}/cleaned")
    return files.scan_lines(spark, f"{home}/cleaned").withColumnRenamed("value", "line")


@query
def csv_round_trip(spark, sf_dir):
    """Bars to headerless comma text and back by the fixed schema."""
    home = work_dir(spark, "csv")
    sinks.write_delimited(adapters.bars(spark, sf_dir), home, sep=",")
    return files.scan_bars(spark, home)


@query
def header_csv_average(spark, sf_dir):
    """Bars with a header in every file, types inferred, averaged per timestamp."""
    home = work_dir(spark, "header")
    gaps = adapters.bars_with_gaps(spark, sf_dir).withColumnRenamed("tstamp", "timestamp")
    sinks.write_delimited(gaps, home, sep=",", header=True)
    inferred = files.scan_inferred(spark, f"{home}/part-*")
    means = averages.avg_close_present(inferred, "timestamp", exact=MONEY)
    return means.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query
def inferred_types(spark, sf_dir):
    """Types of the fields of files with a header that come in three parts, one of them twice."""
    home = work_dir(spark, "types")
    rows = adapters.mixed_fields(spark, sf_dir)
    for part in (0, 1, 1, 2):
        some = rows.where(F.col("part") == part).drop("part")
        some.write.mode("overwrite").option("header", True).csv(f"{home}/raw/{part}")
        infer.add_types(spark, f"{home}/raw/{part}", f"{home}/states", f"part{part}")
    return infer.inferred_types(spark, f"{home}/states")


@query
def tsv_round_trip(spark, sf_dir):
    """Means to tab-separated text and back."""
    home = work_dir(spark, "tsv")
    sinks.write_delimited(averages.avg_close(adapters.bars(spark, sf_dir), exact=MONEY), home)
    return files.scan_bars(spark, home, AVERAGE, sep="\t")


@query
def float_pair_round_trip(spark, sf_dir):
    """32-bit means as tab-separated key and value, and back."""
    home = work_dir(spark, "pairs")
    pairs = lenient.close_pairs(adapters.raw_lines(spark, sf_dir))
    sinks.write_delimited(averages.avg_close_float32(pairs), home)
    return spark.read.schema("tstamp string, avg_close float").csv(home, sep="\t")


@query
def table_round_trip(spark, sf_dir):
    """Bars to a catalog table, replaced once, and scanned."""
    name = _fresh("bars")
    home = work_dir(spark, "table")
    bars = adapters.bars(spark, sf_dir)
    sinks.save_table(bars, name, f"{home}/first")
    sinks.save_table(bars, name, f"{home}/second")
    return tables.scan_table(spark, name)


@query
def external_table_scan(spark, sf_dir):
    """Raw lines under an external table; whatever does not fit its types is NULL."""
    home = work_dir(spark, "external")
    adapters.raw_lines(spark, sf_dir).write.text(home)
    return tables.external_bars(spark, _fresh("raw"), f"{home}/part-*")


@query
def sql_tables(spark, sf_dir):
    """External table over cleaned text, then a table of means by SQL, made once."""
    home = work_dir(spark, "sql")
    sinks.write_delimited(adapters.bars(spark, sf_dir), f"{home}/cleaned", sep=",")
    cleaned, means = _fresh("cleaned"), _fresh("means")
    tables.external_bars(spark, cleaned, f"{home}/cleaned")
    total = "cast(sum(cast(close AS decimal(12,2))) AS double)"
    by_time = spark.sql(
        f"SELECT tstamp AS timestamp, {total} / count(close) AS avg_close FROM {cleaned} GROUP BY 1 ORDER BY 1"
    )
    sinks.create_if_absent(by_time, means, f"{home}/means")
    # The table is there by now, so this leaves it as it is.
    sinks.create_if_absent(by_time.where("false"), means, f"{home}/means")
    return tables.scan_table(spark, means)


# --- warehouse


@query
def range_pruned(spark, sf_dir):
    """The range query on the table laid out by day; only the days in range are opened."""
    home = work_dir(spark, "warehouse")
    write_warehouse(adapters.intraday_bars(spark, sf_dir), home, volume_lookup=10)
    return time_range(tables.scan_warehouse(spark, home), LATE_START).select(*FIELDS)


@query
def stats_refresh(spark, sf_dir):
    name = _fresh("bars")
    write_warehouse(adapters.intraday_bars(spark, sf_dir), work_dir(spark, "stats"), name)
    return refresh_stats(spark, name)


@query
def compacted_table(spark, sf_dir):
    """A table of small files, as loads in several parts leave them, rewritten."""
    name, home = _fresh("small"), work_dir(spark, "compact")
    dated = with_day(adapters.intraday_bars(spark, sf_dir))
    for part in range(3):
        writer = dated.where(F.col("volume") % 3 == part).write.partitionBy("tstamp_date")
        writer.mode("append").option("path", f"{home}/small").saveAsTable(name)
    compact(spark, name)
    return spark.table(name).select(*FIELDS)


@query
def vacuumed_table(spark, sf_dir):
    """A table whose days were exchanged twice and vacuumed: its bars, each with the number of folders
    that are left of its day."""
    name, home = _fresh("exchanged"), work_dir(spark, "exchange")
    dated = with_day(adapters.intraday_bars(spark, sf_dir))
    write_warehouse(dated.where("volume < 5").withColumn("close", F.lit(0.0)), f"{home}/table", name)
    exchange_days(by_day(dated.where("volume < 5")), name)
    exchange_days(by_day(dated), name)
    vacuum(spark, name, keep_seconds=0)
    left = table_files(spark, name).groupBy(DAY).agg(F.count_distinct("folder").alias("n_folders"))
    return spark.table(name).join(left, DAY).select(*FIELDS, "n_folders")


LARGE = (9, 9)


@query
def curve_layout(spark, sf_dir):
    """Bars of one volume, from a table on a curve over time, volume and symbol."""
    home = work_dir(spark, "curve")
    write_curve(adapters.symbol_bars(spark, sf_dir), f"{home}/bars")
    write_zones(spark, f"{home}/bars", CELL, f"{home}/zones")
    rows, zone_rows = spark.read.parquet(f"{home}/bars"), spark.read.parquet(f"{home}/zones")
    return rows_by_zones(rows, zone_rows, CELL, volumes=LARGE).select(SYMBOL, *FIELDS)


@query
def zone_pruned(spark, sf_dir):
    """Late bars of a volume from a table by day, its days chosen by the zones of its files."""
    home = work_dir(spark, "zones")
    write_warehouse(adapters.intraday_bars(spark, sf_dir), f"{home}/bars")
    write_zones(spark, f"{home}/bars", DAY, f"{home}/zones")
    rows, zone_rows = spark.read.parquet(f"{home}/bars"), spark.read.parquet(f"{home}/zones")
    return rows_by_zones(rows, zone_rows, DAY, after=LATE_START, volumes=LARGE).select(*FIELDS)


@query
def curve_files(spark, sf_dir):
    """For a filter on the volume: the rows it finds, and whether fewer files have to be opened for them on the
    curve than by day."""
    home = work_dir(spark, "both")
    bars = adapters.symbol_bars(spark, sf_dir)
    write_warehouse(bars, f"{home}/by_day")
    write_curve(bars, f"{home}/curve")
    sides = []
    for layout, by in (("by_day", DAY), ("curve", CELL)):
        rows = spark.read.parquet(f"{home}/{layout}")
        opened = zones(rows, by).where(meets(volumes=LARGE)).select(F.lit(0).alias("n"), F.lit(layout).alias("file_of"))
        found = rows.where(F.col("volume").between(*LARGE)).select(F.lit(1).alias("n"), F.lit(layout).alias("file_of"))
        sides += [opened, found]
    both = sides[0].union(sides[1]).union(sides[2]).union(sides[3])
    n_files = [F.count_if((F.col("n") == 0) & (F.col("file_of") == layout)) for layout in ("curve", "by_day")]
    n_rows = F.count_if((F.col("n") == 1) & (F.col("file_of") == "curve"))
    return both.agg(n_rows.alias("n_rows"), (n_files[0] < n_files[1]).alias("fewer_files"))


def _two_layouts(spark, sf_dir, home):
    bars = adapters.intraday_bars(spark, sf_dir)
    bars.write.parquet(f"{home}/before")
    write_warehouse(bars, f"{home}/after")
    return {"before": f"{home}/before", "after": f"{home}/after"}


@query
def layout_compare(spark, sf_dir):
    """The range query on a plain table and on one laid out by day: times, reduction, files.

    Times differ from run to run, so there is no SQL for this one; ``layout_rows`` has.
    """
    home = work_dir(spark, "compare")
    paths = _two_layouts(spark, sf_dir, home)
    return compare_layouts(spark, paths["before"], paths["after"], LATE_START, f"{home}/logs")


@query
def layout_rows(spark, sf_dir):
    """What the comparison rests on: rows found in either layout, whether it opens fewer files than
    the layout has, and whether it was timed."""
    home = work_dir(spark, "layouts")
    sides = []
    for stage, path in _two_layouts(spark, sf_dir, home).items():
        bars = spark.read.parquet(path)
        measure(spark, bars, LATE_START, f"{home}/logs/0/{stage}.log")
        found = time_range(bars, LATE_START).agg(F.count(F.lit(1)).alias("n_rows"))
        left = files_left(spark, path, LATE_START).agg(F.count(F.lit(1)).alias("n_left"))
        all_files = data_files(spark, path).agg(F.count(F.lit(1)).alias("n_files"))
        one = [df.withColumn("stage", F.lit(stage)) for df in (found, left, all_files)]
        sides.append(one[0].join(one[1], "stage").join(one[2], "stage"))
    timed = files.first_timings(files.scan_logs(spark, f"{home}/logs")).select("stage", "ms")
    return (
        sides[0]
        .union(sides[1])
        .join(timed, "stage", "left")
        .select("stage", "n_rows", (F.col("n_left") < F.col("n_files")).alias("fewer_files"), (F.coalesce("ms", F.lit(0.0)) > 0).alias("timed"))
    )


@query
def access_path(spark, sf_dir):
    """From the logs of the range query on either layout: whether folders are chosen, and what is pushed to the files."""
    home = work_dir(spark, "access")
    for stage, path in _two_layouts(spark, sf_dir, home).items():
        measure(spark, spark.read.parquet(path), LATE_START, f"{home}/logs/0/{stage}.log")
    paths = access_paths(files.scan_logs(spark, f"{home}/logs"))
    return paths.select(
        "stage",
        "scan",
        F.col("partition_filters").isNotNull().alias("folders_chosen"),
        F.col("pushed_filters").contains("GreaterThan(tstamp,2024-01-20T12:00").alias("time_pushed"),
        (F.size(F.split("read_schema", ",")) == len(FIELDS)).alias("six_fields"),
    )


@query
def log_report(spark, sf_dir):
    """Timing logs as files, a pair per kind of event; some lack the timing or the second log."""
    home = work_dir(spark, "logs")
    adapters.log_lines(spark, sf_dir).write.partitionBy("run", "log").text(home)
    return report(files.scan_logs(spark, home))


# --- landing and the whole load


@query
def landing_ingest(spark, sf_dir):
    """Dumps that land one after the other, each taken once."""
    home = work_dir(spark, "landing")
    landing, table = f"{home}/landing", f"{home}/lines"
    lines = adapters.feed_lines(spark, sf_dir)
    make_folder(spark, landing)
    for snapshots in ((), adapters.SNAPSHOTS[:2], (), adapters.SNAPSHOTS[2:]):
        adapters.write_dumps(lines, landing, snapshots)
        taken = ingest_landing(spark, landing, table, f"{home}/checkpoint")
    return taken


def _streamed(spark, sf_dir):
    home = work_dir(spark, "ticks")
    ticks = adapters.ticks_in_landings(spark, sf_dir)
    for n in range(3):
        ticks.where(F.col("landing") == n).drop("landing").write.mode("append").parquet(f"{home}/landing/{n}")
        final = build_bars(spark, f"{home}/landing", f"{home}/built", "1 hour")
    return home, final.union(open_bars(spark, f"{home}/built"))


@query
def streamed_bars(spark, sf_dir):
    """Bars from a stream over three landings, some ticks late: the final ones and those still open."""
    return _streamed(spark, sf_dir)[1]


@query
def late_ticks(spark, sf_dir):
    """How many ticks came too late for their bar."""
    home, bars = _streamed(spark, sf_dir)
    taken = spark.read.schema(TICK).option("recursiveFileLookup", True).parquet(f"{home}/landing")
    return count_late(taken, bars, "1 hour")


@query
def ledger_ingest(spark, sf_dir):
    """The same dumps taken by a ledger."""
    home = work_dir(spark, "ledger")
    lines = adapters.feed_lines(spark, sf_dir)
    make_folder(spark, f"{home}/landing")
    for snapshots in ((), adapters.SNAPSHOTS[:2], (), adapters.SNAPSHOTS[2:]):
        adapters.write_dumps(lines, f"{home}/landing", snapshots)
        taken = ingest_by_ledger(spark, f"{home}/landing", f"{home}/taken", archive=f"{home}/archive")
    return taken


def _loaded(spark, lines, home):
    targets = LoadTargets(
        cleaned=f"{home}/cleaned",
        warehouse=f"{home}/warehouse",
        averages=f"{home}/averages",
        warehouse_table=_fresh("bars"),
        averages_table=_fresh("means"),
    )
    run_daily_load(lines, targets)
    return targets


@query
def daily_load(spark, sf_dir):
    """All stages of the load over files, ending with the scan of the warehouse table."""
    home = work_dir(spark, "load")
    adapters.intraday_lines(spark, sf_dir).write.text(f"{home}/raw")
    targets = _loaded(spark, files.scan_lines(spark, f"{home}/raw"), home)
    return tables.scan_table(spark, targets.warehouse_table).select(*FIELDS)


def _resumed(spark, sf_dir):
    home = work_dir(spark, "resumed")
    adapters.intraday_lines(spark, sf_dir).write.text(f"{home}/raw")
    targets = LoadTargets(
        *(f"{home}/{name}" for name in ("cleaned", "warehouse", "averages")), _fresh("bars"), _fresh("means")
    )
    runs = []
    for until in ("cleaned", "means", None, None):
        runs.append(run_resumable_load(spark, [f"{home}/raw"], targets, f"{home}/records", identity=False, until=until))
    return targets, runs


@query
def resumed_load(spark, sf_dir):
    """The load in four runs, each of which goes on where the one before has ended."""
    targets, _ = _resumed(spark, sf_dir)
    return tables.scan_table(spark, targets.warehouse_table).select(*FIELDS)


@query
def resumed_stages(spark, sf_dir):
    """Which stages the four runs ran, and how many rows the load reported each time."""
    _, runs = _resumed(spark, sf_dir)
    numbered = [r.withColumn("run", F.lit(n)) for n, r in enumerate(runs)]
    every = numbered[0].union(numbered[1]).union(numbered[2]).union(numbered[3])
    rows = F.get_json_object("report", "$.n_rows").cast("bigint")
    return every.select("run", "stage", "ran", rows.alias("n_rows"))


def _load_of_symbols(spark, sf_dir):
    home = work_dir(spark, "symbols")
    adapters.write_dumps(adapters.intraday_feed(spark, sf_dir), f"{home}/raw")
    return _loaded(spark, files.scan_lines(spark, f"{home}/raw/stock_*.csv", identity=True), home)


@query
def daily_load_symbols(spark, sf_dir):
    """The load of overlapping dumps of several symbols with bars at the same times."""
    targets = _load_of_symbols(spark, sf_dir)
    return tables.scan_table(spark, targets.warehouse_table).select(SYMBOL, *FIELDS)


@query
def incremental_load(spark, sf_dir):
    """Dumps merged one snapshot after the other, the earliest one last."""
    name, home = _fresh("history"), work_dir(spark, "merge")
    lines = adapters.intraday_feed(spark, sf_dir)
    for n, snapshot in enumerate((1, 2, 0)):
        adapters.write_dumps(lines, f"{home}/raw{n}", adapters.SNAPSHOTS[snapshot : snapshot + 1])
        merge_lines(files.scan_lines(spark, f"{home}/raw{n}/stock_*.csv", identity=True), name, f"{home}/history")
    return history_bars(spark, name).select(SYMBOL, *FIELDS)


@query
def daily_load_means(spark, sf_dir):
    """The means that such a load leaves."""
    return tables.scan_table(spark, _load_of_symbols(spark, sf_dir).averages_table)
