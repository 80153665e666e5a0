"""The registered queries in SQL, for the check against another engine."""

from __future__ import annotations

_BARS = """
bars AS (
  SELECT l_shipdate AS tstamp, l_extendedprice AS open, l_extendedprice + l_tax AS high,
         l_extendedprice - l_discount AS low, l_extendedprice AS close,
         CAST(l_quantity AS BIGINT) % 10 AS volume
  FROM lineitem)"""

_GAPS = """
gaps AS (
  SELECT l_shipdate AS tstamp,
         CASE WHEN dayofyear(l_shipdate) % 7 = 0 OR l_linenumber % 3 = 0 THEN NULL
              ELSE l_extendedprice END AS close
  FROM lineitem)"""

# Lines from the text of the fields in money, as (head, price, volume) and a fault.
_LINES = r"""
raw AS (
  SELECT symbol, snapshot,
         CASE fault
           WHEN 0 THEN 'timestamp,open,high,low,close,volume'
           WHEN 1 THEN ''
           WHEN 2 THEN head || price
           WHEN 3 THEN head || price || ',' || volume || ',x'
           WHEN 4 THEN head || 'abc,' || volume
           WHEN 5 THEN head || ',' || volume
           WHEN 6 THEN head || price || ',' || volume || ','
           WHEN 7 THEN ' ' || head || price || ',' || volume
           WHEN 8 THEN chr(9) || head || price || ',' || volume || ' '
           WHEN 9 THEN head || ' ' || price || ',' || volume
           ELSE head || price || ',' || volume
         END AS value
  FROM money)"""

_MONEY = "CAST(CAST({0} AS DECIMAL(12,2)) AS VARCHAR)"


def _raw(table: str, time: str, price: str, high: str, low: str, volume: str, fault: str, feed: str) -> str:
    head = " || ',' || ".join(
        [f"strftime({time}, '%Y-%m-%d %H:%M:%S')", *(_MONEY.format(v) for v in (price, high, low))]
    )
    return f"""
money AS (
  SELECT {fault} % 11 AS fault, {feed}, {head} || ',' AS head,
         {_MONEY.format(price)} AS price, CAST({volume} AS VARCHAR) AS volume
  FROM {table}),{_LINES}"""


def _feed(symbol: str, snapshot: str) -> str:
    return f"""['BRK_B', '^GSPC', 'A+ B%'][{symbol} % 3 + 1] AS symbol,
         ['20250901_040000', '20250902_040000', '20250903_040000'][{snapshot} % 3 + 1] AS snapshot"""


_RAW = _raw(
    "lineitem",
    "l_shipdate",
    "l_extendedprice",
    "l_extendedprice + l_tax",
    "l_extendedprice - l_discount",
    "CAST(l_quantity AS BIGINT) % 10",
    "l_orderkey",
    _feed("l_orderkey", "l_linenumber"),
)
_FEED_RAW = _raw(
    "events",
    "date_trunc('minute', ts)",
    "value",
    "value + 1",
    "value - 1",
    "user_id % 10",
    "event_id",
    _feed("user_id", "event_id"),
)
_INTRADAY_RAW = _raw(
    "events",
    "ts",
    "value",
    "value + 1",
    "value - 1",
    "user_id % 10",
    "event_id",
    "NULL AS symbol, NULL AS snapshot",
)
_INTRADAY_BARS = """
bars AS (
  SELECT ts AS tstamp, value AS open, value + 1 AS high, value - 1 AS low, value AS close,
         user_id % 10 AS volume
  FROM events)"""

_STRICT_ROWS = """,
strict AS (
  SELECT string_split(value, ',')[1] AS key, rtrim(value, ',') AS line, symbol, snapshot
  FROM raw
  WHERE NOT starts_with(value, 'timestamp') AND len(string_split(rtrim(value, ','), ',')) = 6)"""
_STRICT = _RAW + _STRICT_ROWS

# Types of the permissive CSV scan: blanks around a timestamp or a price are let through, blanks
# around a whole number are not.
_FIELDS = r"""
  TRY_CAST(trim({p}[1], ' ' || chr(9)) AS TIMESTAMP) AS tstamp,
  TRY_CAST(trim({p}[2]) AS DOUBLE) AS open, TRY_CAST(trim({p}[3]) AS DOUBLE) AS high,
  TRY_CAST(trim({p}[4]) AS DOUBLE) AS low, TRY_CAST(trim({p}[5]) AS DOUBLE) AS close,
  CASE WHEN regexp_full_match({p}[6], '[0-9]+') THEN CAST({p}[6] AS BIGINT) END AS volume"""

_TYPED = "SELECT" + _FIELDS.format(p="string_split(line, ',')")

_LENIENT = (
    _RAW
    + r""",
trimmed AS (
  SELECT regexp_replace(value, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') AS line FROM raw),
parts AS (
  SELECT line, string_split(rtrim(line, ','), ',') AS p FROM trimmed),
classed AS (
  SELECT trim(p[1]) AS tstamp, TRY_CAST(trim(p[5]) AS FLOAT) AS close,
         CASE WHEN starts_with(line, 'timestamp') OR line = '' THEN 'Skipped'
              WHEN len(p) < 6 OR p[1] = '' OR p[5] = '' THEN 'InvalidLineLength'
              WHEN TRY_CAST(trim(p[5]) AS FLOAT) IS NULL THEN 'InvalidNumberFormat'
              ELSE 'ValidLines' END AS line_class
  FROM parts)"""
)

# The same with the whole line and where it came from.
_REJECTED = (
    _RAW
    + r""",
trimmed AS (
  SELECT value, symbol, snapshot, regexp_replace(value, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') AS line FROM raw),
parts AS (
  SELECT *, string_split(rtrim(line, ','), ',') AS p FROM trimmed),
rejected AS (
  SELECT CASE WHEN len(p) < 6 OR p[1] = '' OR p[5] = '' THEN 'InvalidLineLength'
              ELSE 'InvalidNumberFormat' END AS line_class, symbol, snapshot, value AS line
  FROM parts
  WHERE NOT starts_with(line, 'timestamp') AND line <> ''
    AND (len(p) < 6 OR p[1] = '' OR p[5] = '' OR TRY_CAST(trim(p[5]) AS FLOAT) IS NULL))"""
)

_MEAN = "CAST(sum(CAST(close AS DECIMAL(12,2))) AS DOUBLE) / count(close) AS avg_close"
_FLOAT_MEAN = "CAST(avg(CAST(close AS DOUBLE)) AS FLOAT) AS avg_close"

_AVG_CLOSE = f"WITH {_BARS} SELECT tstamp AS timestamp, {_MEAN} FROM bars GROUP BY tstamp"
_AVG_PRESENT = f"""WITH {_GAPS}
SELECT tstamp AS timestamp, {_MEAN} FROM gaps WHERE close IS NOT NULL GROUP BY tstamp"""
_AVG_GAPS = f"""WITH {_GAPS}
SELECT tstamp AS timestamp,
       CASE WHEN count(close) > 0
            THEN CAST(sum(CAST(close AS DECIMAL(12,2))) AS DOUBLE) / count(close) END AS avg_close
FROM gaps GROUP BY tstamp"""
_AVG_FLOAT = f"""WITH {_LENIENT}
SELECT tstamp, {_FLOAT_MEAN} FROM classed WHERE line_class = 'ValidLines' GROUP BY tstamp"""
_ALL_BARS = f"WITH {_BARS} SELECT * FROM bars"
_COUNT = "SELECT count(*) AS n_rows FROM lineitem"
_LATE = f"WITH {_INTRADAY_BARS} SELECT * FROM bars WHERE tstamp > TIMESTAMP '2024-01-20 12:00:00'"
_LOADED = f"""
one AS (SELECT key, min(line) AS line FROM strict GROUP BY key),
typed AS ({_TYPED} FROM one)
SELECT * FROM typed WHERE volume > 0"""
_FIRST_BAR = """
one AS (
  SELECT * FROM bars
  QUALIFY row_number() OVER (PARTITION BY tstamp ORDER BY open, high, low, close, volume) = 1)"""

_LOGS = r"""
logs AS (
  SELECT event_id AS run,
         CASE WHEN event_id % 7 = 0 THEN 'connection refused'
              ELSE 'Execution Time: ' || CAST(CAST(value AS DECIMAL(12,3)) AS VARCHAR) || ' ms' END AS b,
         CASE WHEN event_id % 11 = 0 THEN NULL
              WHEN event_id % 13 = 0 THEN 'Execution Time: 0 ms'
              WHEN event_id % 17 = 0 THEN 'Execution Time: 1.2.3 ms'
              ELSE 'Execution Time: '
                || CAST(CAST(user_id % 400 + value AS DECIMAL(12,3)) AS VARCHAR) || ' ms' END AS a
  FROM events),
times AS (
  SELECT run,
         TRY_CAST(regexp_extract(b, 'Execution Time: ([0-9.]+) ms', 1) AS DOUBLE) AS before_ms,
         TRY_CAST(regexp_extract(a, 'Execution Time: ([0-9.]+) ms', 1) AS DOUBLE) AS after_ms
  FROM logs)"""

_NEWEST = f"""WITH {_FEED_RAW} {_STRICT_ROWS},
one AS (
  SELECT symbol, key, line FROM strict
  QUALIFY row_number() OVER (PARTITION BY symbol, key ORDER BY snapshot DESC, line) = 1),
typed AS (SELECT symbol, key, {_FIELDS.format(p="string_split(line, ',')")} FROM one)"""

_COUNTERS = f"""WITH {_LENIENT}
SELECT count(*) AS "ProcessedLines",
       count(*) FILTER (line_class = 'Skipped') AS "Skipped",
       count(*) FILTER (line_class = 'ValidLines') AS "ValidLines",
       count(*) FILTER (line_class = 'InvalidNumberFormat') AS "InvalidNumberFormat",
       CAST(0 AS BIGINT) AS "InvalidLineFormat",
       count(*) FILTER (line_class = 'InvalidLineLength') AS "InvalidLineLength"
FROM classed"""

# Ticks with the landing they come in, and whether the watermark has passed their hour by then.
_LANDINGS = """
arrived AS (
  SELECT event_type AS symbol, ts, value, event_id, time_bucket(INTERVAL '1 hour', ts) AS tstamp,
         CASE WHEN ts < TIMESTAMP '2024-01-11' THEN CASE WHEN event_id % 97 = 0 THEN 2 ELSE 0 END
              WHEN ts >= TIMESTAMP '2024-01-20 23:00:00' AND ts < TIMESTAMP '2024-01-21' AND event_id % 5 = 0 THEN 2
              WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS landing
  FROM events WHERE ts IS NOT NULL),
told AS (
  SELECT *, tstamp + INTERVAL '1 hour' <= (
           SELECT max(b.ts) - INTERVAL '10 minutes' FROM arrived b WHERE b.landing < a.landing) AS late
  FROM arrived a)"""

ORACLE: dict[str, str] = {
    "strict_line_clean": f"WITH {_STRICT} SELECT key, line FROM strict",
    "lenient_close_pairs": f"""WITH {_LENIENT}
SELECT tstamp, close FROM classed WHERE line_class = 'ValidLines'""",
    "parse_counters": _COUNTERS,
    "reject_counts": _COUNTERS,
    "rejected_lines": f"WITH {_REJECTED} SELECT * FROM rejected",
    "rejects_by_dump": f"""WITH {_REJECTED}
SELECT symbol, snapshot, line_class, count(*) AS n_lines, min(line) AS example FROM rejected GROUP BY ALL""",
    "first_line_per_key": f"WITH {_STRICT} SELECT key, min(line) AS line FROM strict GROUP BY key",
    "first_row_per_key": f"WITH {_BARS}, {_FIRST_BAR} SELECT * FROM one",
    "newest_snapshot_rows": f"""WITH {_STRICT}
SELECT symbol, key, line, snapshot FROM strict
QUALIFY row_number() OVER (PARTITION BY symbol, key ORDER BY snapshot DESC, line) = 1""",
    "typed_line_fields": f"WITH {_STRICT} {_TYPED} FROM strict",
    "timestamp_parse": """
WITH texts AS (
  SELECT o_orderkey,
         CASE o_orderkey % 7
           WHEN 0 THEN 'unknown'
           WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
           WHEN 2 THEN strftime(o_orderdate, '%Y') || '-02-30 00:00:00'
           WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
           ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS tstamp
  FROM orders)
SELECT o_orderkey, tstamp, try_strptime(tstamp, '%Y-%m-%d %H:%M:%S') AS parsed FROM texts""",
    "timestamp_retype": _ALL_BARS,
    "tstamp_date": "SELECT event_id AS tick_id, ts, CAST(ts AS DATE) AS tstamp_date FROM events",
    "avg_close": _AVG_CLOSE,
    "avg_close_with_gaps": _AVG_GAPS,
    "mean_states": _AVG_GAPS,
    "avg_close_nonnull": _AVG_PRESENT,
    "avg_close_deduplicated": f"""WITH {_BARS}, {_FIRST_BAR}
SELECT tstamp AS timestamp, close AS avg_close FROM one""",
    "avg_close_float32": _AVG_FLOAT,
    "volume_filter_order": f"WITH {_BARS} SELECT * FROM bars WHERE volume > 0",
    "tstamp_range": f"WITH {_BARS} SELECT * FROM bars WHERE tstamp > TIMESTAMP '2000-01-01'",
    "row_count": _COUNT,
    "view_count": _COUNT,
    "interval_bars": """
SELECT event_type AS symbol, time_bucket(INTERVAL '1 hour', ts) AS tstamp,
       arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
       arg_max(value, (ts, event_id)) AS close, count(*) AS volume
FROM events GROUP BY ALL""",
    "load_traded_bars": f"WITH {_STRICT}, {_LOADED}",
    "timing_extract": f"WITH {_LOGS} SELECT run, before_ms, after_ms FROM times",
    "timing_reduction": f"""WITH {_LOGS}
SELECT run, CASE WHEN before_ms > 0 AND after_ms <> 0
                 THEN (before_ms - after_ms) / before_ms * 100 END AS reduction_pct
FROM times""",
    "text_clean_round_trip": f"WITH {_STRICT} SELECT min(line) AS line FROM strict GROUP BY key",
    "csv_round_trip": _ALL_BARS,
    "header_csv_average": _AVG_PRESENT,
    "tsv_round_trip": _AVG_CLOSE,
    "float_pair_round_trip": _AVG_FLOAT,
    "table_round_trip": _ALL_BARS,
    "external_table_scan": f"""WITH {_RAW},
parts AS (SELECT string_split(value, ',') AS p FROM raw WHERE value <> '')
SELECT p[1] AS tstamp, {_FIELDS.format(p="p").split(" AS tstamp,", 1)[1]} FROM parts""",
    "sql_tables": f"""WITH {_BARS}
SELECT strftime(tstamp, '%Y-%m-%d %H:%M:%S') AS timestamp, {_MEAN} FROM bars GROUP BY tstamp""",
    "range_pruned": _LATE,
    "stats_refresh": "SELECT count(*) AS n_rows FROM events",
    "compacted_table": f"WITH {_INTRADAY_BARS} SELECT * FROM bars",
    "curve_layout": """
SELECT event_type AS symbol, ts AS tstamp, value AS open, value + 1 AS high, value - 1 AS low, value AS close,
       user_id % 10 AS volume
FROM events WHERE user_id % 10 = 9""",
    "zone_pruned": f"""WITH {_INTRADAY_BARS}
SELECT * FROM bars WHERE tstamp > TIMESTAMP '2024-01-20 12:00:00' AND volume = 9""",
    "curve_files": "SELECT count(*) AS n_rows, true AS fewer_files FROM events WHERE user_id % 10 = 9",
    "vacuumed_table": f"WITH {_INTRADAY_BARS} SELECT *, CAST(1 AS BIGINT) AS n_folders FROM bars",
    "resumed_load": f"WITH {_INTRADAY_RAW} {_STRICT_ROWS}, {_LOADED}",
    "resumed_stages": f"""WITH {_INTRADAY_RAW} {_STRICT_ROWS}, loaded AS (SELECT * FROM (WITH {_LOADED.lstrip()}))
SELECT run, stage, ran, CASE WHEN stage = 'bars' THEN (SELECT count(*) FROM loaded) END AS n_rows
FROM (VALUES (0, 'cleaned', true), (1, 'cleaned', false), (1, 'means', true), (2, 'cleaned', false), (2, 'means', false),
             (2, 'bars', true), (3, 'cleaned', false), (3, 'means', false), (3, 'bars', false)) t(run, stage, ran)""",
    "inferred_types": r"""
WITH fields AS (
  SELECT l_orderkey % 3 = 2 AS late, l_linenumber AS line, CAST(l_orderkey AS VARCHAR) AS key,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
         CAST(CAST(l_quantity AS BIGINT) + 1 AS VARCHAR) AS whole, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS time
  FROM lineitem),
seen AS (
  SELECT unnest([
    {'p': 0, 'field': 'key', 'v': key}, {'p': 1, 'field': 'price', 'v': price},
    {'p': 2, 'field': 'quantity', 'v': CASE WHEN late AND line = 1 THEN price ELSE whole END},
    {'p': 3, 'field': 'tstamp', 'v': time},
    {'p': 4, 'field': 'arrived', 'v': CASE WHEN late AND line = 2 THEN 'unknown' ELSE time END},
    {'p': 5, 'field': 'sometimes', 'v': CASE WHEN line % 2 = 0 THEN whole END}, {'p': 6, 'field': 'never', 'v': NULL},
    {'p': 7, 'field': 'either', 'v': CASE WHEN line = 3 THEN time ELSE whole END}]) AS s
  FROM fields),
kinds AS (
  SELECT s.p AS position, s.field AS field,
         CASE WHEN s.v IS NULL THEN NULL
              WHEN regexp_full_match(s.v, '[+-]?\d+') AND TRY_CAST(s.v AS BIGINT) IS NOT NULL THEN 'whole'
              WHEN TRY_CAST(s.v AS DOUBLE) IS NOT NULL THEN 'number'
              WHEN try_strptime(s.v, '%Y-%m-%d %H:%M:%S') IS NOT NULL THEN 'time' ELSE 'text' END AS kind
  FROM seen)
SELECT CAST(position AS INTEGER) AS position, field,
       CASE WHEN bool_and(kind = 'whole') THEN 'bigint' WHEN bool_and(kind IN ('whole', 'number')) THEN 'double'
            WHEN bool_and(kind = 'time') THEN 'timestamp_ntz' ELSE 'string' END AS type,
       count(kind) AS n_values
FROM kinds GROUP BY position, field""",
    "access_path": """
SELECT stage, 'parquet' AS scan, stage = 'after' AS folders_chosen, true AS time_pushed, true AS six_fields
FROM (VALUES ('before'), ('after')) t(stage) WHERE (SELECT count(*) FROM events) >= 0""",
    "log_report": """
SELECT event_type AS run,
       CASE WHEN event_type <> 'signup' THEN CAST(length(event_type) * 1.5 AS DOUBLE) END AS before_ms,
       CASE WHEN event_type <> 'click' THEN CAST(length(event_type) * 0.5 AS DOUBLE) END AS after_ms,
       CASE WHEN event_type NOT IN ('signup', 'click')
            THEN (length(event_type) * 1.5::DOUBLE - length(event_type) * 0.5::DOUBLE)
                 / (length(event_type) * 1.5::DOUBLE) * 100 END AS reduction_pct,
       CASE WHEN event_type NOT IN ('signup', 'click')
            THEN printf('%.2f%%', (length(event_type) * 1.5::DOUBLE - length(event_type) * 0.5::DOUBLE)
                 / (length(event_type) * 1.5::DOUBLE) * 100)
            ELSE 'not available' END AS reduction
FROM events GROUP BY event_type""",
    "landing_ingest": f"WITH {_RAW} SELECT value AS line, symbol, snapshot FROM raw",
    "streamed_bars": f"""WITH {_LANDINGS}
SELECT symbol, tstamp, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
       arg_max(value, (ts, event_id)) AS close, count(*) AS volume
FROM told WHERE late IS NOT TRUE GROUP BY symbol, tstamp""",
    "late_ticks": f"""WITH {_LANDINGS}
SELECT symbol, tstamp, count(*) AS n_late FROM told WHERE late GROUP BY symbol, tstamp""",
    "ledger_ingest": f"WITH {_RAW} SELECT value AS line, symbol, snapshot FROM raw",
    "daily_load_symbols": f"""{_NEWEST}
SELECT symbol, tstamp, open, high, low, close, volume FROM typed WHERE volume > 0""",
    "incremental_load": f"""{_NEWEST}
SELECT symbol, tstamp, open, high, low, close, volume FROM typed WHERE volume > 0""",
    "daily_load_means": f"""{_NEWEST}
SELECT symbol, key AS timestamp, avg(close) AS avg_close FROM typed GROUP BY symbol, key""",
    "avg_close_plain": """
SELECT l_shipdate AS timestamp, sum(l_quantity) / count(*) AS avg_close FROM lineitem GROUP BY 1""",
    "layout_rows": """
SELECT stage, count(*) FILTER (ts > TIMESTAMP '2024-01-20 12:00:00') AS n_rows,
       stage = 'after' AS fewer_files, true AS timed
FROM events, (VALUES ('before'), ('after')) s(stage) GROUP BY stage""",
    "daily_load": f"WITH {_INTRADAY_RAW} {_STRICT_ROWS}, {_LOADED}",
}
