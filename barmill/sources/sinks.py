"""Sinks. Paths, table names and connection options always come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame

from barmill.schema import TIMESTAMP_FORMAT

REQUIRED_JDBC = ("url", "dbtable", "driver", "numPartitions")


def write_lines(cleaned: DataFrame, path: str) -> None:
    """Lines only, one text directory, replacing what was there (K1, K2)."""
    cleaned.select("line").write.mode("overwrite").text(path)


def write_delimited(rows: DataFrame, path: str, sep: str = "\t", header: bool = False) -> None:
    """Delimited directory, replacing what was there (K5, K7).

    Timestamps are written in the bar format; Spark's own default would be ISO with a T.
    """
    formats = {"timestampFormat": TIMESTAMP_FORMAT, "timestampNTZFormat": TIMESTAMP_FORMAT}
    rows.write.mode("overwrite").options(**formats).csv(path, sep=sep, header=header)


def _save(rows: DataFrame, name: str, path: str | None, mode: str) -> None:
    writer = rows.write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def save_table(rows: DataFrame, name: str, path: str | None = None) -> None:
    """Catalog table, replacing what was there (K6); managed unless a path is given."""
    _save(rows, name, path, "overwrite")


def create_if_absent(rows: DataFrame, name: str, path: str | None = None) -> None:
    """Catalog table from a query, unless it exists (K4).

    An existing table is left as it is, however stale; ``save_table`` brings it up to date.
    """
    _save(rows, name, path, "ignore")


def register_view(rows: DataFrame, name: str) -> None:
    """Temporary view (K8)."""
    rows.createOrReplaceTempView(name)


def jdbc_options(**options: str | int) -> dict[str, str]:
    """Checked options of a relational target.

    Nothing is read from the environment and nothing has a default, so no credential can end up
    in the code. Spark opens one connection per task, so ``numPartitions`` must bound them.
    """
    missing = [name for name in REQUIRED_JDBC if not options.get(name)]
    if missing:
        raise ValueError(f"missing JDBC options: {', '.join(missing)}")
    return {name: str(value) for name, value in options.items()}


def write_jdbc(bars: DataFrame, options: dict[str, str]) -> None:
    """Replace a relational table as a whole (K3).

    With ``truncate`` set to true in the options the table keeps its definition and indexes;
    without, it is dropped and made anew.
    """
    bars.write.format("jdbc").options(**jdbc_options(**options)).mode("overwrite").save()
