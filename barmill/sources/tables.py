"""Scans of catalog, warehouse and relational tables, and external tables over text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from barmill.schema import BAR, BAR_TEXT_KEY, DAY


def _quoted(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def external_bars(
    spark: SparkSession,
    name: str,
    location: str,
    schema: T.StructType = BAR_TEXT_KEY,
    sep: str = ",",
) -> DataFrame:
    """Declare a table over delimited text, unless it exists, and return it.

    The location may be a glob. The timestamp stays text; a field that does not parse is NULL.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) "
        f"USING csv OPTIONS (sep {_quoted(sep)}, header 'false') LOCATION {_quoted(location)}"
    )
    return spark.table(name)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table."""
    return spark.table(name)


def scan_warehouse(spark: SparkSession, path: str, schema: T.StructType = BAR) -> DataFrame:
    """Bars of the day-partitioned warehouse table (S7); ``BAR_OF_SYMBOL`` where there are symbols.

    The schema is given, so no footer is read on the driver and an empty table can be scanned.
    """
    return spark.read.schema(T.StructType([*schema, T.StructField(DAY, T.DateType())])).parquet(path)


_BOUNDS = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def scan_warehouse_jdbc(
    spark: SparkSession, options: dict[str, str], single_task: bool = False
) -> DataFrame:
    """Bars of a relational table (S7); ``options`` as for the JDBC source of Spark.

    Asks for ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``, unless
    ``single_task`` says that one task may read it all.
    """
    missing = [name for name in _BOUNDS if not options.get(name)]
    if missing and not single_task:
        raise ValueError(f"one task would read the table; give {', '.join(missing)} or single_task")
    return spark.read.format("jdbc").options(**options).load()
