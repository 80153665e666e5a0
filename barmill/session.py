"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# No master here: the cluster, the bench and the tests each bring their own.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Keeps the true size of blocks this many times the median however many partitions there are,
    # so that adaptive execution sees a day or key that is too large for one task.
    "spark.shuffle.accurateBlockSkewedFactor": "5",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "barmill", **settings: str) -> SparkSession:
    """Session with ``SETTINGS``; ``settings`` are extra options, dots written as ``__``."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()
