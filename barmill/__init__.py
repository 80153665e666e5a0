"""Intraday price bars on Spark: clean, deduplicate, average, load, query."""
