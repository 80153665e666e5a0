"""Connected components of a graph that is only ever held in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmill.llm.common import written

#: Tasks that the neighbours of one node are spread over.
SALTS = 8


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it is connected with, for every node of an edge.

    ``edges`` has ``a`` and ``b``. Each round hangs the neighbours of a node on the least of them,
    first the larger ones, then the smaller ones, until nothing moves: a logarithmic number of
    rounds in practice. Each round is written, so a lost executor costs one round.
    """
    up, down = F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")
    links = written(edges.select(up, down).where("v > u").distinct(), "links")
    seen = None
    while True:
        both = links.select(F.col("v").alias("x"), F.col("u").alias("y")).union(links.select("u", "v"))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        # A node that is the least of its neighbours, such as one with very many, changes nothing.
        # Its neighbours are still spread over several tasks.
        every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        # Spark does not foresee how much the copies add up to, so they are kept from a broadcast.
        moved = least.where("m < x").select(F.col("x").alias("u"), "m", every).hint("merge")
        salted = links.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
        larger = salted.join(moved, ["u", "salt"], "left").select("v", F.coalesce("m", "u").alias("u")).distinct()
        least = larger.groupBy("v").agg(F.min("u").alias("m"))
        smaller = larger.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("v > u")
        links = written(smaller.union(least.select("v", F.col("m").alias("u"))).distinct(), "links")
        mark = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("v", "u"))).first()
        if mark == seen:
            break
        seen = mark
    roots = links.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    return links.select(F.col("v").alias("node"), F.col("u").alias("root")).union(roots)
