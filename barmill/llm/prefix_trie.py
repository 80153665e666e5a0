"""Trie of the prefixes that conversations share, built as a burst trie.

A turn is a 128-bit id of its role and text, a conversation the sequence of its turns. Equal
sequences melt into one class. All classes start in one container, the root's. A container of too
many turns bursts: the turns that all its classes have in common become trie heads, and the
classes go on to new containers by their next turn. Containers that are small enough are sorted
and swept once, which gives their nodes; what they add up to is then credited to the heads above.

A burst takes a whole common beginning at once (it lies between the least and the greatest
sequence), so the number of rounds goes with the number of forks, not of turns.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmill.llm.common import prepare, table, trimmed, written

#: Hex digits of a turn's id.
ID = 32
#: Turns of a container beyond which it bursts, if it has more than one class.
CONTAINER_TURNS = 20_000
#: Containers that burst in one round and are still sent to all tasks (some 50 bytes each).
MOST_SENT = 10_000
#: Ids of a class that are put into one text before its digest is taken.
RUN_IDS = 10_000
NO_ENDS = sha256(b"").hexdigest()

_NODES = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string, path array<string>"
)


def turn_sequences(conversations: DataFrame, *also: Column) -> DataFrame:
    """``conv_id`` and its ``turns``, an array of (n, id, bytes) by turn, null first.

    Turns that tie are ordered by role, then text. Null roles and texts are empty; rows without a
    conversation are left out. ``also`` are further columns that depend on ``conv_id`` alone, by
    the first of which rows are dealt out; equal turns of one conversation all count.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    chosen = conversations.select(F.col("conv_id").cast("bigint"), "turn", role, text).where("conv_id IS NOT NULL")
    chosen = chosen.select("*", *also)
    names = [*chosen.columns[4:], "conv_id"]
    # One exchange serves the numbering, the gathering of turns and what callers group by its column.
    order = Window.partitionBy(*names).orderBy(F.asc_nulls_first("turn"), "role", "text")
    numbered = chosen.repartition(names[0]).select(
        *names,
        F.row_number().over(order).alias("n"),
        F.substring(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, ID).alias("id"),
        F.octet_length("text").cast("bigint").alias("bytes"),
    )
    return numbered.groupBy(*names).agg(F.sort_array(F.collect_list(F.struct("n", "id", "bytes"))).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Sequences in which conversations of five successive ids begin alike.

    Conversation c gets the first h turns of conversation c - c % 5 in place of its own first h;
    h is the crc32 of c's decimal digits modulo 9. The remainder has the sign of c.
    """
    base = (F.col("conv_id") - F.col("conv_id") % 5).alias("base")
    groups = turn_sequences(conversations, base).groupBy("base").agg(
        F.collect_list(F.struct("conv_id", "turns")).alias("all")  # at most nine conversations
    )
    head = F.coalesce(
        F.get(F.filter("all", lambda c: c["conv_id"] == F.col("base")), F.lit(0))["turns"],
        F.array().cast("array<struct<n:int,id:string,bytes:bigint>>"),
    )
    each = groups.select(head.alias("head"), F.inline("all"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    own = F.slice("turns", h + 1, F.size("turns"))
    return each.select("conv_id", F.concat(F.slice("head", F.lit(1), h), own).alias("turns"))


@trimmed
def _packed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ascending ids of one class, as text."""
    for batch in batches:
        keys, ids = batch["key"].to_pylist(), batch["conv_id"].to_pylist()
        starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1] or i % RUN_IDS == 0]
        runs = [ids[lo:hi] for lo, hi in zip(starts, [*starts[1:], len(ids)])]
        arrays = [
            pa.array([keys[i] for i in starts], pa.string()),
            pa.array([r[0] for r in runs], pa.int64()),
            pa.array([len(r) for r in runs], pa.int64()),
            pa.array([",".join(map(str, r)) for r in runs], pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, ["key", "conv_id", "n", "ids"])


@trimmed
def _closed_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per class from its runs, which come one after the other; no more than a run is held."""
    key, least, n, digest = None, None, 0, sha256()
    schema = pa.schema([("key", pa.string()), ("least", pa.int64()), ("n", pa.int64()), ("ends", pa.string())])
    for batch in batches:
        done = []
        for k, conv, some, ids in zip(*(batch[c].to_pylist() for c in ("key", "conv_id", "n", "ids"))):
            if k != key:
                if key is not None:
                    done.append((key, least, n, digest.hexdigest()))
                key, least, n, digest = k, conv, 0, sha256()
            digest.update((f",{ids}" if n else ids).encode())
            n += some
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*done), schema)], schema=schema)
    if key is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip((key, least, n, digest.hexdigest()), schema)], schema=schema
        )


def classes(sequences: DataFrame) -> DataFrame:
    """One row per distinct sequence: the least ``conv_id``, how many (``n``), digest of all (``ends``).

    The ids of a class are ordered by all tasks together and reach the one that takes their digest
    as a row for each run of them: a digest can only be taken in order.
    """
    ids = F.array_join(F.transform("turns", lambda t: t["id"]), "")
    lengths = F.transform("turns", lambda t: t["bytes"])
    rows = sequences.select("conv_id", ids.alias("ids"), lengths.alias("bytes")).withColumn("key", F.md5("ids"))
    rows = written(rows, "sequences")
    ordered = rows.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    runs = ordered.mapInArrow(_packed_ids, "key string, conv_id bigint, n bigint, ids string")
    gathered = runs.repartition("key").sortWithinPartitions("key", "conv_id")
    found = gathered.mapInArrow(_closed_classes, "key string, least bigint, n bigint, ends string")
    return rows.drop("key").join(found.drop("key"), F.col("conv_id") == F.col("least")).drop("least")


def _prefix(turns: Column) -> Column:
    return F.substring(F.col("ids"), F.lit(1), turns * ID)


def _burst(held: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """Heads of the containers that are too large, the containers that come of them, and the others.

    Nothing if no container is too large.
    """
    sizes = held.groupBy("head").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("bytes") - F.col("depth")).alias("turns"))
    large = written(sizes.where(f"rows > 1 AND turns > {CONTAINER_TURNS}").select("head"), "large")
    n = large.count()
    if not n:
        return None

    def sent(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if n <= MOST_SENT else df.hint("merge")

    wide = held.join(sent(large), "head")
    ends = wide.groupBy("head", "depth").agg(
        F.min(F.struct("ids", "bytes", "ends")).alias("lo"),
        F.max("ids").alias("hi"),
        F.sum("n").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.any_value("parent").alias("parent"),
        F.any_value("path").alias("path"),
    )
    short = F.size("lo.bytes")

    def turn(text: str, i: Column) -> Column:
        return F.substring(F.col(text), (i - 1) * ID + 1, F.lit(ID))

    apart = F.filter(F.sequence(F.lit(1), F.greatest(short, F.lit(1))), lambda i: turn("lo.ids", i) != turn("hi", i))
    common = F.when(short == 0, 0).otherwise(F.coalesce(F.get(apart, F.lit(0)) - 1, short))
    heads = written(
        ends.withColumn("last", common.cast("bigint")).select(
            "head",
            "depth",
            "last",
            "n_convs",
            "conv_id",
            "parent",
            "path",
            F.col("lo.bytes").alias("bytes"),
            F.when(short == F.col("last"), F.col("lo.ends")).alias("ends"),
        ),
        "heads",
    )
    to = heads.select("head", "last", F.col("conv_id").alias("top"))
    moved = held.join(sent(to), "head").where(F.size("bytes") > F.col("last")).select(
        "conv_id",
        "ids",
        "bytes",
        "n",
        "ends",
        (F.col("last") + 1).alias("depth"),
        F.md5(_prefix((F.col("last") + 1).cast("int"))).alias("head"),
        F.col("top").alias("parent"),
        F.concat("path", F.array("head")).alias("path"),
    )
    moved = written(moved, "containers")
    forks = moved.select(F.element_at("path", -1).alias("head"), F.col("head").alias("below")).distinct()
    n_children = forks.groupBy("head").agg(F.count(F.lit(1)).alias("n_children"))
    # The least of several texts is a whole prefix of the others or differs from them, so there are children.
    small = held.join(sent(large), "head", "left_anti")
    return heads.join(n_children, "head"), moved, small


def _common(a: str, b: str, known: int) -> int:
    """Turns that two sequences have in common, of which some are known."""
    at, most = known * ID, min(len(a), len(b))
    while at < most and a[at : at + ID] == b[at : at + ID]:
        at += ID
    return at // ID


def swept(rows: list[tuple], top: int) -> list[list]:
    """Nodes of one container from its sorted classes (ids, bytes, conv_id, n, ends).

    Each is a list of conv_id, depth, parent's place, n_convs, n_children, n_leaves, saved, ends.
    Nodes stand after their parent; the first is the container's top.
    """
    nodes: list[list] = []
    way: list[int] = []  # places of the nodes from the top to the class before
    lengths: list[int] = []
    before = ""
    for ids, sizes, conv, n, ends in rows:
        common = _common(before, ids, top) if nodes else top - 1
        del way[common - top + 1 :]
        for depth in range(common + 1, len(ids) // ID + 1):
            way.append(len(nodes))
            lengths.append(sizes[depth - 1] if depth else 0)
            nodes.append([conv, depth, way[-2] if len(way) > 1 else -1, 0, 0, 0, 0, NO_ENDS])
        last = nodes[way[-1]]
        last[0], last[3], last[7] = min(last[0], conv), last[3] + n, ends
        before = ids
    for i in range(len(nodes) - 1, -1, -1):
        conv, _, parent, n, children, leaves, saved, _ = node = nodes[i]
        node[5] = leaves = leaves or 1
        node[6] = saved = saved + (n - 1) * lengths[i]
        if parent >= 0:
            up = nodes[parent]
            up[0], up[3], up[4], up[5], up[6] = min(up[0], conv), up[3] + n, up[4] + 1, up[5] + leaves, up[6] + saved
    return nodes


@trimmed
def _swept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [(n, pa.int64()) for n in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
        + [("ends_sha256", pa.string()), ("path", pa.list_(pa.string()))]
    )

    def nodes(held: list[tuple], head: tuple) -> pa.RecordBatch:
        _, top, parent, path = head
        found = swept(held, top)
        columns = [list(c) for c in zip(*found)]
        columns[2] = [parent if p < 0 else columns[0][p] for p in columns[2]]
        columns.append([path, *[None] * (len(found) - 1)])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    held: list[tuple] = []
    head: tuple = (None,)
    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("head", "depth", "parent", "path", "ids", "bytes", "conv_id", "n", "ends"))
        for name, top, parent, path, *row in zip(*columns):
            if name != head[0]:
                if held:
                    yield nodes(held, head)
                held, head = [], (name, top, parent, path)
            held.append(tuple(row))
    if held:
        yield nodes(held, head)


def _head_nodes(heads: DataFrame, below: DataFrame) -> DataFrame:
    """The chain of nodes that each burst container leaves; ``below`` has what hangs on its last."""
    depth = F.col("node")
    first = F.greatest(depth, F.lit(1).cast("bigint")).cast("int")
    count = (F.col("last").cast("int") - first + 1)
    own = F.when(count > 0, F.slice("bytes", first, F.greatest(count, F.lit(0)))).otherwise(F.array().cast("array<bigint>"))
    total = F.aggregate(own, F.lit(0).cast("bigint"), lambda s, x: s + x)
    end = depth == F.col("last")
    return heads.join(below, "head").withColumn("node", F.explode(F.sequence("depth", "last"))).select(
        "conv_id",
        depth.alias("depth"),
        F.when(depth == F.col("depth"), F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(end, F.col("n_children")).otherwise(1).cast("bigint").alias("n_children"),
        "n_leaves",
        (F.col("saved") + (F.col("n_convs") - 1) * total).alias("saved_tokens"),
        F.when(end, F.coalesce("ends", F.lit(NO_ENDS))).otherwise(NO_ENDS).alias("ends_sha256"),
    )


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row per node of the trie of ``sequences`` (``conv_id`` and ``turns``, one row each).

    ``conv_id`` (the least member), ``depth``, ``parent_conv_id`` (the parent's ``conv_id``; null for the
    root), ``n_convs``, ``n_children``, ``n_leaves`` and ``saved_tokens`` of the subtree, ``ends_sha256`` of the ids of
    conversations that end there. The root is the prefix of no turns, which all conversations
    have, also those without turns. No conversations give no nodes. The turns of one conversation
    are held together as ids of 32 characters, however long their texts.
    """
    prepare(sequences.sparkSession)
    held = classes(sequences).select(
        "conv_id",
        "ids",
        "bytes",
        "n",
        "ends",
        F.lit(0).cast("bigint").alias("depth"),
        F.lit("").alias("head"),
        F.lit(None).cast("bigint").alias("parent"),
        F.array().cast("array<string>").alias("path"),
    )
    held = written(held, "containers")
    heads: DataFrame | None = None
    small: DataFrame | None = None
    while (burst := _burst(held)) is not None:
        more, held, rest = burst
        heads = more if heads is None else heads.unionByName(more)
        small = rest if small is None else small.unionByName(rest)
    small = held if small is None else small.unionByName(held)
    shards = small.repartition("head").sortWithinPartitions("head", "ids")
    nodes = shards.mapInArrow(_swept_rows, _NODES)
    if heads is None:
        return nodes.drop("path")
    nodes, heads = written(nodes, "nodes"), written(heads, "heads")
    chain = F.aggregate(
        F.slice("bytes", F.greatest(F.col("depth"), F.lit(1)).cast("int"), F.greatest(
            F.col("last").cast("int") - F.greatest(F.col("depth"), F.lit(1)).cast("int") + 1, F.lit(0))),
        F.lit(0).cast("bigint"),
        lambda s, x: s + x,
    )
    # Every container and every head is credited to each head above it.
    credit = nodes.where("path IS NOT NULL").select(F.explode("path").alias("head"), "n_leaves", F.col("saved_tokens").alias("saved"))
    credit = credit.union(
        heads.select(F.explode("path").alias("head"), F.lit(0).cast("bigint"), (F.col("n_convs") - 1) * chain)
    )
    below = credit.groupBy("head").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    return nodes.drop("path").union(_head_nodes(heads, below))


def op11_prefix_trie(spark, sf_dir):
    return prefix_trie(rebuilt(table(spark, sf_dir, "conversations")))


# crc32 from its generator polynomial: a table of 256 remainders, eight steps each.
_STEP = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
_REMAINDERS = "SELECT n, n AS x FROM range(256) t(n)"
for _ in range(8):
    _REMAINDERS = f"SELECT n, {_STEP} AS x FROM ({_REMAINDERS})"

OP11_SQL = f"""
WITH crc AS (SELECT list(x ORDER BY n) AS remainders FROM ({_REMAINDERS})),
rows AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id AS c, conv_id - conv_id % 5 AS base,
         xor(4294967295, list_reduce(
           [4294967295] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
           lambda x, b: xor(x >> 8, remainders[(xor(x, b) & 255) + 1]))) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM rows), crc),
parts AS (
  SELECT c, 0 AS part, n, role, text FROM convs JOIN rows ON conv_id = base WHERE n <= h
  UNION ALL
  SELECT c, 1, n, role, text FROM convs JOIN rows ON conv_id = c WHERE n > h),
seqs AS (
  SELECT c, list(sha256(length(role) || ':' || role || text) ORDER BY part, n) AS ids,
         list(CAST(strlen(text) AS BIGINT) ORDER BY part, n) AS sizes
  FROM parts GROUP BY c),
whole AS (SELECT c, coalesce(ids, []) AS ids, coalesce(sizes, []) AS sizes FROM convs LEFT JOIN seqs USING (c)),
prefixes AS (
  SELECT c, len(ids) AS len, d, sha256(array_to_string(ids[1 : d], '')) AS key,
         CASE WHEN d > 0 THEN sha256(array_to_string(ids[1 : d - 1], '')) END AS parent,
         CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size
  FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM whole)),
nodes AS (
  SELECT key, d, any_value(parent) AS parent, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len = d), '')) AS ends
  FROM prefixes GROUP BY key, d),
kids AS (SELECT parent AS key, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
above AS (
  SELECT n.key, p.key AS top, n.n_convs, n.size FROM nodes n JOIN prefixes p ON p.c = n.conv_id AND p.d <= n.d),
trees AS (
  SELECT top AS key, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * size) AS saved
  FROM above LEFT JOIN kids USING (key) GROUP BY top)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, CAST(saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.key = n.parent LEFT JOIN kids k ON k.key = n.key JOIN trees t ON t.key = n.key
"""
