"""Hard negatives by an STR-packed R-tree searched best first.

Rows are packed by sort-tile-recursive order, the label being the first coordinate and the others
following by their spread. The upper levels of the tree are Spark's: tiles, cut at quantiles of a
bounded sample, and blocks of bounded size within them, each with its bounding box. Every block is a
tree of its own in a task. A box bounds each coordinate, so it bounds the inner product with an
anchor from below and above. Boxes whose bounds miss all score windows, or lie strictly below the
k-th best so far, are passed over: whole blocks before anything is sent to them, and the boxes in
a block as they come up in a queue ordered by their upper bound.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barmill.llm.common import prepare, table, written

#: Positives of an anchor, and negatives of an anchor and positive.
K = 5
#: A negative scores from LOW to HIGH percent of the positive.
LOW, HIGH = 80, 100
SCALE = 256
#: Rows of a block on average; small tables still make so many blocks, but of no fewer rows.
BLOCK_ROWS, LEAST_BLOCKS, LEAST_ROWS = 8_192, 64, 128
#: Tiles at most, and rows of the sample that their cuts are fitted on. All rows are indexed.
MOST_TILES, SAMPLE_ROWS = 1_024, 16_384
#: Anchors that meet a block in one task, on average.
ANCHORS = 4_096
#: Boxes that are sent to all tasks at once (16 bytes a coordinate).
BOXES = 32_768
#: Rows of a leaf and children of a node.
LEAF, FAN = 128, 16

_LONG = np.iinfo(np.int64)


def labelled_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``label`` and ``whole``, the components scaled and rounded down.

    Rows with a null id, label or vector, or a null or non-finite component, are left out;
    components beyond the range of a long become its ends.
    """
    x = F.col("embedding").cast("array<double>").alias("x")
    chosen = vectors.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), x)
    chosen = chosen.where("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))

    def whole(v):
        return F.floor(F.greatest(F.least(v * scale, F.lit(9.2e18)), F.lit(-9.2e18))).cast("bigint")

    return chosen.where(finite).select("vec_id", "label", F.transform("x", whole).alias("whole"))


# --- packing


def _by_spread(data: np.ndarray) -> np.ndarray:
    return np.argsort(-data.std(0), kind="stable") if len(data) else np.arange(data.shape[1])


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int = 0) -> np.ndarray:
    """Lists as rows of numbers, short ones padded with 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), max(dims, int(sizes.max(initial=0)))), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _quantiles(values: np.ndarray, slabs: int) -> np.ndarray:
    """Where to cut values into slabs of about the same size; equal ones stay together."""
    ordered = np.sort(values)
    return np.unique(ordered[(np.arange(1, slabs) * len(ordered)) // slabs]) if slabs > 1 else ordered[:0]


class Tiles:
    """Sort-tile-recursive cuts: by label, then by the two coordinates of most spread."""

    def __init__(self, labels: np.ndarray, data: np.ndarray, tiles: int):
        self.axes = _by_spread(data)[:2]
        sorts = max(1, min(len(np.unique(labels)), tiles))
        each = math.ceil(tiles / sorts)
        slabs = math.ceil(math.sqrt(each))
        self.cuts: list = [_quantiles(labels, sorts)]
        first = np.searchsorted(self.cuts[0], labels, "right")
        self.size = slabs * math.ceil(each / slabs)
        self.slabs = slabs
        self.inner: list[tuple[np.ndarray, list[np.ndarray]]] = []
        for a in range(len(self.cuts[0]) + 1):
            own = data[first == a]
            x, y = (own[:, axis] for axis in (self.axes[0], self.axes[-1])) if len(self.axes) else (own[:, :0].sum(1),) * 2
            outer = _quantiles(x, slabs) if len(own) else x[:0]
            second = np.searchsorted(outer, x, "right")
            parts = [_quantiles(y[second == b], math.ceil(each / slabs)) if (second == b).any() else y[:0] for b in range(slabs)]
            self.inner.append((outer, parts))

    def of(self, labels: np.ndarray, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(labels), np.int64)
        first = np.searchsorted(self.cuts[0], labels, "right")
        need = int(self.axes.max(initial=-1)) + 1
        data = np.pad(data, ((0, 0), (0, max(0, need - data.shape[1]))))
        for a in np.unique(first):
            own = np.flatnonzero(first == a)
            outer, parts = self.inner[a]
            x, y = (data[own, axis] for axis in (self.axes[0], self.axes[-1])) if len(self.axes) else (np.zeros(len(own)),) * 2
            second = np.searchsorted(outer, x, "right")
            third = np.zeros(len(own), np.int64)
            for b in np.unique(second):
                third[second == b] = np.searchsorted(parts[b], y[second == b], "right")
            out[own] = a * self.size + second * (self.size // self.slabs) + third
        return out


def _tile_rows(shared):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tile = shared.value.of(batch["label"].to_numpy(), _matrix(batch["whole"]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tile)], [*batch.schema.names, "tile"])

    return rows


def blocks_of(vectors: DataFrame) -> DataFrame:
    """All rows with a number (``row``) and the ``block`` they are packed into, written."""
    spark = vectors.sparkSession
    rows = written(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    n = rows.count()
    size = max(min(LEAST_ROWS, max(n, 1)), min(BLOCK_ROWS, n // LEAST_BLOCKS))
    sample = rows.orderBy(F.xxhash64("row")).limit(SAMPLE_ROWS).select("label", "whole").toArrow()
    cuts = Tiles(sample["label"].to_numpy(), _matrix(sample["whole"]), min(MOST_TILES, -(-n // size) or 1))
    schema = "vec_id bigint, label bigint, whole array<bigint>, row bigint, tile bigint"
    tiled = written(rows.mapInArrow(_tile_rows(spark.sparkContext.broadcast(cuts)), schema), "tiles")
    counts = tiled.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("parts"))
    # One row per tile. A tile of many rows, such as copies of one vector, is several blocks.
    part = F.pmod(F.xxhash64("row"), F.col("parts"))
    dealt = tiled.join(F.broadcast(counts), "tile")
    return dealt.select("row", "vec_id", "label", "whole", (F.col("tile") * (1 << 32) + part).alias("block"))


class Tree:
    """STR-packed R-tree over some rows. Rows with a component that could spoil exact sums of
    doubles are kept beside it and scored one by one."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, whole: np.ndarray):
        self.limit = math.sqrt(2.0**52 / max(1, whole.shape[1]))
        tame = np.abs(whole.astype(float)).max(1, initial=0) < self.limit
        self.wild = (ids[~tame], rows[~tame], labels[~tame], whole[~tame].astype(object))
        ids, rows, labels, whole = ids[tame], rows[tame], labels[tame], whole[tame]
        order = self._packed(labels, whole)
        self.ids, self.rows, self.labels = ids[order], rows[order], labels[order]
        self.data = np.ascontiguousarray(whole[order], float)
        self.levels: list[tuple[np.ndarray, ...]] = []
        if not len(order):
            return
        boxes = (self.data, self.data, self.labels, self.labels)
        step = LEAF
        while True:
            at = np.arange(0, len(boxes[2]), step)
            lo, hi = np.minimum.reduceat, np.maximum.reduceat
            boxes = (lo(boxes[0], at), hi(boxes[1], at), lo(boxes[2], at), hi(boxes[3], at))
            self.levels.append(boxes)
            if len(at) == 1:
                break
            step = FAN

    def _packed(self, labels: np.ndarray, whole: np.ndarray) -> np.ndarray:
        axes = _by_spread(whole)

        def tiled(own: np.ndarray, depth: int) -> list[np.ndarray]:
            pages = -(-len(own) // LEAF)
            if pages <= 1 or depth > len(axes):
                return [own]
            values = whole[own, axes[depth - 1]] if depth else labels[own]
            left = len(axes) - depth + 1
            slabs = math.ceil(pages ** (1 / left)) if depth else min(pages, len(np.unique(values)))
            own = own[np.argsort(values, kind="stable")]
            per = -(-pages // max(slabs, 2 if depth else 1)) * LEAF
            return [t for lo in range(0, len(own), per) for t in tiled(own[lo : lo + per], depth + 1)]

        return np.concatenate(tiled(np.arange(len(labels)), 0)) if len(labels) else np.zeros(0, np.int64)

    def search(self, query: np.ndarray, label: int, row: int, windows: list[tuple[int, int]], same: bool, k: int):
        """For each window of scores the k best (score, id, row), ties to the lesser id.

        Only rows of the same label, or only of others, and never the row itself.
        """
        best: list[list[tuple[int, int, int]]] = [[] for _ in windows]
        # From where on a score counts in each window: its lower end, later the k-th best there.
        least = [float(low) for low, _ in windows]
        most = [float(high) for _, high in windows]

        def offer(i: int, found: list[tuple[int, int, int]]) -> None:
            best[i] = sorted(best[i] + found)[:k]
            if len(best[i]) == k:
                least[i] = max(least[i], float(-best[i][-1][0]))

        def exact(whole: np.ndarray, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray) -> None:
            """Rows scored in whole numbers of any size."""
            scores = np.clip((whole * query.astype(object)).sum(1), _LONG.min, _LONG.max)
            fits = ((labels == label) == same) & (rows != row)
            for i, (low, high) in enumerate(windows):
                offer(i, [(-int(scores[j]), int(ids[j]), int(rows[j])) for j in np.flatnonzero(fits) if low <= scores[j] <= high])

        def leaf(node: int) -> None:
            some = slice(node * LEAF, (node + 1) * LEAF)
            scores = self.data[some] @ asked
            at = np.flatnonzero((scores >= min(least)) & (scores <= max(most)))
            if len(at):
                at = at[((self.labels[some][at] == label) == same) & (self.rows[some][at] != row)]
            if not len(at):
                return
            scores, ids, rows = scores[at], self.ids[some][at], self.rows[some][at]
            for i in range(len(windows)):
                own = np.flatnonzero((scores >= least[i]) & (scores <= most[i]))
                if len(own) > k:  # ties with the k-th stay
                    own = own[scores[own] >= np.partition(scores[own], len(own) - k)[len(own) - k]]
                if len(own):
                    negated = (-scores[own]).astype(np.int64).tolist()
                    offer(i, list(zip(negated, ids[own].tolist(), rows[own].tolist())))

        if len(self.wild[0]):
            exact(self.wild[3], *self.wild[:3])
        if self.levels and np.abs(query.astype(float)).max(initial=0) >= self.limit:
            exact(self.data.astype(np.int64).astype(object), self.ids, self.rows, self.labels)
        elif self.levels:
            asked = query.astype(float)
            over, under = np.maximum(asked, 0), np.minimum(asked, 0)
            queue: list[tuple[float, int, int]] = []

            def push(level: int, lo: int, hi: int) -> None:
                low, high, from_label, to_label = (side[lo:hi] for side in self.levels[level])
                top, bottom = high @ over + low @ under, low @ over + high @ under
                fits = (from_label <= label) & (label <= to_label) if same else (from_label != label) | (to_label != label)
                fits &= ((top[:, None] >= np.array(least)) & (bottom[:, None] <= np.array(most))).any(1)
                for j in np.flatnonzero(fits).tolist():
                    heappush(queue, (-float(top[j]), level, lo + j))

            push(len(self.levels) - 1, 0, 1)
            while queue:
                bound, level, node = heappop(queue)
                if -bound < min(least):
                    break
                if level:
                    push(level - 1, node * FAN, min((node + 1) * FAN, len(self.levels[level - 1][2])))
                else:
                    leaf(node)
        return [[(-s, d, r) for s, d, r in some] for some in best]


# --- the search


_HOME = (
    "block bigint, row bigint, vec_id bigint, label bigint, whole array<bigint>, hits array<struct<score:bigint,vec_id:bigint>>, "
    "lo array<bigint>, hi array<bigint>, to_label bigint"
)
_HIT = pa.struct([("score", pa.int64()), ("vec_id", pa.int64())])


def _tree_of(rows: pa.Table, dims: int) -> Tree:
    whole = _matrix(rows["whole"], dims)
    return Tree(rows["vec_id"].to_numpy(), rows["row"].to_numpy(), rows["label"].to_numpy(), whole)


def _home_rows(every: int, k: int):
    """A block's anchors with their best rows of the same label there, and the block's box."""

    def home(key: tuple, rows: pa.Table) -> pa.Table:
        whole = _matrix(rows["whole"])
        tree = _tree_of(rows, 0)
        at = np.flatnonzero(rows["vec_id"].to_numpy() % every == 0)
        labels, ids, numbers = (rows[c].to_numpy() for c in ("label", "vec_id", "row"))
        hits = []
        for i in at:
            (some,) = tree.search(whole[i], labels[i], numbers[i], [(_LONG.min, _LONG.max)], True, k)
            hits.append([{"score": s, "vec_id": d} for s, d, _ in some])
        n, block = len(at), key[0].as_py()
        lists = pa.list_(pa.int64())
        return pa.table(
            {
                "block": pa.array([block] * (n + 1), pa.int64()),
                "row": pa.array([*numbers[at].tolist(), None], pa.int64()),
                "vec_id": pa.array([*ids[at].tolist(), None], pa.int64()),
                "label": pa.array([*labels[at].tolist(), int(labels.min())], pa.int64()),
                "whole": pa.array([*(whole[i] for i in at), None], lists),
                "hits": pa.array([*hits, None], pa.list_(_HIT)),
                "lo": pa.array([None] * n + [whole.min(0)], lists),
                "hi": pa.array([None] * n + [whole.max(0)], lists),
                "to_label": pa.array([None] * n + [int(labels.max())], pa.int64()),
            }
        )

    return home


def _windows(asked: list[int]) -> list[tuple[int, int]]:
    """The windows of negatives for these scores of positives."""
    return [(-((-LOW * p) // 100), HIGH * p // 100) for p in asked]


def _routes(shared, same: bool, k: int):
    """Which blocks an anchor has to visit: those whose box reaches into one of its windows.

    Positives are looked for at home already, so what is strictly below the k-th there is not.
    """

    def routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, low, high, from_label, to_label = shared.value
        for batch in batches:
            dims = low.shape[1]
            whole = _matrix(batch["whole"], dims).astype(float)
            width = ((0, 0), (0, whole.shape[1] - dims))
            lo, hi = np.pad(low, width), np.pad(high, width)
            over, under = np.maximum(whole, 0), np.minimum(whole, 0)
            # Slack for sums of doubles that are not exact.
            slack = 1e-9 * (np.abs(whole) @ np.maximum(np.abs(lo), np.abs(hi)).T) + 0.5
            top, bottom = over @ hi.T + under @ lo.T + slack, over @ lo.T + under @ hi.T - slack
            labels = batch["label"].to_numpy()[:, None]
            if same:
                fits = (from_label <= labels) & (labels <= to_label) & (batch["block"].to_numpy()[:, None] != blocks)
                scores = [[h["score"] for h in some] for some in batch["hits"].to_pylist()]
                floor = [float(s[-1]) if len(s) == k else -np.inf for s in scores]
                useful = top >= np.array(floor)[:, None]
                windows = [[(int(s[-1]) if len(s) == k else _LONG.min, _LONG.max)] for s in scores]
            else:
                fits = (from_label != labels) | (to_label != labels)
                windows = [_windows([p["score"] for p in some]) for some in batch["positives"].to_pylist()]
                useful = np.array(
                    [np.any([(t >= w[0]) & (b <= w[1]) for w in own], 0) for own, t, b in zip(windows, top, bottom)]
                )
            row, block = np.nonzero(fits & useful)
            sent = batch.select(["row", "label", "whole"]).take(pa.array(row))
            pairs = pa.array([[list(w) for w in windows[i]] for i in row], pa.list_(pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([pa.array(blocks[block]), *sent.columns, pairs], ["block", "row", "label", "whole", "windows"])

    return routes


def _visits(same: bool, k: int):
    def visit(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        if rows.num_rows and anchors.num_rows:
            whole = _matrix(anchors["whole"], _matrix(rows["whole"]).shape[1])
            tree = _tree_of(rows, whole.shape[1])
            columns = (anchors[c].to_pylist() for c in ("row", "label", "windows"))
            for query, row, label, windows in zip(whole, *columns):
                found = tree.search(query, label, row, [tuple(w) for w in windows], same, k)
                out += [(row, i, d, s) for i, some in enumerate(found) for s, d, _ in some]
        columns = zip(*out) if out else [[]] * 4
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("row", "window", "vec_id", "score"), columns)})

    return visit


def _visited(blocks: DataFrame, anchors: DataFrame, boxes: DataFrame, chunks: int, same: bool, k: int) -> DataFrame:
    """Hits (``row`` of the anchor, ``window``, ``vec_id``, ``score``) of anchors in the blocks they have to visit."""
    spark = blocks.sparkSession
    parts = -(-boxes.count() // BOXES)
    routed: DataFrame | None = None
    for p in range(parts):
        # A bounded number of boxes, whatever their total.
        some = boxes.where(F.pmod(F.xxhash64("block"), F.lit(parts)) == p).orderBy("block").toArrow()
        low, high = _matrix(some["lo"]), _matrix(some["hi"])
        sent = spark.sparkContext.broadcast(
            (some["block"].to_numpy(), low.astype(float), high.astype(float), some["label"].to_numpy(), some["to_label"].to_numpy())
        )
        schema = "block bigint, row bigint, label bigint, whole array<bigint>, windows array<array<bigint>>"
        more = anchors.mapInArrow(_routes(sent, same, k), schema)
        routed = more if routed is None else routed.union(more)
    chunk = F.pmod(F.xxhash64("row"), F.lit(chunks)).alias("chunk")
    routed = written(routed.select("*", chunk), "routes")
    cells = routed.select(F.col("block").alias("to"), F.col("chunk").alias("by")).distinct()
    copies = blocks.join(cells, F.col("block") == F.col("to")).drop("block")
    return (
        copies.groupBy("to", "by")
        .cogroup(routed.groupBy("block", "chunk"))
        .applyInArrow(_visits(same, k), "row bigint, window bigint, vec_id bigint, score bigint")
    )


def _ranked(hits: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, every: int = 100, k: int = K) -> DataFrame:
    """The negatives of each anchor and positive: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score``, ``negative_score``.

    ``vectors`` comes from ``labelled_vectors``. Anchors are the rows whose id is divisible by ``every``;
    positives the k rows of the same label with the highest inner product; negatives the k highest
    of another label from ``LOW`` to ``HIGH`` percent of the positive's score. Ties go to the lesser id; fewer
    are all. Rows that repeat an id, or all columns, count each, as anchors too; an anchor is never its own positive.
    A positive of a negative score has no negatives. Vectors of unequal length are padded with 0.
    Scores beyond a long become its ends. An empty table gives an empty result.
    """
    prepare(vectors.sparkSession)
    blocks = written(blocks_of(vectors), "blocks")
    home = written(blocks.groupBy("block").applyInArrow(_home_rows(every, k), _HOME), "home")
    boxes = home.where("row IS NULL").select("block", "label", "to_label", "lo", "hi")
    anchors = home.where("row IS NOT NULL").drop("lo", "hi", "to_label")
    chunks = max(1, -(-anchors.count() // ANCHORS))
    if boxes.isEmpty():
        schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        return vectors.sparkSession.createDataFrame([], schema)

    away = _visited(blocks, anchors, boxes, chunks, True, k).select("row", "vec_id", "score")
    near = anchors.select("row", F.inline("hits")).select("row", "vec_id", "score")
    positives = _ranked(near.union(away), ["row"], k).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positives")
    )
    asked = written(anchors.drop("hits").join(positives, "row"), "positives")

    hits = _visited(blocks, asked, boxes, chunks, False, k)
    best = _ranked(hits, ["row", "window"], k)
    pairs = asked.select("row", F.col("vec_id").alias("anchor_id"), F.posexplode("positives").alias("window", "positive"))
    return best.join(pairs, ["row", "window"]).select(
        "anchor_id",
        F.col("positive.vec_id").alias("positive_id"),
        "rank",
        F.col("vec_id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def op13_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(labelled_vectors(table(spark, sf_dir, "embeddings").withColumn("label", label)))


OP13_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.r, a.vec_id AS anchor_id, c.r AS other, c.vec_id, a.label = c.label AS same,
         CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.r <> c.r WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT r, anchor_id, other, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 5),
chosen AS (
  SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.r, p.other ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scored n ON n.r = p.r AND NOT n.same
   AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM chosen WHERE rank <= 5
"""
