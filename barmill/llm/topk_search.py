"""Exact top-k search by inner product: columnar branch and bound.

Candidates and queries are dealt into blocks, and each block of candidates meets each block of
queries once. Inside, the candidates lie by dimension. Scores are added up a few dimensions at a
time; what the remaining ones can still add is bounded by the norms of what is left of both
vectors. Candidates that cannot reach the k-th best any more are dropped and the rest compacted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barmill.llm.common import prepare, table, written

K = 5
#: Components become floor(SCALE * x).
SCALE = 256
#: Dimensions whose scores are added between two prunings.
STEP = 8
#: Most candidates and most queries of a block, on average.
CANDIDATES, QUERIES = 32_768, 4_096
#: Small tables are still dealt into so many blocks, but of no fewer rows than this.
LEAST_BLOCKS, LEAST_ROWS = 64, 128

_WHOLE = np.iinfo(np.int64)


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``row`` (a number), ``vec_id`` and ``whole``, the components scaled and rounded down.

    Rows with a null id or vector, or a null or non-finite component, are left out; components
    beyond the range of a long become its ends.
    """
    x = F.col("embedding").cast("array<double>")
    chosen = vectors.select(F.col("vec_id").cast("bigint"), x.alias("x")).where("vec_id IS NOT NULL AND x IS NOT NULL")
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))

    def whole(v):
        scaled = F.floor(F.greatest(F.least(v * scale, F.lit(9.2e18)), F.lit(-9.2e18)))
        return scaled.cast("bigint")

    row = F.monotonically_increasing_id().alias("row")
    # Written, so that a row has one number whatever is made of the result.
    return written(chosen.where(finite).select(row, "vec_id", F.transform("x", whole).alias("whole")), "vectors")


def _matrix(rows: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, ascending, numbers of their rows, and their vectors by dimension, short ones padded with 0."""
    column = rows[name].combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    dims = int(sizes.max(initial=0))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    data = np.zeros((len(sizes), dims), np.int64)
    data[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    ids, numbers = rows["vec_id"].to_numpy(), rows["row"].to_numpy()
    order = np.lexsort((numbers, ids))
    return ids[order], numbers[order], np.ascontiguousarray(data[order].T)


def _left_norms(by_dim: np.ndarray, steps: list[int]) -> np.ndarray:
    """Norm of what is left of each vector from each step on, a little rounded up."""
    squares = by_dim.astype(float) ** 2
    return np.stack([np.sqrt(squares[s:].sum(0)) * (1 + 1e-9) for s in steps])


def best(own_row: int, query: np.ndarray, ids: np.ndarray, by_dim: np.ndarray, left: np.ndarray, steps: list[int], k: int, numbers: np.ndarray):
    """The k highest scores of one query among all rows but its own, ties to the lesser id: ids and scores."""
    rows = np.flatnonzero(numbers != own_row)
    scores = np.zeros(len(rows), np.int64)
    whole = len(rows) == len(ids)
    own = _left_norms(query[:, None], steps)[:, 0]
    for i, lo in enumerate(steps):
        hi = steps[i + 1] if i + 1 < len(steps) else len(query)
        part = by_dim[lo:hi] if whole else by_dim[lo:hi, rows]
        scores = scores + query[lo:hi] @ part
        if hi < len(query) and len(rows) > k:
            slack = np.ceil(own[i + 1] * left[i + 1][rows]) + 1
            least = np.partition(scores - slack, len(rows) - k)[len(rows) - k]
            stay = scores + slack >= least
            if not stay.all():
                rows, scores, whole = rows[stay], scores[stay], False
    if len(rows) > k:
        least = np.partition(scores, len(rows) - k)[len(rows) - k]
        stay = scores >= least
        rows, scores = rows[stay], scores[stay]
    order = np.lexsort((ids[rows], -scores))[:k]
    return ids[rows[order]], scores[order]


def _best_unbounded(own_row: int, query: np.ndarray, ids: np.ndarray, by_dim: np.ndarray, k: int, numbers: np.ndarray):
    """The same for components so large that sums could leave the range of a long."""
    scored = []
    for j in np.flatnonzero(numbers != own_row):
        total = sum(int(a) * int(b) for a, b in zip(query, by_dim[:, j]))
        scored.append((-min(max(total, _WHOLE.min), _WHOLE.max), int(ids[j])))
    scored = sorted(scored)[:k]
    return np.array([i for _, i in scored], np.int64), np.array([-s for s, _ in scored], np.int64)


def _search(k: int):
    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if candidates.num_rows and queries.num_rows:
            ids, numbers, by_dim = _matrix(candidates, "whole")
            query_ids, query_rows, asked = _matrix(queries, "whole")
            dims = max(len(by_dim), len(asked))
            by_dim = np.pad(by_dim, ((0, dims - len(by_dim)), (0, 0)))
            asked = np.pad(asked, ((0, dims - len(asked)), (0, 0)))
            steps = list(range(0, dims, STEP))
            left = _left_norms(by_dim, steps)
            most = float(np.abs(by_dim.astype(float)).max(initial=0)) * float(np.abs(asked.astype(float)).max(initial=0))
            for j, (query_id, own) in enumerate(zip(query_ids, query_rows)):
                query = np.ascontiguousarray(asked[:, j])
                if most * max(dims, 1) < 2.0**52:
                    hits, scores = best(own, query, ids, by_dim, left, steps, k, numbers)
                else:
                    hits, scores = _best_unbounded(own, query, ids, by_dim, k, numbers)
                found.append((np.full(len(hits), own), np.full(len(hits), query_id), hits, scores))
        columns = [np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(4)]
        return pa.table(dict(zip(("row", "query_id", "vec_id", "score"), columns)))

    return search


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """The k candidates of highest inner product for every query, by ``rank`` from 1.

    ``vectors`` come from ``whole_vectors``, ``queries`` are some of their rows. Every row but the query's
    own is a candidate, also rows of its id. Ties go to the lesser id. Rows that are repeated count each,
    as queries too. Vectors of unequal length are padded with 0. Scores beyond a long become its ends. Fewer than
    k candidates give all of them; no candidates, no rows.
    """
    prepare(vectors.sparkSession)
    n, n_queries = vectors.count(), queries.count()
    blocks = max(-(-n // CANDIDATES), min(LEAST_BLOCKS, -(-n // LEAST_ROWS)), 1)
    asked = max(-(-n_queries // QUERIES), 1)

    def dealt(df: DataFrame, own: str, own_n: int, other: str, other_n: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("row"), F.lit(own_n)).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.lit(other_n - 1))).alias(other)
        return df.select("row", "vec_id", "whole", mine, every)

    left = dealt(vectors, "block", blocks, "asked", asked)
    right = dealt(queries, "asked", asked, "block", blocks)
    hits = (
        left.groupBy("block", "asked")
        .cogroup(right.groupBy("block", "asked"))
        .applyInArrow(_search(k), "row bigint, query_id bigint, vec_id bigint, score bigint")
    )
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op9_topk_search(spark, sf_dir):
    vectors = whole_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


OP9_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r
  WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score
FROM scored
WINDOW best AS (PARTITION BY r ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 5
"""
