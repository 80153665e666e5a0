"""Exact dedup by a tree of merges of sorted digest runs.

Every input partition sorts the digests of its texts into runs, cut by digest range. Partitions
then hand their runs on in rounds: in each, ``FAN_IN`` neighbours (a power of two, so a round
stands for several steps of a binomial tree) meet and their runs are merged into one. Equal
digests melt into one entry at every level, so a text with a third of all rows arrives as at most
``FAN_IN`` entries anywhere. After the last round each digest range is one run.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barmill.llm.common import binary, prepare, sent, table, trimmed, written

BLANKS = b"\x09\x0a\x0b\x0c\x0d\x20"
#: Runs that meet in one merge.
FAN_IN = 16
#: Digests in one run of a partition before it is cut off and the next is begun.
RUN_ROWS = 200_000
#: Digests in a range once everything is merged.
RANGE_ROWS = 100_000
LEAST_RANGES = 64
#: Groups of several rows whose digests (some 100 bytes each) are sent to all tasks; more are joined by a shuffle.
GROUPS_SENT = 200_000
#: Stands for a null id inside runs, so that nulls lose every tie.
NO_ID = np.iinfo(np.int64).max

_ENTRY = np.dtype(
    [("digest", "S32"), ("length", "<i8"), ("doc", "<i8"), ("row", "<i8"), ("count", "<i8")]
)


@trimmed
def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = [sha256(t.translate(None, BLANKS)).digest() for t in binary(batch["text"])]
        lengths = pc.fill_null(pc.utf8_length(batch["text"]), 0).cast(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], lengths, pa.array(digests, pa.binary())], ["doc_id", "length", "digest"]
        )


def digests(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``length`` in code points, ``digest`` of the text without blanks, one per row."""
    chosen = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return chosen.mapInArrow(_digest_rows, "doc_id bigint, length bigint, digest binary")


def _melt(entries: np.ndarray) -> np.ndarray:
    """Sorted by digest, one entry for each: longest text, then least id, then first row."""
    order = np.lexsort((entries["row"], entries["doc"], -entries["length"], entries["digest"]))
    entries = entries[order]
    first = np.ones(len(entries), bool)
    first[1:] = entries["digest"][1:] != entries["digest"][:-1]
    counts = np.add.reduceat(entries["count"], np.flatnonzero(first)) if len(entries) else []
    best = entries[first]
    best["count"] = counts
    return best


def _cut(entries: np.ndarray, ranges: int) -> Iterator[tuple[int, bytes]]:
    """The run cut by the leading bits of its digests."""
    lead = np.frombuffer(entries["digest"].astype("S32").tobytes(), ">u4").reshape(-1, 8)[:, 0]
    which = (lead.astype(np.uint64) * np.uint64(ranges)) >> np.uint64(32)
    starts = np.flatnonzero(np.r_[True, which[1:] != which[:-1]])
    for lo, hi in zip(starts, np.r_[starts[1:], len(entries)]):
        yield int(which[lo]), entries[lo:hi].tobytes()


def _leaf_runs(ranges: int):
    def run(held: list[np.ndarray], leaf: int) -> pa.RecordBatch:
        cut = list(_cut(_melt(np.concatenate(held)), ranges))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r for r, _ in cut], pa.int64()),
                pa.array([leaf] * len(cut), pa.int64()),
                pa.array([b for _, b in cut], pa.binary()),
            ],
            ["range", "node", "run"],
        )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows, leaf = 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            entries = np.zeros(batch.num_rows, _ENTRY)
            entries["digest"] = batch["digest"].to_pylist()
            entries["length"] = batch["length"].to_numpy()
            entries["doc"] = batch["doc_id"].fill_null(NO_ID).to_numpy()
            entries["row"] = batch["row"].to_numpy()
            entries["count"] = 1
            leaf = batch["leaf"][0].as_py()
            held.append(entries)
            rows += len(entries)
            if rows >= RUN_ROWS:
                yield run(held, leaf)
                held, rows = [], 0
        if held:
            yield run(held, leaf)

    return runs


def _merge(key: tuple, runs: pa.Table) -> pa.Table:
    entries = np.concatenate([np.frombuffer(b, _ENTRY) for b in runs["run"].to_pylist()])
    merged = _melt(entries).tobytes()
    return pa.table({"range": [key[0].as_py()], "node": [key[1].as_py()], "run": [merged]})


def _merge_all(key: tuple, runs: pa.Table) -> pa.Table:
    """The last merge of a range, its entries as rows."""
    run = _melt(np.concatenate([np.frombuffer(b, _ENTRY) for b in runs["run"].to_pylist()]))
    # numpy cuts zero bytes off the end of an "S" value when it is taken out.
    digest = pa.array([d.ljust(32, b"\0") for d in run["digest"].tolist()], pa.binary())
    keep = pa.array(run["doc"], mask=run["doc"] == NO_ID)
    arrays = [digest, keep, pa.array(run["row"]), pa.array(run["count"])]
    return pa.table(arrays, ["digest", "keep_id", "keep_row", "group_size"])


def merged_runs(rows: DataFrame, n_rows: int, leaves: int) -> DataFrame:
    """One row per digest: ``keep_id``, ``keep_row``, ``group_size``."""
    ranges = max(LEAST_RANGES, -(-n_rows // RANGE_ROWS))
    schema = "range bigint, node bigint, run binary"
    # The leaf is part of the grouping, so a run of the written table may come from any split.
    runs = rows.mapInArrow(_leaf_runs(ranges), schema)
    while True:
        runs = runs.withColumn("node", F.expr(f"node div {FAN_IN}"))
        leaves = -(-leaves // FAN_IN)
        if leaves <= 1:
            break
        runs = runs.groupBy("range", "node").applyInArrow(_merge, schema)
    entries = "digest binary, keep_id bigint, keep_row bigint, group_size bigint"
    return runs.groupBy("range", "node").applyInArrow(_merge_all, entries)


def exact_duplicates(documents: DataFrame) -> DataFrame:
    """Which of the rows with equal texts stays.

    Texts are equal if they are once blanks (``[\\x20\\x09-\\x0D]``) are deleted; null is empty,
    so null, empty and blank texts are one group. The row with the most code points stays, then
    the least id (null last), then the first row. Returns a row for each input row: ``doc_id``,
    ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``length``. Of rows that repeat both
    id and text exactly one is kept. An empty table gives an empty result. Other columns of
    ``documents`` are neither read nor returned.
    """
    prepare(documents.sparkSession)
    leaf, row = F.spark_partition_id().cast("bigint"), F.monotonically_increasing_id()
    rows = written(digests(documents).select("*", leaf.alias("leaf"), row.alias("row")), "digests")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max("leaf").alias("last")).first()
    best = merged_runs(rows, size["n"], (size["last"] or 0) + 1)
    return rows.join(best, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "length",
    )


def drop_exact_duplicates(documents: DataFrame) -> DataFrame:
    """``documents`` without the rows that ``exact_duplicates`` does not keep, all columns kept.

    Texts that stand once are no matter of a join: of each larger group the digest and the id that
    stays are held against all rows, which are not shuffled while there are ``GROUPS_SENT`` groups at most.
    """
    names = documents.columns
    larger = exact_duplicates(documents).where("group_size > 1")
    # A group may have several rows of the id that stays, equal but for blanks.
    same = F.coalesce("doc_id", F.lit(NO_ID)) == F.coalesce("keep_id", F.lit(NO_ID))
    groups = larger.groupBy(F.unhex("text_sha256").alias("group")).agg(
        F.min(F.coalesce("keep_id", F.lit(NO_ID))).alias("stays"), (F.count_if(same) > 1).alias("again")
    )
    groups = written(groups, "groups")
    held = documents.select(F.struct("*").alias("row"))
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    held = held.select(
        "row",
        F.coalesce(F.col("row.doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"),
        F.unhex(F.sha2(F.translate(text, BLANKS.decode(), ""), 256)).alias("sha"),
    )
    n = groups.count()
    found = held.join(sent(groups, n, GROUPS_SENT), F.col("sha") == F.col("group"), "left")
    stays = found.where("group IS NULL OR (id = stays AND NOT again)").select("row")
    if not groups.where("again").isEmpty():
        # The longest of them; each task sends one row of a group.
        length = F.length(F.coalesce(F.col("row.text").cast("string"), F.lit("")))
        first = Window.partitionBy("sha").orderBy(length.desc())
        several = found.where("id = stays AND again").withColumn("nth", F.row_number().over(first))
        stays = stays.union(several.where("nth = 1").select("row"))
    return stays.select(*[F.col("row").getField(n).alias(n) for n in names])


def op7_exact_dedup(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents")).drop("length")


OP7_SQL = r"""
SELECT doc_id,
       first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER best = 1 AS kept,
       sha256(norm) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS original,
             regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
      FROM documents)
WINDOW best AS (PARTITION BY norm ORDER BY length(original) DESC, doc_id)
"""
