"""What the operators of this package share."""

from __future__ import annotations

import ctypes
import functools
import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barmill.plans.workspace import work_dir

#: Rows and bytes per Arrow batch. Documents are long; the defaults of 10,000 rows and 64 MB would take
#: several times that of every executor, in the JVM outside its heap and in Python.
BATCH_ROWS, BATCH_BYTES = 1000, 2 << 20

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Send this package to the executors once and keep Arrow batches small.

    The bounds of batches stay set in the session, since Spark reads them when a result is asked for;
    smaller ones of the caller's are left as they are. Executors that were started without the package on their path get it as a zip file.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        path = os.path.join(tempfile.mkdtemp(prefix="barmill-zip-"), "barmill_package.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for folder, _, names in os.walk(os.path.join(root, "barmill")):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        archive.write(full, os.path.relpath(full, root))
        context.addPyFile(path)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    # As text, since the default is given with its unit.
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") in ("67108864b", "64m", "64MB"):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sent(small: DataFrame, rows: int, most: int) -> DataFrame:
    """A written table for a join: to all tasks if it has no more than ``most`` rows, else by a shuffle."""
    return F.broadcast(small) if rows <= most else small.hint("merge")


def trim() -> None:
    """Give back what Arrow and the C library hold in reserve.

    Python workers live on after their task, next to those of the next one.
    """
    pa.default_memory_pool().release_unused()
    library = ctypes.CDLL(None)
    if hasattr(library, "malloc_trim"):
        library.malloc_trim(0)


def trimmed(rows):
    """A generator of Arrow batches that gives back memory when it ends."""

    @functools.wraps(rows)
    def generator(batches):
        try:
            yield from rows(batches)
        finally:
            trim()

    return generator


def binary(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Texts, null as empty."""
    return [value or "" for value in column.to_pylist()]


def batches_of(rows: Iterable[pa.RecordBatch], most_bytes: int) -> Iterator[pa.Table]:
    """Arrow batches put together until they hold about ``most_bytes``."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in rows:
        held.append(batch)
        size += batch.nbytes
        if size >= most_bytes:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def byte_slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``BATCH_BYTES`` of a binary column, at least a row each."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy()
    unit = np.cumsum(sizes) // BATCH_BYTES
    starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]]) if len(sizes) else []
    for lo, hi in zip(starts, [*starts[1:], len(sizes)]):
        yield batch.slice(lo, hi - lo)


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit words (the finaliser of splitmix64)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def one_text_each(rows: DataFrame) -> DataFrame:
    """``doc_id``, ``label`` and of the texts of each such pair that with the least hash.

    Each task picks one before anything is sent, so an id with most of the rows is no large group.
    """
    picked = rows.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("least"))
    return picked.select("doc_id", "label", F.col("least.text").alias("text"))
