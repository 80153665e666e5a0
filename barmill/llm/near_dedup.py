"""Near-duplicates by min-max hashing, each link confirmed on the full sets.

A document is its set of five-word shingles. Under each of ``HASHES`` hash functions both the
least and the greatest value of the set are kept, so a signature takes half as many evaluations
as values. Bands of ``ROWS`` values are keys; documents that share a key are compared on their
full sets. At a similarity of 0.75 a pair is missed by all bands with a probability of 1e-4, and
of a group of copies all pairs would have to be.

Documents with equal sets are one class, of which one member is compared. A bucket (the classes
that share a key) is dealt into chunks of bounded size, and within a chunk classes are compared
only until they are known to be connected. A second pass compares, across the chunks of large
buckets, what the first one has left apart. Neither drops or caps anything.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmill.llm.common import byte_slices, mix64, prepare, sent, table, trimmed, written
from barmill.llm.components import connected
from barmill.llm.filters import filter_of, passes

SHINGLE = 5
#: Linked if PERCENT_UNION * intersection size >= PERCENT * union size.
PERCENT, PERCENT_UNION = 75, 100
HASHES, ROWS = 144, 6
BANDS = 2 * HASHES // ROWS
#: Classes of a bucket, and shingles of them all, that are compared in one task (8 bytes each, some ten times
#: that while they are); both on average, as classes are dealt out by hash.
CHUNK, CHUNK_SHINGLES = 256, 1 << 20

#: Ids of documents to be dropped that are sent to all tasks; more are joined by a shuffle.
IDS_SENT = 1_000_000

_random = np.random.default_rng(20)
_FACTORS = _random.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_OFFSETS = _random.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_BAND = _random.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; none for a text without words."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(column, "")))
    flat = words.flatten().dictionary_encode()
    distinct = flat.dictionary.cast(pa.binary()).to_pylist()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct], np.uint64)
    blank = distinct.index(b"") if b"" in distinct else -1
    codes = flat.indices.to_numpy()
    ends = np.cumsum(pc.list_value_length(words).to_numpy())
    for lo, hi in zip(np.r_[0, ends[:-1]], ends):
        own = codes[lo:hi]
        h = hashes[own[own != blank]]
        if len(h) >= SHINGLE:
            n = len(h) - SHINGLE + 1
            total = h[:n].copy()
            for i in range(1, SHINGLE):
                total = mix64(total) + h[i : i + n] * np.uint64(2 * i + 1)
            yield np.unique(mix64(total))
        elif len(h):
            total = np.uint64(len(h))
            for value in h:
                total = mix64(np.array([total]))[0] ^ value
            yield mix64(np.array([total], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """A row of keys for each set, none of them empty."""
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    signature = np.empty((len(sets), 2 * HASHES), np.uint64)
    for k in range(HASHES):
        values = flat * _FACTORS[k] + _OFFSETS[k]
        values ^= values >> np.uint32(15)
        values *= np.uint32(0x2C1B3C6D)
        signature[:, k] = np.minimum.reduceat(values, starts)
        signature[:, HASHES + k] = np.maximum.reduceat(values, starts)
    banded = signature.reshape(len(sets), BANDS, ROWS) + np.uint64(1)
    return mix64((banded * _BAND).sum(2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


@trimmed
def _signature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sets = list(shingle_sets(batch["text"]))
        full = [i for i, s in enumerate(sets) if len(s)]
        keys: list = [None] * len(sets)
        if full:
            for i, row in zip(full, band_keys([sets[i] for i in full]).astype(np.int64)):
                keys[i] = row
        digests = [blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
        arrays = [
            batch["doc_id"],
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array(digests, pa.binary()),
            pa.array(keys, pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_shingles", "digest", "bands"])


def _set_rows(shared):
    @trimmed
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].fill_null(0).to_numpy()
            wanted = pa.array(passes(shared.value, mix64(ids.astype(np.uint64))))
            batch = batch.filter(pc.and_(wanted, batch["doc_id"].is_valid()))
            if batch.num_rows:
                sets = [s.tobytes() for s in shingle_sets(batch["text"])]
                arrays = [batch["doc_id"], pa.array(sets, pa.binary())]
                yield from byte_slices(pa.RecordBatch.from_arrays(arrays, ["rep", "shingles"]), "shingles")

    return rows


def _hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = mix64(batch["rep"].to_numpy().astype(np.uint64)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(hashes)], ["h"])


def linked_pairs(reps: np.ndarray, roots: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect all classes here that have a path of links, beyond those of equal root.

    Each class is compared with all others at once, and not at all once everything is connected.
    """
    sizes = np.array([len(s) for s in sets])
    flat, places = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    label = np.unique(roots, return_inverse=True)[1]
    found = []
    mark = np.zeros(len(flat), bool)
    for i in range(len(sets)):
        if not (label != label[i]).any():
            continue
        own = places[starts[i] : starts[i] + sizes[i]]
        mark[own] = True
        common = np.add.reduceat(mark[places], starts, dtype=np.int64)
        mark[own] = False
        union = sizes + sizes[i] - common
        linked = (label != label[i]) & (PERCENT_UNION * common >= PERCENT * union)
        for j in np.flatnonzero(linked):
            if label[j] != label[i]:
                found.append((int(reps[i]), int(reps[j])))
                label[label == label[j]] = label[i]
    return found


def _link_group(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("rep")
    sets = [np.frombuffer(b, np.uint64) for b in rows["shingles"].to_pylist()]
    pairs = linked_pairs(rows["rep"].to_numpy(), rows["root"].to_numpy(), sets) if len(sets) > 1 else []
    return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})


def _links(groups: DataFrame, sets: DataFrame, keys: list[str]) -> DataFrame:
    """Links within the groups: rows of ``keys``, ``rep``, ``root``."""
    joined = groups.join(sets, "rep")
    return written(joined.groupBy(*keys).applyInArrow(_link_group, "a bigint, b bigint"), "links")


def shared_buckets(classes: DataFrame) -> DataFrame:
    """``bucket``, ``chunks``, ``rep``: the classes that share a key; buckets of equal members are one.

    Classes are told apart by their digest, since rows of one id may be in several of them.
    """
    keyed = classes.select("rep", "digest", "n_shingles", F.explode("bands").alias("bucket"))
    buckets = (
        keyed.groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("n_shingles").alias("size"),
            F.bit_xor(F.xxhash64("digest")).alias("x"),
            F.bit_xor(F.xxhash64("digest", F.lit(1))).alias("y"),
        )
        .where("n > 1")
    )
    one_each = buckets.groupBy("n", "size", "x", "y").agg(F.min("bucket").alias("bucket"))
    chunks = _parts(F.col("n"), F.col("size")).alias("chunks")
    return keyed.drop("digest", "n_shingles").join(one_each.select("bucket", chunks, "size", "n"), "bucket")


def _parts(n, size):
    """Into how many parts so many classes of so many shingles are dealt."""
    return F.greatest(F.ceil(n / CHUNK), F.ceil(size / CHUNK_SHINGLES)).cast("int")


def _chunk(chunks, salt: int = 0):
    return F.pmod(F.xxhash64("rep", F.lit(salt)), chunks).cast("int")


def _across(members: DataFrame, roots: DataFrame) -> DataFrame | None:
    """Groups that bring together what large buckets hold of different components.

    Members outside the largest component of their bucket meet every chunk of it.
    """
    large = members.where("chunks > 1")
    if large.isEmpty():
        return None
    named = large.join(roots, large["rep"] == roots["node"], "left")
    root = F.coalesce("root", "rep").alias("root")
    named = written(named.select("bucket", "chunks", "rep", root, (F.col("size") / F.col("n")).alias("mean")), "large")
    sizes = named.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"), F.max("mean").alias("mean"))
    per = sizes.groupBy("bucket").agg(
        F.sum("n").alias("n"),
        F.max("n").alias("most"),
        F.max_by("root", F.struct("n", "root")).alias("main"),
        F.max("mean").alias("mean"),
    )
    apart = F.col("n") - F.col("most")
    parts = _parts(apart, apart * F.col("mean")).alias("parts")
    named = named.join(per.where("n > most").select("bucket", "main", parts), "bucket")
    own = named.select(
        "bucket",
        "rep",
        "root",
        _chunk(F.col("chunks")).alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
    )
    apart = named.where("root <> main").select(
        "bucket",
        "rep",
        "root",
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        _chunk(F.col("parts"), 1).alias("part"),
    )
    return own.union(apart).distinct()


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (least id reachable over links) and ``kept``.

    A-Z are lower-cased, words are what lies between blanks (``[\\x20\\x09-\\x0D]``). A text of
    fewer than five words is one shingle; one without words, or null, is linked with nothing. Rows
    that share an id count as one document that has all their links. A row without an id is linked
    with nothing, has no component and is kept. Other columns are neither read nor returned.
    """
    spark = documents.sparkSession
    prepare(spark)
    chosen = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    schema = "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>"
    rows = written(chosen.mapInArrow(_signature_rows, schema), "signatures")
    full = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = full.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands"), F.any_value("n_shingles").alias("n_shingles")
    )
    members = written(shared_buckets(classes), "buckets")
    hashed = members.select("rep").distinct().mapInArrow(_hash_rows, "h bigint")
    shared = spark.sparkContext.broadcast(filter_of(hashed, F.col("h")))
    sets = written(chosen.mapInArrow(_set_rows(shared), "rep bigint, shingles binary"), "sets")

    first = members.select("bucket", "rep", F.col("rep").alias("root"), _chunk(F.col("chunks")).alias("chunk"))
    links = _links(first, sets, ["bucket", "chunk"])
    roots = connected(links)
    groups = _across(members, roots)
    if groups is not None:
        links = links.union(_links(groups, sets, ["bucket", "chunk", "part"]))
        roots = connected(links)

    named = full.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    named = named.join(roots, F.col("rep") == F.col("node"), "left")
    named = named.select(F.col("digest"), F.coalesce("root", "rep").alias("root"))
    joined = rows.join(named, (rows["digest"] == named["digest"]) & rows["doc_id"].isNotNull(), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("root")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def drop_near_duplicates(documents: DataFrame) -> DataFrame:
    """``documents`` with one document of each component, all columns kept.

    Documents are not shuffled while ``IDS_SENT`` ids at most are to go.
    """
    gone = near_duplicates(documents).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    gone = written(gone, "gone")
    return documents.join(sent(gone, gone.count(), IDS_SENT), documents["doc_id"] == F.col("_gone"), "left_anti")


def op4_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(
           string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(
           CASE WHEN len(w) >= 5
                THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n
  HAVING 100 * count(*) >= 75 * (p.n + q.n - count(*))),
reach(x, y) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = doc_id AS kept
FROM (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
LEFT JOIN sizes USING (doc_id)
"""
