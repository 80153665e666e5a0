"""Benchmark decontamination by one Aho-Corasick automaton.

Test questions and answers are normalised to words and cut into windows of ten words. All windows
go into one automaton, which is run over the normalised words of every document once. What it
finds is mapped back to where it stands in the original text.

Words are numbers to the automaton, each two symbols long, so that no state has more followers
than about the root of the vocabulary. A word that no window has sends it back to its start, so
it is run over the stretches between such words only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmill.llm.common import prepare, table, trim, trimmed, written

#: Words of a window; an item of fewer is one window.
WINDOW = 10
#: Words of benchmark text in one automaton (some 10 symbols of 40 bytes a word). A larger benchmark is
#: dealt to several, and documents are scanned once for each.
PART_WORDS = 200_000
#: Bytes of text that are normalised at once.
UNIT_BYTES = 8 << 20

# A-Z become a-z; what is neither a letter, a digit nor beyond ASCII becomes a space.
_FOLD = bytes(c if c > 127 else ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256))

_HITS = "doc_id bigint, n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:bigint,end:bigint>>"


def folded(column: pa.Array) -> pa.Array:
    """The texts, null as empty, with A-Z lower-cased and separators as spaces, byte for byte as long."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    column = pa.concat_arrays([column])  # offsets from 0
    _, offsets, data = column.buffers()
    text = (data.to_pybytes() if data else b"").translate(_FOLD)
    return pa.LargeStringArray.from_buffers(len(column), offsets, pa.py_buffer(text))


def _words(column: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts end to end, and where each text's words end."""
    words = pc.ascii_split_whitespace(folded(column))
    flat = words.flatten().dictionary_encode()
    distinct = flat.dictionary.cast(pa.large_binary()).to_pylist()
    ends = np.cumsum(pc.list_value_length(words).to_numpy())
    if b"" in distinct:  # before the first and after the last space
        some = flat.indices.to_numpy() != distinct.index(b"")
        ends = np.r_[0, np.cumsum(some)][ends]
        flat = flat.filter(pa.array(some))
    return flat, ends


class Automaton:
    """Windows of items as patterns; ``items`` are (id as text or None, words)."""

    def __init__(self, items: list[tuple[str | None, list[str]]]):
        owners: dict[tuple[str, ...], set[str]] = {}
        for item, words in items:
            for i in range(max(1, len(words) - WINDOW + 1) if words else 0):
                own = owners.setdefault(tuple(words[i : i + WINDOW]), set())
                if item is not None:
                    own.add(item)
        self.vocabulary = {w: n for n, w in enumerate(sorted({w for window in owners for w in window}))}
        self.radix = math.isqrt(len(self.vocabulary)) + 1
        self.owners = list(owners.values())
        self.lengths = np.array([len(window) for window in owners], np.int64)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for n, window in enumerate(owners):
            self.machine.add_word(self._symbols(np.array([self.vocabulary[w] for w in window])), n)
        if owners:
            self.machine.make_automaton()

    def _symbols(self, ids: np.ndarray) -> tuple[int, ...]:
        # First symbols are below all second ones, so no match begins within a word.
        pairs = np.stack([ids // self.radix, ids % self.radix + self.radix + 1], axis=1)
        return tuple(pairs.ravel().tolist())

    def scan(self, flat: pa.DictionaryArray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where windows end (place among all words) and which they are, by place; none crosses a text's end."""
        known = np.array([self.vocabulary.get(w, -1) for w in flat.dictionary.to_pylist()], np.int64)
        ids = known[flat.indices.to_numpy()] if len(flat) else np.zeros(0, np.int64)
        inside = np.r_[False, ids >= 0, False]
        first = np.zeros(len(ids) + 1, bool)
        first[np.r_[0, ends]] = True
        begins = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
        stops = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
        places: list[int] = []
        windows: list[int] = []
        if len(self.lengths):
            long = stops - begins >= self.lengths.min()
            for lo, hi in zip(begins[long].tolist(), stops[long].tolist()):
                for at, window in self.machine.iter(self._symbols(ids[lo:hi])):
                    places.append(lo + at // 2)
                    windows.append(window)
        return np.array(places, np.int64), np.array(windows, np.int64)


def _spans(text: str, hit: np.ndarray) -> list[dict]:
    """Runs of hit words as code points of the text as it was, end exclusive."""
    data = text.encode()
    fold = data.translate(_FOLD)
    edges = np.flatnonzero(np.diff(np.r_[0, np.frombuffer(fold, np.uint8) != 32, 0]))
    starts, ends = edges[::2], edges[1::2]
    runs = np.flatnonzero(np.diff(np.r_[0, hit, 0]))
    # Bytes that begin a code point, counted up to each byte.
    points = np.r_[0, np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)]
    return [{"start": int(points[starts[a]]), "end": int(points[ends[b - 1]])} for a, b in zip(runs[::2], runs[1::2])]


def _units(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``UNIT_BYTES`` of text."""
    sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy()
    unit = np.cumsum(sizes) // UNIT_BYTES
    for _, rows in groupby(range(len(sizes)), key=lambda i: unit[i]):
        rows = list(rows)
        yield batch.slice(rows[0], len(rows))


def _hit_rows(shared, hits_only: bool):
    @trimmed
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton: Automaton = shared.value
        for batch in batches:
            for some in _units(batch):
                flat, ends = _words(some["text"])
                begins = np.r_[0, ends[:-1]]
                places, windows = automaton.scan(flat, ends)
                cover = np.zeros(len(flat) + 1, np.int64)
                np.add.at(cover, places - automaton.lengths[windows] + 1, 1)
                np.add.at(cover, places + 1, -1)
                hit = np.cumsum(cover[:-1]) > 0
                docs = np.searchsorted(ends, places, "right")
                found: dict[int, set[str]] = {}
                for doc, window in {*zip(docs.tolist(), windows.tolist())}:
                    found.setdefault(doc, set()).update(automaton.owners[window])
                total = np.r_[0, np.cumsum(hit)]
                kept = sorted(found) if hits_only else range(some.num_rows)
                spans = [
                    _spans(some["text"][i].as_py(), hit[begins[i] : ends[i]]) if i in found else [] for i in kept
                ]
                chosen = pa.array(kept, pa.int64())
                arrays = {
                    "doc_id": some["doc_id"].take(chosen),
                    "n_words": pa.array(ends - begins, pa.int64()).take(chosen),
                    "n_hit": pa.array(total[ends] - total[begins], pa.int64()).take(chosen),
                    "items": pa.array([sorted(found.get(i, ())) for i in kept], pa.list_(pa.string())),
                    "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                }
                yield pa.RecordBatch.from_pydict(arrays)
                del flat, some
            trim()

    return rows


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items cut into sections that have every window once, each with its number of words."""
    for batch in batches:
        for i, item in enumerate(batch["item_id"].to_pylist()):
            flat, _ = _words(batch["text"].slice(i, 1))
            words = flat.cast(pa.large_string()).to_pylist()
            step = PART_WORDS // 4
            cut = [words[at : at + step + WINDOW - 1] for at in range(0, max(1, len(words) - WINDOW + 1), step)]
            cut = [c for c in cut if c]
            arrays = [
                pa.array([item] * len(cut), pa.string()),
                pa.array([" ".join(c) for c in cut], pa.string()),
                pa.array([len(c) for c in cut], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["item", "words", "n"])


def _parts(benchmark: DataFrame) -> Iterator[Automaton]:
    """Automata of bounded size for all windows; equal sections of one item count once."""
    chosen = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    sections = written(chosen.mapInArrow(_word_rows, "item string, words string, n bigint").distinct(), "benchmark")
    total = sections.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, -(-total // PART_WORDS))
    part = F.pmod(F.xxhash64("item", "words"), F.lit(parts))
    for p in range(parts):
        # About PART_WORDS words, since no section has more than a quarter of that.
        yield Automaton([(r["item"], r["words"].split(" ")) for r in sections.where(part == p).collect()])


def _merged(hits: DataFrame, base: DataFrame) -> DataFrame:
    """Results of several automata over the same numbered rows put together."""
    span = F.explode("spans").alias("span")
    # The spans of different automata overlap or not; a span begins where no earlier one reaches.
    each = hits.select(F.col("doc_id").alias("row"), span).select("row", "span.*").distinct()
    merged = each.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("all"))
    items = hits.select(F.col("doc_id").alias("row"), F.explode("items").alias("item")).distinct()
    named = items.groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    return base.join(merged, "row", "left").join(named, "row", "left")


def _whole_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and joined spans from the texts and the spans of all automata."""
    for batch in batches:
        out: dict[str, list] = {name: [] for name in ("doc_id", "n_words", "n_hit", "items", "spans")}
        for row in batch.to_pylist():
            text = row["text"] or ""
            data = text.encode()
            edges = np.flatnonzero(np.diff(np.r_[0, np.frombuffer(data.translate(_FOLD), np.uint8) != 32, 0]))
            points = np.r_[0, np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)]
            starts = points[edges[::2]]
            cover = np.zeros(len(starts) + 1, np.int64)
            for span in row["all"] or []:
                cover[np.searchsorted(starts, span["start"])] += 1
                cover[np.searchsorted(starts, span["end"])] -= 1
            hit = np.cumsum(cover[:-1]) > 0
            out["doc_id"].append(row["doc_id"])
            out["n_words"].append(len(starts))
            out["n_hit"].append(int(hit.sum()))
            out["items"].append(row["items"] or [])
            out["spans"].append(_spans(text, hit) if hit.any() else [])
        kinds = [pa.int64()] * 3 + [pa.list_(pa.string()), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """What each document has of the benchmark: ``doc_id``, ``n_words``, ``n_hit``, ``items``, ``spans``.

    A-Z are lower-cased; words are runs of digits, letters and everything beyond ASCII. A word is
    hit if it lies in an occurrence of a window. ``items`` are the ids (as texts, sorted) of items that
    have a window there, ``spans`` the runs of hit words in code points of the original text.

    One row for each input row, in whatever number an id or text is repeated. A null or empty text
    has no words and no hits. An item without words has no window. Items that share an id are one
    item; an item without an id marks words but is not named. Without any items nothing is hit.
    A text needs about six times its size in memory. Other columns are neither read nor returned.

    A benchmark of up to ``PART_WORDS`` words is one automaton; its size is counted first. A larger
    one is several, sent one after the other, and what they find is put together by row.
    """
    spark = documents.sparkSession
    prepare(spark)
    chosen = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    automata = _parts(benchmark)
    one, more = next(automata), next(automata, None)
    if more is None:
        return chosen.mapInArrow(_hit_rows(spark.sparkContext.broadcast(one), False), _HITS)
    base = written(chosen.withColumn("row", F.monotonically_increasing_id()), "numbered")
    numbered = base.select(F.col("row").alias("doc_id"), "text")
    hits = _with_part(_with_part(None, numbered, one), numbered, more)
    for automaton in automata:
        hits = _with_part(hits, numbered, automaton)
    return _merged(hits, base).select("doc_id", "text", "all", "items").mapInArrow(_whole_rows, _HITS)


def _with_part(hits: DataFrame | None, numbered: DataFrame, automaton: Automaton) -> DataFrame:
    shared = numbered.sparkSession.sparkContext.broadcast(automaton)
    found = written(numbered.mapInArrow(_hit_rows(shared, True), _HITS).drop("n_words", "n_hit"), "hits")
    shared.unpersist()
    return found if hits is None else hits.union(found)


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without those that have a window of the benchmark, all columns kept.

    Rows that share the id of one that goes, go too; rows without an id stay.
    """
    gone = contamination(documents, benchmark).where("n_hit > 0").select(F.col("doc_id").alias("_gone")).distinct()
    return documents.join(gone, documents["doc_id"] == F.col("_gone"), "left_anti")


def op12_decontamination(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _sql_words(name: str) -> str:
    return f"""list_filter(string_split_regex(
        translate(coalesce({name}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"""


OP12_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_sql_words("text")} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_sql_words("text")} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n,
         unnest(list_transform(range(1, greatest(2, len(w) - 8)), lambda i: array_to_string(w[i : i + 9], ' '))) AS g
  FROM items WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
wanted AS (SELECT DISTINCT n, g FROM windows),
grams AS (
  SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i,
         unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i : i + n - 1], ' '))) AS g
  FROM docs, sizes WHERE len(w) >= n),
found AS (SELECT r, i, n, g FROM grams SEMI JOIN wanted USING (n, g)),
hit AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM found JOIN windows USING (n, g) WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""
