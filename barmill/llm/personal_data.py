"""Personal data: spans by pattern, and terms that give protected values away.

Patterns find e-mail addresses, IP numbers, cards and phones. Words that stand near such a value
in several independent places, and hardly anywhere without it, disclose it as well: a term t
discloses value c if PMI(c; t) is at least ``THRESHOLD`` of the information content of c, which is
the same as p(c|t) >= p(c) ** (1 - THRESHOLD), and if chance does not bring them together as often.
All counts are over all documents. A filter of fixed size tells tasks which words to look at; the
exact decision is a join.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barmill.llm.common import mix64, prepare, table, texts, trimmed, written

KINDS = ("email", "ip", "card", "phone", "term")

#: Words on either side of a value that count as its context, within so many characters.
CONTEXT_WORDS, CONTEXT_CHARS = 8, 160
#: Each document has this many labels, least hashes of the words around the term; two documents share
#: a label with the probability of their similarity. The evidence is the number of distinct labels,
#: so copies of one passage are one piece of it.
LABELS = 8
THRESHOLD = 0.9

#: Counts that a task holds before it hands them on.
MOST_COUNTS = 200_000

#: Words that a task remembers the answer for.
MOST_WORDS = 150_000

#: Bits of the word filter, whatever the number of words.
FILTER_BITS = 1 << 22

#: Unit in which shares of a document's terms are added up, so that sums do not depend on the order.
SHARE = 1 << 20

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"\w+")
_NOT_DIGIT = re.compile(r"[^0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The local part is all that may stand before the sign, so each sign is looked at once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        done = domain.end() if domain else at + 1
        if domain:
            yield start, done
        at = text.find("@", done)


def _part_fits(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end of every match, by kind and start."""
    spans = [("email", *s) for s in _emails(text)]
    for m in _IP.finditer(text):
        if all(map(_part_fits, m[0].split("."))):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 37:
            digits = _NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                spans.append(("phone", *m.span()))
    return spans


def _is_term(word: str) -> bool:
    return len(word) >= 3 and not word.isdigit()


class _Covered:
    """Which places of a text lie in spans, asked for one by one: the spans put together, and a search by halves."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted((a, b) for _, a, b in spans):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end) - 1
        return at >= 0 and self.ends[at] > start


def contexts(text: str, spans: list[tuple[str, int, int]]) -> dict[tuple[str, str], set[str]]:
    """By value and term near it, the words around the term; words within base spans are no terms.

    Those are the words on the same side of the value, and on the other one if the text ends so
    soon that there are fewer than ``CONTEXT_WORDS``.
    """
    found: dict[tuple[str, str], set[str]] = {}
    covered = _Covered(spans)
    for kind, start, end in spans:
        value = text[start:end].lower() if kind in ("email", "ip") else _NOT_DIGIT.sub("", text[start:end])
        lo, hi = max(0, start - CONTEXT_CHARS), min(len(text), end + CONTEXT_CHARS)
        sides = []
        for a, b, side in ((lo, start, -1), (end, hi, 1)):
            words = [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text, a, b)]
            if words and lo == a and side < 0 and lo and words[0][1] == lo:
                words = words[1:]  # perhaps cut
            if words and side > 0 and hi < len(text) and words[-1][2] == hi:
                words = words[:-1]
            sides.append(words[::side])  # the nearest first
        for words, others in (sides, sides[::-1]):
            around = words + others[: max(0, CONTEXT_WORDS - len(words))]
            for word, x, y in words[:CONTEXT_WORDS]:
                if _is_term(word) and not covered.meets(x, y):
                    rest = found.setdefault((f"{kind}:{value}", word), set())
                    rest.update(w for w, _, _ in around if w != word)
    return found


_SEEDS = mix64(np.arange(1, LABELS + 1, dtype=np.uint64))


def _labels(words: set[str]) -> list[int]:
    """The least hash of the words, for each of the hash functions."""
    if not words:
        return [0] * LABELS
    h = np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64)
    return mix64(h[:, None] ^ _SEEDS).min(0).astype(np.int64).tolist()


@trimmed
def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: in how many documents each value and term stand together, with each label.

    Place -1 counts the documents; rows without a term count those of the value, and at place -2
    they add up what share of the terms of these documents stands near it.
    """
    counts: Counter = Counter()

    def rows():
        columns = list(zip(*counts)) or [()] * 4
        types = (pa.string(), pa.string(), pa.int32(), pa.int64())
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        arrays.append(pa.array(counts.values(), pa.int64()))
        return pa.RecordBatch.from_arrays(arrays, ["value", "term", "place", "label", "n"])

    for batch in batches:
        for text in texts(batch["text"]):
            if spans := base_spans(text):
                found = contexts(text, spans)
                for (value, term), words in found.items():
                    counts[value, term, -1, 0] += 1
                    counts.update((value, term, i, label) for i, label in enumerate(_labels(words)))
                near = Counter(value for value, _ in found)
                distinct = len({w for w in _WORD.findall(text.lower()) if _is_term(w)}) if near else 0
                for value, n in near.items():
                    counts[value, None, -1, 0] += 1
                    counts[value, None, -2, 0] += max(1, round(SHARE * min(1, n / max(distinct, 1))))
            if len(counts) > MOST_COUNTS:
                yield rows()
                counts.clear()
    yield rows()


def _bits(words: list[str]) -> np.ndarray:
    """Three places in the filter for each word."""
    h = np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64)
    size = np.uint64(FILTER_BITS - 1)
    return np.stack([(h >> np.uint64(s)) & size for s in (0, 21, 42)], 1).astype(np.int64)


def _bit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places = np.unique(_bits(batch["term"].to_pylist()).ravel())
        cells = pa.array(places >> 6), pa.array(places & 63)
        yield pa.RecordBatch.from_arrays(list(cells), ["cell", "bit"])


def word_filter(terms: DataFrame) -> bytes:
    """A filter that lets all of ``terms`` pass and few others. Its size is fixed."""
    cells = (
        terms.select("term")
        .mapInArrow(_bit_rows, "cell bigint, bit bigint")
        .groupBy("cell")
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit AS int))")).alias("bits"))
        .collect()
    )
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for row in cells:
        bits[row["cell"]] = row["bits"]
    return bits.tobytes()


class _Words:
    """Which distinct words pass the filter; remembers a bounded number of answers."""

    def __init__(self, bits: bytes):
        self.bits = np.frombuffer(bits, np.uint8)
        self.any = bool(self.bits.any())
        self.known: dict[str, bool] = {}

    def passing(self, words: set[str]) -> set[str]:
        if not self.any:
            return set()
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > MOST_WORDS:
            self.known, new = {}, list(words)
        if new:
            places = _bits(new)
            hit = (self.bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1
            self.known.update(zip(new, hit.all(1).tolist()))
        known = self.known
        return {w for w in words if known[w]}


def _count_rows(shared):
    @trimmed
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = _Words(shared.value), Counter()

        def rows():
            columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["term", "n"])

        for batch in batches:
            for text in texts(batch["text"]):
                counts.update(words.passing({w for w in _WORD.findall(text.lower()) if _is_term(w)}))
            if len(counts) > MOST_COUNTS:
                yield rows()
                counts.clear()
        yield rows()

    return rows


def _surprise():
    """Bits of the chance, by Chernoff's bound, that so many documents with the term have it near the value.

    ``chance`` is that of any term in any document. The first document is why the pair is looked at
    and so proves nothing; documents that are copies count neither for nor against.
    """
    more = F.col("evidence") - 1
    without = F.greatest(F.col("term_n") - F.col("pair_n"), F.lit(0))
    found, chance = more / F.greatest(more + without, F.lit(1e-9)), F.col("chance")
    rest = F.when(without > 0, without * F.log2((1 - found) / (1 - chance))).otherwise(F.lit(0.0))
    return F.when((more > 0) & (found > chance), more * F.log2(found / chance) + rest).otherwise(F.lit(0.0))


def disclosing_terms(documents: DataFrame) -> DataFrame:
    """``term`` and the greatest ``disclosure`` (0 to 1) of any value it gives away.

    Of all pairs of a term and a value that is in two documents or more, less than one is expected
    to pass by accident.
    """
    spark = documents.sparkSession
    prepare(spark)
    chosen = documents.select(F.col("text").cast("string"))
    near = written(
        chosen.mapInArrow(_context_rows, "value string, term string, place int, label bigint, n bigint")
        .groupBy("value", "term", "place", "label")
        .agg(F.sum("n").alias("n")),
        "contexts",
    )
    total = max(chosen.count(), 1)
    values = (
        near.where("term IS NULL")
        .groupBy("value")
        .agg(
            F.sum(F.when(F.col("place") == -1, F.col("n"))).alias("value_n"),
            (F.sum(F.when(F.col("place") == -2, F.col("n"))) / F.lit(SHARE * total)).alias("chance"),
        )
        .where("value_n > 1")
    )
    pairs = (
        near.where("term IS NOT NULL")
        .groupBy("value", "term")
        .agg(
            F.sum(F.when(F.col("place") < 0, F.col("n"))).alias("pair_n"),
            (F.count_if(F.col("place") >= 0) / LABELS).alias("evidence"),
        )
    )
    pairs = written(pairs.join(values, "value"), "pairs")
    needed = math.log2(max(pairs.count(), 1))
    # No pair has more bits than this, which it has if the term is only near the value.
    candidates = pairs.where((F.col("evidence") - 1) * -F.log2("chance") >= needed)
    shared = spark.sparkContext.broadcast(word_filter(candidates.select("term").distinct()))
    seen = (
        chosen.mapInArrow(_count_rows(shared), "term string, n bigint")
        .groupBy("term")
        .agg(F.sum("n").alias("term_n"))
    )
    given = F.least(F.col("pair_n") / F.col("term_n"), F.lit(1.0))
    content = -F.log2(F.col("value_n") / F.lit(total))
    share = F.when(content > 0, 1 + F.log2(given) / content).otherwise(F.lit(0.0))
    sure = candidates.join(seen, "term").where(_surprise() >= needed)
    scored = sure.groupBy("term").agg(F.max(share).alias("disclosure"))
    return scored.where(F.col("disclosure") >= THRESHOLD)


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_HIT = pa.struct([("term", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _span_rows(shared):
    @trimmed
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(shared.value)
        for batch in batches:
            base, hits = [], []
            for text in texts(batch["text"]):
                spans = base_spans(text)
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                found = []
                lower = text.lower() if words.any else ""
                passing = words.passing({w for w in _WORD.findall(lower) if _is_term(w)})
                if passing:
                    covered = _Covered(spans)
                    for m in _WORD.finditer(text):
                        word = m[0].lower()
                        if word in passing and not covered.meets(*m.span()):
                            found.append({"term": word, "start": m.start(), "end": m.end()})
                hits.append(found)
            others = [batch[name] for name in batch.schema.names if name != "text"]
            names = [name for name in batch.schema.names if name != "text"]
            arrays = [*others, pa.array(base, pa.list_(_SPAN)), pa.array(hits, pa.list_(_HIT))]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "base", "hits"])

    return rows


_SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_HITS = "array<struct<term:string,start:bigint,end:bigint>>"


def _marked(documents: DataFrame, held: DataFrame) -> DataFrame:
    """``held`` (``row`` and any columns, and ``text``) without ``text``, with ``base`` and ``terms``."""
    spark = documents.sparkSession
    terms = written(disclosing_terms(documents), "terms")
    shared = spark.sparkContext.broadcast(word_filter(terms))
    schema = held.drop("text").schema
    for name, kind in (("base", _SPANS), ("hits", _HITS)):
        schema = schema.add(name, T.DataType.fromDDL(kind))
    rows = written(held.mapInArrow(_span_rows(shared), schema), "spans")
    # The filter lets some other words pass; the join takes them out. Few rows have any.
    hit = F.size("hits") > 0
    hits = rows.where(hit).select("row", F.inline("hits")).join(terms, "term", "left_semi")
    span = F.struct(F.lit("term").alias("kind"), "start", "end")
    grouped = hits.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("terms"))
    none = F.expr(f"cast(array() AS {_SPANS})")
    joined = rows.where(hit).drop("hits").join(grouped, "row", "left")
    joined = joined.withColumn("terms", F.coalesce("terms", none))
    return joined.union(rows.where(~hit).drop("hits").withColumn("terms", none))


def personal_spans(documents: DataFrame) -> DataFrame:
    """All spans of every row: ``row``, ``doc_id``, ``base`` and ``terms`` (kind, start, end).

    Positions count code points, ends are exclusive; spans go by kind, then start. A null or empty
    text has none. Repeated rows are judged one by one. ``row`` numbers the rows. Other columns of
    ``documents`` are neither read nor returned.
    """
    prepare(documents.sparkSession)
    row, text = F.monotonically_increasing_id().alias("row"), F.col("text").cast("string")
    return _marked(documents, documents.select(row, F.col("doc_id").cast("bigint"), text))


def _without(text, spans):
    """The text with each span, and spans that overlap it, replaced by its kind in brackets."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(done, span):
        between = F.substring(text, (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        sign = F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))
        out = F.when(span["start"] < done["at"], done["out"]).otherwise(F.concat(done["out"], between, sign))
        return F.struct(out.alias("out"), F.greatest(done["at"], span["end"]).alias("at"))

    done = F.aggregate(spans, start, step)
    rest = F.substring(text, (done["at"] + 1).cast("int"), F.length(text))
    return F.when(F.size(spans) > 0, F.concat(done["out"], rest)).otherwise(text)


def sanitised(documents: DataFrame) -> DataFrame:
    """``documents`` with all spans replaced; ``n_chars``, where there is one, follows the text."""
    prepare(documents.sparkSession)
    held = documents.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("document"))
    held = held.select("row", "document", F.col("document.text").cast("string").alias("text"))
    marked = _marked(documents, held)
    spans = F.array_sort(
        F.transform(F.concat("base", "terms"), lambda s: F.struct(s["start"], s["end"], s["kind"]))
    )
    text = F.col("document").getField("text").cast("string")
    marked = marked.select("document", _without(text, spans).alias("text"))
    columns = [F.col("document").getField(n).alias(n) for n in documents.columns]
    for i, name in enumerate(documents.columns):
        if name == "text":
            columns[i] = F.col("text")
        elif name == "n_chars":
            length = F.length("text").cast(documents.schema[name].dataType)
            columns[i] = F.coalesce(length, columns[i]).alias(name)
    return marked.select(*columns)


def _joined(spans):
    def text(s):
        return F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))

    return F.array_join(F.transform(spans, text), ",")


def op10_personal_data(spark, sf_dir):
    spans = personal_spans(table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return spans.select(
        "doc_id",
        *[count(kind) for kind in KINDS[:-1]],
        F.sha2(_joined("base"), 256).alias("base_sha256"),
        _joined(F.concat("base", "terms")).alias("spans"),
    )
