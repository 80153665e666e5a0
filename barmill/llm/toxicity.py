"""Toxicity by a factorization machine over hashed terms.

A document is the set of its hashed lower-case words, of which those count that tell toxic documents
from others, alone or in a pair. The machine adds a weight per term and, for each pair of terms, the inner product of their factors, so that
two terms may count for more together than apart. It is fitted on a bounded sample of labelled
documents in one task, which returns tables of fixed size; every text is then scored whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barmill.llm.common import held_out, mix64, one_text_each, prepare, table, texts, trim, trimmed

#: Terms are hashed to this many slots.
SLOTS = 1 << 18
FACTORS = 8
#: Longer words also count by their first letters, for endings not met in training.
STEM = 5
#: Most labelled documents that are fitted on: those with the least hash of their id.
TRAINING_ROWS = 12_000
#: Slots seen in fewer training documents, or whose share of toxic documents is within so many
#: standard deviations of the overall share, get no weight of their own: what they teach is noise.
#: They get one if a share, their own or that of a pair they are in, is beyond chance even among
#: as many as there are.
LEAST_DOCUMENTS = 5
LEAST_SHARE = 0.001
LEAST_DEVIATIONS = 4.5
#: Of the training documents of one label that share so much of their slots, the first is kept.
COPY = 0.8
#: Bands of three least hashes by which they are found, and documents of a band that are compared.
COPY_BANDS, COPY_TRIES = 8, 8
EPOCHS = 40
BATCH = 256
STEP = 0.2
PENALTY = 1e-5

_WORD = re.compile(r"\w+")


def slots_of(text: str) -> np.ndarray:
    """The distinct hashed terms of a whole text: its words and their stems."""
    words = set(_WORD.findall(text.lower()))
    words |= {"^" + w[:STEM] for w in words if len(w) > STEM}
    found = {crc32(w.encode("utf-8", "surrogatepass")) % SLOTS for w in words}
    return np.fromiter(found, np.int32, len(found))


@trimmed
def _slot_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [np.sort(slots_of(t)) for t in texts(batch["text"])]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["label"], pa.array(found, pa.list_(pa.int32()))],
            ["doc_id", "label", "slots"],
        )


class Machine:
    """By slot: whether it is known (0 or 1), its weight, its factors; and the bias."""

    def __init__(self, bias: float, known: np.ndarray, linear: np.ndarray, factors: np.ndarray):
        self.bias, self.known, self.linear, self.factors = bias, known, linear, factors

    def score(self, slots: np.ndarray) -> float:
        slots = slots[self.known[slots] > 0]
        v = self.factors[slots]
        pairs = 0.5 * (v.sum(0) ** 2 - (v**2).sum(0)).sum()
        total = self.bias + float(self.linear[slots].sum()) + float(pairs)
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))

    def to_bytes(self) -> bytes:
        return b"".join(
            np.ascontiguousarray(a, np.float32).tobytes()
            for a in (np.array([self.bias]), self.known, self.linear, self.factors)
        )

    @classmethod
    def from_bytes(cls, blob: bytes) -> Machine:
        flat = np.frombuffer(blob, np.float32)
        known, linear = flat[1 : 1 + SLOTS], flat[1 + SLOTS : 1 + 2 * SLOTS]
        return cls(float(flat[0]), known, linear, flat[1 + 2 * SLOTS :].reshape(SLOTS, FACTORS))


def _least_hashes(rows: list[np.ndarray]) -> np.ndarray:
    """For each row and each of ``COPY_BANDS`` bands, the three least hashes as one number; rows are not empty."""
    starts = np.r_[0, np.cumsum([len(r) for r in rows])[:-1]]
    flat = np.concatenate(rows).astype(np.uint64)
    keys = np.zeros((len(rows), COPY_BANDS), np.uint64)
    for seed in range(3 * COPY_BANDS):
        least = np.minimum.reduceat(mix64(flat + mix64(np.array([seed + 1], np.uint64))), starts)
        keys[:, seed // 3] = mix64(keys[:, seed // 3] ^ least)
    return keys


def _without_copies(rows: list[np.ndarray], labels: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Documents but those that are ``COPY`` similar to one kept, of the same label.

    They would pass for independent evidence. Bands only pick the kept rows to compare with, the
    last ``COPY_TRIES`` of a band; what is not found to be a copy stays.
    """
    full = [i for i, r in enumerate(rows) if len(r)]
    keys = dict(zip(full, _least_hashes([rows[i] for i in full]).tolist())) if full else {}
    kept, bands, empty = [], {}, set()
    mark = np.zeros(SLOTS, bool)
    for i, slots in enumerate(rows):
        if not len(slots):
            if labels[i] not in empty:
                kept.append(i)
            empty.add(labels[i])
            continue
        names = [(k, key, labels[i]) for k, key in enumerate(keys[i])]
        mark[slots] = True
        copy = False
        for j in {j for name in names for j in bands.get(name, ())}:
            common = int(mark[rows[j]].sum())
            copy = common >= COPY * (len(slots) + len(rows[j]) - common)
            if copy:
                break
        mark[slots] = False
        if not copy:
            kept.append(i)
            for name in names:
                bands[name] = (*bands.get(name, ()), i)[-COPY_TRIES:]
    return [rows[i] for i in kept], labels[kept]


def _bits(found: np.ndarray, n: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Bits of the chance, by Chernoff's bound, of ``found`` among ``n`` or further from what is expected."""
    share = found / np.maximum(n, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        one = np.where(found > 0, found * np.log2(share / chance), 0)
        other = np.where(found < n, (n - found) * np.log2((1 - share) / (1 - chance)), 0)
    return one + other


def _paired(rows: list[np.ndarray], labels: np.ndarray, slots: np.ndarray, share: float) -> np.ndarray:
    """Those of ``slots`` in a pair whose share of toxic documents neither of its terms accounts for.

    A pair is held against the overall share, that of each term, and what their weights add up to,
    whichever is nearest; of all pairs of ``slots`` less than one is expected to pass by accident.
    """
    chosen = np.zeros(SLOTS, bool)
    if len(slots) < 2:
        return np.flatnonzero(chosen)
    needed = 2 * np.log2(len(slots))
    seen = np.bincount(np.concatenate(rows), minlength=SLOTS)
    for label in (1, 0):
        base = share if label else 1 - share
        # With fewer documents of this label, a pair has not the bits even if it is in no others.
        least = max(1, int(np.ceil(needed / -np.log2(base))))
        own = np.bincount(np.concatenate([r if y == label else r[:0] for r, y in zip(rows, labels)]), minlength=SLOTS)
        able = slots[own[slots] >= least]
        if len(able) < 2:
            continue
        place = np.full(SLOTS, -1)
        place[able] = np.arange(len(able))
        short = [place[r] for r in rows]
        short = [np.sort(r[r >= 0]) for r in short]
        flat, sizes = np.concatenate(short), np.array([len(r) for r in short])
        doc = np.repeat(np.arange(len(rows)), sizes)
        order = np.argsort(flat, kind="stable")
        ends = np.cumsum(np.bincount(flat, minlength=len(able)))
        alone = (own[able] + base) / (seen[able] + 1)
        odds = alone / (1 - alone)
        for a, end in enumerate(ends):
            docs = doc[order[end - seen[able[a]] : end]]
            same = docs[labels[docs] == label]
            found = np.bincount(np.concatenate([short[i] for i in same]), minlength=len(able))
            found[: a + 1] = 0
            others = np.flatnonzero(found >= least)
            if not len(others):
                continue
            hit = found[others]
            n = np.bincount(np.concatenate([short[i] for i in docs]), minlength=len(able))[others]
            both = odds[a] * odds[others] * (1 - base) / base
            chance = np.maximum.reduce([np.full(len(others), max(base, alone[a])), alone[others], both / (1 + both)])
            passed = others[(hit > n * chance) & (_bits(hit, n, np.minimum(chance, 1 - 1e-9)) >= needed)]
            if len(passed):
                chosen[able[a]] = True
                chosen[able[passed]] = True
    return np.flatnonzero(chosen)


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Machine:
    """Logistic loss, mini-batches in a fixed order, step sizes by past gradients (AdaGrad)."""
    rows, labels = _without_copies(rows, labels)
    n = len(rows)
    marked = np.zeros(SLOTS, np.float32)
    linear, factors = np.zeros(SLOTS, np.float32), np.zeros((SLOTS, FACTORS), np.float32)
    if not n:
        return Machine(0.0, marked, linear, factors)
    seen = np.bincount(np.concatenate(rows), minlength=SLOTS)
    toxic = np.bincount(np.concatenate([r if y else r[:0] for r, y in zip(rows, labels)]), minlength=SLOTS)
    share = (labels.sum() + 1) / (n + 2)
    bias = float(np.log(share / (1 - share)))
    deviations = np.abs(toxic - share * seen) / np.sqrt(np.maximum(seen, 1) * share * (1 - share))
    often = np.flatnonzero(seen >= LEAST_DOCUMENTS)
    clear = (seen >= max(LEAST_DOCUMENTS, LEAST_SHARE * n)) & (deviations >= LEAST_DEVIATIONS)
    clear[often] |= _bits(toxic[often], seen[often], share) >= np.log2(max(len(often), 1))
    clear[_paired(rows, labels, often, share)] = True
    known = np.flatnonzero(clear)
    marked[known] = 1
    place = np.full(SLOTS, -1)
    place[known] = np.arange(len(known))
    random = np.random.default_rng(7)
    w = np.zeros(len(known))
    v = random.normal(0, 0.01, (len(known), FACTORS))
    past_w, past_v, past_b = np.full(len(known), 1e-6), np.full(v.shape, 1e-6), 1e-6
    kept = [place[r[place[r] >= 0]] if len(r) else np.empty(0, int) for r in rows]
    for _ in range(EPOCHS):
        order = random.permutation(n)
        for lo in range(0, n, BATCH):
            chosen = order[lo : lo + BATCH]
            sizes = np.array([len(kept[i]) for i in chosen])
            flat = np.concatenate([kept[i] for i in chosen])
            doc = np.repeat(np.arange(len(chosen)), sizes)
            vx = v[flat]
            sums = np.zeros((len(chosen), FACTORS))
            squares = np.zeros(len(chosen))
            full = np.flatnonzero(sizes)
            if len(full):
                starts = np.r_[0, np.cumsum(sizes[full])[:-1]]
                sums[full] = np.add.reduceat(vx, starts)
                squares[full] = np.add.reduceat((vx**2).sum(1), starts)
            linear_part = np.bincount(doc, w[flat], len(chosen))
            total = bias + linear_part + 0.5 * ((sums**2).sum(1) - squares)
            error = 1 / (1 + np.exp(-np.clip(total, -30, 30))) - labels[chosen]
            e = error[doc]
            gw = np.bincount(flat, e, len(w)) / len(chosen)
            inner = e[:, None] * (sums[doc] - vx)
            gv = np.stack([np.bincount(flat, inner[:, k], len(w)) for k in range(FACTORS)], 1) / len(chosen)
            hit = np.unique(flat)
            gw[hit] += PENALTY * w[hit]
            gv[hit] += PENALTY * v[hit]
            past_w[hit] += gw[hit] ** 2
            past_v[hit] += gv[hit] ** 2
            w[hit] -= STEP * gw[hit] / np.sqrt(past_w[hit])
            v[hit] -= 0.1 * STEP * gv[hit] / np.sqrt(past_v[hit])
            past_b += error.mean() ** 2
            bias -= 0.1 * STEP * error.mean() / np.sqrt(past_b)
    linear[known], factors[known] = w, v
    return Machine(float(bias), marked, linear, factors)


def _fit_group(rows: pa.Table) -> pa.Table:
    order = np.argsort(rows["doc_id"].to_numpy(), kind="stable")
    held = rows["slots"].combine_chunks()
    held = held.chunk(0) if isinstance(held, pa.ChunkedArray) else held
    # Views of one array: as Python numbers the slots would take ten times the room.
    ends, flat = held.offsets.to_numpy(), held.values.to_numpy()
    slots = [flat[ends[i] : ends[i + 1]] for i in order]
    model = fit(slots, rows["label"].to_numpy()[order].astype(float)).to_bytes()
    del held, flat, slots, rows
    trim()
    return pa.table({"model": [model]})


def train(documents: DataFrame, labels: DataFrame, most_rows: int = TRAINING_ROWS) -> Machine:
    """Fit on labelled documents that are not held out, ``most_rows`` of them at most.

    Of rows that share an id one text is taken. Rows with a null id or a null label teach nothing; a label other than 0 counts as 1. Without
    any label the machine scores every text 0.5.
    """
    spark = documents.sparkSession
    prepare(spark)
    usable = F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    sample = (
        labels.where(usable)
        .select(F.col("doc_id").cast("bigint").alias("id"), (F.col("toxic") != 0).cast("int").alias("label"))
        .distinct()
        .orderBy(F.xxhash64("id"), "id", "label")
        .limit(most_rows)
    )
    # At most ``most_rows`` rows of two numbers, so their size is bounded.
    chosen = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"))
    rows = chosen.join(F.broadcast(sample), F.col("doc_id") == F.col("id")).select("doc_id", "label", "text")
    rows = one_text_each(rows)
    slots = rows.mapInArrow(_slot_rows, "doc_id bigint, label int, slots array<int>")
    model = slots.groupBy().applyInArrow(_fit_group, "model binary").collect()
    if not model:
        return fit([], np.zeros(0))
    return Machine.from_bytes(bytes(model[0]["model"]))


def _score_rows(shared):
    @trimmed
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine.from_bytes(shared.value)
        for batch in batches:
            # Whole rows come as a struct, which has the text.
            column = pc.struct_field(batch["row"], "text") if "row" in batch.schema.names else batch["text"]
            scores = [machine.score(slots_of(t)) for t in texts(column.cast(pa.string()))]
            names = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), pa.array(scores, pa.float64())], [*names, "score"])

    return rows


def score(documents: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every row. Null and empty texts get the bias alone.

    Very long texts are scored whole; a text's distinct words are held at once. Words the machine has not learned count for nothing. Nothing but the text goes into a score;
    repeated rows get equal scores. Other columns are neither read nor returned.
    """
    prepare(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(machine.to_bytes())
    chosen = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return chosen.mapInArrow(_score_rows(shared), "doc_id bigint, score double")


def drop_toxic(documents: DataFrame, machine: Machine) -> DataFrame:
    """``documents`` without the rows that score 0.5 or more, all columns kept.

    A machine that has learned no term, as without labels, tells no documents apart, and all stay.
    """
    prepare(documents.sparkSession)
    if not machine.known.any():
        return documents
    names = documents.columns
    shared = documents.sparkSession.sparkContext.broadcast(machine.to_bytes())
    held = documents.select(F.struct("*").alias("row"))
    scored = held.mapInArrow(_score_rows(shared), T.StructType([*held.schema, T.StructField("score", T.DoubleType())]))
    return scored.where("score < 0.5").select(*[F.col("row").getField(n).alias(n) for n in names])


def op5_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    scored = score(documents, train(documents, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
