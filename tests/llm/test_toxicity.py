from zlib import crc32

import duckdb
import numpy as np
from cases import edges, frame, prose, rows_of
from pyspark.sql import functions as F

from barmill.llm import quality
from barmill.llm import toxicity as ops

GIVEN = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = {r[0]: r for r in rows_of(ops.op5_toxicity(spark, GIVEN), "doc_id", "held_out", "score", "predicted")}
    assert len(rows) == 10_000
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{GIVEN}/labels.parquet'").fetchall()
    asked = [(rows[i][3], y) for i, y in labels if rows[i][1]]
    assert all(rows[i][1] == (crc32(str(i).encode()) % 5 == 0) for i in rows)
    caught = sum(p for p, y in asked if y) / sum(y for _, y in asked)
    wrong = sum(p for p, y in asked if not y) / sum(1 - y for _, y in asked)
    assert caught > 0.8 and wrong < 0.01
    assert all(0 <= s <= 1 and p == (s >= 0.5) for _, _, s, p in rows.values())


def test_pairs_count_for_more_than_their_terms():
    """Only both terms together are toxic; a model of single terms cannot tell."""
    rows, labels = [], []
    for i in range(1200):
        words = prose(i, 12).split()
        a, b = i % 2, i // 2 % 2
        words += ["insult"] * a + ["people"] * b
        rows.append(ops.slots_of(" ".join(words)).astype(int))
        labels.append(a * b)
    machine = ops.fit(rows, np.array(labels, float))
    both, one = ops.slots_of("insult people"), ops.slots_of("insult")
    assert machine.score(both) > 0.5 > machine.score(one)
    again = ops.Machine.from_bytes(machine.to_bytes())
    assert abs(again.score(both) - machine.score(both)) < 1e-6


def test_rare_pairs_of_terms_that_are_near_neutral_alone():
    """Of 12,000 documents 18 have both terms and are toxic; each term alone is as innocent as any."""
    rows, labels = [], []
    for i in range(12_000):
        a, b = i < 360, i < 18 or 360 <= i < 942
        words = prose(i, 12).split() + ["insult"] * a + ["people"] * b
        toxic = i < 18 or i % 20 == 0
        words += ["vile"] * (toxic and i >= 942)
        rows.append(ops.slots_of(" ".join(words)).astype(int))
        labels.append(toxic)
    machine = ops.fit(rows, np.array(labels, float))
    both, alone = ops.slots_of("insult people"), [ops.slots_of(w) for w in ("insult", "people", "stone17")]
    assert machine.score(both) > 0.5 > max(map(machine.score, alone))
    assert machine.known.sum() < 20


def test_only_copies_of_the_same_label_are_dropped():
    """Documents under one boilerplate stay, also toxic ones behind a clean one; copies go."""
    boilerplate = prose(1, 12)
    texts = [f"{boilerplate} {prose(100 + i, 8)}" for i in range(300)]
    texts += [f"{prose(2, 60)} end{i}" for i in range(20)]
    labels = np.array([i % 3 == 2 for i in range(300)] + [i % 2 for i in range(20)], float)
    rows, left = ops._without_copies([ops.slots_of(t).astype(int) for t in texts], labels)
    assert len(rows) == 302 and left.sum() == 101
    empty = [np.empty(0, int)] * 3
    assert len(ops._without_copies(empty, np.array([0.0, 1.0, 0.0]))[0]) == 2


def test_edges(spark):
    machine = ops.train(spark.read.parquet(f"{GIVEN}/documents.parquet"), spark.read.parquet(f"{GIVEN}/labels.parquet"), 500)
    rows = edges()
    found = rows_of(ops.score(frame(spark, rows), machine), "doc_id", "score")
    assert sorted((i for i, _ in found), key=str) == sorted((i for i, _ in rows), key=str)
    assert all(0 <= s <= 1 for _, s in found)
    assert ops.score(frame(spark, []), machine).collect() == []


def test_without_labels(spark):
    labels = spark.createDataFrame([(None, 1, 1), (4, 1, None)], "doc_id bigint, quality int, toxic int")
    machine = ops.train(frame(spark, edges()), labels)
    assert {s for _, s in rows_of(ops.score(frame(spark, edges()), machine), "doc_id", "score")} == {0.5}
    assert ops.drop_toxic(frame(spark, edges()), machine).count() == len(edges())


def test_one_text_of_each_sampled_id(spark):
    """Two thousand documents that share an id teach as much as one."""
    rows = [(i, prose(i, 20)) for i in range(20)] + [(3, prose(100 + i, 20)) for i in range(2000)]
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(20)], "doc_id bigint, quality int, toxic int")
    documents = frame(spark, rows)
    least = documents.where("doc_id = 3").orderBy(F.xxhash64("text")).first()["text"]
    one_each = frame(spark, [r for r in rows if r[0] != 3] + [(3, least)])
    assert crc32(b"3") % 5
    assert ops.train(documents, labels).to_bytes() == ops.train(one_each, labels).to_bytes()
    assert quality.train(documents, labels).tobytes() == quality.train(one_each, labels).tobytes()


def test_drop_keeps_clean_rows_whole(spark):
    rows = [(i, prose(i, 30) + (" vile" if i % 3 == 0 else "")) for i in range(600)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(600)], "doc_id bigint, quality int, toxic int")
    documents = frame(spark, rows)
    left = ops.drop_toxic(documents, ops.train(documents, labels))
    assert left.schema == documents.schema
    assert sorted(rows_of(left, "doc_id", "text")) == [r for r in rows if r[0] % 3]


def test_scores_are_the_sum_over_all_pairs():
    """The short form (square of sums less sum of squares) against every pair of terms, one by one."""
    random = np.random.default_rng(4)
    known = (random.random(ops.SLOTS) < 0.5).astype(np.float32)
    linear, factors = random.normal(0, 0.3, ops.SLOTS), random.normal(0, 0.2, (ops.SLOTS, ops.FACTORS))
    machine = ops.Machine(-0.4, known, linear, factors)
    for n in (0, 1, 2, 30):
        slots = np.sort(random.choice(ops.SLOTS, n, replace=False))
        own = [s for s in slots if known[s]]
        total = -0.4 + sum(linear[s] for s in own)
        total += sum(float(factors[a] @ factors[b]) for i, a in enumerate(own) for b in own[:i])
        assert abs(machine.score(slots) - 1 / (1 + np.exp(-total))) < 1e-9


def test_chosen_pairs_are_those_of_the_definitions():
    """Every pair of frequent terms, counted and held against chance one by one."""
    random = np.random.default_rng(9)
    rows, labels = [], []
    for i in range(1500):
        slots = set(random.choice(40, random.integers(1, 7), replace=False).tolist())
        toxic = random.random() < 0.08 or {3, 5} <= slots or ({7, 8} <= slots and random.random() < 0.9)
        toxic = toxic and not ({11, 12} <= slots)
        rows.append(np.array(sorted(slots)))
        labels.append(float(toxic))
    labels = np.array(labels)
    share = (labels.sum() + 1) / (len(labels) + 2)
    often = np.flatnonzero(np.bincount(np.concatenate(rows), minlength=ops.SLOTS) >= ops.LEAST_DOCUMENTS)
    sets, needed, chosen = [set(r.tolist()) for r in rows], 2 * np.log2(len(often)), set()
    for label, base in ((1, share), (0, 1 - share)):
        def alone(a):
            docs = [y for s, y in zip(sets, labels) if a in s]
            return (sum(y == label for y in docs) + base) / (len(docs) + 1)

        least = max(1, int(np.ceil(needed / -np.log2(base))))
        for i, a in enumerate(often):
            for b in often[:i]:
                both = [y for s, y in zip(sets, labels) if a in s and b in s]
                hit, n = sum(y == label for y in both), len(both)
                if hit < least:
                    continue
                x, y = alone(a), alone(b)
                odds = x / (1 - x) * y / (1 - y) * (1 - base) / base
                chance = min(max(base, x, y, odds / (1 + odds)), 1 - 1e-9)
                found = hit / n
                bits = hit * np.log2(found / chance) + ((n - hit) * np.log2((1 - found) / (1 - chance)) if hit < n else 0)
                if hit > n * chance and bits >= needed:
                    chosen |= {int(a), int(b)}
    assert {3, 5} <= chosen and set(ops._paired(rows, labels, often, share).tolist()) == chosen
