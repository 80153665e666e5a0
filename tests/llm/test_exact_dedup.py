import hashlib
from collections import defaultdict

import numpy as np
import pytest
from cases import edges, frame, rows_of
from conftest import plan

from barmill.llm import exact_dedup

BLANKS = str.maketrans("", "", " \t\n\x0b\x0c\r")


def expected(rows):
    groups = defaultdict(list)
    for n, (i, t) in enumerate(rows):
        groups[(t or "").translate(BLANKS)].append((-len(t or ""), i is None, i or 0, n))
    out = []
    for text, members in groups.items():
        best = min(members)
        keep = None if best[1] else best[2]
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(None if m[1] else m[2], keep, len(members), sha) for m in members]
    return sorted(out, key=str)


COLUMNS = ("doc_id", "keep_id", "group_size", "text_sha256")


@pytest.mark.parametrize("partitions", [1, 40])
def test_groups(spark, partitions):
    rows = edges() + [(100 + i, "copy  of one") for i in range(300)] + [(50, "copyofone\n\n\n\n")]
    found = exact_dedup.exact_duplicates(frame(spark, rows).repartition(partitions))
    assert sorted(rows_of(found, *COLUMNS), key=str) == expected(rows)
    # Of every group, repeated rows included, one row stays.
    assert found.where("kept").count() == len({r[3] for r in expected(rows)})
    assert found.where("kept AND NOT (doc_id <=> keep_id)").count() == 0


def test_no_rows(spark):
    assert exact_dedup.exact_duplicates(frame(spark, [])).collect() == []


@pytest.mark.parametrize("most_sent", [exact_dedup.GROUPS_SENT, 0])
def test_drop_keeps_columns_and_one_row_per_group(spark, monkeypatch, most_sent):
    monkeypatch.setattr(exact_dedup, "GROUPS_SENT", most_sent)
    rows = edges() + [(30, "a b"), (30, "ab"), (30, "a  b"), (31, "a b"), (40, "c d")] + [(None, "e f")] * 3
    documents = frame(spark, rows)
    left = exact_dedup.drop_exact_duplicates(documents)
    assert left.schema == documents.schema
    texts = [(t or "").translate(BLANKS) for _, t in rows_of(left, "doc_id", "text")]
    assert sorted(texts) == sorted({(t or "").translate(BLANKS) for _, t in rows})
    assert (30, "a  b") in rows_of(left, "doc_id", "text")


def test_drop_does_not_shuffle_texts(spark):
    left = exact_dedup.drop_exact_duplicates(frame(spark, [(1, "a"), (2, "a"), (3, "b")]))
    assert "hashpartitioning" not in plan(left) and "BroadcastHashJoin" in plan(left)


def test_merge_is_the_same_in_any_grouping():
    random = np.random.default_rng(3)
    entries = np.zeros(500, exact_dedup._ENTRY)
    entries["digest"] = [bytes([d]) * 31 + b"\0" for d in random.integers(0, 9, 500).astype(np.uint8)]
    entries["length"], entries["doc"] = random.integers(0, 3, 500), random.integers(0, 50, 500)
    entries["row"], entries["count"] = np.arange(500), 1
    at_once = exact_dedup._melt(entries)
    parts = [exact_dedup._melt(p) for p in np.array_split(entries, 7)]
    assert (exact_dedup._melt(np.concatenate(parts)) == at_once).all()
    assert at_once["count"].sum() == 500
