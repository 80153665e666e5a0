import random
from hashlib import sha256
from zlib import crc32

import pytest

from barmill.llm import prefix_trie as ops

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = "conv_id bigint, turn bigint, role string, text string, n string, ids string, head string, path string"


def gathered(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(some)] for c, some in turns.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def expected(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        size = len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[b] for b in below) or 1
        saved[node] = sum(saved[b] for b in below) + (len(members[node]) - 1) * size
    out = []
    for node, some in members.items():
        ends = ",".join(str(c) for c in sorted(some) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        n = len(children.get(node, []))
        digest = sha256(ends.encode()).hexdigest()
        out.append((min(some), len(node), parent, len(some), n, leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def found(spark, rows, rebuild=True):
    given = frame(spark, rows)
    nodes = ops.prefix_trie(ops.rebuilt(given) if rebuild else ops.turn_sequences(given))
    return sorted((tuple(r) for r in nodes.select(*COLUMNS).collect()), key=repr)


def talks(seed=3):
    """Forks, copies, one conversation in another, a common beginning, one long one, odd rows."""
    rng = random.Random(seed)
    rows = []
    for c in range(60):
        rows += [(c, t, rng.choice(["user", "bot"]), rng.choice(["hi", "é", "no", "a longer text"])) for t in range(rng.randrange(6))]
    start = [("system", "be kind")] + [("user", f"step {i}") for i in range(12)]
    for c in range(100, 140):
        rows += [(c, t, *turn) for t, turn in enumerate(start[: 6 + c % 8])]
        rows += [(c, 50, "user", f"{c % 7}"), (c, 51, "bot", "ok")]
    for c in range(200, 260):  # copies
        rows += [(c, t, "user", f"copy {t}") for t in range(11)]
    rows += [(300, t, "user", f"{t % 3}") for t in range(400)]
    rows += [(310, None, "user", "first"), (310, 0, None, None), (310, 0, None, None), (310, 0, "a", "tie"), (310, 0, "a", "sit")]
    rows += [(311, None, None, None), (None, 1, "user", "nobody"), (-7, 0, "user", "minus"), (-5, 0, "user", "minus five")]
    rows += [(2**62, 0, "user", "large"), (403, 0, "user", "few"), (404, 0, "user", "few"), (404, 1, "bot", "")]
    return rows


@pytest.mark.parametrize("turns", [ops.CONTAINER_TURNS, 40, 1])
def test_against_brute_force(spark, monkeypatch, turns):
    monkeypatch.setattr(ops, "CONTAINER_TURNS", turns)
    convs = gathered(talks())
    assert found(spark, talks()) == expected(rebuilt(convs))


@pytest.mark.parametrize("sent", [0, 100])
def test_without_rebuilding(spark, monkeypatch, sent):
    monkeypatch.setattr(ops, "CONTAINER_TURNS", 3)
    monkeypatch.setattr(ops, "MOST_SENT", sent)
    monkeypatch.setattr(ops, "RUN_IDS", 7)
    assert found(spark, talks(5), rebuild=False) == expected(gathered(talks(5)))


def test_few_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 0, "user", "x")]) == []
    # No turn is left of conversation 3, whose base is missing.
    assert crc32(b"3") % 9 > 1
    assert found(spark, [(3, 0, "user", "x")]) == expected({3: []})


def test_rounds_go_with_forks_not_turns(spark, monkeypatch):
    monkeypatch.setattr(ops, "CONTAINER_TURNS", 100)
    rounds = []
    burst = ops._burst
    monkeypatch.setattr(ops, "_burst", lambda held: rounds.append(1) or burst(held))
    rows = [(c, t, "user", "same" if t < 60 else str(c)) for c in range(30) for t in range(62)]
    assert found(spark, rows, rebuild=False) == expected(gathered(rows))
    assert len(rounds) == 2


def test_sweep_of_one_container():
    rng = random.Random(1)
    for _ in range(50):
        sequences = sorted({"".join(rng.choice("ab") * ops.ID for _ in range(rng.randrange(7))) for _ in range(12)})
        rows = [(s, [1] * 9, i, 1, str(i)) for i, s in enumerate(sequences)]
        nodes = ops.swept(rows, 0)
        assert len(nodes) == len({s[: d * ops.ID] for s in sequences for d in range(len(s) // ops.ID + 1)})
        assert nodes[0][3] == len(rows) and nodes[0][5] == sum(n[4] == 0 for n in nodes)
