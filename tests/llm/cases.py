"""Documents with everything that must not break an operator."""

from __future__ import annotations

import random

# Columns that no operator may read, named like what operators make.
CLASHES = "row string, digest string, kept string, score string, block string, rep string, root string, text_sha256 string"
SCHEMA = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHES}"
WORDS = "stone river under light seven copper window morning garden simple letter market candle winter bridge".split()


def frame(spark, rows):
    """A documents table of (doc_id, text), with clashing columns on top."""
    full = [(i, t, "en", "src0", len(t or ""), *["x"] * len(CLASHES.split(","))) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed, n):
    chosen = random.Random(seed)
    return " ".join(chosen.choice(WORDS) + str(chosen.randrange(400)) for _ in range(n))


def edges():
    """Null, empty and blank texts, a null id, ties, repeated rows, other scripts, a very long text."""
    base = prose(1, 120)
    return [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, base),
        (5, base),
        (5, base),
        (6, "  " + base.replace(" ", "\n")),
        (7, base.upper()),
        (None, base),
        (None, "nobody's text"),
        (8, "one two"),
        (9, "One\ttwo"),
        (10, "naïve Straße 你好 🙂 é ▁ \x00 end " * 5),
        (11, prose(2, 20_000)),
        (12, base + " " + prose(3, 30)),
        (13, prose(4, 30) + base),
        (14, "a" * 5000),
        (15, "x"),
        (2**62, prose(5, 60)),
        (-3, prose(5, 60)),
    ]


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]
