import hashlib
import math
import random
import re
import time

import pytest
from cases import edges, frame, prose, rows_of

from barmill.llm import personal_data as ops

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(number):
    total = 0
    for k, d in enumerate(reversed(number)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def expected(text):
    spans = [("email", *m.span()) for m in EMAIL.finditer(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    spans += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]
    return spans


TEXTS = [
    "a@b@c.de x.y+z%@mail-1.example.com, @no.pe me@nodot one@two.three.", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3 1.2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111 1111 1111 1112 4111  1111 41111111111111110", "+1 (743) 555-3824. +49-30 1 +1234567 +1 2+34567890123",
    "+1 4111111111111111 a@1.2.3.4", "ü@x.yz é.a@ü.de 🙂b@c.d", "", "...@a.b %@-.-", "1.1.1.1000000000000 0.0.0.0", "+1((((", "+12 345 6789012345 678",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans(text):
    assert ops.base_spans(text) == expected(text)


@pytest.mark.parametrize("text", ["a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "a@" * 100_000, "+1" + " " * 200_000, "+1" * 100_000, "1 " * 100_000])
def test_long_runs_take_no_longer(text):
    start = time.perf_counter()
    ops.base_spans(text)
    assert time.perf_counter() - start < 3


def test_edges(spark):
    rows = edges() + list(enumerate(TEXTS, 100))
    found = ops.personal_spans(frame(spark, rows))
    got = [(i, [(s.kind, s.start, s.end) for s in base]) for i, base in rows_of(found, "doc_id", "base")]
    assert sorted(got, key=str) == sorted(((i, expected(t or "")) for i, t in rows), key=str)
    assert ops.personal_spans(frame(spark, [])).collect() == []


def disclosing():
    """"zanzibarov" stands near one address and nowhere else, in other words each time; copies of a
    passage show "hapaxword" near another one, always in the same words."""
    rows = [(i, prose(i, 40)) for i in range(60)]
    rows += [(100 + i, f"{prose(i, 5)} Zanzibarov {prose(i + 500, 2)} z.b@mail.example.com {prose(i + 900, 30)}") for i in range(6)]
    rows += [(200 + i, f"{prose(77, 5)} hapaxword {prose(78, 2)} other@mail.example.com {prose(i, 30)}") for i in range(6)]
    rows += [(300, f"as Zanzibarov said: {prose(3, 20)}")]
    return rows


def test_terms_that_disclose(spark):
    rows = disclosing()
    texts = dict(rows)
    found = ops.personal_spans(frame(spark, rows))
    terms = {(i, texts[i][s.start : s.end]) for i, spans in rows_of(found, "doc_id", "terms") for s in spans}
    assert terms == {(i, "Zanzibarov") for i in [*range(100, 106), 300]}


def found_terms(spark, rows):
    texts = dict(rows)
    found = rows_of(ops.personal_spans(frame(spark, rows)), "doc_id", "terms")
    return {texts[i][s.start : s.end] for i, spans in found for s in spans}


def test_terms_with_a_fixed_neighbour(spark):
    """Right after the value, after a first name, in a set phrase, and with no words before them."""
    rows = [(i, prose(i, 40)) for i in range(200)]
    for i in range(8):
        p = [prose(1000 + 20 * i + k, 12) for k in range(8)]
        rows += [(300 + i, f"{p[0]} one@mail.example.com Zanzibarov {p[1]}"), (400 + i, f"{p[2]} Xaverius Quillfeather two@mail.example.com {p[3]}")]
        rows += [(500 + i, f"{p[4]} the code word is Umbrellabird for three@mail.example.com {p[5]}"), (600 + i, f"Ottoline four@mail.example.com {p[6]}")]
        near_copy = prose(9, 30).split()
        near_copy[i // 2 * 2] = f"other{i // 2}"
        rows += [(700 + i, f"{p[7]} five@mail.example.com Copyword {prose(9, 30)}"), (800 + i, f"six@mail.example.com Nearcopyword {' '.join(near_copy)}")]
    found = found_terms(spark, rows)
    assert {"Zanzibarov", "Xaverius", "Quillfeather", "Umbrellabird", "Ottoline"} <= found
    assert not {"Copyword", "Nearcopyword"} & found


def test_terms_of_rare_values(spark):
    """Two documents that have nothing else in common are evidence; two copies, or one document, are not."""
    rows = [(i, prose(i, 20)) for i in range(3000)]
    for i in range(2):
        p = [prose(5000 + 9 * i + k, 30) for k in range(3)]
        rows += [(4000 + i, f"{p[0]} Zanzibarov one@mail.example.com {p[1]}"), (4100 + i, f"{p[2]} two@mail.example.com Copyword {prose(9, 30)}")]
    rows += [(4200, f"{prose(6000, 30)} Onceword three@mail.example.com {prose(6001, 30)}")]
    assert found_terms(spark, rows) == {"Zanzibarov"}


def test_sanitised(spark):
    rows = disclosing() + [(400, "+1 (743) 555-3824 a@1.2.3.4"), (401, None), (402, "")]
    documents = frame(spark, rows)
    left = ops.sanitised(documents)
    assert left.schema == documents.schema
    texts = {i: t for i, t in rows_of(left, "doc_id", "text")}
    assert texts[300].startswith("as [TERM] said") and texts[401] is None and texts[402] == ""
    assert "[EMAIL]" in texts[200] and "hapaxword" in texts[200] and "@" not in texts[200]
    assert texts[400] == "[PHONE] [EMAIL]"
    assert all(texts[i] == t for i, t in rows if i < 60)
    assert all(n == len(t or "") for t, n in rows_of(left, "text", "n_chars"))


def test_query(spark, sf_dir):
    texts = dict(rows_of(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text"))
    for r in ops.op10_personal_data(spark, sf_dir).collect():
        spans = expected(texts[r.doc_id] or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert ",".join(s for s in r.spans.split(",") if not s.startswith("term")) == joined
        assert [r[f"n_{k}"] for k in ops.KINDS[:-1]] == [sum(s[0] == k for s in spans) for k in ops.KINDS[:-1]]


def test_many_values_in_one_text_take_no_longer():
    text = " ".join(f"word{i} name{i}@mail{i % 7}.example.com" for i in range(4_000))
    spans = ops.base_spans(text)
    start = time.perf_counter()
    found = ops.contexts(text, spans)
    assert time.perf_counter() - start < 1 and len(spans) == 4_000
    assert found["email:name7@mail0.example.com", "word7"] and ("email:name7@mail0.example.com", "mail1") not in found


def test_covered_places_are_those_of_any_span():
    rng = random.Random(6)
    for _ in range(200):
        spans = [("x", a, a + rng.randrange(1, 9)) for a in (rng.randrange(60) for _ in range(rng.randrange(8)))]
        covered = ops._Covered(spans)
        for x in range(70):
            for y in (x + 1, x + 4):
                assert covered.meets(x, y) == any(x < q and p < y for _, p, q in spans)


def scored(rows):
    """Terms and their disclosure by the definitions, over all documents at once."""
    pair, value_docs, share, term_docs, labels = {}, {}, {}, {}, {}
    for _, text in rows:
        text = text or ""
        words = {w for w in re.findall(r"\w+", text.lower()) if len(w) >= 3 and not w.isdigit()}
        for w in words:
            term_docs[w] = term_docs.get(w, 0) + 1
        near = {}
        for (value, term), around in ops.contexts(text, ops.base_spans(text)).items():
            pair[value, term] = pair.get((value, term), 0) + 1
            labels.setdefault((value, term), set()).update(enumerate(ops._labels(around)))
            near[value] = near.get(value, 0) + 1
        for value, n in near.items():
            value_docs[value] = value_docs.get(value, 0) + 1
            share[value] = share.get(value, 0) + max(1, round(ops.SHARE * min(1, n / max(len(words), 1))))
    pairs = [(v, t) for v, t in pair if value_docs[v] > 1]
    needed, out = math.log2(max(len(pairs), 1)), {}
    for v, t in pairs:
        chance = share[v] / (ops.SHARE * len(rows))
        more, without = len(labels[v, t]) / ops.LABELS - 1, max(term_docs[t] - pair[v, t], 0)
        found = more / max(more + without, 1e-9)
        bits = 0.0
        if more > 0 and found > chance:
            bits = more * math.log2(found / chance) + (without * math.log2((1 - found) / (1 - chance)) if without else 0)
        content = -math.log2(value_docs[v] / len(rows))
        disclosure = 1 + math.log2(min(pair[v, t] / term_docs[t], 1)) / content if content > 0 else 0.0
        if bits >= needed and disclosure >= ops.THRESHOLD:
            out[t] = max(out.get(t, 0), disclosure)
    return out


def test_terms_are_scored_by_the_definitions(spark, monkeypatch):
    rows = disclosing() + [(400 + i, f"{prose(i, 9)} Ottoline b@x.example.com {prose(i + 40, 9)} elsewhere") for i in range(3)]
    rows += [(500 + i, f"{prose(600 + i, 3)} halfway c@x.example.com {prose(700 + i, 9)}") for i in range(5)]
    rows += [(600 + i, f"{prose(800 + i, 12)} halfway {prose(900 + i, 4)}") for i in range(2)] + [(700, None), (701, "")]
    want = scored(rows)
    assert len(want) >= 2
    for most in (ops.MOST_COUNTS, 3):
        monkeypatch.setattr(ops, "MOST_COUNTS", most)
        found = dict(rows_of(ops.disclosing_terms(frame(spark, rows).repartition(4)), "term", "disclosure"))
        assert found.keys() == want.keys() and all(abs(found[t] - want[t]) < 1e-9 for t in want)
