import duckdb
import numpy as np
import pytest
from cases import CLASHES, edges, frame, prose, rows_of

from barmill.llm import quality as ops

GIVEN = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r[0]: r for r in rows_of(ops.op2_quality(spark, GIVEN), "doc_id", "held_out", "score", "predicted", "kept")}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{GIVEN}/labels.parquet'").fetchall()
    asked = [(rows[i][3], y) for i, y in labels if i in rows and rows[i][1]]
    assert len(rows) == 1000 and len(asked) > 50
    assert np.mean([p == y for p, y in asked]) > 0.95
    assert all(0 <= s <= 1 and p == (s >= 0.5) == kept for _, _, s, p, kept in rows.values())


def _sites(spark, sites):
    """Documents of given evidence are imitated by texts with or without junk."""
    rows, n = [], 0
    for source, good, bad in sites:
        for k in range(good + bad):
            text = prose(n, 40) if k < good else prose(n, 40).replace(" ", "### ")
            rows.append((n, text, "en", source, 0, *["x"] * len(CLASHES.split(","))))
            n += 1
    return spark.createDataFrame(rows, frame(spark, []).schema)


@pytest.fixture(scope="module")
def model():
    import pyarrow as pa

    good = [prose(i, 40) for i in range(60)]
    bad = [t.replace(" ", "### ") for t in good[:30]]
    return ops.fit(ops.measures(pa.array(good + bad)), np.r_[np.ones(60), np.zeros(30)])


def test_sparse_sites_are_drawn_to_the_rest(spark, model):
    sites = [("good", 60, 0), ("bad", 3, 57), ("new", 2, 0), ("mixed", 30, 30), ("other", 50, 10)]
    found = ops.quality(_sites(spark, sites), model)
    named = found.join(_sites(spark, sites).select("doc_id", "source"), "doc_id")
    site = {r["source"]: r["s"] for r in named.groupBy("source").agg({"site": "avg"}).withColumnRenamed("avg(site)", "s").collect()}
    everything = (60 + 3 + 2 + 30 + 50) / 242
    assert site["bad"] < 0.2 < site["mixed"] < site["good"]
    assert abs(site["new"] - everything) < abs(site["good"] - everything)


def test_edges(spark, model):
    rows = edges()
    found = rows_of(ops.quality(frame(spark, rows), model), "doc_id", "score")
    assert sorted((i for i, _ in found), key=str) == sorted((i for i, _ in rows), key=str)
    assert all(0 <= s <= 1 for _, s in found)
    assert ops.quality(frame(spark, []), model).collect() == []


def test_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = ops.train(frame(spark, edges()), labels)
    assert {s for _, s in rows_of(ops.quality(frame(spark, edges()), model), "doc_id", "evidence")} == {0.5}


def posteriors(rows, p):
    """Evidence, site and score by the formulas, one document at a time."""
    n = len(p)
    mean = sum(p) / n
    within = max(sum((x - mean) ** 2 for x in p) / n, 1e-9)

    def grouped(key):
        groups = {}
        for k, (source, lang) in enumerate(rows):
            groups.setdefault(key(source or "", lang or ""), []).append(p[k])
        return groups

    def weight(groups, parent):
        ss = sum(len(g) * (sum(g) / len(g) - parent(k)) ** 2 for k, g in groups.items())
        beyond = (ss - len(groups) * within) / n
        return min(ops.MOST_WEIGHT, within / beyond) if beyond > within / ops.MOST_WEIGHT else ops.MOST_WEIGHT

    hosts, paths = grouped(lambda s, _: s), grouped(lambda s, g: (s, g))
    host_weight = weight(hosts, lambda _: mean)
    drawn = {h: (sum(g) + host_weight * mean) / (len(g) + host_weight) for h, g in hosts.items()}
    path_weight = weight(paths, lambda k: drawn[k[0]])
    out = []
    for (source, lang), own in zip(rows, p):
        h, g = hosts[source or ""], paths[source or "", lang or ""]
        rest = (sum(h) - own + host_weight * mean) / (len(h) - 1 + host_weight)
        site = (sum(g) - own + path_weight * rest) / (len(g) - 1 + path_weight)
        logits = [np.log(x / (1 - x)) for x in (own, site, mean)]
        out.append((site, 1 / (1 + np.exp(-(logits[0] + logits[1] - logits[2])))))
    return out, host_weight, path_weight


@pytest.mark.parametrize("spread", ["sites differ", "sites are alike"])
def test_posteriors_are_those_of_the_formulas(spark, model, spread):
    random = np.random.default_rng(8)
    places, texts = [], []
    for source, lang, n, share in [
        ("a", "en", 40, 0.9), ("a", "de", 7, 0.2), ("b", "en", 25, 0.1), ("b", None, 1, 1.0), (None, "en", 3, 0.5),
        ("c", "en", 1, 0.0), ("hot", "en", 90, 0.6),
    ]:
        for k in range(n):
            places.append((source, lang))
            good = random.random() < (share if spread == "sites differ" else 0.6)
            texts.append(prose(len(texts), 30) if good else prose(len(texts), 30).replace(" ", "### "))
    rows = [(n, t, lang, source, 0, *["x"] * len(CLASHES.split(","))) for n, (t, (source, lang)) in enumerate(zip(texts, places))]
    documents = spark.createDataFrame(rows, frame(spark, []).schema)
    found = sorted(rows_of(ops.quality(documents.repartition(5), model), "doc_id", "evidence", "site", "score"))
    want, host_weight, path_weight = posteriors(places, [r[1] for r in found])
    if spread == "sites differ":
        assert host_weight < ops.MOST_WEIGHT and path_weight < ops.MOST_WEIGHT
    assert np.allclose([r[2:] for r in found], want, atol=1e-6)
    # Not a digit depends on how the rows lie.
    assert found == sorted(rows_of(ops.quality(documents.repartition(13, "text"), model), "doc_id", "evidence", "site", "score"))
