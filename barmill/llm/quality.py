"""Quality by hierarchical empirical Bayes.

A logistic model of a few measures of the text gives the evidence of a document. Documents lie on
hosts (``source``) and paths (``source`` and ``lang``). The mean of a host is drawn towards the
mean of all, that of a path towards its host's, the more so the fewer documents there are; how
strongly is estimated from how much hosts and paths vary beyond chance. A document's own evidence
is taken out of the means it is combined with.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmill.llm.common import held_out, one_text_each, prepare, table, trimmed, written

#: Most labelled documents that are fitted on: those with the least hash of their id.
TRAINING_ROWS = 12_000
STEPS = 25
PENALTY = 1e-3
#: Prior weight of host and path means, in documents, if they do not vary beyond chance.
MOST_WEIGHT = 1e6

#: Counts of these, as a share of the characters, are measures.
_PATTERNS = (r"[#$%&*]", r"!", r"\|", r"[0-9]", r"[A-ZÀ-ÖØ-Þ]", r"\n", r"[.,;:]", r"[^\x00-\x{24f}]")
MEASURES = len(_PATTERNS) + 5


def measures(column: pa.Array) -> np.ndarray:
    """A row of measures for each text; null is empty, and of an empty text all are 0."""
    column = pc.fill_null(column, "")
    size = np.maximum(pc.utf8_length(column).to_numpy(), 1).astype(float)
    found = [np.sqrt(pc.count_substring_regex(column, p).to_numpy() / size) for p in _PATTERNS]
    words = pc.ascii_split_whitespace(column)
    per_text = pc.list_value_length(words).to_numpy()
    codes = words.flatten().dictionary_encode().indices.to_numpy()
    ends = np.cumsum(per_text)
    again = np.r_[False, codes[1:] == codes[:-1]]
    if len(ends):
        again[np.minimum((ends - per_text), max(len(codes) - 1, 0))] = False
    upto = np.r_[0, np.cumsum(again)]
    repeats = upto[ends] - upto[ends - per_text]
    distinct = np.array([len(np.unique(codes[e - n : e])) for e, n in zip(ends, per_text)], float)
    n = np.maximum(per_text, 1)
    found.append(np.sqrt(repeats / n))
    found.append(distinct / n)
    found.append(np.log1p(n) / 10)
    found.append(np.minimum(size / n, 50) / 10)
    found.append((size <= 1).astype(float))
    return np.stack(found, 1) if len(column) else np.zeros((0, MEASURES))


@trimmed
def _measure_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            rows = pa.array(list(measures(batch["text"])), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], rows], ["doc_id", "label", "x"])


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Centre, scale, weights and bias of a logistic model, by Newton steps with a small penalty."""
    if not len(y):
        return np.zeros((3, MEASURES + 1))
    centre, scale = x.mean(0), x.std(0) + 1e-6
    z = np.c_[(x - centre) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    share = (y.sum() + 1) / (len(y) + 2)
    w[-1] = np.log(share / (1 - share))
    ridge = PENALTY * len(y) * np.eye(len(w))
    ridge[-1, -1] = 1e-9 * len(y)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + ridge
        w -= np.linalg.solve(hessian, z.T @ (p - y) + ridge @ w - ridge[-1] * w[-1])
    return np.stack([np.r_[centre, 0], np.r_[scale, 1], w])


def _fit_group(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("doc_id")
    x = np.array(rows["x"].to_pylist(), float).reshape(-1, MEASURES)
    model = fit(x, rows["label"].to_numpy().astype(float))
    return pa.table({"model": [model.tobytes()]})


def train(documents: DataFrame, labels: DataFrame, most_rows: int = TRAINING_ROWS) -> np.ndarray:
    """Fit on labelled documents that are not held out, ``most_rows`` of them at most.

    Of rows that share an id one text is taken. Rows with a null id or label teach nothing. Without labels every document gets 0.5.
    """
    prepare(documents.sparkSession)
    usable = F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    sample = (
        labels.where(usable)
        .select(F.col("doc_id").cast("bigint").alias("id"), (F.col("quality") != 0).cast("int").alias("label"))
        .distinct()
        .orderBy(F.xxhash64("id"), "id", "label")
        .limit(most_rows)
    )
    chosen = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"))
    # At most ``most_rows`` rows of two numbers, so their size is bounded.
    rows = chosen.join(F.broadcast(sample), F.col("doc_id") == F.col("id")).select("doc_id", "label", "text")
    rows = one_text_each(rows)
    measured = rows.mapInArrow(_measure_rows, "doc_id bigint, label int, x array<double>")
    model = measured.groupBy().applyInArrow(_fit_group, "model binary").collect()
    if not model:
        return np.zeros((3, MEASURES + 1))
    return np.frombuffer(model[0]["model"], float).reshape(3, MEASURES + 1)


def _evidence_rows(model: np.ndarray):
    @trimmed
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, scale, w = model
        for batch in batches:
            x = (measures(batch["text"]) - centre[:-1]) / np.where(scale[:-1] == 0, 1, scale[:-1])
            # Measure by measure: the last digits of a matrix product depend on how many rows a batch has.
            logit = sum((x[:, k] * w[k] for k in range(MEASURES)), w[-1])
            p = 1 / (1 + np.exp(-np.clip(logit, -15, 15)))
            others = [batch[n] for n in ("doc_id", "host", "path")]
            yield pa.RecordBatch.from_arrays([*others, pa.array(p, pa.float64())], ["doc_id", "host", "path", "p"])

    return rows


#: Evidence is added up in whole units of this size, so that sums do not depend on the order of the rows.
UNIT = 2.0**-30


def _units(value) -> Column:
    return F.round(value / F.lit(UNIT)).cast("decimal(24,0)")


def _sum(value) -> Column:
    return F.sum(_units(value)).cast("double") * F.lit(UNIT)


def _weight(means: DataFrame, within: float) -> float:
    """Documents that the parent's mean counts for: chance variance over variance beyond chance.

    ``means`` has ``n``, ``mean`` and ``parent``. Moments are taken by Spark, one row comes back.
    """
    gap = F.col("n") * (F.col("mean") - F.col("parent")) ** 2
    row = means.agg(_sum(gap).alias("ss"), F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).first()
    if not row["k"]:
        return MOST_WEIGHT
    beyond = (row["ss"] - row["k"] * within) / row["n"]
    return float(min(MOST_WEIGHT, within / beyond)) if beyond > within / MOST_WEIGHT else MOST_WEIGHT


def _logit(p):
    return F.log(p / (F.lit(1.0) - p))


def quality(documents: DataFrame, model: np.ndarray) -> DataFrame:
    """``doc_id``, ``evidence`` (of the text alone), ``site`` (the shrunk mean of its path without
    itself), ``score`` (0 to 1, higher: better).

    Null ``source`` and ``lang`` are sites of their own. Null and empty texts are judged by their
    measures, very long ones like others. Repeated rows count as documents each. Scores are the same however
    the rows lie. Other columns are neither read nor returned.
    """
    prepare(documents.sparkSession)
    host = F.coalesce(F.col("source").cast("string"), F.lit(""))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    chosen = documents.select(
        F.col("doc_id").cast("bigint"),
        host.alias("host"),
        F.concat(host, F.lit("\t"), lang).alias("path"),
        F.col("text").cast("string"),
    )
    schema = "doc_id bigint, host string, path string, p double"
    rows = written(chosen.mapInArrow(_evidence_rows(model), schema), "evidence")
    # Only ever as many rows as there are sites, which Spark joins as it sees fit.
    paths = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), _sum(F.col("p")).alias("s"))
    paths = written(paths, "paths")
    p = F.col("p")
    total = rows.agg(F.count(F.lit(1)).alias("n"), _sum(p).alias("s"), _sum(p * p).alias("squares")).first()
    mean = total["s"] / total["n"] if total["n"] else 0.5
    within = max(total["squares"] / total["n"] - mean**2 if total["n"] else 0.0, 1e-9)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), _sum(F.col("s")).alias("host_s"))
    host_weight = _weight(
        hosts.select(F.col("host_n").alias("n"), (F.col("host_s") / F.col("host_n")).alias("mean"), F.lit(mean).alias("parent")),
        within,
    )
    shrunk = (F.col("host_s") + host_weight * mean) / (F.col("host_n") + host_weight)
    sites = paths.join(hosts.select("host", "host_n", "host_s", shrunk.alias("host_mean")), "host")
    path_weight = _weight(
        sites.select("n", (F.col("s") / F.col("n")).alias("mean"), F.col("host_mean").alias("parent")), within
    )
    joined = rows.join(sites.drop("host"), "path")
    host_rest = (F.col("host_s") - F.col("p") + host_weight * mean) / (F.col("host_n") - 1 + host_weight)
    site = (F.col("s") - F.col("p") + path_weight * host_rest) / (F.col("n") - 1 + path_weight)
    site = F.greatest(F.least(site, F.lit(1 - 1e-6)), F.lit(1e-6))
    together = _logit(F.col("p")) + _logit(F.col("site")) - _logit(F.lit(min(max(mean, 1e-6), 1 - 1e-6)))
    return joined.withColumn("site", site).select(
        "doc_id", F.col("p").alias("evidence"), "site", (1 / (1 + F.exp(-together))).alias("score")
    )


def op2_quality(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    scored = quality(documents, train(documents, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        (F.col("score") >= 0.5).alias("kept"),
        "evidence",
        "site",
    )
