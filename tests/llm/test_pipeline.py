import duckdb
from cases import edges, frame
from test_near_dedup import shingles

import corpus_pipeline
from barmill.llm.exact_dedup import exact_duplicates
from barmill.llm.near_dedup import near_duplicates
from barmill.llm.personal_data import base_spans
from barmill.llm.toxicity import score, train
from barmill.plans.workspace import work_dir

GIVEN = "/root/testdata/sf0.01"


def test_each_stage_does_its_work(spark):
    given = spark.read.parquet(f"{GIVEN}/documents.parquet")
    machine = train(given, spark.read.parquet(f"{GIVEN}/labels.parquet"))
    docs, seen = given, {}
    for name, stage in corpus_pipeline.STAGES:
        path = work_dir(spark, f"stage_{name}")
        stage(spark, docs, GIVEN).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        seen[name] = docs
        if name != "packing":
            assert docs.schema == before.schema
        ids = {r.doc_id for r in docs.select("doc_id").distinct().collect()}
        kept = {r.doc_id for r in before.select("doc_id").collect()}
        if name == "toxicity":
            kept = {r.doc_id for r in score(before, machine).where("score < 0.5").collect()}
        elif name == "exact_dedup":
            kept = {r.doc_id for r in exact_duplicates(before).where("kept").collect()}
        elif name == "near_dedup":
            kept = {r.doc_id for r in near_duplicates(before).where("kept").collect()}
        assert ids == kept
    texts = [r.text for r in seen["personal_data"].collect()]
    assert not any(base_spans(t or "") for t in texts)
    near = [shingles(r.text) for r in seen["near_dedup"].orderBy("doc_id").limit(300).collect()]
    assert not any(100 * len(a & b) >= 75 * len(a | b) > 0 for n, a in enumerate(near) for b in near[:n])


def test_run_is_the_stages_in_order(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "personal_data", "packing"]
    total = duckdb.sql(f"SELECT count(*) FROM '{sf_dir}/documents.parquet'").fetchall()[0][0]
    assert 0 < found.select("doc_id").distinct().count() <= total


def test_stages_take_any_rows(spark):
    for rows in (edges(), []):
        docs = frame(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            path = work_dir(spark, f"stage_{name}")
            stage(spark, docs, GIVEN).write.parquet(path)
            docs = spark.read.parquet(path)
        assert (docs.count() > 0) == bool(rows)
