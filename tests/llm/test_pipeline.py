"""The pipeline: each stage on what its predecessor kept, decisions in effect."""

import corpus_pipeline
import duckdb

from estatelens.llm.storage import written

DATA = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept, columns = [docs], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        kept.append(written(stage(spark, kept[-1], DATA), name))
        if name != "packing":
            assert kept[-1].columns == columns
    counts = [k.count() for k in kept]
    assert counts[0] >= counts[1] > counts[2] == counts[3] > counts[4] > 0
    redacted = {r.doc_id: r.text for r in kept[3].collect()}
    assert any("<EMAIL>" in (t or "") for t in redacted.values())
    pieces = kept[5].toPandas()
    assert set(pieces.doc_id) == {r.doc_id for r in kept[4].collect()}
    sizes = pieces.groupby("sequence_id").length.sum()
    assert sizes.max() <= 2048
    assert len(sizes) <= 1.05 * -(-pieces.length.sum() // 2048) + 1


def test_run_returns_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, DATA)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(rows.columns)
    there = duckdb.sql(f"select count(*) from '{DATA}/documents.parquet'").fetchall()[0][0]
    assert 0 < rows.select("doc_id").distinct().count() < there


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, DATA), name)
    assert docs.count() == 0
