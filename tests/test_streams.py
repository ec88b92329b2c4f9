import json
import os
import subprocess
import sys
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException

from estatelens.schemas import RAW_ROW
from estatelens.streaming import jobs
from estatelens.streaming.jobs import (
    BAD_RECORDS, FINISHED, OUTPUTS, StreamSpec, fanout_rows, finished_batches, read_raw_stream,
    stream_fanout, stream_tasks_filter, write_fanout,
)

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def attempts(spark, n=12):
    rows = []
    for i in range(n):
        record = json.dumps({"kenmerk": f"R{i}", "court": "x", "type": "company",
                             "publications": [{"kenmerk": f"P{i}.{j}"} for j in range(i % 3)],
                             "documents": [{"kenmerk": f"D{i}"}]})
        rows.append((f"K{i}", datetime(2024, 1 + i % 2, 1), "ok" if i % 4 else "fetch_failed", "",
                     "", record if i != 5 else "{", ""))
    return spark.createDataFrame(rows, RAW_ROW)


def content(spark, out):
    return {name: sorted(tuple(map(str, r)) for r in spark.read.parquet(f"{out}/{name}")
                         .drop("run_id", "batch_id").collect()) for name in OUTPUTS}


def test_stream_equals_one_batch_and_replay_changes_nothing(spark, tmp_path):
    log = attempts(spark)
    log.repartition(3, "kenmerk").write.parquet(str(tmp_path / "raw"))
    spec = StreamSpec(str(tmp_path / "out"), str(tmp_path / "checkpoint"))

    def run():
        stream = read_raw_stream(spark, str(tmp_path / "raw"), max_files=1)
        stream_fanout(stream, spec).awaitTermination()

    run()
    streamed = content(spark, spec.output)
    write_fanout(log, str(tmp_path / "batch"), "r", 0)
    write_fanout(log, str(tmp_path / "batch"), "r", 0)
    assert streamed == content(spark, str(tmp_path / "batch"))
    assert len(streamed["processed_cases"]) == 8
    log.limit(1).withColumn("status", log["status"]).write.mode("append").parquet(
        str(tmp_path / "raw"))
    run()
    assert len(content(spark, spec.output)["processed_documents"]) == len(
        streamed["processed_documents"])  # the added attempt had failed


def test_new_checkpoint_loses_nothing(spark, tmp_path):
    """Batch 0 of a stream with a new checkpoint stands beside the old batch 0."""
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    attempts(spark).filter("kenmerk < 'K5'").coalesce(1).write.parquet(raw)
    stream_fanout(read_raw_stream(spark, raw), StreamSpec(out, str(tmp_path / "c1"))) \
        .awaitTermination()
    before = {r.kenmerk for r in fanout_rows(spark, out, "processed_cases").collect()}
    # the old input files are gone, as is the old checkpoint
    later = str(tmp_path / "later")
    attempts(spark).filter("kenmerk >= 'K5'").coalesce(1).write.parquet(later)
    stream_fanout(read_raw_stream(spark, later), StreamSpec(out, str(tmp_path / "c2"))) \
        .awaitTermination()
    after = [r.kenmerk for r in fanout_rows(spark, out, "processed_cases").collect()]
    assert before < set(after) and len(after) == len(set(after)) == 8
    assert [r.record for r in fanout_rows(spark, out, BAD_RECORDS).collect()] == ["{"]


def test_old_files_are_passed_over_without_comparing_rows(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    attempts(spark).repartition(3, "kenmerk").write.parquet(raw)
    for checkpoint in ("c1", "c2", "c1"):
        stream_fanout(read_raw_stream(spark, raw, max_files=1),
                      StreamSpec(out, str(tmp_path / checkpoint))).awaitTermination()
        rows = fanout_rows(spark, out, "processed_cases")
        assert sorted(r.kenmerk for r in rows.collect()) == sorted(
            f"R{i}" for i in (1, 2, 3, 6, 7, 9, 10, 11))
    assert "Exchange" not in rows._jdf.queryExecution().toString()
    files = [r.source_file for r in finished_batches(spark, out).collect()]
    assert len(files) == len(set(files)) > 1


def test_unfinished_batch_is_not_read_and_taken_over(spark, tmp_path, monkeypatch):
    """A stream ends after its tables but before the batch counts as finished, and its checkpoint
    is lost: the next one writes the batch, and taking up the first again adds nothing."""
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    first, second = (StreamSpec(out, str(tmp_path / c)) for c in ("c1", "c2"))

    def run(spec):
        stream_fanout(read_raw_stream(spark, raw), spec).awaitTermination()

    def names():
        return sorted(r.kenmerk for r in fanout_rows(spark, out, "processed_cases").collect())

    attempts(spark).filter("kenmerk in ('K1', 'K2')").coalesce(1).write.parquet(raw)
    run(first)
    attempts(spark).filter("kenmerk = 'K3'").coalesce(1).write.mode("append").parquet(raw)
    write = jobs._write

    def fails(df, path, *rest):
        if path.endswith(FINISHED):
            raise OSError("lost")
        write(df, path, *rest)

    monkeypatch.setattr(jobs, "_write", fails)
    with pytest.raises(StreamingQueryException):
        run(first)
    monkeypatch.setattr(jobs, "_write", write)
    assert "R3" in {r.kenmerk for r in spark.read.parquet(f"{out}/processed_cases").collect()}
    assert names() == ["R1", "R2"]
    run(second)
    assert names() == ["R1", "R2", "R3"]
    run(first)
    assert names() == ["R1", "R2", "R3"]


def test_running_stream_flushes_at_its_interval(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    attempts(spark).coalesce(1).write.parquet(raw)
    query = stream_fanout(read_raw_stream(spark, raw),
                          StreamSpec(out, str(tmp_path / "c"), interval="1 second"))
    try:
        query.processAllAvailable()
        assert fanout_rows(spark, out, "processed_cases").count() == 8 and query.isActive
    finally:
        query.stop()


def test_tasks(spark):
    df = spark.createDataFrame([('{"kenmerk": "a", "court": "x"}',), ('{"kenmerk": "b"}',),
                                ('{"kenmerk": ""}',), ('{"court": "x"}',), ("{",), (None,)],
                               "body string")
    assert sorted(map(tuple, stream_tasks_filter(df).collect())) == [("a", "x"), ("b", "")]


def test_the_log_of_the_checks_is_dealt_to_as_many_files_as_cores(spark):
    from checks import streams
    from checks.base import Source

    out = streams._streamed(Source(spark, "/root/testdata/sf0.001"), 1, 1)
    files = spark.read.parquet(out.replace("/out", "/raw")).inputFiles()
    assert len(files) == max(3, spark.sparkContext.defaultParallelism)
    assert finished_batches(spark, out).select("batch_id").distinct().count() == 2


LARGE_BATCH = """
from pyspark.sql import functions as F
from estatelens.session import build_session
from estatelens.streaming.jobs import write_fanout

spark = build_session("local[1]", spark__driver__memory="600m", spark__ui__enabled="false",
                      spark__sql__shuffle__partitions="1")
text = F.repeat(F.col("id").cast("string"), 200)
pubs = F.transform(F.sequence(F.lit(1), F.lit(20)), lambda i: F.struct(
    F.concat_ws(".", "id", i).alias("kenmerk"), text.alias("description")))
log = spark.range(0, {rows}, 1, 1).select(
    F.col("id").cast("string").alias("kenmerk"), F.lit("ok").alias("status"),
    F.timestamp_seconds(F.lit(0)).alias("scraped_at"),
    F.to_json(F.struct(pubs.alias("publications"))).alias("record"))
write_fanout(log, "{out}", "r", 0)
"""


def test_memory_of_a_batch_does_not_grow_with_its_rows(spark, tmp_path):
    """About 800 MB of decoded records pass through one task and a heap of 600 MB."""
    out = str(tmp_path / "out")
    script = LARGE_BATCH.format(rows=20000, out=out)
    ran = subprocess.run([sys.executable, "-c", script], cwd=REPO, capture_output=True, text=True,
                         timeout=300, env=os.environ | {"PYTHONPATH": REPO})
    assert ran.returncode == 0, ran.stderr[-2000:]
    assert spark.read.parquet(f"{out}/processed_cases").count() == 20000
    assert spark.read.parquet(f"{out}/processed_publications").count() == 400000


def test_decoded_records_are_stored_for_their_batch_only(spark, tmp_path, monkeypatch):
    """Neither cached while the tables are written nor left behind, also by a batch that fails."""
    out, write, cached = tmp_path / "out", jobs._write, []

    def looks(df, path, *rest):
        cached.append(spark.sparkContext._jsc.getPersistentRDDs().size())
        if rest[0] == "fails" and path.endswith("processed_documents"):
            raise OSError("lost")
        write(df, path, *rest)

    monkeypatch.setattr(jobs, "_write", looks)
    write_fanout(attempts(spark), str(out), "r/1", 0)
    with pytest.raises(OSError):
        write_fanout(attempts(spark), str(out), "fails", 1)
    assert set(cached) == {0}
    assert sorted(p.name for p in out.iterdir()) == sorted([*OUTPUTS, BAD_RECORDS, FINISHED])


def test_malformed_records_of_a_stream_are_kept_without_a_cache(spark, tmp_path, monkeypatch):
    """As they came, beside good ones, whatever they hold; nothing is cached to look for them."""
    bad = {"M0": "{", "M1": "geen json", "M2": "[1, 2]", "M3": '{"kenmerk": "half\nline',
           "M4": "ü" * 5000, "M5": '"text"'}
    rows = [(k, datetime(2024, 1, 1), "ok", "", "", record, "") for k, record in bad.items()]
    raw, out, write, cached = str(tmp_path / "raw"), str(tmp_path / "out"), jobs._write, []
    attempts(spark).unionByName(spark.createDataFrame(rows, RAW_ROW)).coalesce(1).write.parquet(raw)

    def looks(df, path, *rest):
        cached.append(spark.sparkContext._jsc.getPersistentRDDs().size())
        write(df, path, *rest)

    monkeypatch.setattr(jobs, "_write", looks)
    stream_fanout(read_raw_stream(spark, raw), StreamSpec(out, str(tmp_path / "c"))) \
        .awaitTermination()
    kept = {r.kenmerk: r.record for r in fanout_rows(spark, out, BAD_RECORDS).collect()}
    assert kept == bad | {"K5": "{"}
    assert fanout_rows(spark, out, "processed_cases").count() == 8
    assert set(cached) == {0}
