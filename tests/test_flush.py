"""Flushes by number of rows, by time, and across a restart."""

import time
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from estatelens.streaming.flush import PROVIDER, FlushSpec, buffered

SCHEMA = "kenmerk string, n long, at timestamp"


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, PROVIDER)
    yield spark
    spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _rows(spark, path, numbers):
    spark.createDataFrame([(f"k{n}" if n % 5 else None, n, datetime(2024, 1, 1)) for n in numbers],
                          SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _started(spark, tmp_path, seconds, buffers=1, **trigger):
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    out = buffered(stream, F.lit(0) if buffers == 1 else F.col("kenmerk"),
                   FlushSpec(20, seconds, buffers))
    return out.writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "c")).trigger(**trigger).start(str(tmp_path / "out"))


def _seen(spark, tmp_path):
    out = spark.read.schema("buffer int, flush long, cause string, " + SCHEMA).parquet(
        str(tmp_path / "out")).collect()
    return Counter((r.flush, r.cause) for r in out), sorted(r.n for r in out)


def _until(spark, tmp_path, count):
    end = time.time() + 90
    while time.time() < end:
        if (tmp_path / "out").exists() and len(_seen(spark, tmp_path)[1]) >= count:
            return
        time.sleep(0.5)


def test_full_buffers_go_at_once_and_the_rest_after_a_time(rocks, tmp_path):
    _rows(rocks, str(tmp_path / "in"), range(45))
    query = _started(rocks, tmp_path, 6, processingTime="500 milliseconds")
    try:
        _until(rocks, tmp_path, 40)
        assert _seen(rocks, tmp_path)[0] == {(0, "rows"): 20, (1, "rows"): 20}
        _until(rocks, tmp_path, 45)
        flushes, numbers = _seen(rocks, tmp_path)
        assert flushes == {(0, "rows"): 20, (1, "rows"): 20, (2, "time"): 5}
        assert numbers == list(range(45))
    finally:
        query.stop()


def test_a_restart_goes_on_with_the_buffer(rocks, tmp_path):
    for numbers, seen in ((range(15), []), (range(15, 27), list(range(20)))):
        _rows(rocks, str(tmp_path / "in"), numbers)
        _started(rocks, tmp_path, 3600, availableNow=True).awaitTermination(60)
        # five of the second file fill the buffer of the first; seven wait
        assert _seen(rocks, tmp_path) == ({(0, "rows"): 20} if seen else {}, seen)


def test_rows_of_a_key_share_a_buffer(rocks, tmp_path):
    _rows(rocks, str(tmp_path / "in"), [1] * 41 + list(range(2, 30)))
    _started(rocks, tmp_path, 3600, buffers=4, availableNow=True).awaitTermination(60)
    assert _seen(rocks, tmp_path)[1].count(1) == 40
