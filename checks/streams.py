"""Streaming jobs run to completion over files written from the derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.base import Source, query
from checks.payloads import BAD_ROWS, FANOUT_ROWS, fanout_content, records
from estatelens.schemas import RAW_ROW
from estatelens.session import work_dir
from estatelens.streaming.jobs import (
    BAD_RECORDS, OUTPUTS, StreamSpec, compact_months, fanout_rows, read_raw_stream,
    stream_fanout, stream_tasks_filter,
)


def _streamed(s: Source, parts: int, checkpoints: int) -> str:
    """Streams the attempt log, which arrives in ``parts`` portions of several files; each portion
    is met by a stream with the next of so many checkpoints."""
    folder = work_dir(s.spark, "stream")
    log = records(s).select(
        "kenmerk", F.col("scraped_at").cast("timestamp").alias("scraped_at"), "status",
        "entity_type", F.lit("").alias("error"), "record", F.lit("").alias("git_sha"))
    # rendered once, and dealt to as many files as there are cores to write them
    files = max(3, s.spark.sparkContext.defaultParallelism)
    log.withColumn("part", F.pmod(F.xxhash64("kenmerk"), F.lit(parts))).write.partitionBy(
        "part").parquet(f"{folder}/log")
    for part in range(parts):
        own = s.spark.read.schema(RAW_ROW).parquet(f"{folder}/log/part={part}")
        own.repartition(files, "kenmerk").write.mode("append").parquet(f"{folder}/raw")
        stream = read_raw_stream(s.spark, f"{folder}/raw", max_files=-(-files * 2 // 3))
        spec = StreamSpec(f"{folder}/out", f"{folder}/checkpoint{part % checkpoints}")
        stream_fanout(stream, spec).awaitTermination()
    return f"{folder}/out"


@query("stream_fanout", FANOUT_ROWS)
def _(s: Source) -> DataFrame:
    """Several micro-batches and a restart from the same checkpoint: the rows of one batch."""
    out = _streamed(s, 2, 1)
    return fanout_content({name: s.spark.read.parquet(f"{out}/{name}") for name in OUTPUTS})


@query("stream_restart", FANOUT_ROWS)
def _(s: Source) -> DataFrame:
    """A new checkpoint counts batches from 0 and reads old files again: nothing may vanish, and
    rows written twice are read once."""
    out = _streamed(s, 2, 2)
    return fanout_content({name: fanout_rows(s.spark, out, name) for name in OUTPUTS})


@query("stream_malformed", BAD_ROWS)
def _(s: Source) -> DataFrame:
    """Records that are no JSON object are kept as they came."""
    out = _streamed(s, 1, 1)
    return s.spark.read.parquet(f"{out}/{BAD_RECORDS}").select(
        "kenmerk", F.col("scraped_at").cast("string").alias("scraped_at"), "record")


@query("compact_months", f"""select * from ({FANOUT_ROWS}) f where scraped_month < '1997-01'""")
def _(s: Source) -> DataFrame:
    """Closed months rewritten, twice: the same rows in month folders of their own."""
    out = _streamed(s, 2, 1)
    targets = {}
    for name in OUTPUTS:
        path = work_dir(s.spark, f"compact-{name}")
        for _ in range(2):
            compact_months(s.spark, out, name, path, "1997-01")
        targets[name] = s.spark.read.parquet(path)
    return fanout_content(targets)


@query("stream_tasks_filter", """select concat('T', cast(event_id as varchar)) as kenmerk,
      case when event_id % 2 = 0 then event_type else '' end as court from {events}
    where event_type not in ('error') and event_id % 7 <> 3""")
def _(s: Source) -> DataFrame:
    """Tasks without an id (error events) and bodies cut short are dropped."""
    folder = work_dir(s.spark, "tasks")
    key = F.col("event_id")
    full = F.to_json(F.struct(
        F.when(F.col("event_type") != "error", F.concat(F.lit("T"), key)).alias("kenmerk"),
        F.when(key % 2 == 0, F.col("event_type")).alias("court")))
    body = F.when(key % 7 == 3, F.substring(full, 1, 9)).otherwise(full)
    s.table("events").select(body.alias("body")).repartition(4).write.parquet(f"{folder}/in")
    bodies = (s.spark.readStream.schema("body string").option("maxFilesPerTrigger", 2)
              .parquet(f"{folder}/in"))
    writer = stream_tasks_filter(bodies).writeStream.format("parquet").option(
        "checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    writer.start(f"{folder}/out").awaitTermination()
    return s.spark.read.parquet(f"{folder}/out")
