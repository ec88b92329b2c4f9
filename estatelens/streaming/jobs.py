"""Structured Streaming: task intake and the continuous fan-out of the attempt log.

Every batch of the fan-out writes folders of its own and, when these are whole, the input files it
took (``finished_batches``).  A stream with a new checkpoint meets old files again; those that a
finished batch of an earlier checkpoint took are passed over.  Readers leave out what no finished
batch wrote.  So each file is in the output once and reading needs no comparison of rows.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from estatelens.operators.fanout import to_cases, to_documents, to_publications
from estatelens.schemas import (
    CASES, DOCUMENTS, MALFORMED, PUBLICATIONS, RAW_ROW, TableSpec,
)
from estatelens.sources.rawlog import split_decoded, with_record
from estatelens.sources.tables import discard, with_month


@dataclass(frozen=True)
class StreamSpec:
    """Where a fan-out stream writes and how it is paced.

    ``interval`` ("10 seconds", say) runs continuously in micro-batches; None takes what is
    available and stops.
    """

    output: str
    checkpoint: str
    interval: str | None = None
    options: dict[str, str] = field(default_factory=dict)


OUTPUTS: dict[str, tuple] = {
    "processed_cases": (to_cases, CASES),
    "processed_publications": (to_publications, PUBLICATIONS),
    "processed_documents": (to_documents, DOCUMENTS),
}
BAD_RECORDS = "malformed_records"
FINISHED = "finished_batches"
DECODED = "_decoded"
# A task holds one group of rows while it writes or reads them.  Its size is looked at often, and in
# bytes that are not compressed, so that records of any size keep to it.
DECODED_AS = {"compression": "none", "parquet.block.size": 16 << 20,
              "parquet.page.size.row.check.max": 200}
FINISHED_SCHEMA = "source_file string, run_id string, batch_id long"


def read_raw_stream(spark: SparkSession, path: str, max_files: int = 100,
                    schema: StructType = RAW_ROW) -> DataFrame:
    """The attempt log as a file stream, each row with its ``source_file``.  Files are tracked, so
    late-flushed rows with an older timestamp are read too."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
            .parquet(path).select("*", F.col("_metadata.file_path").alias("source_file")))


def finished_batches(spark: SparkSession, output: str) -> DataFrame:
    """One row per finished batch and input file; the file is NULL for a batch without any."""
    return spark.read.schema(FINISHED_SCHEMA).parquet(f"{output}/{FINISHED}")


def taken_files(spark: SparkSession, output: str, run_id: str) -> DataFrame | None:
    """Files that finished batches of other runs took; None where there are none."""
    try:
        taken = finished_batches(spark, output).where(F.col("run_id") != run_id)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return None if taken.isEmpty() else taken.select("source_file")


def _write(df: DataFrame, path: str, run_id: str, batch_id: int, *folders: str) -> None:
    # a replayed batch overwrites its own folders and nothing else
    (df.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(batch_id)})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*folders, "run_id", "batch_id").parquet(path))


def write_fanout(raw: DataFrame, output: str, run_id: str, batch_id: int) -> None:
    """Cases, publications and documents of one batch of attempts, and its malformed records.

    ``run_id`` names the numbering that ``batch_id`` belongs to: the same pair again replaces
    what it wrote before, any other pair only adds.  Batches of one run come in the order of their
    numbers.  The batch counts as finished when all its tables are written.

    Decoded records are stored once, next to the tables, until these are written.
    """
    spark = raw.sparkSession
    usable = raw.filter((F.col("status") == "ok") & (F.col("record") != ""))
    # one exchange brings the months of all tables together, as texts, before they are decoded
    monthly = with_month(usable.select("kenmerk", "scraped_at", "record"), CASES).hint(
        "rebalance", "scraped_month")
    decoded = with_record(monthly)
    decoded = decoded.withColumn("_raw", F.when(F.col("malformed"), F.col("_raw")))
    # stored, not cached: what a task holds while it caches grows with the rows it is dealt
    folder = f"{output}/{DECODED}-{quote(run_id, safe='')}-{batch_id}"
    try:
        decoded.write.mode("overwrite").options(**DECODED_AS).parquet(folder)
        stored = spark.read.schema(decoded.schema).parquet(folder)
        good, bad = split_decoded(stored.drop("scraped_month"))
        outputs = {name: (rows(good), spec) for name, (rows, spec) in OUTPUTS.items()}
        if not bad.isEmpty():
            outputs[BAD_RECORDS] = (bad, MALFORMED)
        for name, (rows, spec) in outputs.items():
            monthly = with_month(rows, spec).sortWithinPartitions("scraped_month", *spec.key)
            _write(monthly, f"{output}/{name}", run_id, batch_id, "scraped_month")
    finally:
        discard(spark, folder)
    file = F.col("source_file") if "source_file" in raw.columns else F.lit(None).cast("string")
    _write(raw.select(file.alias("source_file")).distinct(), f"{output}/{FINISHED}", run_id,
           batch_id)


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint: the same after a restart, another one where
    the checkpoint is new and batches are counted from 0 again."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def stream_fanout(raw_stream: DataFrame, spec: StreamSpec) -> StreamingQuery:
    """Runs ``write_fanout`` on every micro-batch of ``read_raw_stream``.

    Files that a finished batch of another checkpoint took are passed over.  One stream at a time
    writes to an output; an older checkpoint may be taken up again after a newer one.
    """
    others: dict[str, DataFrame | None] = {}  # of this run: what had been taken when it started

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run_id = checkpoint_id(spark, spec.checkpoint)
        if run_id not in others:
            others[run_id] = taken_files(spark, spec.output, run_id)
        if others[run_id] is not None:
            # at most as many names as a batch has files
            known = (batch.select("source_file").distinct()
                     .join(others[run_id], "source_file", "left_semi").collect())
            batch = batch.where(~F.col("source_file").isin([row.source_file for row in known]))
        write_fanout(batch, spec.output, run_id, batch_id)

    writer = (raw_stream.writeStream.option("checkpointLocation", spec.checkpoint)
              .options(**spec.options).foreachBatch(write))
    if spec.interval:
        return writer.trigger(processingTime=spec.interval).start()
    return writer.trigger(availableNow=True).start()


def fanout_rows(spark: SparkSession, output: str, name: str) -> DataFrame:
    """All versions of one output table, from the folders of finished batches.

    An attempt that lies in two input files is there twice; ``latest_per_key`` and
    ``compact_months`` keep it once.
    """
    # one row per checkpoint that ever wrote here; batches of a run finish in order
    runs = finished_batches(spark, output).groupBy("run_id").agg(
        F.max("batch_id").alias("last")).collect()
    whole = F.lit(False)
    for run in runs:
        whole = whole | ((F.col("run_id") == run.run_id) & (F.col("batch_id") <= run.last))
    rows = spark.read.parquet(f"{output}/{name}")
    return rows.where(whole).drop("run_id", "batch_id")


def compact_months(spark: SparkSession, output: str, name: str, target: str,
                   before: str) -> None:
    """Rewrites the closed months (``yyyy-MM`` below ``before``) of an output table to ``target``:
    every row once, in few sorted files instead of one folder per batch.

    A month is replaced as a whole, so late rows of a closed month are taken up by running again.
    """
    spec = OUTPUTS[name][1]
    closed = fanout_rows(spark, output, name).filter(F.col("scraped_month") < before).distinct()
    (closed.hint("rebalance", "scraped_month").sortWithinPartitions("scraped_month", *spec.key)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("scraped_month").parquet(target))


def stream_tasks_filter(bodies: DataFrame) -> DataFrame:
    """Task bodies (JSON text in ``body``) to (kenmerk, court); malformed bodies and tasks without
    an id are dropped.  Works on batch and streaming input."""
    task = F.try_parse_json("body")
    parsed = bodies.withColumn("_t", task)
    return parsed.select(
        F.try_variant_get("_t", "$.kenmerk", "string").alias("kenmerk"),
        F.coalesce(F.try_variant_get("_t", "$.court", "string"), F.lit("")).alias("court"),
    ).filter(F.col("kenmerk") != "")
