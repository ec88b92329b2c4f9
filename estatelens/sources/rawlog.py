"""The attempt log: reading, record decoding and bounded incremental batches."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estatelens.functions.stages import compute_once
from estatelens.schemas import RECORD

def _usable(raw: DataFrame, since: datetime) -> DataFrame:
    kept = raw.filter((F.col("status") == "ok") & (F.col("record") != "")
                      & (F.col("scraped_at") >= F.lit(since)))
    if "scraped_month" in raw.columns:  # prune partitions of a month-partitioned log
        kept = kept.filter(F.col("scraped_month") >= since.strftime("%Y-%m"))
    return kept


def raw_ok(raw: DataFrame, since: datetime, limit: int | None = None) -> DataFrame:
    """Successful attempts strictly after ``since``: all of them, or the oldest ``limit``."""
    rows = _usable(raw, since).filter(F.col("scraped_at") > F.lit(since)).select(
        "kenmerk", "scraped_at", "record")
    return rows if limit is None else rows.orderBy("scraped_at", "kenmerk").limit(limit)


def incremental_batch(raw: DataFrame, after: tuple[datetime, str],
                      limit: int | None = None) -> DataFrame:
    """Attempts after a (time, id) checkpoint: all, or the oldest ``limit``.  The id breaks ties,
    so rows that share the boundary time are not lost between batches.

    The result is lazy.  Write it out and take ``next_checkpoint`` of the written rows: the log
    may grow between two evaluations, and the checkpoint must not pass rows nobody saw.
    """
    since, kenmerk = after
    newer = (F.col("scraped_at") > F.lit(since)) | (F.col("kenmerk") > F.lit(kenmerk))
    rows = _usable(raw, since).filter(newer).select("kenmerk", "scraped_at", "record")
    return rows if limit is None else rows.orderBy("scraped_at", "kenmerk").limit(limit)


def next_checkpoint(batch: DataFrame) -> DataFrame:
    """One row: the checkpoint after a batch that has been written."""
    top = F.max(F.struct("scraped_at", "kenmerk"))
    return batch.agg(top.alias("c")).select("c.scraped_at", "c.kenmerk")


def checkpoint_of(spark: SparkSession, folder: str, step: int) -> tuple[datetime, str] | None:
    """The checkpoint behind batch ``step`` of ``take_batch``; None where it is not committed."""
    try:
        commit = spark.read.parquet(f"{folder}/commits/step={step}").first()
    except AnalysisException as error:
        # no folder yet, or one without a finished file
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return None if commit is None else (commit.scraped_at, commit.kenmerk)


def take_batch(raw: DataFrame, folder: str, step: int, start: tuple[datetime, str],
               limit: int | None = None) -> DataFrame:
    """Batch ``step`` (from 0, the first after ``start``) of the log, as kept below ``folder``.

    The rows are written first; the checkpoint is computed from the written rows, and storing it
    commits the batch.  So it cannot pass rows that nobody saw, however the log grows meanwhile.
    A committed step is read as it was written; one cut short before its commit is written anew.
    A batch without rows leaves the checkpoint where it was.
    """
    spark, rows = raw.sparkSession, f"{folder}/rows/step={step}"
    if checkpoint_of(spark, folder, step) is None:
        after = start if step == 0 else checkpoint_of(spark, folder, step - 1)
        if after is None:
            raise ValueError(f"batch {step - 1} is not committed")
        incremental_batch(raw, after, limit).write.mode("overwrite").parquet(rows)
        next_checkpoint(spark.read.parquet(rows)).select(
            F.coalesce("scraped_at", F.lit(after[0]).cast(raw.schema["scraped_at"].dataType))
            .alias("scraped_at"),
            F.coalesce("kenmerk", F.lit(after[1])).alias("kenmerk"),
        ).write.mode("overwrite").parquet(f"{folder}/commits/step={step}")
    return spark.read.parquet(rows)


def with_record(raw: DataFrame) -> DataFrame:
    """Adds the decoded record; ``malformed`` marks rows that are no JSON object."""
    schema = T.StructType(RECORD.fields + [T.StructField("_corrupt_record", T.StringType())])
    parsed = compute_once(raw, {"_r": F.from_json("record", schema, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})})
    plain = F.struct(*[F.col(f"_r.{f}").alias(f) for f in RECORD.fieldNames()])
    bad = F.col("_r").isNull() | F.col("_r._corrupt_record").isNotNull()
    return (parsed.withColumn("malformed", bad).withColumn("_raw", F.col("record"))
            .withColumn("record", plain).drop("_r"))


def decode_record(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): rows with a decoded record, and the malformed rows as they came."""
    return split_decoded(with_record(raw))


def split_decoded(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of rows from ``with_record``, which a caller may keep between the two."""
    good = decoded.filter(~F.col("malformed")).drop("malformed", "_raw")
    bad = decoded.filter("malformed").withColumn("record", F.col("_raw")).drop("malformed", "_raw")
    return good, bad
