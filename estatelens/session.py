"""Session defaults and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings the semantics depend on (UTC dates, errors instead of silent NULLs) and the
# adaptive features the plans rely on for runtime join choice and skew.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # report mining is bound by CPU per byte: do not merge small shuffles below this
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # long expressions are built faster without a call site per operator
    "spark.sql.dataFrameQueryContext.enabled": "false",
}


def build_session(master: str | None = None, app: str = "estatelens", **conf: str) -> SparkSession:
    """Session with the defaults above; keyword settings use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


#: Used where ``spark.checkpoint.dir`` is not set; it can be set on a running session.
WORK_SETTING = "spark.estatelens.work.dir"


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor must see."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(WORK_SETTING, None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
