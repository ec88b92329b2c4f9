"""Written tables in the shared folder, and the shards that streaming tasks read."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCOPES: list[dict[str, str]] = []


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    Where the setting is absent a folder of this machine serves, but only for a ``local`` master,
    whose tasks all run in one process; a cluster without the setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "local")
        if not master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "estatelens-llm")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage ends there."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    if _SCOPES:
        _SCOPES[-1][path] = purpose
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_shuffles(spark: SparkSession) -> None:
    """Has the shuffle files of finished queries deleted.

    Spark deletes those that nothing refers to any more, but learns of it when the driver's heap is
    collected, which on a driver with little to do may be long after.
    """
    gc.collect()
    for _ in range(2):  # what the first one lets go may hold more
        spark._jvm.java.lang.System.gc()


@contextmanager
def passing_tables(spark: SparkSession, *kept: str) -> Iterator[None]:
    """Deletes, at the end, the tables written inside whose purpose is not among ``kept``.

    What is returned from inside may read the kept tables only.
    """
    _SCOPES.append({})
    try:
        yield
    finally:
        for path, purpose in _SCOPES.pop().items():
            if purpose not in kept:
                folder = spark._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        drop_shuffles(spark)


def set_aside(docs: DataFrame, needed: Sequence[str]) -> DataFrame:
    """``needed`` columns and all others as one struct, so that no name of theirs can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in needed]
    others = F.struct(*rest) if rest else F.lit(0)
    return docs.select(*needed, others.alias("others"))


def brought_back(rows: DataFrame, columns: Sequence[str], needed: Sequence[str],
                 **added: str) -> DataFrame:
    """The columns of the table that ``set_aside`` was given, and ``added`` ones (new name and
    column), which stand in for columns of that name."""
    own = [F.col(c) if c in needed else F.col("others").getField(c).alias(c)
           for c in columns if c not in added]
    return rows.select(*own, *[F.col(c).alias(name) for name, c in added.items()])
