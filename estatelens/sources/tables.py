"""Reading and writing the engine's tables as Parquet."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelens.operators.latest import latest_per_key
from estatelens.schemas import TableSpec


def with_month(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Adds the partition column of a month-partitioned table."""
    if spec.month_of is None:
        return df
    return df.withColumn("scraped_month", F.date_format(spec.month_of, "yyyy-MM"))


def by_month(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows brought together by month.  Rebalancing splits a large month over several tasks and
    joins small ones, so neither one task nor thousands of tiny files result."""
    monthly = with_month(df, spec)
    return monthly.hint("rebalance", "scraped_month") if spec.month_of else monthly


def write_table(df: DataFrame, path: str, spec: TableSpec, mode: str = "append") -> None:
    """Month folders, rows sorted by key within files (tight min/max statistics)."""
    order = list(spec.sort or spec.key)
    rows = by_month(df, spec)
    if spec.month_of is None:
        rows.sortWithinPartitions(*order).write.mode(mode).parquet(path)
    else:
        (rows.sortWithinPartitions("scraped_month", *order)
         .write.mode(mode).partitionBy("scraped_month").parquet(path))


def stamped(df: DataFrame, spec: TableSpec, at: datetime) -> DataFrame:
    """Rows with the table's version column set to the time of their making."""
    return df.withColumn(spec.version, F.lit(at))


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder that passed rows from one step to the next."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """All versions of a table, month column as text."""
    return (spark.read.option("basePath", path).parquet(path))


def write_bucketed(df: DataFrame, name: str, path: str, spec: TableSpec, buckets: int,
                   mode: str = "append") -> None:
    """Keeps ``df`` at ``path`` as catalog table ``name``, in ``buckets`` buckets by replace key.

    Rows are dealt to buckets once, when they are written: one file per bucket and write.  All
    versions of a key lie in its bucket, so ``live_table`` reads in place.  Take about as many
    buckets as the table has times 128 MB; later writes must name the same number.
    """
    (df.repartition(buckets, *spec.key).write.mode(mode).format("parquet")
     .bucketBy(buckets, *spec.key).sortBy(*spec.key).option("path", path).saveAsTable(name))


def live_table(spark: SparkSession, name: str, spec: TableSpec,
               tie_break: Sequence[str] = ()) -> DataFrame:
    """Newest version per replace key of a table of ``write_bucketed``, without an exchange."""
    return latest_per_key(spark.read.table(name), spec.key, spec.version, tie_break)


def live_rows(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Newest version per replace key."""
    return latest_per_key(read_table(spark, path), spec.key, spec.version)
