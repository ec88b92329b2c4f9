"""What the attempt log says of each case id, kept as a table of parts that add up.

A part summarises some log rows per id; parts of disjoint rows merge by maxima and sums, so new
log rows are summarised alone and laid beside the older parts.  A part is stored under the name of
its rows: writing it again replaces it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REFRESHED_TYPES = ["company", "eenmanszaak"]
_KINDS = ["person", *REFRESHED_TYPES]

#: How each column of two parts becomes one.
MERGED = {"last_attempt": F.max, "attempts": F.sum, "successes": F.sum, "purged": F.sum,
          "last_ok": F.max, "last_kind": F.max}


def attempt_state(raw: DataFrame) -> DataFrame:
    """One row per id of the log: ``last_attempt``, ``attempts``, ``successes``, ``purged``,
    ``last_ok`` and ``last_kind``.

    ``last_kind`` holds the time of the last good attempt in its high digits and the entity class
    it found in its low ones, so a plain maximum finds the class, without a sort.
    """
    ok = F.col("status") == "ok"
    code = F.array_position(F.array(*map(F.lit, _KINDS)), F.col("entity_type"))
    stamp = F.unix_micros(F.col("scraped_at").cast("timestamp"))
    return raw.groupBy("kenmerk").agg(
        F.max("scraped_at").alias("last_attempt"), F.count(F.lit(1)).alias("attempts"),
        F.count_if(ok).alias("successes"), F.count_if(F.col("status") == "purged").alias("purged"),
        F.max(F.when(ok, F.col("scraped_at"))).alias("last_ok"),
        F.max(F.when(ok, stamp * 8 + code)).alias("last_kind"))


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all rows that the parts summarise; no row may be in two parts."""
    rows = reduce(DataFrame.unionByName, states)
    return rows.groupBy("kenmerk").agg(*[how(c).alias(c) for c, how in MERGED.items()])


def refreshed_kind() -> Column:
    """Whether the last good attempt found a class that is fetched again."""
    return F.pmod("last_kind", F.lit(8)) > len(_KINDS) - len(REFRESHED_TYPES)


def add_attempts(new_rows: DataFrame, path: str, part: str) -> None:
    """Summarises log rows that no other part holds and stores them as ``part``."""
    attempt_state(new_rows).write.mode("overwrite").parquet(f"{path}/part={part}")


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The state of all parts: rows per id and part meet, not log rows."""
    return merge_states(spark.read.option("basePath", path).parquet(path).drop("part"))


def compact_state(spark: SparkSession, path: str, target: str) -> None:
    """All parts as one, in the new folder ``target``, where later parts go."""
    read_state(spark, path).write.mode("overwrite").parquet(f"{target}/part=all")
