"""Latest version per replace key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: Sequence[str], version: str,
                   tie_break: Sequence[str] = ()) -> DataFrame:
    """One row per key: the highest version, then the highest ``tie_break`` values.

    Without ``tie_break`` all other sortable columns break ties, so the result does not depend
    on row order.  Spark keeps one row per key before the shuffle (window group limit), so a hot
    key sends one row per task.
    """
    if not tie_break:
        tie_break = [f.name for f in df.schema.fields
                     if f.name not in {*key, version}
                     and f.dataType.typeName() not in ("map", "variant")]
    order = [F.col(version).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tie_break]]
    ranked = df.withColumn("_rank", F.row_number().over(
        Window.partitionBy(*key).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")
