"""Stage boundary for expensive columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, columns: dict[str, Column],
                 keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) plus ``columns``, each evaluated once per row.

    A filter or a join key on a plain computed column is pushed below the projection and drags a
    copy of its whole expression along; nested parsing expressions multiply that way.  Passing the
    new columns through a one-row generator stops this without a shuffle.
    """
    kept = [c for c in (df.columns if keep is None else keep) if c not in columns]
    # computed in a projection, which compiles; the generator only passes the result on
    packed = df.select(*kept, F.struct(*[c.alias(n) for n, c in columns.items()]).alias("_row"))
    return packed.select(*kept, F.inline(F.array("_row")))
