"""Membership in a large key set without moving the rows that are asked about.

Keys set bits in blocks of a bitmap (a Bloom filter in blocks).  The bitmap has at most a fixed
size, so it can go to every task whatever the number of keys; rows are tested where they lie.  An
answer "no" is certain.  "Yes" is wrong for under 0.3 % of rows up to four million keys and
more often beyond; what follows must be exact by itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 1 << 15  # of a block, 4 kB: the size that Spark's bitmap functions work in
MOST_BLOCKS = 2048    # 8 MB in all
BITS_PER_KEY = 16
PROBES = 4


def blocks_for(keys: int) -> int:
    return max(1, min(MOST_BLOCKS, -(-keys * BITS_PER_KEY // BLOCK_BITS)))


def _places(columns: Sequence[str], blocks: int) -> tuple[Column, Column]:
    """The block of a key and its bits there."""
    bits = F.xxhash64(*columns)
    return (F.pmod(F.hash(*columns), F.lit(blocks)),
            F.array(*[F.shiftrightunsigned(bits, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1))
                      for i in range(PROBES)]))


def key_bitmap(keys: DataFrame, columns: Sequence[str], flags: dict[str, Column],
               blocks: int) -> DataFrame:
    """``block`` and a bitmap for each flag, of the keys that its condition holds: at most
    ``blocks`` rows.  Tasks combine their bits before the shuffle."""
    block, places = _places(columns, blocks)
    rows = keys.select(block.alias("block"), F.explode(places).alias("place"), *[
        F.coalesce(c, F.lit(False)).alias(f) for f, c in flags.items()])
    return rows.groupBy("block").agg(*[
        F.bitmap_construct_agg(F.when(F.col(f), F.col("place"))).alias(f) for f in flags])


def _holds(bits: Column, places: Column) -> Column:
    def holds(place: Column) -> Column:
        at = (F.shiftright(place, 3) + 1).cast("int")
        byte = F.conv(F.hex(F.substring(bits, at, F.lit(1))), 16, 10).cast("bigint")
        return F.getbit(byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1

    return F.forall(places, holds)


def flag_known(rows: DataFrame, keys: DataFrame, columns: Sequence[str],
               flags: dict[str, Column]) -> DataFrame:
    """``rows`` and a boolean for each of ``flags``: false where none of the keys that the flag's
    condition (on columns of ``keys``) holds can be the row's.

    ``keys`` are read twice, for their number and for their bits; ``rows`` are not shuffled.
    """
    blocks = blocks_for(keys.count())
    bitmap = key_bitmap(keys, columns, flags, blocks).select(
        F.col("block").alias("_block"), *[F.col(f).alias(f"_bits_{f}") for f in flags])
    block, places = _places(columns, blocks)
    # a hint, because the size is bounded here and not known to Spark
    met = rows.withColumn("_block", block).join(F.broadcast(bitmap), "_block", "left")
    return met.select(*rows.columns, *[
        F.coalesce(_holds(F.col(f"_bits_{f}"), places), F.lit(False)).alias(f) for f in flags])


def probably_in(rows: DataFrame, keys: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows whose key is among ``keys`` and a few others, where they lie."""
    return flag_known(rows, keys, columns, {"_maybe": F.lit(True)}).filter("_maybe") \
        .drop("_maybe")
