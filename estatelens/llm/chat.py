"""Chat formatting: cumulative snapshots collapse, the longest conversations are rendered.

A conversation that was logged again after every turn leaves snapshots, each a prefix of the next.
Every turn has a hash of its place, role and text; the running exclusive-or of these identifies
each prefix.  Equal conversations keep the smallest id, and an anti-join on the prefix hashes of
longer ones drops all that such a prefix equals.  Turns are numbered and hashed in chunks, so a
very long conversation is not one task's work, and rendered one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK_TURNS = 256


def _numbered(turns: DataFrame) -> DataFrame:
    """Turns with ``position`` (from 1) in order of turn, role and text."""
    # a turn without number comes first, so its chunk does
    chunked = turns.withColumn("chunk", F.coalesce(F.floor(F.col("turn") / CHUNK_TURNS),
                                                   F.lit(-(1 << 62))))
    sizes = chunked.groupBy("conv_id", "chunk").agg(F.count("*").alias("size"))
    before = Window.partitionBy("conv_id").orderBy("chunk") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = sizes.select("conv_id", "chunk",
                         (F.sum("size").over(before) - F.col("size")).alias("before"))
    inside = Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text")
    return (chunked.withColumn("at", F.row_number().over(inside))
            .join(sizes, ["conv_id", "chunk"])
            .select("conv_id", "chunk", "role", "text",
                    (F.col("before") + F.col("at")).alias("position")))


def _hashes(numbered: DataFrame) -> DataFrame:
    return numbered.select("conv_id", "chunk", "position", *[
        F.xxhash64(F.lit(seed), "position", "role", "text").alias(name)
        for seed, name in ((1, "h1"), (2, "h2"))])


def _prefixes(hashed: DataFrame) -> DataFrame:
    """``conv_id, position, p1, p2``: hash of the conversation up to each turn."""
    chunks = hashed.groupBy("conv_id", "chunk").agg(
        F.bit_xor("h1").alias("c1"), F.bit_xor("h2").alias("c2"))
    earlier = Window.partitionBy("conv_id").orderBy("chunk") \
        .rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("conv_id", "chunk", *[
        F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(c) for c in ("c1", "c2")])
    upto = Window.partitionBy("conv_id", "chunk").orderBy("position") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = hashed.select("conv_id", "chunk", "position", *[
        F.bit_xor(h).over(upto).alias(h) for h in ("h1", "h2")])
    return (running.join(chunks, ["conv_id", "chunk"])
            .select("conv_id", "position", F.col("h1").bitwiseXOR(F.col("c1")).alias("p1"),
                    F.col("h2").bitwiseXOR(F.col("c2")).alias("p2")))


def maximal_conversations(hashed: DataFrame) -> DataFrame:
    """``conv_id, n_turns`` of the conversations that no longer one begins with."""
    whole = hashed.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), F.bit_xor("h1").alias("p1"), F.bit_xor("h2").alias("p2"))
    unlike = whole.groupBy("n_turns", "p1", "p2").agg(F.min("conv_id").alias("conv_id"))
    proper = (_prefixes(hashed).join(whole.select("conv_id", "n_turns"), "conv_id")
              .where("position < n_turns")
              .select(F.col("position").alias("n_turns"), "p1", "p2").distinct())
    return unlike.join(proper, ["n_turns", "p1", "p2"], "left_anti").select("conv_id", "n_turns")


def format_chats(turns: DataFrame, begin: str = "<|{}|>\n", end: str = "<|end|>\n") -> DataFrame:
    """``conv_id, position, n_turns, rendered`` of every turn of the conversations that remain.

    Turns of ``turns(conv_id, turn, role, text, ...)`` are ordered by turn (NULL first), then role
    and text; NULL role or text is empty.  Rows without conv_id belong to no conversation and are
    left out; repeated rows count once; other columns are ignored.  ``begin`` holds ``{}`` for the
    role.  The rendered turns of a conversation, joined by position, are its text.
    """
    own = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")) \
        .distinct()
    numbered = _numbered(own)
    kept = maximal_conversations(_hashes(numbered))
    before, after = begin.split("{}")
    return numbered.join(kept, "conv_id").select(
        "conv_id", "position", "n_turns",
        F.concat(F.lit(before), "role", F.lit(after), "text", F.lit("\n" + end))
        .alias("rendered"))
