"""Connected components of a distributed edge list by alternating stars."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm.storage import written


CHUNK_EDGES = 200_000


def _contracted(batches):
    """Edges of each chunk of rows as stars around the smallest node of their group."""
    held, rows = [], 0

    def stars():
        a = np.concatenate([b.column(0).to_numpy() for b in held])
        b = np.concatenate([b.column(1).to_numpy() for b in held])
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        i, j, low = at[:len(a)], at[len(a):], np.arange(len(nodes))
        while True:
            least = np.minimum(low[i], low[j])
            new = low.copy()
            np.minimum.at(new, i, least)
            np.minimum.at(new, j, least)
            new = new[new]
            if (new == low).all():
                break
            low = new
        moved = np.flatnonzero(low != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes[moved]), pa.array(nodes[low[moved]])], ["a", "b"])

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= CHUNK_EDGES:
            yield stars()
            held, rows = [], 0
    if rows:
        yield stars()


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return (both.where("b > a").join(low, "a")
            .select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("a", F.col("low").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node, component`` for every node of an edge; the component is its smallest node.

    Tasks first contract their own edges, chunk by chunk.  Each round then shuffles the edges, whose
    number never grows; minima are combined before the shuffle, and a hub's edges are an inner join
    that Spark can split.  Rounds end when the edges
    stay the same (their sum and count); each round is written to the shared folder.
    NULL ends and self links are ignored.
    """
    own = edges.select(F.col(left).cast("long").alias("a"), F.col(right).cast("long").alias("b"))
    now = written(own.where("a <> b").distinct().mapInArrow(_contracted, "a long, b long"),
                  "edges")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        now = written(_small_star(_large_star(now)), "edges")
    lows = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        lows.select("node", F.col("node").alias("component")))
