"""Exact top-k by inner product: a KD-tree in every shard.

Shards are the leaves of a few median splits fitted on a bounded sample; a crowded shard is dealt
to several.  Each shard builds its own tree: median splits along the widest side of the tight
bounding box.  The bound of a box is the largest inner product any point in it could have; nodes
are visited best first until no bound reaches the kth score.  A query first visits one shard near
it, and the kth score found there goes with it to all others, most of whose boxes then fail it.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm.storage import written
from estatelens.llm.vectors import matrix, pack, unpack, usable


@dataclass(frozen=True)
class SearchParams:
    """``k``: results of a query; ``shard_rows``: vectors of a shard; ``leaf_rows``: of a leaf;
    ``sample``: most vectors that the splits between shards are fitted on; ``query_rows``: queries
    that one task answers on one shard."""

    k: int = 5
    shard_rows: int = 4096
    leaf_rows: int = 64
    sample: int = 8192
    query_rows: int = 8192


class ShardSplits:
    """Median splits of a sample, along the widest side, down to ``parts`` shards."""

    def __init__(self, sample: np.ndarray, parts: int):
        self.sides, self.cuts, self.depth = [], [], max(0, int(np.ceil(np.log2(max(parts, 1)))))
        groups = [sample]
        for _ in range(self.depth):
            following = []
            for rows in groups:
                wide = int(np.ptp(rows, axis=0).argmax()) if len(rows) else 0
                cut = float(np.median(rows[:, wide])) if len(rows) else 0.0
                self.sides.append(wide)
                self.cuts.append(cut)
                below = rows[:, wide] <= cut if len(rows) else np.zeros(0, bool)
                following += [rows[below], rows[~below]]
            groups = following

    def shard(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), np.int64)
        sides, cuts = np.array(self.sides + [0]), np.array(self.cuts + [0.0])
        for _ in range(self.depth):
            right = rows[np.arange(len(rows)), sides[node]] > cuts[node]
            node = 2 * node + 1 + right
        return node - ((1 << self.depth) - 1)


class KdTree:
    """Tree over integer rows; nodes in preorder with tight boxes."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, leaf_rows: int):
        self.order = np.arange(len(rows))
        self.spans, self.children, low, high = [], [], [], []
        todo = [(0, len(rows), None)]
        while todo:
            a, b, parent = todo.pop()
            own = rows[self.order[a:b]]
            node = len(self.spans)
            self.spans.append((a, b))
            self.children.append([])
            low.append(own.min(axis=0))
            high.append(own.max(axis=0))
            if parent is not None:
                self.children[parent].append(node)
            wide = int((high[-1] - low[-1]).argmax())
            if b - a > leaf_rows and high[-1][wide] > low[-1][wide]:
                middle = (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(own[:, wide], middle)]
                todo += [(a, a + middle, node), (a + middle, b, node)]
        self.ids, self.rows = ids[self.order], rows[self.order]
        self.low, self.high = np.array(low), np.array(high)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest possible inner product of each query with each node's box."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        return up @ self.high.T + down @ self.low.T

    def search(self, query: np.ndarray, own: int, bounds: np.ndarray, k: int, kth) -> list:
        """Up to ``k`` best ``(score, -id)`` that reach ``kth`` (None: any), best first."""
        best: list = []  # a heap, worst on top
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            if kth is not None and -bound < kth:
                break
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(queue, (-bounds[child], child))
                continue
            a, b = self.spans[node]
            scores, ids = self.rows[a:b] @ query, self.ids[a:b]
            fit = ids != own
            if kth is not None:
                fit &= scores >= kth
            for i in np.flatnonzero(fit):
                entry = (int(scores[i]), -int(ids[i]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                kth = best[0][0] if kth is None else max(kth, best[0][0])
        return sorted(best, reverse=True)


def _exact(rows: np.ndarray) -> np.ndarray:
    """As double where sums of products stay exact in it, which is faster."""
    top = int(np.abs(rows).max(initial=0))
    return rows.astype(np.float64) if top * top * rows.shape[1] < 1 << 52 else rows


def _visit(index: DataFrame, visitors: DataFrame, params: SearchParams) -> DataFrame:
    """Answers of all visitors in their shards: both sides meet as one sorted stream."""
    k, leaf_rows = params.k, params.leaf_rows

    def answer(batches):
        at, parts, tree = None, [], None
        for batch in batches:
            place = np.stack([batch.column(i).to_numpy() for i in range(4)])
            change = np.flatnonzero(np.diff(place).any(axis=0)) + 1
            for a, b in zip([0, *change], [*change, batch.num_rows]):
                part = batch.slice(a, b - a)
                ids, rows = part.column(4).to_numpy(), unpack(part.column(5), np.int64)
                key = tuple(place[:3, a])
                if place[3, a] == 0:
                    if key != at:
                        at, parts, tree = key, [], None
                    parts.append((ids, rows))
                    continue
                if key != at:
                    continue
                if tree is None:
                    tree = KdTree(np.concatenate([p[0] for p in parts]),
                                  _exact(np.concatenate([p[1] for p in parts])), leaf_rows)
                queries = _exact(rows)
                if queries.dtype != tree.rows.dtype or queries.dtype == np.float64 and \
                        np.abs(queries).max() * np.abs(tree.rows).max() * rows.shape[1] > 1 << 52:
                    queries, tree.rows = rows, tree.rows.astype(np.int64)
                    tree.low, tree.high = tree.low.astype(np.int64), tree.high.astype(np.int64)
                bounds, kths = tree.bounds(queries), part.column(6).to_pylist()
                found = [(own, -i, s) for own, q, limit, kth in zip(
                    ids.tolist(), queries, bounds.tolist(), kths)
                    for s, i in tree.search(q, own, limit, k, kth)]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*found)],
                        ["query_id", "vec_id", "score"])

    columns = ["shard", "portion", "flock", "role", "vec_id", "vector", "kth"]
    return (index.select(*columns).union(visitors.select(*columns))
            .repartition("shard", "portion", "flock")
            .sortWithinPartitions("shard", "portion", "flock", "role", "vec_id")
            .mapInArrow(answer, "query_id long, vec_id long, score long"))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _search(rows: DataFrame, is_query: Column, size: int, total: int,
            params: SearchParams) -> DataFrame:
    spark = rows.sparkSession
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(params.sample) \
        .select("vector").toArrow().column(0).combine_chunks()
    # no more shards than the sample can tell apart; larger ones are dealt in portions
    fitted = ShardSplits(matrix(sample, size),
                         min(-(-total // params.shard_rows), max(1, params.sample // 8)))
    parts, splits = 1 << fitted.depth, spark.sparkContext.broadcast(fitted)

    def deal(batches):
        for batch in batches:
            vectors = matrix(batch.column(1), size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pack(vectors),
                 pa.array(splits.value.shard(vectors))], ["vec_id", "asks", "vector", "shard"])

    dealt = written(rows.select("vec_id", "vector", is_query.alias("asks")).mapInArrow(
        deal, "vec_id long, asks boolean, vector binary, shard long"), "shards")
    crowds = written(dealt.groupBy("shard").agg(F.ceil(
        F.count("*") / params.shard_rows).cast("int").alias("portions")), "crowds")
    # of a repeated query id the vector with the least bytes asks, whatever the partitioning
    asking = (dealt.where("asks").groupBy("vec_id").agg(F.min(F.struct("vector", "shard")).alias("q"))
              .select("vec_id", "q.vector", "q.shard"))
    flocks = max(1, -(-asking.count() // params.query_rows))
    flock = F.pmod(F.xxhash64("vec_id"), F.lit(flocks)).cast("int").alias("flock")
    index = (dealt.join(crowds, "shard").select(
        "shard", F.pmod(F.xxhash64("vec_id", "vector"), "portions").cast("int").alias("portion"),
        F.explode(F.sequence(F.lit(0), F.lit(flocks - 1))).alias("flock"), F.lit(0).alias("role"),
        "vec_id", "vector", F.lit(None).cast("long").alias("kth")))
    home = asking.select("shard", F.lit(0).alias("portion"), flock, F.lit(1).alias("role"),
                         "vec_id", "vector", F.lit(None).cast("long").alias("kth"))
    first = written(_ranked(_visit(index.where("portion = 0"), home, params), params.k)
                    .select("query_id", "vec_id", "score"), "first")
    kth = first.groupBy("query_id").agg(
        F.when(F.count("*") == params.k, F.min("score")).alias("kth"))
    # every query, in flocks, against every portion of every shard but the one it has visited
    rest = (asking.withColumnRenamed("shard", "home").join(
        kth.withColumnRenamed("query_id", "vec_id"), "vec_id", "left")
        .select("home", flock, "vec_id", "vector", "kth",
                F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("shard"))
        .join(crowds, "shard")
        .select("home", "shard", F.explode(F.expr("sequence(0, portions - 1)")).alias("portion"),
                "flock", F.lit(1).alias("role"), "vec_id", "vector", "kth")
        .where((F.col("shard") != F.col("home")) | (F.col("portion") != 0)))
    return _ranked(first.union(_visit(index, rest, params)), params.k)


def top_k(vectors: DataFrame, is_query: Column, params: SearchParams = SearchParams(),
          key: str = "vec_id", column: str = "embedding", scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score``: the best ``k`` rows for each row that ``is_query`` holds.

    Components become ``floor(scale * x)``; the score is their inner product, ties go to the
    smaller id.  Rows with the query's own id are not its candidates.  Vectors that are NULL or
    empty, hold NULL or non-finite numbers or ones too large for a long, and rows without id take
    no part; vectors of different dimension are not compared.  Repeated candidate rows each count;
    a query id asks once, with the vector whose packed bytes are least.  ``is_query`` is a condition on the column ``vec_id``.
    """
    whole = F.transform(column, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    fits = F.forall(column, lambda x: F.abs(x.cast("double")) * scale < F.lit(9.0e18))
    rows = (vectors.where(usable(column)).where(fits & F.col(key).isNotNull())
            .select(F.col(key).cast("long").alias("vec_id"), whole.alias("vector")))
    answers = None
    for size, total in rows.groupBy(F.size("vector").alias("size")).count().orderBy("size") \
            .collect():
        own = _search(rows.where(F.size("vector") == size), is_query, size, total, params)
        answers = own if answers is None else answers.union(own)
    if answers is None:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id",
                           F.lit(0).cast("long").alias("score")).limit(0)
    return answers.select("query_id", "rank", "vec_id", "score")
