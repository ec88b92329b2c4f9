"""Embedding near-duplicates by an inverted multi-index.

Vectors are halved; each half has its own codebook, and the product of the codebooks is a grid of
cells.  A vector visits cells by rising sum of its two distances (multi-sequence traversal over
the two sorted codebook rows), as many as reach the target recall.  That number is measured on
pairs at exactly the threshold, the hardest there are, so real recall is higher.  Every pair met is
verified by its cosine in double precision.

Equal vectors are one class with a count; a crowded cell is cut into blocks, each visited
separately.  No pair leaves a task: links are counted, and each block gives a star of each group
of linked vectors.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm.components import components
from estatelens.llm.storage import written
from estatelens.llm.vectors import matrix, pack, unpack, usable


@dataclass(frozen=True)
class MultiIndexParams:
    """``threshold``: least cosine; ``target_recall``: share of pairs at the threshold that the
    visited cells must hold; ``sample``: most vectors that codebooks and the number of cells are
    fitted on; ``cell_rows``: vectors per cell aimed at, ``most_codes``: largest codebook;
    ``block_rows``: vectors of a cell that one block holds."""

    threshold: float = 0.9
    target_recall: float = 0.98
    sample: int = 8192
    cell_rows: int = 1000
    most_codes: int = 256
    block_rows: int = 2048


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; zero rows stay zero."""
    rows = rows.astype(np.float64)
    rows = rows / np.maximum(np.abs(rows).max(axis=1, keepdims=True), 1e-300)
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)


def codebook(rows: np.ndarray, codes: int, rounds: int = 10) -> np.ndarray:
    """k-means centres; an empty centre restarts at the row farthest from its own."""
    centres = rows[np.linspace(0, len(rows) - 1, codes).astype(int)].copy()
    for _ in range(rounds):
        distance = squared(rows, centres)
        own = distance.argmin(axis=1)
        for k in range(codes):
            members = rows[own == k]
            far = distance[np.arange(len(rows)), own].argmax()
            centres[k] = members.mean(axis=0) if len(members) else rows[far]
    return centres


def squared(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres."""
    return ((rows ** 2).sum(1)[:, None] - 2 * rows @ centres.T + (centres ** 2).sum(1)[None, :])


def nearest_cells(left: np.ndarray, right: np.ndarray, count: int) -> list[int]:
    """The ``count`` cells with the least sums of a left and a right distance, nearest first."""
    a, b = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    x, y, codes = left[a].tolist(), right[b].tolist(), len(right)
    a, b = a.tolist(), b.tolist()
    queue, reached, out = [(x[0] + y[0], 0, 0)], [0] * len(a), []
    while queue and len(out) < count:
        _, i, j = heapq.heappop(queue)
        out.append(a[i] * codes + b[j])
        reached[i] = j + 1
        # (i, j + 1) follows once the row above has passed it, (i + 1, j) once the cell beside has
        if j + 1 < codes and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(queue, (x[i] + y[j + 1], i, j + 1))
        if i + 1 < len(a) and reached[i + 1] == j:
            heapq.heappush(queue, (x[i + 1] + y[j], i + 1, j))
    return out


class MultiIndex:
    """Codebooks for vectors of one dimension, and the number of cells to visit."""

    def __init__(self, sample: np.ndarray, total: int, params: MultiIndexParams):
        rows = unit_rows(sample)
        self.half = max(1, rows.shape[1] // 2)
        codes = int(round((total / params.cell_rows) ** 0.5))
        codes = min(max(1, codes), params.most_codes, len(rows))
        self.left = codebook(rows[:, :self.half], codes)
        rest = rows[:, self.half:]
        self.right = codebook(rest, codes) if rest.shape[1] else np.zeros((1, 0))
        self.visits = self._calibrate(rows, params)

    def distances(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return squared(rows[:, :self.half], self.left), squared(rows[:, self.half:], self.right)

    def cells(self, rows: np.ndarray, count: int) -> list[list[int]]:
        """Cells that each row visits; the first is its own."""
        left, right = self.distances(rows)
        return [nearest_cells(a, b, count) for a, b in zip(left, right)]

    def _calibrate(self, rows: np.ndarray, params: MultiIndexParams) -> int:
        """Cells to visit so that ``target_recall`` of pairs at the threshold meet."""
        size = len(self.left) * len(self.right)
        rng = np.random.default_rng(7)
        one = rows[rng.choice(len(rows), min(len(rows), 400), replace=False)]
        aside = rng.standard_normal(one.shape)
        aside = unit_rows(aside - (aside * one).sum(1, keepdims=True) * one)
        t = params.threshold
        two = t * one + (1 - t * t) ** 0.5 * aside
        ranks = []
        for a, b in zip(self.cells(one, size), self.cells(two, size)):
            ranks.append(1 + min(a.index(b[0]), b.index(a[0])))  # either may visit the other
        return int(np.quantile(ranks, params.target_recall, method="higher"))


def _stars(found: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple:
    """Edges from every linked row or column to the least id of its group within the block."""
    rows, columns = np.flatnonzero(found.any(1)), np.flatnonzero(found.any(0))
    found = found[np.ix_(rows, columns)]
    a, b = low[rows].copy(), high[columns].copy()
    i, j = np.nonzero(found)
    while True:
        least = np.minimum(a[i], b[j])
        x, y = a.copy(), b.copy()
        np.minimum.at(x, i, least)
        np.minimum.at(y, j, least)
        if (x == a).all() and (y == b).all():
            break
        a, b = x, y
    return np.concatenate([low[rows], high[columns]]), np.concatenate([a, b])


class _Block:
    """The vectors of one block, met by visitors a batch at a time."""

    def __init__(self, threshold: float):
        self.threshold, self.parts, self.rows = threshold, [], None

    def add(self, ids, counts, vectors, visited) -> None:
        self.parts.append((ids, counts, unit_rows(vectors), visited))

    def close(self) -> None:
        self.ids, self.counts, self.rows, self.visited = map(np.concatenate, zip(*self.parts))

    def meet(self, ids, counts, vectors, cells) -> tuple:
        """Link counts of both sides, and stars."""
        found = unit_rows(vectors) @ self.rows.T >= self.threshold
        found &= ids[:, None] != self.ids[None, :]
        i, j = np.nonzero(found)
        if not len(i):
            return None
        # a vector that would not visit its visitor's cell gets the link from this visit
        back = ~(self.visited[j] == cells[i][:, None]).any(axis=1)
        nodes = np.concatenate([ids, self.ids])
        links = np.concatenate([np.bincount(i, self.counts[j], len(ids)),
                                np.bincount(j[back], counts[i[back]], len(self.ids))])
        some = np.flatnonzero(links)
        return nodes[some], links[some].astype(np.int64), *_stars(found, ids, self.ids)


def _visits(classes: DataFrame, index: MultiIndex, size: int, params: MultiIndexParams):
    shared = classes.sparkSession.sparkContext.broadcast(index)
    names = ["class", "count", "vector", "cells"]

    def assign(batches):
        index = shared.value
        for batch in batches:
            rows = matrix(batch.column(2), size)
            cells = np.array(index.cells(unit_rows(rows), index.visits), np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pack(rows),
                 pa.ListArray.from_arrays(
                     pa.array(np.arange(len(cells) + 1) * cells.shape[1], pa.int32()),
                     pa.array(cells.ravel()))], names)

    placed = written(classes.select("class", "count", "vector").mapInArrow(
        assign, "class long, count long, vector binary, cells array<int>"), "cells")
    placed = placed.withColumn("own", F.col("cells")[0])
    crowds = placed.groupBy("own").agg(
        F.ceil(F.count("*") / params.block_rows).cast("int").alias("blocks")) \
        .withColumnRenamed("own", "cell")
    inside = (placed.withColumnRenamed("own", "cell").join(crowds, "cell").select(
        "cell", F.pmod(F.xxhash64("class"), "blocks").cast("int").alias("block"),
        F.lit(0).alias("role"), "class", "count", "vector", "cells", F.lit(0).alias("own")))
    visitors = (placed.select(F.explode("cells").alias("cell"), "class", "count", "vector", "own")
                .join(crowds, "cell")
                .select("cell", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
                        F.lit(1).alias("role"), "class", "count", "vector",
                        F.lit(None).cast("array<int>").alias("cells"), "own"))
    threshold = params.threshold

    def meet(batches):
        at, block = None, None
        for batch in batches:
            key = (batch.column(0).to_numpy().astype(np.int64) << 32) | batch.column(1).to_numpy()
            role = batch.column(2).to_numpy()
            change = np.flatnonzero(np.diff(key) | np.diff(role)) + 1
            for low, high in zip([0, *change], [*change, len(key)]):
                if low == high:
                    continue
                part = batch.slice(low, high - low)
                ids, counts = part.column(3).to_numpy(), part.column(4).to_numpy()
                vectors = unpack(part.column(5), np.float32)
                if role[low] == 0:
                    if key[low] != at:
                        at, block = key[low], _Block(threshold)
                    visited = part.column(6).flatten().to_numpy().reshape(len(ids), -1)
                    block.add(ids, counts, vectors, visited)
                    continue
                if key[low] != at:
                    continue  # a cell nobody lives in
                if block.rows is None:
                    block.close()
                own = part.column(7).to_numpy()
                for i in range(0, len(ids), 1024):
                    cut = slice(i, i + 1024)
                    met = block.meet(ids[cut], counts[cut], vectors[cut], own[cut])
                    if met is None:
                        continue
                    nodes, links, ends, roots = met
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([nodes, ends])),
                         pa.array(np.concatenate([links, np.zeros(len(ends), np.int64)])),
                         pa.array(np.concatenate([nodes, roots]))], ["class", "links", "root"])

    return (inside.union(visitors).repartition("cell", "block")
            .sortWithinPartitions("cell", "block", "role", "class")
            .mapInArrow(meet, "class long, links long, root long"))


def near_duplicates(vectors: DataFrame, params: MultiIndexParams = MultiIndexParams(),
                    key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors``.

    Two rows link when found with a cosine of ``threshold`` or more; only vectors of one dimension
    are compared.  The component is the smallest id reachable, the kept row its holder.  Vectors
    that are NULL, empty or zero, or hold NULL or non-finite numbers, link with nothing.  Rows
    are returned one for one; repeated rows are vectors of their own and link with each other.  A
    row without id links like any other and takes its component from rows that have one.  Numbers
    are compared as 32-bit floats give them; other columns are ignored.
    """
    sized = vectors.select(F.col(key).cast("long").alias("vec_id"),
                           F.col(column).cast("array<float>").alias("vector"))
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x.cast("double"))))
    rows = sized.withColumn("size", F.when(usable("vector") & (norm > 0), F.size("vector")))
    rows = written(rows.select("vec_id", "size", F.when(F.col("size").isNotNull(), F.xxhash64(
        "size", F.transform("vector", lambda x: x + F.lit(0.0).cast("float")))).alias("class"),
        "vector"), "vectors")
    classes = written(rows.where("class is not null").groupBy("class").agg(
        F.count("*").alias("count"), F.first("size").alias("size"),
        F.first("vector").alias("vector")), "classes")
    met = None
    # one index for each dimension; an embedding table has one, or a few models' worth
    for size, total in classes.groupBy("size").count().orderBy("size").collect():
        own = classes.where(F.col("size") == size)
        sample = own.orderBy(F.xxhash64("class"), "class").limit(params.sample) \
            .select("vector").toArrow().column(0).combine_chunks()
        index = MultiIndex(matrix(sample, size), total, params)
        found = _visits(own, index, size, params)
        met = found if met is None else met.union(found)
    if met is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"),
                           F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    met = written(met, "met")
    links = met.where("links > 0").groupBy("class").agg(F.sum("links").alias("links"))
    joined = components(met.where("links = 0").select("class", "root").distinct(), "class", "root")
    roots = classes.join(joined.withColumnRenamed("node", "class"), "class", "left").select(
        "class", "count", F.coalesce("component", "class").alias("root"))
    roots = written(roots, "roots")
    lowest = rows.groupBy("class").agg(F.min("vec_id").alias("low")).join(roots, "class") \
        .groupBy("root").agg(F.min("low").alias("component_id"))
    of_class = roots.join(links, "class", "left").join(lowest, "root").select(
        "class", (F.col("count") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        "component_id")
    return rows.join(of_class, "class", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
        .alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
