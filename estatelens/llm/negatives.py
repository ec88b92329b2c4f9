"""Hard negatives for anchors, by an inverted multi-index over whole-number inner products.

Vectors are halved; each half has a codebook, and pairs of codes form cells.  Every code knows its
radius, the greatest distance of a member's half to the centre, so a half's score against an
anchor is at most ``anchor . centre + |anchor| * radius``; the two halves' bounds add up to a bound
of the cell.  A heap over the two sorted lists of bounds hands out cells, highest bound first.  An
anchor stops when no window can gain from the next cell: each has all its rows with scores above
that bound, or the bound is below the window.  The answer is exact.

Cells are met in rounds: every open anchor takes cells of some thousand rows, then of more, with
what it has found so far as its floor.  Crowded cells are cut into blocks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm.multiindex import codebook, squared
from estatelens.llm.storage import written
from estatelens.llm.vectors import unpack, usable

#: Stands for "no limit" in scores, which are far smaller.
FAR = 1 << 62


@dataclass(frozen=True)
class NegativeParams:
    """``positives`` of an anchor and ``negatives`` of each; a negative's score must be from
    ``low_per_cent`` to ``high_per_cent`` of the positive's; ``scale``: of the components;
    ``sample``: most vectors that codebooks are fitted on; ``cell_rows``: rows of a cell aimed at;
    ``block_rows``: most rows of a block; ``first_rows``: rows an anchor's first round looks at,
    ``growth``: by how much more in each further one."""

    positives: int = 5
    negatives: int = 3
    low_per_cent: int = 50
    high_per_cent: int = 95
    scale: int = 256
    sample: int = 8192
    cell_rows: int = 2048
    block_rows: int = 4096
    first_rows: int = 8192
    growth: int = 16


class Grid:
    """Codebooks of the two halves of vectors of one dimension; radii and counts come later."""

    def __init__(self, rows: np.ndarray, codes: int):
        self.half = (rows.shape[1] + 1) // 2
        self.sides = [codebook(part, min(codes, len(part))) if part.shape[1] and len(part)
                      else np.zeros((1, part.shape[1])) for part in self.parts(rows)]
        self.radii = [np.zeros(len(side)) for side in self.sides]
        self.counts = np.zeros(len(self.sides[0]) * len(self.sides[1]), np.int64)

    def parts(self, rows: np.ndarray) -> list[np.ndarray]:
        return [rows[:, :self.half], rows[:, self.half:]]

    def place(self, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Code and distance of each row, for both halves."""
        out = []
        for part, side in zip(self.parts(rows), self.sides):
            code = squared(part, side).argmin(axis=1)
            out.append((code, np.linalg.norm(part - side[code], axis=1)))
        return out

    def bounds(self, rows: np.ndarray) -> list[np.ndarray]:
        """Upper bounds of each row's half scores with every code, with slack for rounding."""
        return [part @ side.T + np.linalg.norm(part, axis=1)[:, None] * radii[None, :] * (1 + 1e-9)
                + 1 for part, side, radii in zip(self.parts(rows), self.sides, self.radii)]


def falling_cells(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[float, int]]:
    """All cells with the sum of their two bounds, highest first."""
    a, b = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
    x, y, codes = left[a], right[b], len(right)
    heap, reached = [(-(x[0] + y[0]), 0, 0)], np.zeros(len(a), int)
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, int(a[i]) * codes + int(b[j])
        reached[i] = j + 1
        if j + 1 < codes and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
        if i + 1 < len(a) and reached[i + 1] == j:
            heapq.heappush(heap, (-(x[i + 1] + y[j]), i + 1, j))


def _whole(vectors: pa.Array, scale: int) -> np.ndarray:
    """Vectors of one dimension as whole numbers, in double precision."""
    return np.floor(unpack(vectors, np.float64) * scale)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact."""
    top = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if top < 1 << 52:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.T.astype(np.int64)


def _best(scores: np.ndarray, fit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` highest fitting scores of each row, ties to early columns."""
    rows = np.flatnonzero(fit.any(axis=1))
    kept_rows, kept_columns = [], []
    for row in rows:
        columns = np.flatnonzero(fit[row])
        own = scores[row, columns]
        if len(columns) > k:
            least = np.partition(own, len(own) - k)[len(own) - k]
            above = columns[own > least]
            columns = np.concatenate([above, columns[own == least][:k - len(above)]])
        kept_rows.append(np.full(len(columns), row))
        kept_columns.append(columns)
    if not kept_rows:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate(kept_rows), np.concatenate(kept_columns)


class MultiIndex:
    """Rows dealt to cells, and the grids that bound them.

    ``rows`` has ``vec_id, label`` (long), ``size`` and ``vector`` (doubles as bytes).
    """

    def __init__(self, rows: DataFrame, params: NegativeParams):
        self.params, self.context = params, rows.sparkSession.sparkContext
        rows = written(rows, "vectors")
        sample = rows.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(params.sample) \
            .select("size", "vector").toArrow()
        total, sizes = rows.count(), sample.column(0).to_numpy()
        grids = {}
        for size in np.unique(sizes).tolist():
            own = sample.filter(pa.array(sizes == size)).column(1).combine_chunks()
            codes = round((total * len(own) / len(sizes) / params.cell_rows) ** 0.5)
            # no more codes than the sample can tell apart; larger cells are cut into blocks
            grids[size] = Grid(_whole(own, params.scale), max(1, min(codes, len(own) // 16)))
        self.rows = self._placed(rows, grids)
        self._measure(grids)
        self.grids = self.context.broadcast(grids)

    def _placed(self, rows: DataFrame, grids: dict) -> DataFrame:
        shared, scale = self.context.broadcast(grids), self.params.scale

        def place(batches):
            for batch in batches:
                sizes = batch.column(2).to_numpy()
                for size in np.unique(sizes).tolist():
                    own = batch.filter(pa.array(sizes == size))
                    grid = shared.value.get(size) or Grid(np.zeros((0, size)), 1)
                    (a, x), (b, y) = grid.place(_whole(own.column(3), scale))
                    cell = a * len(grid.sides[1]) + b
                    yield pa.RecordBatch.from_arrays(
                        [*own.columns, pa.array(cell.astype(np.int64)), pa.array(x), pa.array(y)],
                        [*own.schema.names, "cell", "left", "right"])

        placed = rows.mapInArrow(place, "vec_id long, label long, size int, vector binary, "
                                        "cell long, left double, right double")
        # a number of its own deals each row, copies too, to the blocks of a crowded cell
        return written(placed.withColumn("number", F.monotonically_increasing_id()), "placed")

    def _measure(self, grids: dict) -> None:
        """Radii of all members and rows of all cells: one row for each cell that has any."""
        for size, cell, n, x, y in self.rows.groupBy("size", "cell").agg(
                F.count("*"), F.max("left"), F.max("right")).collect():
            grid = grids.setdefault(size, Grid(np.zeros((0, size)), 1))
            grid.counts[cell] = n
            for side, code, far in zip((0, 1), divmod(cell, len(grid.sides[1])), (x, y)):
                grid.radii[side][code] = max(grid.radii[side][code], far)

    def search(self, asking: DataFrame, k: int, same: bool) -> DataFrame:
        """``asker, slot, vec_id, score, rank``: the ``k`` best rows of every slot.

        ``asking`` has ``asker, label, size, vector`` and, for each slot, the greatest and least
        score it takes (``tops``, ``leasts``).  ``same``: rows of the asker's label, else of others.
        """
        state = asking.select("asker", "label", "size", "vector", "tops", "leasts",
                              F.lit(0).cast("long").alias("done"))
        best = Window.partitionBy("asker", "slot").orderBy(F.desc("score"), "vec_id")
        found, quota = None, self.params.first_rows
        while True:
            plan = written(self._planned(state, quota), "plan")
            if plan.where(F.size("cells") > 0).isEmpty():
                break
            met = self._met(plan, k, same)
            if found is not None:
                met = met.union(found.select("asker", "slot", "vec_id", "score"))
            found = written(met.withColumn("rank", F.row_number().over(best))
                            .where(F.col("rank") <= k), "found")
            floors = found.where(F.col("rank") == k).groupBy("asker").agg(F.map_from_entries(
                F.collect_list(F.struct("slot", "score"))).alias("floors"))
            state = plan.where("open").join(floors, "asker", "left").withColumn(
                "leasts", F.transform("leasts", lambda x, i: F.greatest(x, F.coalesce(
                    F.try_element_at("floors", i), x)))).drop("floors", "cells", "open")
            quota *= self.params.growth
        if found is None:
            kinds = "asker long, slot int, vec_id long, score long, rank int"
            return asking.sparkSession.createDataFrame([], kinds)
        return found

    def _planned(self, state: DataFrame, quota: int) -> DataFrame:
        """The next cells of every asker, and whether others may follow."""
        grids, scale = self.grids, self.params.scale

        def cells_of(grid, left, right, done, need):
            taken, rows, passed = [], 0, 0
            for passed, (bound, cell) in enumerate(falling_cells(left, right)):
                if bound < need:
                    return taken, passed, False
                if passed < done or not grid.counts[cell]:
                    continue
                if rows >= quota:
                    return taken, passed, True
                taken.append(cell)
                rows += grid.counts[cell]
            return taken, passed + 1, False

        def plan(batches):
            for batch in batches:
                sizes = batch.column(2).to_numpy()
                for size in np.unique(sizes).tolist():
                    own = batch.filter(pa.array(sizes == size))
                    grid = grids.value[size]
                    left, right = grid.bounds(_whole(own.column(3), scale))
                    out = []
                    for i, (tops, leasts, done) in enumerate(zip(
                            *(own.column(c).to_pylist() for c in (4, 5, 6)))):
                        need = min((low for low, top in zip(leasts, tops) if low <= top),
                                   default=2 * FAR)
                        out.append(cells_of(grid, left[i], right[i], done, need))
                    cells, done, follows = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [*own.columns[:6], pa.array(done, pa.int64()),
                         pa.array(cells, pa.list_(pa.int64())), pa.array(follows)],
                        [*own.schema.names, "cells", "open"])

        return state.select("asker", "label", "size", "vector", "tops", "leasts", "done") \
            .mapInArrow(plan, "asker long, label long, size int, vector binary, tops array<long>, "
                              "leasts array<long>, done long, cells array<long>, open boolean")

    def _met(self, plan: DataFrame, k: int, same: bool) -> DataFrame:
        """Best rows of every visit: askers and a block's rows meet as one sorted stream."""
        scale = self.params.scale
        part = F.col("label") if same else F.lit(0).cast("long")
        inside = self.rows.select("size", "cell", part.alias("part"), "vec_id", "label", "vector",
                                  "number")
        blocks = inside.groupBy("size", "cell", "part").agg(F.ceil(
            F.count("*") / self.params.block_rows).cast("int").alias("blocks"))
        visits = plan.select("size", F.explode("cells").alias("cell"), part.alias("part"),
                             F.col("asker").alias("vec_id"), "label", "vector", "tops", "leasts")
        none = F.lit(None).cast("array<long>")
        at = ["size", "cell", "part"]
        rows = inside.join(blocks, at).select(
            *at, F.pmod(F.xxhash64("number"), "blocks").cast("int").alias("block"),
            F.lit(0).alias("role"), "vec_id", "label", "vector", none.alias("tops"),
            none.alias("leasts"))
        visitors = visits.join(blocks, at).select(
            *at, F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
            F.lit(1).alias("role"), "vec_id", "label", "vector", "tops", "leasts")

        def answer(block, part):
            ids, labels, rows = block
            askers, marks = part.column(5).to_numpy(), part.column(6).to_numpy()
            scores = _products(_whole(part.column(7), scale), rows)
            alike = marks[:, None] == labels[None, :]
            able = (alike if same else ~alike) & (askers[:, None] != ids[None, :])
            tops, leasts = part.column(8).to_pylist(), part.column(9).to_pylist()
            for slot in range(max(map(len, tops))):
                high = np.array([t[slot] if slot < len(t) else -FAR for t in tops])
                low = np.array([t[slot] if slot < len(t) else FAR for t in leasts])
                fit = able & (scores <= high[:, None]) & (scores >= low[:, None])
                i, j = _best(scores, fit, k)
                if len(i):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(askers[i]), pa.array(np.full(len(i), slot, np.int32)),
                         pa.array(ids[j]), pa.array(scores[i, j])],
                        ["asker", "slot", "vec_id", "score"])

        def meet(batches):
            at, parts, block = None, [], None
            for batch in batches:
                place = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(5)])
                change = np.flatnonzero(np.diff(place).any(axis=0)) + 1
                for a, b in zip([0, *change], [*change, batch.num_rows]):
                    key, part = tuple(place[:4, a]), batch.slice(a, b - a)
                    if place[4, a] == 0:
                        if key != at:
                            at, parts, block = key, [], None
                        parts.append((part.column(5).to_numpy(), part.column(6).to_numpy(),
                                      _whole(part.column(7), scale)))
                    elif key == at:  # else a block without rows
                        if block is None:
                            block = [np.concatenate(p) for p in zip(*parts)]
                        for i in range(0, b - a, 256):
                            yield from answer(block, part.slice(i, min(256, b - a - i)))

        return (rows.union(visitors).repartition("size", "cell", "part", "block")
                .sortWithinPartitions("size", "cell", "part", "block", "role", "vec_id")
                .mapInArrow(meet, "asker long, slot int, vec_id long, score long"))


def _bytes_of(batches):
    for batch in batches:
        flat = batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        raw, ends = flat.tobytes(), 8 * np.cumsum(batch.column(2).to_numpy().astype(np.int64))
        vectors = pa.array([raw[a:b] for a, b in zip([0, *ends[:-1]], ends)], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], vectors], batch.schema.names)


def hard_negatives(vectors: DataFrame, is_anchor: Column, params: NegativeParams = NegativeParams(),
                   key: str = "vec_id", label: str = "label",
                   column: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(scale * x)``; a row's score is its inner product with the anchor,
    ties go to the smaller id.  An anchor's positives are its best other rows of the same label,
    all if fewer; a positive's negatives are the best rows of other labels whose score is from
    ``low_per_cent`` to ``high_per_cent`` of the positive's.  Pairs without such rows give none.

    Rows whose id, label or vector is NULL or empty, or whose vector holds a NULL, a non-finite
    number or one too large for a long, take no part; vectors of different dimension are not
    compared.  Rows with the anchor's own id are never its candidates.  Repeated candidate rows
    each count; an id that occurs twice asks once, by its least (label, vector).  ``is_anchor`` is
    a condition on the column ``vec_id``.  Labels are whole numbers; other columns are ignored.
    """
    fits = F.forall(column, lambda x: F.abs(x.cast("double")) * params.scale < F.lit(9.0e18))
    rows = vectors.where(usable(column)).where(fits).select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
        F.size(column).alias("size"), F.col(column).cast("array<double>").alias("vector")) \
        .where("vec_id is not null and label is not null") \
        .mapInArrow(_bytes_of, "vec_id long, label long, size int, vector binary")
    index = MultiIndex(rows, params)
    # one row of an id that occurs twice: structs compare by label, then by the vector's bytes
    anchors = index.rows.where(is_anchor).groupBy(F.col("vec_id").alias("asker")).agg(
        F.min(F.struct("label", "size", "vector")).alias("own")).select("asker", "own.*")
    anchors = written(anchors, "anchors")
    far = F.array(F.lit(FAR).cast("long"))
    positives = index.search(anchors.select("*", far.alias("tops"), F.transform(
        far, lambda x: -x).alias("leasts")), params.positives, same=True)
    positives = positives.select("asker", (F.col("rank") - 1).cast("int").alias("slot"),
                                 F.col("vec_id").alias("positive_id"),
                                 F.col("score").alias("positive_score"))
    windows = positives.groupBy("asker").agg(F.sort_array(F.collect_list(
        F.struct("slot", "positive_score"))).alias("slots"))

    def share(per_cent: int, up: bool):
        # whole scores within a per cent limit: rounded up for the least, down for the greatest
        def limit(x):
            product = x["positive_score"] * F.lit(per_cent)
            return (F.ceil if up else F.floor)(product.cast("decimal(38,0)") / 100).cast("long")
        return limit

    asking = anchors.join(windows, "asker").select(
        "asker", "label", "size", "vector",
        F.transform("slots", share(params.high_per_cent, False)).alias("tops"),
        F.transform("slots", share(params.low_per_cent, True)).alias("leasts"))
    found = index.search(asking, params.negatives, same=False)
    return found.join(positives, ["asker", "slot"]).select(
        F.col("asker").alias("anchor_id"), "positive_id", "rank",
        F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
