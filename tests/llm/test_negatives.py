"""Hard negatives against brute force, and the order and bounds of cells."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from estatelens.llm.negatives import Grid, NegativeParams, falling_cells, hard_negatives

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, cell long, size string"


def _rows(seed=6, n=700, d=7):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, d)).astype(np.float32)
    base[100:260] = base[100]                                   # one vector many times
    base[300:420] = base[300] + 0.1 * rng.standard_normal((120, d)).astype(np.float32)
    labels = rng.integers(0, 4, n).tolist()
    labels[550] = 77                                            # an anchor alone with its label
    rows = [(i, [float(x) for x in v], labels[i]) for i, v in enumerate(base)]
    return rows + [(1000, None, 1), (1050, [], 1), (1100, rows[3][1], None), (None, rows[3][1], 1),
                   (1150, [1.0] * (d - 1) + [None], 2), (1200, [NAN] * d, 1), (1250, [INF] * d, 1),
                   (1300, [1.0, 2.0], 1), (1301, [1.5, 2.0], 1), (1302, [0.5, 2.0], 2),
                   (50, rows[51][1], 0), (50, rows[50][1], 3), (7, *rows[7][1:]),
                   (1350, [0.0] * d, 1)]


def plain(rows, params):
    whole = [(i, tuple(math.floor(params.scale * x) for x in v), label) for i, v, label in rows
             if i is not None and label is not None and v
             and all(x is not None and math.isfinite(x) for x in v)]
    raw = [r for r in rows if r[0] is not None and r[2] is not None and r[1]
           and all(x is not None and math.isfinite(x) for x in r[1])]
    asks = {}
    for (i, v, label), (_, q, _) in zip(raw, whole):
        if i % 50 == 0:
            least = (label, len(v), np.array(v, np.float64).tobytes())
            asks[i] = min(asks.get(i, (least, q)), (least, q))
    out = Counter()
    for i, ((label, *_), q) in asks.items():
        scored = sorted((-sum(map(int.__mul__, q, w)), j, other) for j, w, other in whole
                        if j != i and len(w) == len(q))
        positives = [(j, -s) for s, j, other in scored if other == label][:params.positives]
        for j, top in positives:
            fit = [(k, -s) for s, k, other in scored if other != label and
                   params.low_per_cent * top <= -100 * s <= params.high_per_cent * top]
            for rank, (k, s) in enumerate(fit[:params.negatives], 1):
                out[i, j, rank, k, top, s] += 1
    return out


@pytest.mark.parametrize("params", [
    NegativeParams(), NegativeParams(cell_rows=10, block_rows=20, first_rows=8, growth=3),
    NegativeParams(2, 1, 0, 100, cell_rows=40, block_rows=16, first_rows=60)])
def test_equals_brute_force(spark, params):
    rows = _rows()
    df = spark.createDataFrame([(*r[:3], 1, "x") for r in rows], SCHEMA)
    got = Counter(tuple(r) for r in hard_negatives(
        df, F.col("vec_id") % 50 == 0, params).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score",
        "negative_score").collect())
    want = plain([(i, v and [None if x is None else float(np.float32(x)) for x in v], label)
                  for i, v, label in rows], params)
    assert got == want and sum(got.values()) > 20


def test_the_order_of_rows_does_not_matter(spark):
    df = spark.createDataFrame([(*r[:3], 1, "x") for r in _rows()], SCHEMA)
    params = NegativeParams(cell_rows=30, block_rows=50, first_rows=90)
    found = [Counter(map(tuple, hard_negatives(d, F.col("vec_id") % 50 == 0, params).collect()))
             for d in (df, df.orderBy(F.rand(3)).repartition(7))]
    assert found[0] == found[1]


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert hard_negatives(df, F.col("vec_id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(50, [1.0, 2.0], 1, 1, "x")], SCHEMA)
    assert hard_negatives(one, F.col("vec_id") % 50 == 0).count() == 0


def test_cells_fall_and_their_bounds_hold():
    rng = np.random.default_rng(1)
    rows = np.floor(256 * rng.standard_normal((500, 9)))
    grid = Grid(rows, 6)
    codes = grid.place(rows)
    for radii, (code, far) in zip(grid.radii, codes):
        np.maximum.at(radii, code, far)
    cell = codes[0][0] * len(grid.sides[1]) + codes[1][0]
    query = np.floor(256 * rng.standard_normal((3, 9)))
    for q, left, right in zip(query, *grid.bounds(query)):
        order = list(falling_cells(left, right))
        assert len({c for _, c in order}) == len(order) == 36
        assert [b for b, _ in order] == sorted((b for b, _ in order), reverse=True)
        bound = {c: b for b, c in order}
        assert all(rows[i] @ q <= bound[cell[i]] for i in range(500))
