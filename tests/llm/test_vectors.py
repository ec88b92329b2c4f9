"""Top-k search and near-duplicates of vectors against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from estatelens.llm.kdtree import KdTree, SearchParams, ShardSplits, top_k
from estatelens.llm.multiindex import (MultiIndex, MultiIndexParams, near_duplicates,
                                       nearest_cells, unit_rows)

NAN, INF = float("nan"), float("inf")


def _vectors(seed=3, n=900, d=8):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, d)).astype(np.float32)
    base[100:250] = base[100] + 0.05 * rng.standard_normal((150, d)).astype(np.float32)
    base[300:500] = base[300]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    rows += [(2000, None), (2050, []), (2100, [0.0] * d), (2150, [1.0] * (d - 1) + [None]),
             (2200, [NAN] + [1.0] * (d - 1)), (2250, [INF] * d), (2300, [1.0, 2.0]),
             (2301, [2.0, 4.0]), (None, rows[100][1]), (5, rows[5][1]), (2350, [1e30] * d)]
    return rows


def _clean(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def test_top_k_equals_brute_force(spark):
    rows = _vectors()
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows],
                               "vec_id long, embedding array<float>, shard int, score int")
    params = SearchParams(k=5, shard_rows=100, leaf_rows=8, query_rows=7)
    got = {}
    for r in top_k(df, F.col("vec_id") % 50 == 0, params).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and _clean(v)
             and all(abs(256 * float(np.float32(x))) < 9e18 for x in v)]
    want = {}
    for q, a in whole:
        if q % 50:
            continue
        scored = sorted((-sum(map(int.__mul__, a, b)), i) for i, b in whole
                        if i != q and len(a) == len(b))
        want[q] = [(k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])]
    assert {q: sorted(v) for q, v in got.items()} == {q: v for q, v in want.items() if v}
    assert top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_repeated_query_id_asks_once_whatever_the_partitioning(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.integers(-9, 9, (60, 3)))]
    rows += [(50, [4.0, -8.0, 2.0]), (50, [-7.0, 1.0, 5.0]), (50, rows[50][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    own = [np.array([256.0 * x for x in v]) for i, v in rows if i == 50]
    asks = min(own, key=lambda v: v.tobytes())
    scored = sorted((-int(asks @ np.array([256 * x for x in v])), i) for i, v in rows if i != 50)
    want = [(k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])]
    for parts in (1, 3, 7):
        got = top_k(df.repartition(parts), F.col("vec_id") == 50, SearchParams(k=5, shard_rows=20))
        assert sorted((r["rank"], r.vec_id, r.score) for r in got.collect()) == want


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    rows = np.concatenate([rng.integers(-9, 9, (500, 4)) + 1000 * k for k in range(4)])
    tree = KdTree(np.arange(2000), rows.astype(float), 16)
    query = np.array([[1.0, 2.0, 0.5, 1.0]])
    bounds = tree.bounds(query)[0]
    for (a, b), bound in zip(tree.spans, bounds):
        assert (tree.rows[a:b] @ query[0]).max() <= bound
    best = tree.search(query[0], -1, bounds, 3, None)
    scores = sorted(((s, -i) for i, s in enumerate((rows @ query[0]).tolist())), reverse=True)
    assert [s for s, _ in best] == [int(s) for s, _ in scores[:3]]
    assert tree.search(query[0], -1, bounds, 3, scores[0][0] + 1) == []


def test_shards_part_the_rows():
    rows = np.random.default_rng(2).standard_normal((1000, 5))
    shard = ShardSplits(rows, 8).shard(rows)
    assert set(shard) == set(range(8)) and np.bincount(shard).max() < 140


def _plain_links(rows, threshold):
    out = {}
    units = [unit_rows(np.array([v], np.float32))[0] if _clean(v) and any(v) else None
             for _, v in rows]
    links = [[j for j, b in enumerate(units) if j != i and a is not None and b is not None
              and len(a) == len(b) and a @ b >= threshold] for i, a in enumerate(units)]
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.setdefault(rows[i][0], []).append((len(links[i]), min(ids) if ids else None))
    return out


@pytest.mark.parametrize("params", [
    MultiIndexParams(cell_rows=10_000), MultiIndexParams(cell_rows=20, block_rows=16)])
def test_near_duplicates_against_brute_force(spark, params):
    rows = _vectors()
    df = spark.createDataFrame([(i, v, 3, 4) for i, v in rows],
                               "vec_id long, embedding array<float>, label int, links int")
    got = {}
    for r in near_duplicates(df, params).collect():
        got.setdefault(r.vec_id, []).append((r.n_links, r.component_id))
        assert r.kept == (r.vec_id == r.component_id) or r.vec_id is None
    want = _plain_links(rows, 0.9)
    assert got.keys() == want.keys()
    found = sum(n for v in got.values() for n, _ in v)
    there = sum(n for v in want.values() for n, _ in v)
    assert 0.97 * there <= found <= there
    for key, entries in want.items():
        assert len(got[key]) == len(entries)
        for (n, _), (m, _) in zip(sorted(got[key]), sorted(entries)):
            assert n <= m
    if params.cell_rows == 10_000:  # one cell: all pairs meet
        assert {k: sorted(v, key=repr) for k, v in got.items()} == {
            k: sorted(v, key=repr) for k, v in want.items()}
    assert near_duplicates(df.limit(0), params).count() == 0


def test_cells_come_nearest_first():
    rng = np.random.default_rng(4)
    for _ in range(20):
        left, right = rng.random(7), rng.random(5)
        cells = nearest_cells(left, right, 35)
        sums = [left[c // 5] + right[c % 5] for c in cells]
        assert sorted(cells) == list(range(35)) and sums == sorted(sums)
        assert nearest_cells(left, right, 4) == cells[:4]


def test_recall_at_the_threshold():
    rng = np.random.default_rng(6)
    rows = unit_rows(rng.standard_normal((4000, 32)))
    index = MultiIndex(rows, 4000, MultiIndexParams(cell_rows=40))
    aside = rng.standard_normal((300, 32))
    one = rows[:300]
    aside = unit_rows(aside - (aside * one).sum(1, keepdims=True) * one)
    two = 0.9 * one + np.sqrt(0.19) * aside
    hits = sum(a[0] in b or b[0] in a for a, b in zip(
        index.cells(one, index.visits), index.cells(two, index.visits)))
    assert hits >= 0.93 * 300 and index.visits < 100
