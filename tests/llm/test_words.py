"""Words, shingles, Jaccard components and pieces against plain versions."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from estatelens.llm.components import components
from estatelens.llm.jaccard import (JaccardParams, document_sets, drop_near_copies,
                                    first_elements, jaccard_components, light_boundary)
from estatelens.llm.textbytes import text_slices

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = [w.translate(ASCII) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def plain_components(rows):
    sets = [shingles(t) for _, t in rows]
    low = list(range(len(rows)))
    linked = [[j for j in range(len(rows)) if sets[i] and sets[j] and
               100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
              for i in range(len(rows))]
    ids = [i for i, _ in rows]
    out = list(ids)
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        known = [ids[j] for j in seen if ids[j] is not None]
        out[low[i]] = min(known) if known else None
    return sorted(((ids[i], len(sets[i]), out[i]) for i in range(len(rows))), key=repr)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("abAB \n\t\x0b\x1cé", max_size=40)), max_size=30))
def test_sets_have_the_size_of_plain_sets(texts):
    got = [len(s) for s in document_sets(pa.array(texts, pa.string()), 5)]
    assert got == [len(shingles(t)) for t in texts]


def test_slices_cover_all_rows():
    column = pa.array(["a" * 10, None, "", "b" * 500, "c"] * 40).slice(3)
    rows = [bytes(data[a:b]).decode() for _, data, off in text_slices(column, 64)
            for a, b in zip(off, off[1:])]
    assert rows == [t or "" for t in column.to_pylist()]


def test_first_elements_hold_one_of_any_match():
    assert [first_elements(n, 80) for n in (1, 2, 3, 4, 5, 10)] == [0, 0, 0, 1, 2, 3]
    assert light_boundary(np.zeros(16, np.uint8), JaccardParams()) == 0


def _corpus():
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 4))
    passage = " ".join(word() for _ in range(60))
    rows, n = [], 0
    for size in (3, 5, 8, 9, 12, 20, 30, 60, 200):
        for _ in range(3):
            base = [word() for _ in range(size)]
            for copy in range(6):
                words = list(base)
                for _ in range(copy // 2):
                    words[int(rng.integers(size))] = word()
                rows.append((n, " ".join(words).title() if copy == 1 else "\n ".join(words)))
                n += 1
    for i in range(25):
        own = " ".join(word() for _ in range(int(rng.integers(5, 60))))
        rows.append((n + i, own + " " + passage))
    rows += [(n + 30, None), (n + 31, ""), (n + 32, " \n"), (n + 33, "x " * 30000),
             (n + 34, "x " * 20000), (0, rows[0][1]), (None, rows[10][1]), (None, "lonely words"),
             (n + 40, "a b c d"), (n + 41, "A B c\td")]
    return rows


def test_components_equal_plain_version(spark):
    rows = _corpus()
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows],
                                 "doc_id long, text string, class int, key int")
    got = jaccard_components(docs, JaccardParams(sketch_bits=12, filter_bits=12)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_components(rows)


def test_one_of_each_group_stays(spark):
    rows = _corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows],
                                 "doc_id long, text string, head string")
    kept = drop_near_copies(docs, JaccardParams(sketch_bits=12)).collect()
    want = {i for i, _, c in plain_components(rows) if i is not None and i == c}
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(want)
    assert sum(r.doc_id is None for r in kept) == 2
    empty = drop_near_copies(docs.limit(0))
    assert empty.columns == docs.columns and empty.count() == 0


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(0, 40, 1)] + [(100, 100 + i) for i in range(1, 50)]
    edges += [(7, 7), (None, 3), (3, None), (200, 201), (201, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long"), "a", "b")
                   .collect()))
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 150)} == {100}
    assert got[200] == got[201] == 200 and len(got) == 41 + 50 + 2


@pytest.mark.parametrize("schema", ["a long, b long"])
def test_no_edges(spark, schema):
    assert components(spark.createDataFrame([], schema), "a", "b").count() == 0
