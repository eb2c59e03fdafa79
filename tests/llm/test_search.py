"""Inverted multi-index: the walk's order, exact results on small tables, recall on larger ones."""

from __future__ import annotations

import numpy as np
import pytest

from zonepulse.llm.multi_index import LEAST, Layout, search, usable, walk


def table(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")


def exact(x, ids, queries, k):
    out = {}
    for q in queries:
        s = (x * x[ids.tolist().index(q)]).sum(1)
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        out[q] = ids[order].tolist()
    return out


def results(found):
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.vec_id)
    return out


def test_walk_visits_cells_by_summed_distance():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=7), rng.normal(size=5)
    counts = rng.integers(0, 4, size=35)
    order = [int(c) for c in np.argsort((a[:, None] + b[None]).ravel(), kind="stable") if counts[c]]
    assert walk(a, b, counts, 10**9) == order
    some = walk(a, b, counts, 20)
    assert some == order[: len(some)] and counts[some].sum() >= 20 > counts[some[:-1]].sum()


def test_layout_bounds_blocks():
    counts = np.array([3, 0, 10, 25, 1, 1])
    layout = Layout.of(counts, 10)
    assert layout.pieces.tolist() == [1, 1, 1, 3, 1, 1]
    assert layout.first.tolist() == [0, 0, 1, 2, 5, 5]


@pytest.mark.parametrize("dim", [8, 5, 1])
def test_small_tables_are_exact(spark, dim):
    rng = np.random.default_rng(dim)
    x = rng.integers(-2, 3, size=(120, dim)).astype(float)
    x[60:90] = x[3]  # copies: ties go to the smaller id
    x[np.abs(x).sum(1) == 0] = 1.0
    ids = rng.permutation(1000)[:120]
    rows = usable(table(spark, x, ids), "vec_id", "embedding")
    found = search(rows, rows.filter("id % 5 = 0"), k=20, block_rows=16, chunk_queries=7)
    assert results(found) == exact(x, ids, [int(i) for i in ids if i % 5 == 0], 20)


def test_recall(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.arange(3000)
    rows = usable(table(spark, x), "vec_id", "embedding")
    found = results(search(rows, rows.filter("id % 100 = 0"), k=20, centroids=32, share=0.5, least=100))
    truth = exact(x, ids, list(range(0, 3000, 100)), 20)
    hits = sum(len(set(found[q]) & set(truth[q])) for q in truth)
    assert hits / (20 * len(truth)) >= 0.9 and all(len(v) == 20 for v in found.values())


def test_recall_with_unequal_norms(spark):
    """More rows than twice LEAST, searched with the defaults of the registered query."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(5000, 32))
    x *= (np.exp(rng.normal(size=5000)) / np.linalg.norm(x, axis=1))[:, None]
    assert len(x) > 2 * LEAST
    rows = usable(table(spark, x), "vec_id", "embedding")
    found = results(search(rows, rows.filter("id % 100 = 0"), k=20))
    truth = exact(x, np.arange(len(x)), list(range(0, len(x), 100)), 20)
    hits = sum(len(set(found[q]) & set(truth[q])) for q in truth)
    assert hits / (20 * len(truth)) >= 0.9 and all(len(v) == 20 for v in found.values())


def test_edges(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [2.0, 1.0]), (None, [1.0, 1.0]), (8, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    good = usable(df, "vec_id", "embedding")
    assert results(search(good, good)) == {0: [6], 6: [0]}
    assert search(good.limit(0), good.limit(0)).count() == 0
    assert search(good, good.limit(0)).count() == 0
