"""Linked vectors against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonepulse.llm.collisions import collisions, deviation, needed, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, threshold=0.98):
    """[(id, n_links, component, kept)] of all rows, by all pairs."""
    x = []
    for i, v, label in rows:
        ok = i is not None and label is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)
        x.append(np.array(v, dtype=np.float32).astype(np.float64) if ok else None)
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            if x[a] is not None and x[b] is not None and rows[a][2] == rows[b][2] and len(x[a]) == len(x[b]):
                if x[a] @ x[b] / math.sqrt(x[a] @ x[a]) / math.sqrt(x[b] @ x[b]) >= threshold:
                    n[a] += 1
                    n[b] += 1
                    root[find(a)] = find(b)
    low = {}
    for a, r in enumerate(rows):
        if r[0] is not None:
            low[find(a)] = min(low.get(find(a), r[0]), r[0])
    return sorted(((r[0], n[a], low.get(find(a)), r[0] == low.get(find(a))) for a, r in enumerate(rows)), key=str)


def found(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def planted(seed, n, dim=32):
    """Random vectors with copies, longer ones, near ones on both sides of the threshold, and chains."""
    rng = np.random.default_rng(seed)
    x = []
    for i in range(n):
        v = rng.normal(size=dim)
        if i % 3 and x:
            old = x[rng.integers(len(x))]
            away = rng.normal(size=dim)
            away -= away @ old * old / (old @ old)
            angle = math.acos([1.0, 1.0, 0.995, 0.985, 0.9805, 0.9795, 0.97][i % 7])
            v = math.cos(angle) * old / np.linalg.norm(old) + math.sin(angle) * away / np.linalg.norm(away)
            v = old if i % 7 == 0 else v * rng.choice([1.0, 3.0])
        x.append(v)
    return [(int(i * 7 % 1009), [float(c) for c in np.float32(v)], int(i % 3) or None if i % 11 == 0 else 1) for i, v in enumerate(x)]


@pytest.mark.parametrize("slab", [1024, 37])
def test_equals_all_pairs(spark, slab):
    rows = planted(5, 400)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(near_vectors(df, slab_rows=slab)) == expected(rows)
    assert sum(r[1] for r in expected(rows)) > 300


def test_edges(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 1), (2, v, 1), (2, v, 1), (3, [2.0, 4.0, 6.0], 1), (4, v, 2), (5, v, None), (None, v, 1),
        (6, None, 1), (7, [], 1), (8, [0.0, 0.0, 0.0], 1), (9, [1.0, None, 3.0], 1), (10, [1.0, float("nan"), 3.0], 1),
        (11, [float("inf"), 2.0, 3.0], 1), (12, [1.0, 2.0], 1), (13, [-0.0, 1.0, 0.0], 1), (14, [0.0, 1.0, 0.0], 1), (15, [1e-30, 2e-30, 3e-30], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n_links", F.lit("x")).withColumn("node", F.lit(1))
    want = [(i, n, c, True if i is None else k) for i, n, c, k in expected(rows)]
    assert found(near_vectors(df)) == sorted(want, key=str)
    assert near_vectors(df.limit(0)).count() == 0


def test_one_vector_in_a_crowd(spark):
    """A third of all rows are copies of one vector, another third near copies of another."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=16)
    rows = [(i, [1.0] * 16, 1) for i in range(300)]
    rows += [(300 + i, [float(c) for c in base + 0.02 * rng.normal(size=16)], 1) for i in range(200)]
    rows += [(500 + i, [float(c) for c in rng.normal(size=16)], 1) for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(near_vectors(df, slab_rows=64)) == expected(rows)


def test_count_holds_for_pairs_at_the_threshold():
    """Of pairs whose cosine is the threshold no more than the loss, here of 20,000 pairs, miss the count."""
    rng = np.random.default_rng(3)
    p = rng.normal(size=(20_000, 24))
    q = p + deviation(0.98) * rng.normal(size=p.shape)
    met = (np.abs(p - q) <= 2.0 * deviation(0.98)).sum(axis=1)
    assert (met >= needed()).mean() >= 1 - 5e-4 and needed() > 12
    small, other = p[:50], q[:60]
    assert (collisions(small, other, 0.4) == (np.abs(small[:, None] - other[None]) <= 0.4).sum(axis=2)).all()


def test_recall_of_the_query_on_the_given_table(spark, data):
    from zonepulse.llm.queries import op11_collision_counting

    table = spark.read.parquet(f"{data}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    assert found(op11_collision_counting(spark, data)) == expected(rows)
