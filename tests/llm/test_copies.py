"""Relative Lempel-Ziv dedup and the Jaccard join against plain versions."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from zonepulse.llm.components import components
from zonepulse.llm.jaccard_join import JaccardJoin, jaccard_components
from zonepulse.llm.relative_lz import remove_repeats

from . import brute


def pairs_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


@pytest.mark.parametrize("window", [13, 4])
def test_repeats_equal_brute_force(messy, window):
    got = remove_repeats(messy, window).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("h")).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.h) for r in got} == brute.repeats(pairs_of(messy), window)
    assert sum(r.n_removed for r in got) > 30000


def test_spans_cover_what_is_removed(messy):
    for r in remove_repeats(messy, 13).collect():
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert len(r.kept.split(" ")) - (r.kept == "") == r.n_words - r.n_removed


def test_hot_windows_give_the_same(messy):
    """Windows of seeds in three documents or more take the aggregate's way."""
    got = remove_repeats(messy, 13, hot=3).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("h")).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.h) for r in got} == brute.repeats(pairs_of(messy), 13)


@pytest.mark.parametrize("hot", [20_000, 2])
def test_factors_are_copies(messy, hot):
    """Each factor's words stand in its source, which has a smaller id, and no factor could go on there."""
    words = {i: brute.words(t) for i, t in pairs_of(messy)}
    seen = longer = 0
    for r in remove_repeats(messy, 13, hot=hot).collect():
        mine, covered = words[r.doc_id], set()
        assert [f.start for f in r.factors] == sorted({f.start for f in r.factors})
        for f in r.factors:
            theirs = words[f.source]
            assert f.source < r.doc_id and f.end - f.start >= 13
            assert mine[f.start : f.end] == theirs[f.place : f.place + f.end - f.start]
            covered.update(range(f.start, f.end))
            seen += 1
            longer += f.end - f.start > 13
        assert covered == {p for s in r.spans for p in range(s.start, s.end)}
    assert seen > 20 and longer > 10


def test_batches_of_sources(spark):
    """A run that goes on over batches of the sorted stream keeps its first row."""
    import pyarrow as pa

    from zonepulse.llm.relative_lz import _sources

    rows = [(1, 5, 0), (1, 5, 9), (1, 7, 1), (2, 4, 0), (2, 6, 3), (2, 8, 2), (3, 1, 0)]
    for size in (1, 2, 3, 7):
        parts = [pa.RecordBatch.from_pylist([dict(zip(("run", "id", "place"), r, strict=True)) for r in rows[i : i + size]]) for i in range(0, len(rows), size)]
        got = [tuple(r.values()) for b in _sources(iter(parts)) for r in b.to_pylist()]
        assert got == [(7, 1, 5, 0), (6, 2, 4, 0), (8, 2, 4, 0)]


def test_repeats_edges(spark, nothing):
    assert remove_repeats(nothing).count() == 0
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(None, text, "s"), (None, text, "s"), (1, text, "s"), (1, text, "s"), (2, text, "s")]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, seed string")).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (0, 0), (1, 0), (1, 0), (2, 20)]


@pytest.mark.parametrize(("k", "t", "lower"), [(4, (85, 100), True), (5, (4, 5), False), (2, (1, 2), False)])
def test_join_equals_brute_force(messy, k, t, lower):
    got = jaccard_components(messy, k, t, lower).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.jaccard_components(pairs_of(messy), k, t, lower)


def near_copies(n, seed=1):
    """A base of 120 words and copies with a few words changed: chains as well as stars."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = f"c{rng.randrange(30)}"
        rows.append((i, " ".join(w)))
    return rows


def test_join_keeps_every_link_of_a_crowd(spark):
    rows = near_copies(150)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = jaccard_components(docs, 4, (85, 100)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.jaccard_components(rows, 4, (85, 100), False)


def test_join_does_not_list_pairs_of_a_crowd(spark):
    rows = [(i, " ".join(f"b{j}" for j in range(200)) + f" t{i}") for i in range(200)]
    join = JaccardJoin(spark.createDataFrame(rows, "doc_id long, text string"))
    found = join.solve()
    assert found.count() == 200 and found.select("component").distinct().count() == 1
    assert join.links.count() < 400  # of 19,900 pairs


class Counted(JaccardJoin):
    def _verified(self, pairs):
        checked = super()._verified(pairs)
        self.n_checked = getattr(self, "n_checked", 0) + checked.count()
        return checked


def test_pivot_is_the_text_that_others_were_made_from(spark):
    """Copies changed in three places each are like the base, but not like one another, and
    the base has neither the smallest nor the largest id."""
    rng, rows = random.Random(4), []
    base = [f"b{i}" for i in range(200)]
    for i in range(200):
        w = list(base)
        if i != 77:
            for j, at in enumerate(rng.sample(range(5, 195, 6), 3)):
                w[at] = f"c{i}_{j}"
        rows.append((i, " ".join(w)))
    join = Counted(spark.createDataFrame(rows, "doc_id long, text string"))
    found = join.solve()
    assert {(r.node, r.component) for r in found.collect()} == {(i, 0) for i in range(200)}
    assert join.n_checked < 2000  # of 19,900 pairs


def test_join_edges(spark, nothing):
    assert jaccard_components(nothing).count() == 0
    rows = [(None, "a b c d e f", 1), (4, "a b c d e f", 1), (4, "a b c d e f", 1), (7, "A B C D E F", 1), (8, None, 1), (9, " ", 1), (None, "q", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component int")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard_components(docs, lower=True).collect() if r.component_id is not None)
    assert got == [(0, 2, 4), (4, 2, 4), (4, 2, 4), (7, 2, 4), (8, 0, 8), (9, 0, 9)]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 160)}}
