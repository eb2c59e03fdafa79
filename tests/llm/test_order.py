"""Mixing and sharding: targets against the repeated sharing, and the laws of both."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonepulse.llm.hilbert import Dim, hilbert_index, hilbert_shards, write_shards
from zonepulse.llm.mixing import mix, repeat_texts, taken_words, water_fill
from zonepulse.llm.text import n_words

from . import brute


def shared_again(sizes, weights, share, most):
    """The rule as told: clamp, share the excess by weight, until none is above."""
    total = share * sum(sizes)
    fixed = {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        left = total - sum(fixed.values())
        w = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / w > most * sizes[i]]
        if not over:
            return [fixed.get(i, left * weights[i] / w if w else 0) for i in range(len(sizes))]
        fixed |= {i: most * sizes[i] for i in over}


@pytest.mark.parametrize("sizes", [[100, 5, 40, 900, 3, 60, 0], [10], [1, 1, 1], [7, 7000, 7, 7]])
def test_water_level_equals_sharing_again(spark, sizes):
    rows = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    got = {r.source: r.target for r in water_fill(rows).collect()}
    expected = shared_again(sizes, [(3, 1, 2)[i % 3] for i in range(len(sizes))], 1.5, 2)
    assert [got[f"s{i}"] for i in range(len(sizes))] == pytest.approx(expected)


def test_mix_takes_its_targets(messy):
    got = mix(messy, n_words(F.col("text"))).withColumn("taken", taken_words()).collect()
    assert {r.doc_id: r.mix_size for r in got} == {r.doc_id: len(brute.words(r.text)) for r in messy.collect()}
    by = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.mix_size
        by.setdefault(r.source, []).append(r)
    assert set(by) == {"a", "b", "c", None}
    for rows in by.values():
        assert sum(r.mix_size for r in rows) == rows[0].mix_source_size
        assert sum(r.taken for r in rows) == round(rows[0].mix_target)


def test_mix_repeats_and_reruns(messy):
    once, again = (sorted((r.doc_id, r.mix_whole, r.mix_part) for r in mix(d, n_words(F.col("text"))).collect()) for d in (messy, messy.repartition(5)))
    assert once == again
    mixed = mix(messy, n_words(F.col("text")))
    texts = repeat_texts(mixed, ["doc_id", "text"]).collect()
    taken = {}
    for r in texts:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(brute.words(r.text))
    assert taken == {r.doc_id: r.t for r in mixed.select("doc_id", taken_words().alias("t")).collect() if r.t}


def test_mix_edges(spark, nothing):
    assert mix(nothing, n_words(F.col("text"))).count() == 0
    rows = [(None, "a b", None, 1), (None, "a b", None, 1), (1, None, "s", 1), (1, "", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_size int")
    got = mix(docs, n_words(F.col("text"))).withColumn("taken", taken_words()).collect()
    assert len(got) == 4 and sum(r.taken for r in got) == 6  # 150 % of 4 words
    assert all(r.mix_target == 0 and r.taken == 0 for r in got if r.source == "s")


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (4, 2)])
def test_hilbert_curve_is_one_walk(dims, bits):
    side = 1 << bits
    cells = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
    index = hilbert_index(cells, bits)
    assert sorted(index) == list(range(side**dims))
    steps = np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(1)
    assert (steps == 1).all()


def placed(docs, shards=8):
    dims = {"source": Dim(F.col("source"), "name"), "n": Dim(F.col("n_chars"), "log"), "id": Dim(F.col("doc_id"))}
    return hilbert_shards(docs, dims, shards)


def test_shards_are_equal_runs(messy):
    crowd = messy.unionByName(messy.filter("doc_id = 3").withColumn("doc_id", F.explode(F.sequence(F.lit(1000), F.lit(1100)))))
    rows = placed(crowd.withColumn("slot", F.lit("old"))).collect()
    assert len(rows) == crowd.count()
    counts = {}
    for r in rows:
        counts.setdefault(r.shard, []).append(r.slot)
    assert sorted(counts) == list(range(8))
    assert max(map(len, counts.values())) - min(map(len, counts.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in counts.values())
    walk = [r.curve for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert walk == sorted(walk)


def test_shard_edges(spark, nothing, tmp_path):
    assert placed(nothing).count() == 0
    rows = [(None, None, None, None, None), (1, "x", "en", "a", 5), (1, "x", "en", "a", 5)]
    docs = spark.createDataFrame(rows, nothing.schema)
    assert sorted((r.shard, r.slot) for r in placed(docs).collect()) == [(0, 0), (2, 0), (5, 0)]


def test_written_shards_prune(messy, tmp_path):
    one = messy.dropDuplicates(["doc_id"])
    write_shards(one, placed(one, 4), str(tmp_path / "out"))
    back = messy.sparkSession.read.parquet(str(tmp_path / "out"))
    assert back.count() == one.count() and {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}


def test_written_files_exclude_by_two_dimensions(spark, nothing, tmp_path):
    """Each shard has its files of equal runs, and their minima and maxima exclude most."""
    size = (F.col("id") * 7919 % 1000 + 1).cast("long")
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("en").alias("lang"), F.lit("a").alias("source"), size.alias("n_chars"))
    dims = {"n": Dim(F.col("n_chars")), "id": Dim(F.col("doc_id"))}
    write_shards(docs, hilbert_shards(docs, dims, 4), str(tmp_path / "out"), files_per_shard=16)
    back = spark.read.parquet(str(tmp_path / "out")).withColumn("file", F.input_file_name())
    files = back.groupBy("shard", "file").agg(F.count(F.lit(1)).alias("n"), *(f(c).alias(f"{f.__name__}_{c}") for c in ("n_chars", "doc_id") for f in (F.min, F.max))).collect()
    per_shard = {}
    for r in files:
        per_shard.setdefault(r.shard, []).append(r.n)
    assert {s: len(n) for s, n in per_shard.items()} == {s: 16 for s in range(4)}
    assert all(max(n) - min(n) <= 1 for n in per_shard.values())
    met = [r for r in files if r.min_n_chars <= 300 and r.max_n_chars >= 200 and r.min_doc_id <= 1400 and r.max_doc_id >= 1000]
    assert len(met) <= len(files) / 8
    assert back.count() == 4000
