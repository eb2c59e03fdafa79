from __future__ import annotations

import math
from datetime import date, timedelta
import random

import pytest
from pyspark.sql import functions as F

from zonepulse.operators import aggregates, correlation, joins, profile, quality
from zonepulse.operators.correlation import correlate_by_shift, pearson
from zonepulse.operators.partials import MomentStore, SketchStore


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """Facts of which a third belong to one key, with copies, and a table per key."""
    rng = random.Random(7)
    facts = [(i, "2018-01", "hot", float(i % 50)) for i in range(1000)]
    facts += [(1000 + i, f"2018-{1 + i % 12:02d}", f"z{rng.randrange(30)}", float(i % 70)) for i in range(2000)]
    per_key = [(f"2018-{m:02d}", z, float(m * 7 % 11 + len(z))) for m in range(1, 13) for z in ["hot"] + [f"z{i}" for i in range(25)]]
    return (
        spark.createDataFrame(facts, "id int, month string, zone string, price double"),
        spark.createDataFrame(per_key, "month string, zone string, signal double"),
    )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_attach_and_salted_join_agree(spark, skewed, how):
    facts, per_key = skewed
    keys = ["month", "zone"]
    plain = facts.join(per_key, keys, how).select("id", *keys, "price", "signal")
    columns = ["id", *keys, "price", "signal"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        attached = joins.attach(facts, per_key, keys, how)
        assert "BroadcastHashJoin" not in attached._jdf.queryExecution().executedPlan().toString()  # the session's word counts
        assert rows(attached.select(columns)) == rows(joins.salted_join(facts, per_key, keys, ["id"], how).select(columns)) == rows(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salts_follow_the_size_of_the_key(skewed):
    facts, _ = skewed
    hot = {(r.month, r.zone): r._salts for r in joins.hot_keys(facts, ["month", "zone"], share=20).collect()}
    assert hot == {("2018-01", "hot"): 7}  # a third of the rows, in twentieths


def test_attach_writes_nothing(spark, skewed, tmp_path):
    from zonepulse import session

    facts, per_key = skewed
    before = list(session._scratch)
    joins.attach(facts, per_key, ["month", "zone"]).count()
    assert session._scratch == before


def test_absent_keys(skewed):
    facts, per_key = skewed
    wanted = {tuple(r) for r in facts.select("month", "zone").collect()}
    known = {tuple(r) for r in per_key.select("month", "zone").collect()}
    assert {tuple(r) for r in joins.absent_keys(facts, per_key, ["month", "zone"]).collect()} == wanted - known


def test_shift_ignores_gaps_in_the_series(spark):
    """A shift moves the key; a missing month in between changes nothing."""
    df = spark.createDataFrame([("2018-01", 1.0), ("2018-04", 2.0)], "month string, v double")
    assert rows(joins.shifted(df, 1)) == [("2018-02", 1.0), ("2018-05", 2.0)]
    assert rows(joins.shifted_all(df, [0, 3]).select("shift", "month", "v")) == [
        (0, "2018-01", 1.0), (0, "2018-04", 2.0), (3, "2018-04", 1.0), (3, "2018-07", 2.0),
    ]


def test_correlation_equals_separate_joins(skewed):
    """The sweep from key moments against a plain row-level join per shift."""
    facts, per_key = skewed
    both = per_key.withColumn("other", F.col("signal") * F.col("signal") - F.length("zone"))
    swept = {r["shift"]: r for r in correlate_by_shift(facts, both, [-1, 0, 2, 5], "price", ["signal", "other"]).collect()}
    assert sorted(swept) == [-1, 0, 2, 5]
    for k, row in swept.items():
        joined = facts.join(joins.shifted(both, k), ["month", "zone"])
        n, a, b = joined.agg(F.count("*"), F.corr("price", "signal"), F.corr("price", "other")).first()
        assert row["n"] == n
        assert row["corr_signal"] == pytest.approx(a, abs=1e-6)
        assert row["corr_other"] == pytest.approx(b, abs=1e-6)


def test_correlation_far_from_zero(spark):
    """Values with a mean far above their spread keep their digits."""
    rng = random.Random(3)
    facts = spark.createDataFrame(
        [("2018-01", f"z{i % 40}", 1e9 + (i % 40) + rng.random()) for i in range(4000)], "month string, zone string, price double"
    )
    signals = spark.createDataFrame([("2018-01", f"z{i}", 1e9 + 2.0 * i) for i in range(40)], "month string, zone string, s double")
    got = correlate_by_shift(facts, signals, [0], "price", ["s"]).first()
    expected = facts.join(signals, ["month", "zone"]).agg(F.corr(F.col("price") - 1e9, F.col("s") - 1e9)).first()[0]
    assert got["corr_s"] == pytest.approx(expected, abs=1e-6)


def test_correlation_undefined_is_null(spark):
    facts = spark.createDataFrame([("2018-01", "a", 1.0), ("2018-01", "b", 2.0), ("2018-02", "a", None)], "month string, zone string, price double")
    signals = spark.createDataFrame([("2018-01", "a", 0.1), ("2018-01", "b", 0.1)], "month string, zone string, s double")
    assert rows(correlate_by_shift(facts, signals, [0, 9], "price", ["s"])) == [(0, 2, 2, None)]
    joined = facts.join(signals, ["month", "zone"])
    assert joined.agg(pearson("price", "s")).first()[0] is None


def test_correlation_leaves_out_null_signals(skewed):
    facts, per_key = skewed
    gaps = per_key.withColumn("other", F.when(F.length("zone") != 2, F.col("signal") + 1)).withColumn("none", F.lit(None).cast("double"))
    got = correlate_by_shift(facts, gaps, [0], "price", ["signal", "other", "none"]).first()
    joined = facts.join(gaps, ["month", "zone"])
    for name in ("signal", "other"):
        n, corr = joined.filter(F.col(name).isNotNull()).agg(F.count("*"), F.corr("price", name)).first()
        assert got[f"n_{name}"] == n and got[f"corr_{name}"] == pytest.approx(corr, abs=1e-6)
    assert got["n"] == joined.count() > got["n_other"] > 0
    assert got["n_none"] == 0 and got["corr_none"] is None


def test_pearson_skips_pairs_with_a_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.5), (3.0, 5.0), (None, 100.0), (9.0, None)], "a double, b double")
    expected = df.na.drop().agg(F.corr("a", "b")).first()[0]
    assert df.agg(pearson("a", "b")).first()[0] == pytest.approx(expected)


def test_attrition_never_rises_and_matches_filters(spark):
    df = spark.range(100).withColumn("v", F.when(F.col("id") % 7 != 0, F.col("id") % 10))
    steps = [("seen", F.col("v").isNotNull()), ("big", F.col("v") > 4), ("even", F.col("v") % 2 == 0)]
    report = {r["step"]: r["surviving"] for r in quality.attrition(df, steps).collect()}
    assert report[0] == 100 and list(report.values()) == sorted(report.values(), reverse=True)
    for i in range(1, 4):
        assert report[i] == quality.keep(df, steps[:i]).count()


def test_bad_numbers(spark):
    df = spark.createDataFrame([("1,200", "$5"), ("0", "- 0"), ("-", "1"), ("", "x"), ("3", None)], "area string, price string")
    rejects = quality.bad_numbers(df, {"area": ",", "price": "$,"})
    assert rows(rejects.select("area", "reason")) == [("", "area"), ("-", "area"), ("0", "price"), ("3", "price")]
    assert quality.bad_numbers(df, {"area": ","}, limit=1).count() == 1


def test_category_counts_and_pivot_agree(spark):
    df = spark.createDataFrame([("m", "A"), ("m", "A"), ("m", "B"), ("n", "C")], "month string, type string")
    counted = aggregates.category_counts(df, ["month"], "type", {"a": "A", "b": "B"}, "n")
    assert rows(counted) == [("m", 3, 2, 1), ("n", 1, 0, 0)]
    assert rows(aggregates.category_pivot(df, ["month"], "type", ["A", "B"])) == [("m", 2, 1), ("n", 0, 0)]


def test_top_and_frequent(spark):
    df = spark.createDataFrame([(x,) for x in "aaabbccd"], "t string")
    assert aggregates.top_vocabulary(df, "t", 2) == ["a", "b"]
    assert rows(aggregates.frequent(df, "t", 1)) == [("a", 3), ("b", 2), ("c", 2)]


def test_unit_price_without_area(spark):
    df = spark.createDataFrame([(10.0, 4.0), (10.0, 0.0), (10.0, -1.0), (10.0, None)], "p double, a double")
    assert [r[0] for r in df.select(aggregates.unit_price("p", "a")).collect()] == [2.5, None, None, None]


def test_profile(spark):
    df = spark.createDataFrame([(1, "a", -0.0), (2, None, 0.0), (2, "b", None)], "i int, s string, d double")
    got = {r["column_name"]: tuple(r)[1:] for r in profile.profile_table(df, exact=True).collect()}
    assert got == {"i": (3, 0, 2, "1", "2"), "s": (3, 1, 2, "a", "b"), "d": (3, 1, 1, "0.0", "0.0")}
    assert [tuple(r) for r in profile.schema_rows(df).collect()] == [(0, "i", "int", 3), (1, "s", "string", 2), (2, "d", "double", 2)]


def test_exact_distinct_over_kinds(spark):
    ends = [-(2**63), 2**63 - 1, -1, 0, 63, 64, -64, -65, 0, None, 63]
    rows = [(v, None if v is None else v % 7 - 3, f"s{v}", None if v is None else date(1970, 1, 1) + timedelta(days=v % 100 - 50)) for v in ends]
    df = spark.createDataFrame(rows, "v long, small tinyint, s string, d date")
    counted = profile.distinct_counts(df, df.columns, exact=True)
    known = [r for r in rows if r[0] is not None]
    assert dict(map(tuple, counted.collect())) == {"v": 8, "small": len({r[1] for r in known}), "s": 9, "d": len({r[3] for r in known})}
    assert "Expand" not in counted._jdf.queryExecution().optimizedPlan().toString()
    assert dict(map(tuple, profile.distinct_counts(df.limit(0), ["v", "s"], exact=True).collect())) == {"v": 0, "s": 0}


def test_dense_keys_meet_as_masks(spark):
    masks = profile._exact_count(spark.range(0, 64_000, 1, 4), "id")
    masks.collect()
    nodes = masks._jdf.queryExecution().executedPlan().toString()
    assert "bit_or" in nodes
    assert masks.first()["n_distinct"] == 64_000


def test_sketches_of_parts(spark, tmp_path):
    df = spark.range(60_000).select("id", (F.col("id") % 9000).alias("a"), (F.col("id") % 7).cast("string").alias("b"))
    store = SketchStore(spark, str(tmp_path / "s"), ["a", "b"])
    assert store.missing(["0", "1"]) == ["0", "1"]
    for part in (1, 0, 1):
        store.feed(df.filter(F.col("id") % 2 == part), str(part))
    assert store.parts() == ["0", "1"] and store.stored().count() == 2
    got = dict(map(tuple, store.distinct_counts().collect()))
    assert math.isclose(got["a"], 9000, rel_tol=0.065) and got["b"] == 7


def test_footer_profile(spark, tmp_path):
    path = str(tmp_path / "f")
    spark.range(5000).select("id", (F.col("id") * 0.5 - 3).alias("x"), F.lit("t").alias("t")).repartition(3).write.parquet(path)
    found = profile.footer_profile(path, spark, ["id", "x"])
    assert sorted(map(tuple, found.collect())) == [("id", 5000, "0", "4999"), ("x", 5000, "-3.0", "2496.5")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and "max(id)" in plan.split("BatchScan")[1]
    with pytest.raises(ValueError):
        profile.footer_profile(path, spark, ["t"])
    assert "FileScan" in spark.read.parquet(path)._jdf.queryExecution().executedPlan().toString()  # the caller's session is as it was


def test_approximate_distinct_is_close(spark):
    df = spark.range(50_000).select((F.col("id") % 9000).alias("a"), (F.col("id") % 7).alias("b"))
    exact = {r[0]: r[1] for r in profile.distinct_counts(df, ["a", "b"], exact=True).collect()}
    near = {r[0]: r[1] for r in profile.distinct_counts(df, ["a", "b"], exact=False).collect()}
    assert exact == {"a": 9000, "b": 7}
    assert all(math.isclose(near[c], exact[c], rel_tol=0.08) for c in exact)


def test_key_moments_of_nulls(spark):
    df = spark.createDataFrame([("m", 1.0), ("m", 3.0), ("m", None), ("n", None)], "month string, v double")
    got = correlation.key_moments(df, ["month"], "v").collect()
    assert [tuple(r) for r in got] == [("m", 2, 2.0, 2.0, 1.0, 3.0)]


def test_combining_aggregates_adds_no_shuffle(spark):
    from zonepulse.plans import complaints, sales

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows_ = spark.range(1000).selectExpr("cast(id % 12 as string) AS month", "id % 5 AS zone", "'HEATING' AS type", "1.0 AS area", "2.0 AS price")
        keys = ["month", "zone"]
        both = joins.combine([complaints.counts(rows_, keys), sales.mean_unit_price(rows_, keys)], keys)
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_moments_of_parts_merge_in_any_order(spark, tmp_path):
    """Fed in three parts, in any order and again, the moments are those of all rows."""
    rng = random.Random(8)
    rows = [(rng.choice(["2019-01", "2019-02"]), f"z{rng.randrange(4)}", 1e6 + rng.gauss(0, 3) if rng.random() < 0.9 else None, i % 3) for i in range(600)]
    df = spark.createDataFrame(rows, "month string, zone string, price double, part int")
    keys = ["month", "zone"]
    want = {(r.month, r.zone): r for r in correlation.key_moments(df, keys, "price").collect()}
    seen = []
    for n, order in enumerate([(0, 1, 2), (2, 0, 1), (1, 2, 0, 1)]):
        store = MomentStore(spark, str(tmp_path / str(n)), keys, "price")
        assert store.parts() == [] and store.missing(["0", "1"]) == ["0", "1"]
        for part in order:
            store.feed(df.filter(F.col("part") == part), str(part))
        assert store.parts() == ["0", "1", "2"] and store.missing(["2", "3"]) == ["3"]
        got = {(r.month, r.zone): r for r in store.moments().collect()}
        assert got.keys() == want.keys()
        for key, r in got.items():
            assert (r.n, r.low, r.high) == (want[key].n, want[key].low, want[key].high)
            assert r["mean"] == pytest.approx(want[key]["mean"], rel=1e-14)
            assert r.spread == pytest.approx(want[key].spread, rel=1e-6)
        seen.append(sorted(map(tuple, got.values())))
    assert seen[0] == seen[1] == seen[2]
