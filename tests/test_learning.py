from __future__ import annotations

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from zonepulse.operators import learning
from zonepulse.plans import catalog_models
from zonepulse.plans.catalog import Tables
from zonepulse.session import materialise


@pytest.fixture(scope="module")
def frame(spark):
    return spark.range(2000).select(
        "id",
        (F.col("id") % 17).cast("double").alias("x"),
        (F.col("id") % 5).cast("int").alias("z"),
        (F.col("id") % 17 * 3 - F.col("id") % 5 * 2 + F.sin("id")).alias("price"),
    )


def test_split_does_not_depend_on_partitioning(frame):
    train, test = learning.split_by_hash(frame, "id")
    again, _ = learning.split_by_hash(frame.repartition(13), "id")
    assert {r.id for r in train.collect()} == {r.id for r in again.collect()}
    assert train.count() + test.count() == 2000
    assert 0.85 < train.count() / 2000 < 0.95


def test_metrics_equal_the_evaluator(frame):
    predicted = frame.withColumn("prediction", F.col("price") + F.cos("id"))
    got = learning.metrics(predicted).first()
    for name in ("rmse", "mae"):
        expected = RegressionEvaluator(labelCol="price", metricName=name).evaluate(predicted)
        assert got[name] == pytest.approx(expected, abs=1e-6)
    assert got.rmse >= got.mae


def test_closed_form_equals_unpenalised_fit(frame):
    line = learning.least_squares(frame, "x", "price").first()
    fitted = learning.fit(frame, ["x"], learning.linear(reg=0.0, alpha=0.0)).stages[-1]
    assert line.slope == pytest.approx(fitted.coefficients[0], abs=1e-5)
    assert line.intercept == pytest.approx(fitted.intercept, abs=1e-5)


def test_compare_models(frame):
    estimators = {"linear": learning.linear(), "trees": learning.boosted_trees(max_iter=3), "forest": learning.forest(depth=4, trees=3)}
    report, models = learning.compare(frame, "id", estimators)
    got = {r["model"]: r for r in report.collect()}
    assert set(got) == set(estimators)
    _, test = learning.split_by_hash(frame, "id")
    for name, model in models.items():
        assert model.stages[0].getInputCols() == ["x", "z"]
        alone = learning.metrics(model.transform(test)).first()
        assert got[name]["n"] == alone.n
        assert got[name]["rmse"] == pytest.approx(alone.rmse, abs=1e-5) and got[name]["rmse"] >= got[name]["mae"]


def test_saved_model_predicts_the_same(frame, tmp_path):
    model = learning.fit(frame, ["x", "z"], learning.forest(depth=3, trees=2))
    learning.save_model(model, str(tmp_path / "m"))
    both = learning.load_model(str(tmp_path / "m")).transform(frame).select("id", F.col("prediction").alias("p"))
    assert model.transform(frame).join(both, "id").filter("prediction <> p").count() == 0


def test_importances_and_coefficients(spark, frame):
    forest = learning.importances(spark, learning.fit(frame, ["x", "z"], learning.forest(depth=3, trees=2)))
    assert forest.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    line = learning.coefficients(spark, learning.fit(frame, ["x", "z"], learning.linear(reg=0.0, alpha=0.0)))
    got = {r.feature: r.coefficient for r in line.collect()}
    assert got["x"] == pytest.approx(3, abs=0.05) and got["z"] == pytest.approx(-2, abs=0.05)


def test_scaling(frame):
    scaled = learning.scale_min_max(frame, ["x", "z"])
    assert set(scaled.columns) == set(frame.columns)
    assert tuple(scaled.agg(F.min("x"), F.max("x"), F.min("z"), F.max("z")).first()) == (0.0, 1.0, 0.0, 1.0)


@pytest.fixture(scope="module")
def tables(spark):
    from conftest import DATA

    return Tables(spark, DATA)


def test_balance_notices_another_penalty(tables):
    rows = materialise(catalog_models.training(tables))

    def wrong(reg, alpha):
        found = catalog_models._balance(tables, rows, learning.linear(reg=reg, alpha=alpha), 3000.0, 0.8)
        return found.filter("NOT is_best").count()

    assert wrong(3000.0, 0.8) == 0
    assert all(wrong(*p) > 3 for p in [(2500.0, 0.8), (3000.0, 0.6), (0.3, 0.8)])


def test_node_queries_notice_other_sizes(tables):
    small = catalog_models._forest_nodes(tables, learning.forest(depth=3, trees=2)).collect()
    assert {(r.n_trees, r.deepest) for r in small} == {(2, 3)} and all(r.importance_agrees and r.rows_kept for r in small)
    boosted = catalog_models._boosted_nodes(tables, learning.boosted_trees(max_iter=3)).first()
    assert (boosted.n_trees, boosted.deepest, boosted.rounds_improve) == (3, 5, True)
    worse = catalog_models._boosted_nodes(tables, learning.boosted_trees(max_iter=3).setStepSize(1.0).setLossType("absolute")).first()
    assert worse.n == boosted.n and worse.start == boosted.start


def test_importances_and_rows_notice_changed_nodes(spark, frame, tmp_path):
    model = learning.fit(frame, ["x", "z"], learning.forest(depth=4, trees=3))
    nodes = learning.stored_nodes(spark, model, str(tmp_path / "m"))
    known = {r.feature: r.importance for r in learning.importances(spark, model).collect()}
    again = {r.feature: r.importance for r in learning.importances_from_nodes(nodes).collect()}
    assert again == pytest.approx(known, abs=1e-12) and learning.misplaced_rows(nodes).isEmpty()
    bent = nodes.withColumn("gain", F.col("gain") * F.when(F.col("feature") == "z", 2.0).otherwise(1.0))
    assert learning.importances_from_nodes(bent).filter("feature = 'z'").first().importance > known["z"] + 1e-3
    lost = nodes.withColumn("n", F.col("n") - F.when((F.col("tree") == 1) & (F.col("left") < 0), 1).otherwise(0))
    assert learning.misplaced_rows(lost).count() > 0
    assert learning.misplaced_rows(nodes.filter("NOT (tree = 2 AND id = 1)")).count() == 1


def test_forest_sends_neither_trees_nor_statistics_of_many_partitions(spark, frame):
    """Each task at work holds the statistics of a pass, each partition sends them."""
    many = frame.repartition(16)
    at_work = spark.sparkContext.defaultParallelism
    forest = learning.forest(depth=3, trees=2)
    assert forest.getCacheNodeIds() and 2 * forest.getMaxMemoryInMB() <= 0.3 * 1800
    assert learning._dealt(many, forest).rdd.getNumPartitions() == min(16, at_work)
    assert learning._dealt(many, learning.linear()).rdd.getNumPartitions() == 16
    assert spark.sparkContext.getCheckpointDir() is not None
    assert learning._dealt(many, forest).count() == 2000


def test_nodes_saved_tree_by_tree_are_the_same(spark, frame, tmp_path):
    model = learning.fit(frame, ["x", "z"], learning.forest(depth=4, trees=3))
    whole = learning.stored_nodes(spark, model, str(tmp_path / "whole"))
    parts = learning.stored_nodes(spark, model, str(tmp_path / "parts"), at_once=10)
    assert (tmp_path / "parts" / "2").exists() and whole.schema.names == parts.schema.names
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, parts.collect()))


def test_linear_score_is_the_prediction(frame):
    model = learning.fit(frame, ["x", "z"], learning.linear())
    both = model.transform(frame).withColumn("again", learning.linear_score(model))
    assert both.filter(F.abs(F.col("prediction") - F.col("again")) > 1e-9).isEmpty()


def test_scores_notice_other_predictions(tables, monkeypatch):
    """The forest is run on the requests: without its predictions there are none."""
    forest = learning.forest(depth=3, trees=2)
    sound = catalog_models._score_requests(tables, forest)
    counts = {r.status[:2]: r["count"] for r in sound.filter("has_prediction").groupBy("status").count().collect()}
    assert set(counts) == {"ok"} and counts["ok"] == sound.filter("status = 'ok'").count() > 0

    class Bent:
        def __init__(self, model, value):
            self.model, self.value = model, value

        def transform(self, rows):
            return self.model.transform(rows).withColumn("prediction", self.value)

    fit = learning.fit
    for value in (-F.col("prediction"), F.col("prediction") * 1e6, F.lit(float("nan"))):
        monkeypatch.setattr(learning, "fit", lambda *a, v=value: Bent(fit(*a), v))
        bent = catalog_models._score_requests(tables, forest)
        assert bent.filter("status = 'ok'").count() == counts["ok"] and bent.filter("has_prediction").isEmpty()
