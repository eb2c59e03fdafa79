"""Regression queries. SQL knows closed forms; of other fits it knows what must hold."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import learning
from ..operators.joins import attach
from ..schemas import FEATURE_COLUMNS, LABEL
from ..session import materialise, scratch_path
from . import roles, study
from .catalog import QUERIES, Tables, query
from .catalog_joins import profile, training

ID = "listing_id"
_BUCKET = "('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 4))::INT % 10"


@query(f"SELECT o_orderkey, {_BUCKET.format(k='o_orderkey')} AS bucket, {_BUCKET.format(k='o_orderkey')} < 9 AS is_train FROM orders")
def hash_split(t: Tables) -> DataFrame:
    return learning.with_split(t.orders.select("o_orderkey"), "o_orderkey")


@query(
    """SELECT l_orderkey, l_quantity AS f0, l_extendedprice AS f1, l_discount AS f2, CAST(l_linenumber AS DOUBLE) AS f3 FROM lineitem"""
)
def assemble_features(t: Tables) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]
    vectors = learning.assembler(columns).transform(t.lineitem)
    cells = vector_to_array("features")
    return vectors.select("l_orderkey", *(cells[i].alias(f"f{i}") for i in range(len(columns))))


@query(
    """SELECT o_orderkey, round((o_totalprice - min(o_totalprice) OVER ()) / (max(o_totalprice) OVER () - min(o_totalprice) OVER ()), 6) AS o_totalprice,
    round((o_custkey - min(o_custkey) OVER ()) / (max(o_custkey) OVER () - min(o_custkey) OVER ()), 6) AS o_custkey FROM orders"""
)
def minmax_scale(t: Tables) -> DataFrame:
    columns = ["o_totalprice", "o_custkey"]
    scaled = learning.scale_min_max(t.orders.select("o_orderkey", *columns), columns)
    return scaled.select("o_orderkey", *(F.round(c, 6).alias(c) for c in columns))


_SPLIT = f"SELECT *, {_BUCKET.format(k='listing_id')} AS bucket FROM ({roles.DUCK_LISTINGS})"


@query(
    f"""WITH s AS ({_SPLIT}), m AS (SELECT zone, avg(price) AS prediction FROM s WHERE bucket < 9 GROUP BY zone)
    SELECT count(*) AS n, round(sqrt(avg((prediction - price) * (prediction - price))), 4) AS rmse, round(avg(abs(prediction - price)), 4) AS mae
    FROM s JOIN m USING (zone) WHERE bucket >= 9"""
)
def regression_metrics(t: Tables) -> DataFrame:
    """The zone mean of the training part as prediction for the rest."""
    train, test = learning.split_by_hash(roles.listings(t), ID)
    means = train.groupBy("zone").agg(F.avg("price").alias("prediction"))
    return learning.metrics(attach(test, means, ["zone"]), place=4)


@query(
    """SELECT l_returnflag, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
    round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem GROUP BY 1"""
)
def linreg_closed_form(t: Tables) -> DataFrame:
    return learning.least_squares(t.lineitem, "l_quantity", "l_extendedprice", ["l_returnflag"], place=4)


_TRAINING = f"""SELECT listing_id FROM ({roles.DUCK_CLEAN_LISTINGS}) l JOIN ({roles.DUCK_PROFILE}) p
  ON replace(l.Date, '/', '-') = p.month AND l.zipcode = p.zone"""


_PRICED = f"""SELECT price, {_BUCKET.format(k='listing_id')} AS bucket FROM ({QUERIES["training_frame"].sql})"""


def _report_sql(*models: str) -> str:
    """Of a fit SQL knows the rows held out and how far off the mean of the training rows is
    there, and that no root mean square is below the mean."""
    held = f"""SELECT count(*) AS n, round(sqrt(avg((price - m) * (price - m))), 2) AS mean_rmse
      FROM ({_PRICED}), (SELECT avg(price) AS m FROM ({_PRICED}) WHERE bucket < 9) WHERE bucket >= 9"""
    flags = "TRUE AS rmse_at_least_mae, TRUE AS evaluator_agrees"
    return " UNION ALL ".join(f"SELECT '{m}' AS model, n, mean_rmse, {flags} FROM ({held})" for m in models)


def _held_out(t: Tables, **estimators) -> DataFrame:
    """The report of ``learning.compare``, and whether Spark's own evaluator finds the same
    errors in predictions that were stored as a table."""
    frame = materialise(training(t))
    report, models = learning.compare(frame, ID, estimators)
    train, test = learning.split_by_hash(frame, ID)
    mean = train.agg(F.avg("price")).first()[0]
    scored = test
    for name, model in models.items():
        scored = model.transform(scored).drop("features").withColumnRenamed("prediction", f"prediction_{name}")
    stored = materialise(scored.select("price", *(f"prediction_{m}" for m in models)))
    again = []
    for name in models:
        judge = RegressionEvaluator(predictionCol=f"prediction_{name}", labelCol="price")
        again.append((name, *(float(judge.setMetricName(m).evaluate(stored)) for m in ("rmse", "mae"))))
    second = t.spark.createDataFrame(again, "model string, rmse2 double, mae2 double")
    off = (F.col("price") - mean) * (F.col("price") - mean)
    baseline = stored.agg(F.round(F.sqrt(F.avg(off)), 2)).first()[0]
    near = F.lit(True)
    for m in ("rmse", "mae"):
        near = near & (F.abs(F.col(m) - F.col(f"{m}2")) <= 1e-9 * F.col(f"{m}2"))
    return report.join(second, "model").select(
        "model",
        "n",
        F.lit(baseline).alias("mean_rmse"),
        ((F.col("rmse") >= F.col("mae")) & (F.col("mae") > 0)).alias("rmse_at_least_mae"),
        near.alias("evaluator_agrees"),
    )


@query(_report_sql("linear"))
def fit_linear(t: Tables) -> DataFrame:
    return _held_out(t, linear=learning.linear())


@query(_report_sql("boosted_trees"))
def fit_gbt(t: Tables) -> DataFrame:
    return _held_out(t, boosted_trees=learning.boosted_trees())


@query(_report_sql("forest"))
def fit_forest(t: Tables) -> DataFrame:
    return _held_out(t, forest=learning.forest())


@query(_report_sql("linear", "boosted_trees", "forest"))
def model_compare(t: Tables) -> DataFrame:
    return _held_out(t, linear=learning.linear(), boosted_trees=learning.boosted_trees(), forest=learning.forest())


_STUMP = "SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(l_returnflag = 'R' AS INT)::DOUBLE AS flag FROM lineitem"


@query(
    f"""SELECT flag, round(avg(l_extendedprice), 4) AS one_tree, round(avg(l_extendedprice), 4) AS one_round
    FROM ({_STUMP}) GROUP BY flag"""
)
def tree_group_means(t: Tables) -> DataFrame:
    """A tree of depth 1 on a 0/1 column predicts the two means, alone and as first round."""
    rows = t.lineitem.select("l_extendedprice", F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("flag"))
    tree = learning.forest("l_extendedprice", depth=1, trees=1).setBootstrap(False).setFeatureSubsetStrategy("all")
    boosted = learning.boosted_trees("l_extendedprice", max_iter=1).setMaxDepth(1)
    cases = rows.select("flag").distinct()
    for name, estimator in (("one_tree", tree), ("one_round", boosted)):
        model = learning.fit(rows, ["flag"], estimator)
        cases = model.transform(cases).drop("features").withColumn(name, F.round("prediction", 4)).drop("prediction")
    return cases


def _names_sql(names: list[str], more: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS feature, {more}" for n in names)


@query(_names_sql(FEATURE_COLUMNS, "TRUE AS in_range, 1.0::DOUBLE AS total"))
def feature_importance(t: Tables) -> DataFrame:
    model = learning.fit(training(t), FEATURE_COLUMNS, learning.forest())
    found = learning.importances(t.spark, model)
    total = found.agg(F.round(F.sum("importance"), 6).alias("total"))
    share = F.col("importance").between(0.0, 1.0)
    # One row on either side of the total: the model has a fixed number of features.
    return found.select("feature", share.alias("in_range"), F.lit(total.first()[0]).alias("total"))


@query(_names_sql(FEATURE_COLUMNS, "10 AS n_trees, 20 AS deepest, TRUE AS importance_agrees, TRUE AS rows_kept"))
def forest_nodes(t: Tables) -> DataFrame:
    """The full forest as a stored table of nodes: importances worked out again from gains
    and row counts, and every split's rows found on its two sides."""
    return _forest_nodes(t, learning.forest())


def _forest_nodes(t: Tables, estimator) -> DataFrame:
    model = learning.fit(training(t), FEATURE_COLUMNS, estimator)
    nodes = learning.stored_nodes(t.spark, model, scratch_path(t.spark, "forest"))
    kept = learning.misplaced_rows(nodes).isEmpty()
    trees = model.stages[-1].trees
    again = learning.importances_from_nodes(nodes).withColumnRenamed("importance", "again")
    both = learning.importances(t.spark, model).join(again, "feature", "left")
    agrees = F.abs(F.col("importance") - F.coalesce("again", F.lit(0.0))) <= 1e-9
    return both.select(
        "feature",
        F.lit(len(trees)).alias("n_trees"),
        F.lit(max(x.depth for x in trees)).alias("deepest"),
        agrees.alias("importance_agrees"),
        F.lit(kept).alias("rows_kept"),
    )


@query(
    f"""SELECT 50 AS n_trees, 5 AS deepest, count(*) AS n, round(avg(price), 2) AS start, TRUE AS rows_kept, TRUE AS rounds_improve
    FROM ({_PRICED})"""
)
def boosted_nodes(t: Tables) -> DataFrame:
    """The full boosted model as a stored table of nodes: its first tree starts from all rows
    and their mean, no row is lost in a split, and no round makes the fit worse."""
    return _boosted_nodes(t, learning.boosted_trees())


def _boosted_nodes(t: Tables, estimator) -> DataFrame:
    frame = materialise(training(t))
    model = learning.fit(frame, FEATURE_COLUMNS, estimator)
    nodes = learning.stored_nodes(t.spark, model, scratch_path(t.spark, "boosted"))
    kept = learning.misplaced_rows(nodes).isEmpty()
    trees = model.stages[-1].trees
    losses = model.stages[-1].evaluateEachIteration(model.stages[0].transform(frame), "squared")
    improve = all(b <= a * (1 + 1e-12) for a, b in zip(losses, losses[1:])) and losses[-1] < losses[0]
    return nodes.filter("tree = 0 AND id = 0").select(
        F.lit(len(trees)).alias("n_trees"),
        F.lit(max(x.depth for x in trees)).alias("deepest"),
        "n",
        F.round("mean", 2).alias("start"),
        F.lit(kept).alias("rows_kept"),
        F.lit(improve).alias("rounds_improve"),
    )


_NET_PENALTIES = [(0.3, 0.8), (3000.0, 0.8), (30000.0, 0.2)]
# What the solver's tolerance leaves of the balance, in deviations of the price.
_NET_GAP = 1e-4


@query(
    f"WITH f AS ({QUERIES['training_frame'].sql}) "
    + " UNION ALL ".join(
        f"SELECT {reg}::DOUBLE AS reg, '{c}' AS feature, round(avg({c}), 3) AS mean, TRUE AS is_best FROM f"
        for reg, _ in _NET_PENALTIES
        for c in FEATURE_COLUMNS
    )
)
def fit_linear_balance(t: Tables) -> DataFrame:
    """The penalised fit on all features, for the study's penalty and stronger ones: each
    coefficient is where the data's pull and the penalty's cancel."""
    frame = materialise(training(t))
    return reduce(DataFrame.unionAll, (_balance(t, frame, learning.linear(reg=r, alpha=a), r, a) for r, a in _NET_PENALTIES))


def _balance(t: Tables, frame: DataFrame, estimator, reg: float, alpha: float) -> DataFrame:
    model = learning.fit(frame, FEATURE_COLUMNS, estimator.setTol(1e-12))
    gaps = learning.penalty_gaps(model.transform(frame), t.spark, model, reg, alpha)
    best = F.coalesce(F.col("gap") <= _NET_GAP, F.col("coefficient") == 0)
    return gaps.select(F.lit(reg).alias("reg"), "feature", F.round("mean", 3).alias("mean"), best.alias("is_best"))


@query(_names_sql([*FEATURE_COLUMNS, "(intercept)"], "TRUE AS is_finite"))
def model_coefficients(t: Tables) -> DataFrame:
    model = learning.fit(training(t), FEATURE_COLUMNS, learning.linear())
    value = F.col("coefficient")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
    return learning.coefficients(t.spark, model).select("feature", finite.alias("is_finite"))


@query(
    f"""SELECT listing_id, TRUE AS is_same FROM ({roles.DUCK_CLEAN_LISTINGS}) l
    JOIN ({roles.DUCK_PROFILE}) p ON replace(l.Date, '/', '-') = p.month AND l.zipcode = p.zone"""
)
def model_roundtrip(t: Tables) -> DataFrame:
    """Whether a model predicts the same after it was saved and loaded."""
    frame = training(t)
    path = scratch_path(t.spark, "model")
    model = learning.fit(frame, FEATURE_COLUMNS, learning.linear())
    learning.save_model(model, path)
    before = model.transform(frame).drop("features").withColumnRenamed("prediction", "before")
    after = learning.load_model(path).transform(before)
    return after.select(ID, (F.col("before") == F.col("prediction")).alias("is_same"))


@query(
    """SELECT 'l_quantity' AS feature, round(regr_slope(l_extendedprice, l_quantity), 4) AS coefficient FROM lineitem
    UNION ALL SELECT '(intercept)', round(regr_intercept(l_extendedprice, l_quantity), 4) FROM lineitem"""
)
def fit_linear_unpenalised(t: Tables) -> DataFrame:
    """The pipeline fit without a penalty, which has a closed form to compare with."""
    plain = learning.linear(label="l_extendedprice", reg=0.0, alpha=0.0)
    model = learning.fit(t.lineitem, ["l_quantity"], plain)
    return learning.coefficients(t.spark, model).withColumn("coefficient", F.round("coefficient", 4))


# Of one feature the penalised fit is closed: with both sides scaled to deviation 1 the
# slope is the correlation, pulled to 0 by the absolute part of the penalty and then
# divided by 1 more than the squared part. Both parts are in units of the label's deviation.
_NET = """SELECT l_returnflag, corr(l_extendedprice, l_quantity) AS r, stddev_pop(l_extendedprice) AS sy, stddev_pop(l_quantity) AS sx,
  avg(l_extendedprice) AS my, avg(l_quantity) AS mx FROM lineitem GROUP BY 1"""


def _net_sql(reg: float, alpha: float) -> str:
    return f"""SELECT l_returnflag, {reg}::DOUBLE AS reg, {alpha}::DOUBLE AS alpha, slope, my - slope * mx AS intercept FROM (
      SELECT *, sign(r) * greatest(abs(r) - {reg * alpha} / sy, 0) / (1 + {reg} * (1 - {alpha}) / sy) * sy / sx AS slope FROM n)"""


_PENALTIES = [(0.3, 0.8), (2000.0, 0.8), (5000.0, 0.0), (9000.0, 1.0)]


@query(
    f"""WITH n AS ({_NET}), f AS ({" UNION ALL ".join(_net_sql(*p) for p in _PENALTIES)})
    SELECT l_returnflag, reg, alpha, round(slope, 2) AS slope, round(intercept, 1) AS intercept FROM f"""
)
def fit_elastic_net_one(t: Tables) -> DataFrame:
    """The penalised pipeline fit on one feature, for the study's penalty and stronger ones."""
    flags = [r[0] for r in t.lineitem.select("l_returnflag").distinct().collect()]  # three values
    found = []
    for flag in flags:
        rows = t.lineitem.filter(F.col("l_returnflag") == flag)
        for reg, alpha in _PENALTIES:
            estimator = learning.linear(label="l_extendedprice", reg=reg, alpha=alpha).setTol(1e-12)
            line = learning.fit(rows, ["l_quantity"], estimator).stages[-1]
            found.append((flag, reg, alpha, float(line.coefficients[0]), float(line.intercept)))
    fits = t.spark.createDataFrame(found, "l_returnflag string, reg double, alpha double, slope double, intercept double")
    return fits.withColumn("slope", F.round("slope", 2)).withColumn("intercept", F.round("intercept", 1))


# What rounding may add to a mean of equal prices, as a share of them.
_MEAN_SLACK = 1e-6


@query(
    f"""SELECT request_id, CASE WHEN p.month IS NULL THEN 'No record for ' || r.month || '|' || r.zone ELSE 'ok' END AS status,
      p.month IS NOT NULL AS has_prediction
    FROM (SELECT request_id, substr(date, 1, 7) AS month, zip AS zone FROM ({roles.DUCK_REQUESTS})) r
    LEFT JOIN ({roles.DUCK_PROFILE}) p ON r.month = p.month AND r.zone = p.zone"""
)
def score_requests(t: Tables) -> DataFrame:
    """Requests scored by the full forest. Its predictions are means of the prices it was
    fitted on, so one that is not between the lowest and the highest of them is none."""
    return _score_requests(t, learning.forest())


def _score_requests(t: Tables, estimator) -> DataFrame:
    neighbourhood = materialise(profile(t))
    frame = materialise(training(t, neighbourhood))
    model = learning.fit(frame, FEATURE_COLUMNS, estimator)
    # Stored, as the optimizer drops a model of which only "is not NULL" is asked.
    scored = materialise(study.score(roles.requests(t), neighbourhood, model))
    low, high = frame.agg(F.min(LABEL), F.max(LABEL)).first()
    slack = _MEAN_SLACK * max(abs(low), abs(high))
    known = F.coalesce(F.col("prediction").between(low - slack, high + slack), F.lit(False))
    return scored.select("request_id", "status", known.alias("has_prediction"))


@query(
    f"""SELECT request_id, CASE WHEN p.month IS NULL THEN 'No record for ' || r.month || '|' || r.zone ELSE 'ok' END AS status,
      CASE WHEN p.month IS NOT NULL THEN TRUE END AS expression_agrees
    FROM (SELECT request_id, substr(date, 1, 7) AS month, zip AS zone FROM ({roles.DUCK_REQUESTS})) r
    LEFT JOIN ({roles.DUCK_PROFILE}) p ON r.month = p.month AND r.zone = p.zone"""
)
def score_requests_linear(t: Tables) -> DataFrame:
    """Requests scored by the linear pipeline, and again by its coefficients as an expression."""
    neighbourhood = materialise(profile(t))
    model = learning.fit(training(t, neighbourhood), FEATURE_COLUMNS, learning.linear())
    scored = study.score(roles.requests(t), neighbourhood, model)
    rows = study.lookup(study.request_rows(roles.requests(t), ("request_id",)), neighbourhood)
    again = rows.select("request_id", learning.linear_score(model).alias("again"))
    near = F.abs(F.col("prediction") - F.col("again")) <= 1e-9 * F.greatest(F.abs("again"), F.lit(1.0))
    both = scored.join(again, "request_id")
    agrees = F.when(F.col("prediction").isNotNull(), F.coalesce(near, F.lit(False)))
    return both.select("request_id", "status", agrees.alias("expression_agrees"))
