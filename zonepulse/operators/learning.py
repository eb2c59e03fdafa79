"""Split, fit, evaluate and score with Spark's regression pipelines."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import LABEL
from ..session import materialise, shared_folder

BUCKETS = 10


def hash_bucket(key: Column | str, buckets: int = BUCKETS) -> Column:
    """A bucket that depends on the key alone: the same row falls on the same side
    whatever the partitioning, and other engines can repeat it."""
    key = F.col(key) if isinstance(key, str) else key
    head = F.substring(F.md5(key.cast("string")), 1, 4)
    return (F.conv(head, 16, 10).cast("int") % buckets).cast("int")


def with_split(df: DataFrame, key: str, train_buckets: int = 9) -> DataFrame:
    """``bucket`` and ``is_train`` beside each row, in one pass."""
    return df.withColumn("bucket", hash_bucket(key)).withColumn("is_train", F.col("bucket") < train_buckets)


def split_by_hash(df: DataFrame, key: str, train_buckets: int = 9) -> tuple[DataFrame, DataFrame]:
    """90 % to train and 10 % to test, by key."""
    bucket = hash_bucket(key)
    return df.filter(bucket < train_buckets), df.filter(bucket >= train_buckets)


def feature_columns(df: DataFrame, label: str = LABEL, leave_out: tuple[str, ...] = ()) -> list[str]:
    """All columns but the label, by name."""
    return [c for c in df.columns if c != label and c not in leave_out]


def assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features")


def linear(label: str = LABEL, max_iter: int = 100, reg: float = 0.3, alpha: float = 0.8) -> LinearRegression:
    """Elastic-net linear regression."""
    return LinearRegression(
        featuresCol="features", labelCol=label, maxIter=max_iter, regParam=reg, elasticNetParam=alpha
    )


def boosted_trees(
    label: str = LABEL, max_iter: int = 50, seed: int = 12345, memory_mb: int = 1024
) -> GBTRegressor:
    return GBTRegressor(
        featuresCol="features", labelCol=label, maxIter=max_iter, seed=seed, maxMemoryInMB=memory_mb
    )


def forest(
    label: str = LABEL, depth: int = 20, trees: int = 10, seed: int = 12345, memory_mb: int = 256
) -> RandomForestRegressor:
    """``memory_mb`` bounds the node statistics of one pass: with more of it, a deep
    forest on much data needs fewer passes over the rows. Every task holds as much at a
    time, beside the kept rows: cores times ``memory_mb`` must leave room in an executor.
    Each row's place in each tree is kept with the row, so that no pass sends out trees."""
    return RandomForestRegressor(
        featuresCol="features",
        labelCol=label,
        maxDepth=depth,
        numTrees=trees,
        seed=seed,
        maxMemoryInMB=memory_mb,
        cacheNodeIds=True,
    )


def fit(train: DataFrame, features: list[str], estimator: Estimator, keep: bool = True) -> PipelineModel:
    """Fit assembler and estimator. The needed columns are kept for the time of the
    fit, which reads them several times; ``keep=False`` when they already are."""
    pipeline = Pipeline(stages=[assembler(features), estimator])
    if not keep:
        return pipeline.fit(_dealt(train, estimator))
    rows = train.select(*features, estimator.getLabelCol()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return pipeline.fit(_dealt(rows, estimator))
    finally:
        rows.unpersist()


def _dealt(rows: DataFrame, estimator: Estimator) -> DataFrame:
    """For trees that keep each row's place: no more partitions than tasks run at a time,
    as each sends the statistics of all open nodes in every pass. The places build on
    those of the pass before, which is cut in the shared folder."""
    if not (estimator.hasParam("cacheNodeIds") and estimator.getCacheNodeIds()):
        return rows
    shared_folder(rows.sparkSession)
    return rows.coalesce(rows.sparkSession.sparkContext.defaultParallelism)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def metrics(predictions: DataFrame, label: str = LABEL, prediction: str = "prediction", place: int = 6) -> DataFrame:
    """(n, rmse, mae) in one aggregation."""
    error = F.col(prediction) - F.col(label)
    return predictions.agg(
        F.count(error).alias("n"),
        F.round(F.sqrt(F.avg(error * error)), place).alias("rmse"),
        F.round(F.avg(F.abs(error)), place).alias("mae"),
    )


def compare(
    df: DataFrame, key: str, estimators: dict[str, Estimator], label: str = LABEL, leave_out: tuple[str, ...] = ()
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit each estimator on one split and report (model, n, rmse, mae) on the rest.

    The frame is evaluated once and kept for the time of the fits, which pass over it
    many times. The report, one row per model, is stored before it is let go.
    """
    features = feature_columns(df, label, (key, *leave_out))
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train, test = split_by_hash(kept, key)
        models = {name: fit(train, features, e, keep=False) for name, e in estimators.items()}
        return materialise(_held_out_errors(test, models, label)), models
    finally:
        kept.unpersist()


def _held_out_errors(test: DataFrame, models: dict[str, PipelineModel], label: str) -> DataFrame:
    """Every model's errors from one pass over the test rows."""
    scored = test
    for name, model in models.items():
        scored = model.transform(scored).drop("features").withColumnRenamed("prediction", f"prediction_{name}")
    stats = []
    for name in models:
        error = F.col(f"prediction_{name}") - F.col(label)
        stats += [
            F.count(error).alias(f"n_{name}"),
            F.sqrt(F.avg(error * error)).alias(f"rmse_{name}"),
            F.avg(F.abs(error)).alias(f"mae_{name}"),
        ]
    rows = [
        F.struct(
            F.lit(name).alias("model"),
            F.col(f"n_{name}").alias("n"),
            F.col(f"rmse_{name}").alias("rmse"),
            F.col(f"mae_{name}").alias("mae"),
        )
        for name in models
    ]
    return scored.agg(*stats).select(F.inline(F.array(*rows)))


def importances(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(feature, importance) of a tree model, one row per feature."""
    names = model.stages[0].getInputCols()
    values = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame(
        [(n, float(v)) for n, v in zip(names, values)], "feature string, importance double"
    )


def coefficients(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(feature, coefficient) of a linear model and its intercept."""
    names = model.stages[0].getInputCols()
    fitted = model.stages[-1]
    rows = [(n, float(v)) for n, v in zip(names, fitted.coefficients.toArray())]
    return spark.createDataFrame(
        [*rows, ("(intercept)", float(fitted.intercept))], "feature string, coefficient double"
    )


def penalty_gaps(
    scored: DataFrame, spark: SparkSession, model: PipelineModel, reg: float, alpha: float, label: str = LABEL
) -> DataFrame:
    """(feature, coefficient, mean, gap): how far each coefficient of an elastic-net fit is
    from the best one, given the rows it was fitted on with their predictions.

    At the best fit the residual's covariance with each feature, both sides scaled to
    deviation 1, is balanced by the penalty's slope. ``gap`` is what is left of the
    balance, in deviations of the label; NULL for a constant feature. One aggregation.
    """
    names = model.stages[0].getInputCols()
    residual = F.col(label) - F.col("prediction")
    found = scored.agg(
        F.stddev_pop(label).alias("sy"),
        *(
            fn.alias(f"{name}_{i}")
            for i, c in enumerate(names)
            for name, fn in (("cov", F.covar_pop(F.col(c), residual)), ("sd", F.stddev_pop(c)), ("mean", F.avg(c)))
        ),
    )
    each = [
        F.struct(
            F.lit(c).alias("feature"),
            "sy",
            F.col(f"cov_{i}").alias("cov"),
            F.col(f"sd_{i}").alias("sd"),
            F.col(f"mean_{i}").alias("mean"),
        )
        for i, c in enumerate(names)
    ]
    rows = found.select(F.inline(F.array(*each))).join(coefficients(spark, model), "feature")
    w, sd = F.col("coefficient"), F.when(F.col("sd") > 0, F.col("sd"))
    slope = -F.col("cov") / sd + reg * (1 - alpha) * w * sd / F.col("sy")
    gap = F.when(w == 0, F.greatest(F.abs(slope) - reg * alpha, F.lit(0.0))).otherwise(F.abs(slope + reg * alpha * F.signum(w)))
    return rows.select("feature", "coefficient", "mean", (gap / F.col("sy")).alias("gap"))


def linear_score(model: PipelineModel) -> Column:
    """The prediction of a linear pipeline as a plain expression over its input columns."""
    fitted = model.stages[-1]
    terms = zip(model.stages[0].getInputCols(), fitted.coefficients.toArray(), strict=True)
    return sum((F.col(c) * F.lit(float(w)) for c, w in terms), F.lit(float(fitted.intercept)))


def stored_nodes(spark: SparkSession, model: PipelineModel, path: str, at_once: int = 100_000) -> DataFrame:
    """The tree model of a pipeline, saved under ``path`` and read back as a table of nodes:
    (tree, id, left, right, feature, gain, weight, n, mean). Leaves have ``left`` -1;
    ``weight`` is the weighted, ``n`` the plain number of rows that reached the node.

    Saving holds the rows of what it saves on the driver, so a model of more than
    ``at_once`` nodes is saved tree by tree."""
    fitted = model.stages[-1]
    names = F.array(*(F.lit(c) for c in model.stages[0].getInputCols()))
    if fitted.totalNumNodes <= at_once:
        fitted.write().save(path)
        saved = spark.read.parquet(f"{path}/data").select("treeID", "nodeData")
    else:
        parts = []
        for i, tree in enumerate(fitted.trees):
            tree.write().save(f"{path}/{i}")
            parts.append(spark.read.parquet(f"{path}/{i}/data").select(F.lit(i).alias("treeID"), F.struct("*").alias("nodeData")))
        saved = reduce(DataFrame.unionAll, parts)
    node = F.col("nodeData")
    split = node["split"]["featureIndex"]
    return saved.select(
        F.col("treeID").alias("tree"),
        node["id"].alias("id"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        F.when(node["leftChild"] >= 0, F.get(names, split)).alias("feature"),
        node["gain"].alias("gain"),
        node["impurityStats"][0].alias("weight"),
        node["rawCount"].alias("n"),
        (node["impurityStats"][1] / node["impurityStats"][0]).alias("mean"),
    )


def importances_from_nodes(nodes: DataFrame) -> DataFrame:
    """(feature, importance) of the features a forest splits on: the weighted gain of their
    splits as shares of each tree's, averaged over the trees that split at all."""
    gains = nodes.filter("left >= 0").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("g"))
    shares = gains.withColumn("share", F.col("g") / F.sum("g").over(Window.partitionBy("tree")))
    sums = shares.groupBy("feature").agg(F.sum("share").alias("s"))
    # The shares of a tree sum to 1, and there is one row per feature.
    return sums.select("feature", (F.col("s") / F.sum("s").over(Window.partitionBy())).alias("importance"))


def misplaced_rows(nodes: DataFrame) -> DataFrame:
    """Splits whose two sides do not hold the rows of the split: none in a sound model."""
    child = nodes.select("tree", F.col("id").alias("child"), F.col("n").alias("m"))
    sides = nodes.filter("left >= 0").select("tree", "id", "n", F.explode(F.array("left", "right")).alias("child"))
    sums = sides.join(child, ["tree", "child"]).groupBy("tree", "id", "n").agg(F.sum("m").alias("m"), F.count(F.lit(1)).alias("k"))
    return sums.filter("m <> n OR k <> 2")


def scale_min_max(df: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns scaled to 0..1: one assembler and one scaler for all."""
    pipeline = Pipeline(stages=[assembler(columns), MinMaxScaler(inputCol="features", outputCol="scaled")])
    cells = vector_to_array("scaled")
    scaled = pipeline.fit(df.select(*columns)).transform(df)
    kept = [c for c in df.columns if c not in columns]
    return scaled.select(*kept, *(cells[i].alias(c) for i, c in enumerate(columns)))


def least_squares(df: DataFrame, x: str, y: str, by: list[str] | None = None, place: int = 6) -> DataFrame:
    """Slope, intercept and count of the line through (x, y), per group."""
    grouped = df.groupBy(*by) if by else df
    return grouped.agg(
        F.regr_count(F.col(y), F.col(x)).alias("n"),
        F.round(F.regr_slope(F.col(y), F.col(x)), place).alias("slope"),
        F.round(F.regr_intercept(F.col(y), F.col(x)), place).alias("intercept"),
    )
