"""Robust multivariate outliers among documents, in DataFrame expressions only.

Per language and source the minimum-covariance-determinant estimate is sought: the
subset of ``H_SHARE`` of the rows whose covariance has the smallest determinant. From two
starts, quartiles per dimension and moments of all rows, concentration steps keep the
rows nearest by Mahalanobis distance and estimate again; the start that ends with the
smaller determinant wins, and one reweighting step follows. Documents beyond a chi-square
quantile of the distance are rejected.

Statistics are whole numbers (units of 1/``UNIT``), sums of them and of their products are
exact decimals, and the rows nearest are found by counting distances in narrow bins, so
the estimates do not depend on the order of rows, and a group of any size is only ever
aggregated, never gathered. Groups under ``LEAST_ROWS`` rows are pooled per language, then
over all; if the pool is too small as well, nothing in it is rejected.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.shaping import derive
from ..session import materialise
from .text import words

UNIT = 1024
H_SHARE = 0.75
STEPS = 3
LEAST_ROWS = 50
#: Chance that a clean document of normal statistics lies beyond the limit.
TAIL = 1e-6
#: The statistics after their transformation, and the deviation each is granted where the
#: real one is smaller: most texts have no symbol or repeated line at all, and a few of them
#: make no outlier. Repeated words count in percent of the words, the others in logarithms.
FLOORS = {"word_length": 0.05, "symbols": 0.7, "repeated_lines": 1.0, "repeated_words": 7.0, "length": 0.5}
DIMS = list(FLOORS)
GROUPS_PER_FILE = 10_000
_BINS = 16  # per doubling of the squared distance


def chi2_cdf(x: float, p: int) -> float:
    """Series of the lower incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, x = p / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > total * 1e-16:
        n += 1
        term *= x / (a + n)
        total += term
    return total * math.exp(a * math.log(x) - x - math.lgamma(a))


def chi2_quantile(q: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, p) < q else (low, mid)
    return high


def consistency(q: float, p: int) -> float:
    """What the covariance of the inner share q of a normal sample is too small by."""
    return q / chi2_cdf(chi2_quantile(q, p), p + 2)


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words).

    Words in 3-word windows that occur twice are found by sorting a text's windows by
    hash, with their places; equal neighbours mark both places.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    start = docs.select(F.col(id_col).alias("id"), F.col("lang"), F.col("source"), text.alias("text"))
    split = derive(start, {"w": words(F.col("text")), "lines": F.split("text", "\n"), "bare": F.regexp_replace("text", r"[#*$%&|<>]+", "")})
    full = F.filter("lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    places = F.when(F.size("w") >= 3, F.sequence(F.lit(0), F.size("w") - 3)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(places, lambda i: F.struct(F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("i")))
    counted = split.select(
        "id",
        "lang",
        "source",
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length("bare")).cast("long").alias("n_symbols"),
        full.alias("full"),
        windows.alias("windows"),
    )
    sorted_ = derive(counted, {"full": F.col("full"), "sorted": F.array_sort("windows")}, ["id", "lang", "source", "n_words", "word_chars", "n_symbols"])
    twice = F.filter("sorted", lambda x, k: F.coalesce(x["h"] == F.get("sorted", k - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get("sorted", k + 1)["h"], F.lit(False)))
    covered = F.aggregate(
        F.array_sort(F.transform(twice, lambda x: x["i"])),
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
    )["n"]
    return sorted_.select(
        "id",
        "lang",
        "source",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _transformed() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    values = {
        "word_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        "symbols": F.log1p(1000 * F.col("n_symbols") / n),
        "repeated_lines": F.log1p(1000 * F.col("n_dup_lines") / n),
        "repeated_words": 100 * F.col("n_repeat_words") / n,
        "length": F.log(n),
    }
    return {d: F.round(values[d] * UNIT).cast("long") for d in DIMS}


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with the ``key`` of the group that judges them; NULL if that is too small."""
    own = F.to_json(F.struct("lang", "source"))
    rows = rows.withColumn("_own", own).withColumn("_lang", F.to_json(F.struct("lang")))
    sizes = rows.groupBy("_own", "_lang").agg(F.count(F.lit(1)).alias("_n"))
    rest = F.when(F.col("_n") < LEAST_ROWS, F.col("_n")).otherwise(0)
    in_lang, in_all = Window.partitionBy("_lang"), Window.partitionBy()
    sizes = sizes.withColumn("_rest", F.sum(rest).over(in_lang))
    alone = F.when((F.col("_n") < LEAST_ROWS) & (F.col("_rest") < LEAST_ROWS), F.col("_n")).otherwise(0)
    sizes = sizes.withColumn("_all", F.sum(alone).over(in_all))
    key = (
        F.when(F.col("_n") >= LEAST_ROWS, F.concat(F.lit("group "), "_own"))
        .when(F.col("_rest") >= LEAST_ROWS, F.concat(F.lit("language "), "_lang"))
        .when(F.col("_all") >= LEAST_ROWS, F.lit("all"))
    )
    return rows.join(sizes.select("_own", key.alias("key")), "_own").drop("_own", "_lang")


def _moments(rows: DataFrame, by: list[str], factor: float) -> DataFrame:
    """Means m_d and covariances c_d_e of each group, no variance under its floor: a raised
    diagonal leaves the matrix positive definite."""
    whole = lambda c: F.sum(c.cast("decimal(20,0)"))
    sums = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *(whole(F.col(d)).alias(f"s_{d}") for d in DIMS),
        *(whole(F.col(d) * F.col(e)).alias(f"p_{d}_{e}") for i, d in enumerate(DIMS) for e in DIMS[: i + 1]),
    )
    n = F.col("n").cast("double")
    mean = {d: F.col(f"s_{d}").cast("double") / n for d in DIMS}
    out = [mean[d].alias(f"m_{d}") for d in DIMS]
    for i, d in enumerate(DIMS):
        for e in DIMS[: i + 1]:
            value = (F.col(f"p_{d}_{e}").cast("double") / n - mean[d] * mean[e]) * factor
            if d == e:
                value = F.greatest(value, F.lit((FLOORS[d] * UNIT) ** 2))
            out.append(value.alias(f"c_{d}_{e}"))
    return sums.select(*by, "n", *out)


def _factored(params: DataFrame) -> DataFrame:
    """Adds the Cholesky factor l_d_e of each covariance, column by column."""
    for j, e in enumerate(DIMS):
        inner = [F.col(f"l_{e}_{x}") * F.col(f"l_{e}_{x}") for x in DIMS[:j]]
        left = reduce(lambda a, b: a - b, inner, F.col(f"c_{e}_{e}"))
        params = params.withColumn(f"l_{e}_{e}", F.sqrt(F.greatest(left, F.lit(1e-6))))
        below = {}
        for d in DIMS[j + 1 :]:
            inner = [F.col(f"l_{d}_{x}") * F.col(f"l_{e}_{x}") for x in DIMS[:j]]
            below[f"l_{d}_{e}"] = reduce(lambda a, b: a - b, inner, F.col(f"c_{d}_{e}")) / F.col(f"l_{e}_{e}")
        params = params.withColumns(below)
    return params


def _stored(params: DataFrame, by: list[str], groups: int) -> DataFrame:
    kept = [*by, *(f"m_{d}" for d in DIMS), *(f"l_{d}_{e}" for i, d in enumerate(DIMS) for e in DIMS[: i + 1])]
    return materialise(_factored(params).select(*kept), files=1 + groups // GROUPS_PER_FILE)


def _distances(rows: DataFrame, params: DataFrame, by: list[str]) -> DataFrame:
    """Rows with ``d2``, the squared Mahalanobis distance by forward substitution."""
    out = rows.join(params, by)
    for i, d in enumerate(DIMS):
        steps = [F.col(f"l_{d}_{x}") * F.col(f"_y_{x}") for x in DIMS[:i]]
        out = out.withColumn(f"_y_{d}", reduce(lambda a, b: a - b, steps, F.col(d) - F.col(f"m_{d}")) / F.col(f"l_{d}_{d}"))
    d2 = reduce(lambda a, b: a + b, (F.col(f"_y_{d}") * F.col(f"_y_{d}") for d in DIMS))
    return out.select(*rows.columns, d2.alias("d2"))


def _quartile_start(rows: DataFrame) -> DataFrame:
    """Medians and spreads between quartiles as a diagonal estimate."""
    long = rows.select("key", F.explode(F.array(*(F.struct(F.lit(d).alias("dim"), F.col(d).alias("v")) for d in DIMS))).alias("x")).select("key", "x.*")
    counts = long.groupBy("key", "dim", "v").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("key", "dim")
    counts = counts.withColumn("until", F.sum("n").over(group.orderBy("v"))).withColumn("all", F.sum("n").over(group))
    at = lambda q: F.min(F.when(F.col("until") >= F.col("all") * q, F.col("v")))
    found = counts.groupBy("key", "dim").agg(at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"))
    pick = lambda d, c: F.max(F.when(F.col("dim") == d, F.col(c))).cast("double")
    wide = found.groupBy("key").agg(
        *(pick(d, "q2").alias(f"m_{d}") for d in DIMS),
        *(((pick(d, "q3") - pick(d, "q1")) / 1.349).alias(f"r_{d}") for d in DIMS),
    )
    cov = [
        (F.greatest(F.col(f"r_{d}") * F.col(f"r_{d}"), F.lit((FLOORS[d] * UNIT) ** 2)) if d == e else F.lit(0.0)).alias(f"c_{d}_{e}")
        for i, d in enumerate(DIMS)
        for e in DIMS[: i + 1]
    ]
    return wide.select("key", *(f"m_{d}" for d in DIMS), *cov)


def robust_estimates(rows: DataFrame) -> DataFrame:
    """Mean and Cholesky factor per ``key`` of rows (key, statistics as whole numbers)."""
    by = ["key", "start"]
    p = len(DIMS)
    groups = rows.select("key").distinct().count()
    classic = _moments(rows, ["key"], 1.0).drop("n").withColumn("start", F.lit(1))
    params = _stored(_quartile_start(rows).withColumn("start", F.lit(0)).unionByName(classic), by, groups)
    twice = rows.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    factor = consistency(H_SHARE, p)
    for _ in range(STEPS):
        near = _distances(twice, params, by).withColumn("_bin", F.floor(F.log2(F.col("d2") + 1e-3) * _BINS))
        bins = near.groupBy(*by, "_bin").agg(F.count(F.lit(1)).alias("_n"))
        group = Window.partitionBy(*by)
        bins = bins.withColumn("_until", F.sum("_n").over(group.orderBy("_bin"))).withColumn("_all", F.sum("_n").over(group))
        cuts = bins.filter(F.col("_until") >= F.ceil(F.col("_all") * H_SHARE)).groupBy(*by).agg(F.min("_bin").alias("_cut"))
        subset = near.join(cuts, by).filter("_bin <= _cut")
        params = _stored(_moments(subset, by, factor), by, groups)
    size = reduce(lambda a, b: a + b, (F.log(f"l_{d}_{d}") for d in DIMS))
    best = params.withColumn("_det", size).groupBy("key").agg(F.min_by("start", F.struct("_det", "start")).alias("start"))
    chosen = params.join(best, by).drop("start")
    inner = 0.975
    close = _distances(rows, chosen, ["key"]).filter(F.col("d2") <= chi2_quantile(inner, p))
    return _stored(_moments(close, ["key"], consistency(inner, p)), ["key"], groups)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tail: float = TAIL) -> DataFrame:
    """Per document (id, counts, base_failed, d2, kept).

    ``docs`` has lang and source, either may be NULL: NULL is a value like any other here.
    NULL and empty texts have zero counts and fail the base rule. ``d2`` is NULL where the
    base rule failed or no group was large enough; the latter are kept. Rows repeated
    under one id are judged one by one and come back as often; other columns are ignored.
    An empty table gives no rows.
    """
    stats = materialise(text_statistics(docs, id_col, text_col).withColumn("base_failed", base_failed()))
    good = stats.filter("NOT base_failed")
    vectors = materialise(_keyed(good.withColumns(_transformed())))
    judged = vectors.filter("key IS NOT NULL").select("key", *DIMS)
    estimates = robust_estimates(judged)
    limit = chi2_quantile(1 - tail, len(DIMS))
    far = _distances(vectors.filter("key IS NOT NULL"), estimates, ["key"])
    rest = vectors.filter("key IS NULL").withColumn("d2", F.lit(None).cast("double"))
    failed = stats.filter("base_failed").withColumn("d2", F.lit(None).cast("double"))
    columns = ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "d2"]
    every = far.select(*columns).unionByName(rest.select(*columns)).unionByName(failed.select(*columns))
    kept = ~F.col("base_failed") & (F.col("d2").isNull() | (F.col("d2") <= limit))
    return every.withColumn("kept", kept).withColumnRenamed("id", id_col)
