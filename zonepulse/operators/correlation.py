"""Correlation of a fact value with per-key signals, for any number of month shifts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_col
from ..session import materialise
from .joins import shifted_all


def pearson(a: Column | str, b: Column | str) -> Column:
    """Pearson correlation as an aggregate; NULL, not an error, on a constant side."""
    a, b = as_col(a), as_col(b)
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def key_moments(facts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Count, mean, squared deviation and range of a value per key.

    These stand for all facts of the key in a correlation with anything that is
    constant within the key, so the facts need not go through the join.
    """
    v = F.col(value)
    return (
        facts.filter(v.isNotNull())
        .groupBy(*keys)
        .agg(
            F.count(v).alias("n"),
            F.avg(v).alias("mean"),
            (F.var_pop(v) * F.count(v)).alias("spread"),
            F.min(v).alias("low"),
            F.max(v).alias("high"),
        )
    )


def merge_moments(parts: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key from rows of ``key_moments`` that were taken of disjoint facts.

    Two sets of facts have the moments of their union: counts add up, the mean is the
    weighted one, and the squared deviations add up with that of the two means. A key's rows
    are merged two at a time, in an order that does not depend on how they came in. A key has at most one row per part that was fed.
    """
    rows = F.array_sort(F.collect_list(F.struct("n", "mean", "spread")))

    def merge(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        off = b["mean"] - a["mean"]
        share = b["n"] / n
        spread = a["spread"] + b["spread"] + off * off * a["n"] * share
        return F.struct(n.alias("n"), (a["mean"] + off * share).alias("mean"), spread.alias("spread"))

    first = F.element_at("_rows", 1)
    folded = F.aggregate(F.slice("_rows", 2, F.size("_rows")), first, merge)
    grouped = parts.groupBy(*keys).agg(rows.alias("_rows"), F.min("low").alias("low"), F.max("high").alias("high"))
    return grouped.withColumn("_all", folded).select(*keys, "_all.n", "_all.mean", "_all.spread", "low", "high")


def correlate_by_shift(
    facts: DataFrame,
    signals: DataFrame,
    shifts: list[int],
    value: str,
    signal_columns: list[str],
    month: str = "month",
    zone: str = "zone",
    place: int = 6,
) -> DataFrame:
    """One row per shift k: the correlation, at fact grain, of ``value`` with every
    signal whose month was moved by k.

    Both inputs are reduced to one row per (month, zone) first. The joined key-level
    frame is stored once; the weighted means of each shift are taken from it and then
    the centred products, which keeps full precision. ``n`` counts the facts of all
    matched keys, ``n_<signal>`` those whose key has the signal; a NULL signal takes its
    facts out of its own correlation only. Shifts without a common key give no row.
    """
    return correlate_moments(key_moments(facts, [month, zone], value), signals, shifts, signal_columns, month, zone, place)


def correlate_moments(
    moments: DataFrame, signals: DataFrame, shifts: list[int], signal_columns: list[str], month: str = "month", zone: str = "zone", place: int = 6
) -> DataFrame:
    """``correlate_by_shift`` from the facts' moments, one row per (month, zone)."""
    moved = shifted_all(signals.select(month, zone, *signal_columns), shifts, month)
    matched = materialise(moved.join(moments, [month, zone]).drop(month, zone))
    weight = {s: F.when(F.col(s).isNotNull(), F.col("n")) for s in signal_columns}
    centres = matched.groupBy("shift").agg(
        *((F.sum(w * F.col("mean")) / F.sum(w)).alias(f"level_{s}") for s, w in weight.items()),
        *((F.sum(w * F.col(s)) / F.sum(w)).alias(f"centre_{s}") for s, w in weight.items()),
    )
    # One row per requested shift, so the broadcast is bounded by the argument.
    centred = matched.join(F.broadcast(centres), "shift")
    return centred.groupBy("shift").agg(
        F.sum("n").alias("n"),
        *(F.coalesce(F.sum(w), F.lit(0)).alias(f"n_{s}") for s, w in weight.items()),
        *(_weighted(w, s, place) for s, w in weight.items()),
    )


def _weighted(weight: Column, signal: str, place: int) -> Column:
    """The correlation with one signal over the keys that have it."""
    here = lambda c: F.when(F.col(signal).isNotNull(), c)
    off = F.col("mean") - F.col(f"level_{signal}")
    away = F.col(signal) - F.col(f"centre_{signal}")
    total = F.sum(here(F.col("spread")) + weight * off * off)
    scale = F.sqrt(total) * F.sqrt(F.sum(weight * away * away))
    varies = (F.min(signal) < F.max(signal)) & (F.min(here(F.col("low"))) < F.max(here(F.col("high"))))
    ratio = F.try_divide(F.sum(weight * off * away), scale)
    return F.when(varies, F.round(ratio, place)).alias(f"corr_{signal}")
