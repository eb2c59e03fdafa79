"""Joins of facts with per-key aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.months import shift_month
# A key with more than one in so many of the rows is hot; so there are fewer hot keys than this.
HOT_SHARE = 200


def attach(facts: DataFrame, per_key: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join facts, many per key, with an aggregate that has one row per key.

    No hint: the planner broadcasts the aggregate while its measured size is under the
    session's threshold, and else the runtime splits skewed partitions of the facts.
    """
    return facts.join(per_key, keys, how)


def hot_keys(facts: DataFrame, keys: list[str], share: int = HOT_SHARE) -> DataFrame:
    """(keys, ``_salts``) of the keys with more than one in ``share`` of the rows: as many
    salts as the key has such shares, so that each salt is about one share."""
    total = facts.count()
    counts = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") * share > total)
    return counts.select(*keys, F.ceil(F.col("_n") * share / F.lit(max(total, 1))).cast("int").alias("_salts"))


def salted_join(
    facts: DataFrame, per_key: DataFrame, keys: list[str], spread_by: list[str], how: str = "inner", share: int = HOT_SHARE
) -> DataFrame:
    """``attach`` for sessions without runtime re-planning: the measured hot keys of
    ``facts`` are spread over tasks, and only their rows of ``per_key`` are copied.

    The salt is a hash of row values and the number of the task that reads them: copies
    of one row are spread too, and a recomputed task gives the same salts.
    """
    hot = F.broadcast(hot_keys(facts, keys, share))  # fewer than ``share`` rows
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    spread = F.xxhash64(*spread_by, F.spark_partition_id())
    salted = facts.join(hot, keys, "left").withColumn("_salt", F.pmod(spread, salts).cast("int")).drop("_salts")
    copies = per_key.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def shifted(df: DataFrame, k: int, month: str = "month") -> DataFrame:
    """The same rows under a month key moved by k (k < 0 moves it back)."""
    return df.withColumn(month, shift_month(month, k))


def shifted_all(df: DataFrame, shifts: list[int], month: str = "month", name: str = "shift") -> DataFrame:
    """Every row once per shift, under the moved key; ``name`` tells the shift."""
    each = df.withColumn(name, F.explode(F.array(*(F.lit(k) for k in shifts))))
    return each.withColumn(month, shift_month(month, F.col(name)))


def combine(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Inner join of aggregates on their common keys. Each has one row per key and is
    already partitioned by the keys, so the join adds no shuffle of its own."""
    return reduce(lambda a, b: a.join(b, keys), frames)


def absent_keys(requests: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct requested keys that ``known`` has no row for."""
    return requests.select(*keys).distinct().join(known.select(*keys), keys, "left_anti")
