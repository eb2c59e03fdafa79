"""Places of rows in the order of their group, without a task that holds a group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

#: Rows to a range of the sort.
RANGE_ROWS = 50_000


def ranked(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0, in ``order``, NULLs first) and ``total`` of their group.

    ``rows`` should be a stored table, as it is read twice. They are dealt by range over
    group and order, so a group of any size spreads over many tasks; each range stores its
    rows with their places, and only the counts of (group, range) meet in a window. NULL is
    a group like any other. Ties stand in either order, but in one range: end ``order``
    with a column that tells rows apart.
    """
    spark = rows.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, rows.count() // RANGE_ROWS + 1)
    by = [*group, *order]
    dealt = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    placed = materialise(dealt.withColumn("_at", F.monotonically_increasing_id()))
    ranges = placed.groupBy(*group, F.shiftright("_at", 33).alias("_range")).agg(F.min("_at").alias("_low"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(
        *(F.col(g).alias(f"_of_{g}") for g in group),
        F.col("_range").alias("_in"),
        "_low",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("total"),
    )
    same = [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in group]
    found = placed.join(starts, reduce(lambda a, b: a & b, same, F.shiftright("_at", 33) == F.col("_in")))
    return found.select(*rows.columns, (F.col("_before") + F.col("_at") - F.col("_low")).alias("rank"), "total")
