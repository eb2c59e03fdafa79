"""Group statistics. All are algebraic, so Spark combines them before the shuffle
and a group that holds a large share of the rows arrives as one row per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_col
from ..schemas import COMPLAINT_SLOTS, COMPLAINT_TOTAL


def unit_price(price: Column | str, area: Column | str) -> Column:
    """Price per unit of area; NULL when there is no area."""
    area = as_col(area)
    return F.try_divide(as_col(price), F.when(area > 0, area))


def mean_by(df: DataFrame, keys: list[str], value: Column | str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(as_col(value)).alias(name))


def category_counts(
    df: DataFrame,
    keys: list[str],
    category: str = "type",
    slots: dict[str, str] = COMPLAINT_SLOTS,
    total: str = COMPLAINT_TOTAL,
) -> DataFrame:
    """Rows per key in all and per known category; unknown ones count in the total."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(total),
        *(F.count_if(F.col(category) == v).alias(name) for name, v in slots.items()),
    )


def category_pivot(df: DataFrame, keys: list[str], category: str, values: list[str]) -> DataFrame:
    """Counts per key with one column per listed category value."""
    return df.groupBy(*keys).pivot(category, values).count().na.fill(0, subset=values)


def frequency(df: DataFrame, by: str | list[str], name: str = "n") -> DataFrame:
    by = [by] if isinstance(by, str) else by
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def frequent(df: DataFrame, by: str, more_than: int, name: str = "n") -> DataFrame:
    """Categories seen more than the given number of times."""
    return frequency(df, by, name).filter(F.col(name) > more_than)


def top_categories(df: DataFrame, by: str, k: int, name: str = "n") -> DataFrame:
    """The k commonest values; ties go by value."""
    return frequency(df, by, name).orderBy(F.desc(name), F.asc(by)).limit(k)


def top_vocabulary(df: DataFrame, by: str, k: int) -> list[str]:
    """The k commonest values as a list, to freeze into a one-hot vocabulary."""
    return [row[0] for row in top_categories(df, by, k).collect()]


def level_by(df: DataFrame, keys: list[str], value: Column | str, prefix: str) -> DataFrame:
    """Highest and mean value per key."""
    value = as_col(value)
    return df.groupBy(*keys).agg(F.max(value).alias(f"max_{prefix}"), F.avg(value).alias(f"avg_{prefix}"))
