"""Table profiles."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _rows(df: DataFrame, columns: list[str], stats: dict[str, Callable[[str], Column]]) -> DataFrame:
    """Aggregate every statistic of every column at once, then one row per column."""
    aggregates = [fn(c).alias(f"{i}_{name}") for i, c in enumerate(columns) for name, fn in stats.items()]
    structs = [
        F.struct(F.lit(c).alias("column_name"), *(F.col(f"{i}_{name}").alias(name) for name in stats))
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*structs)))


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def distinct_counts(df: DataFrame, columns: list[str], exact: bool = False, rsd: float = 0.02) -> DataFrame:
    """(column_name, n_distinct). ``exact=False`` uses mergeable sketches, which need
    no shuffle of the values: the choice for many or high-cardinality columns.

    Exact counts take one aggregation per column, each of which reads that column alone;
    rows are not copied. Whole numbers and dates meet as masks of 64 neighbours, so dense
    keys shuffle one row where their values would be 64, and sparse ones one per value.
    """
    if exact:
        return reduce(DataFrame.unionAll, (_exact_count(df, c) for c in columns))
    return _rows(df, columns, {"n_distinct": lambda c: F.approx_count_distinct(c, rsd)})


def _exact_count(df: DataFrame, column: str) -> DataFrame:
    kind = df.schema[column].dataType
    cells = df.select(F.col(column).alias("v")).filter("v IS NOT NULL")
    if isinstance(kind, T.DateType):
        cells = cells.select(F.unix_date("v").alias("v"))
    if isinstance(kind, (T.IntegralType, T.DateType)):
        v = F.col("v").cast("long")
        # 2 to the place of the value among its 64 neighbours; the last one is the sign bit.
        bit = F.expr("shiftleft(1L, cast(v & 63 AS int))")
        masks = cells.groupBy(F.shiftright(v, 6).alias("word")).agg(F.bit_or(bit).alias("mask"))
        counted = masks.agg(F.coalesce(F.sum(F.bit_count("mask")), F.lit(0)).cast("long").alias("n_distinct"))
    else:
        counted = cells.groupBy("v").agg(F.lit(1).alias("one")).agg(F.count("one").alias("n_distinct"))
    return counted.select(F.lit(column).alias("column_name"), "n_distinct")


def value_range(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, min_value, max_value) with both ends as text."""
    return _rows(df, columns, _ends(df))


def _ends(df: DataFrame) -> dict[str, Callable[[str], Column]]:
    fractions = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}

    def text(fn, c: str) -> Column:
        # -0.0 and 0.0 are equal, so either could be the end; adding zero makes both 0.0.
        return (fn(c) + F.lit(0.0) if c in fractions else fn(c)).cast("string")

    return {"min_value": lambda c: text(F.min, c), "max_value": lambda c: text(F.max, c)}


def schema_rows(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, n_filled): the declared schema beside the
    number of non-NULL cells."""
    fields = df.schema.fields
    counted = df.agg(*(F.count(f.name).alias(f"f{i}") for i, f in enumerate(fields)))
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"f{i}").alias("n_filled"),
        )
        for i, f in enumerate(fields)
    ]
    return counted.select(F.inline(F.array(*rows)))


def profile_table(df: DataFrame, columns: list[str] | None = None, exact: bool = False) -> DataFrame:
    """Rows, NULLs, distinct values and range of each column; exact distinct counts as in
    ``distinct_counts``."""
    columns = columns or df.columns
    stats = {
        "n_rows": lambda c: F.count(F.lit(1)),
        "n_null": lambda c: F.count_if(F.col(c).isNull()),
        "n_distinct": lambda c: F.approx_count_distinct(c, 0.02),
        **_ends(df),
    }
    if not exact:
        return _rows(df, columns, stats)
    del stats["n_distinct"]
    names = ["column_name", "n_rows", "n_null", "n_distinct", "min_value", "max_value"]
    return _rows(df, columns, stats).join(distinct_counts(df, columns, exact=True), "column_name").select(*names)


def footer_profile(path: str, spark: SparkSession, columns: list[str]) -> DataFrame:
    """(column_name, n_rows, min_value, max_value) of Parquet files from their footers.

    The aggregates are pushed into the scan, which then reads no column chunk. Footers keep
    true ends only of numbers, booleans and dates, so other columns are an error. The read
    has a session of its own, as push-down is a setting of the session.
    """
    own = spark.newSession()
    sources = own.conf.get("spark.sql.sources.useV1SourceList", "").split(",")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in sources if s != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    df = own.read.parquet(path)
    kinds = (T.IntegralType, T.FractionalType, T.BooleanType, T.DateType)
    wrong = [c for c in columns if not isinstance(df.schema[c].dataType, kinds) or isinstance(df.schema[c].dataType, T.DecimalType)]
    if wrong:
        raise ValueError(f"footers hold no exact ends of {wrong}")
    found = df.agg(
        F.count(F.lit(1)).alias("n"),
        *(fn(c).alias(f"{name}_{i}") for i, c in enumerate(columns) for name, fn in (("min", F.min), ("max", F.max))),
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("n").alias("n_rows"),
            F.col(f"min_{i}").cast("string").alias("min_value"),
            F.col(f"max_{i}").cast("string").alias("max_value"),
        )
        for i, c in enumerate(columns)
    ]
    return found.select(F.inline(F.array(*rows)))
