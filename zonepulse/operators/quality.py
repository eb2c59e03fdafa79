"""Rule application, attrition counts and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_plain_number

Rules = list[tuple[str, Column]]


def keep(df: DataFrame, rules: Rules) -> DataFrame:
    for _, condition in rules:
        df = df.filter(condition)
    return df


def _counts(rules: Rules) -> list[Column]:
    """Rows in all, and rows that pass each rule and those before it, as aggregates."""
    passed = F.lit(True)
    counts = [F.count(F.lit(1)).alias("s0")]
    for i, (_, condition) in enumerate(rules, start=1):
        passed = passed & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(passed).alias(f"s{i}"))
    return counts


def observed(df: DataFrame, rules: Rules) -> tuple[DataFrame, Observation]:
    """The rows that ``keep`` keeps, and the counts of ``attrition`` from the same pass.

    The counts are there once an action has run over all rows, such as a write, and
    ``observed_attrition`` waits for it. Give the rows to a stage that ends in a stored
    table without a shuffle between: what a lost executor makes Spark compute again
    before a shuffle would be counted again.
    """
    seen = Observation()
    return keep(df.observe(seen, *_counts(rules)), rules), seen


def observed_attrition(spark: SparkSession, seen: Observation, rules: Rules) -> DataFrame:
    """(step, rule, surviving) as ``attrition`` has it."""
    found = seen.get
    names = ["all rows", *(name for name, _ in rules)]
    return spark.createDataFrame([(i, name, found[f"s{i}"]) for i, name in enumerate(names)], "step int, rule string, surviving long")


def attrition(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows left after each rule, applied in order: (step, rule, surviving).

    All steps are counted in one pass over the input.
    """
    names = ["all rows", *(name for name, _ in rules)]
    steps = [
        F.struct(F.lit(i).alias("step"), F.lit(name).alias("rule"), F.col(f"s{i}").alias("surviving"))
        for i, name in enumerate(names)
    ]
    return df.agg(*_counts(rules)).select(F.inline(F.array(*steps)))


def bad_numbers(df: DataFrame, cells: dict[str, str], limit: int | None = None) -> DataFrame:
    """Rows with a cell that is no unsigned decimal once its symbols are stripped.

    ``cells`` maps each column to the symbols to strip. The first offending column
    is named in ``reason``. All rejects are returned; ``limit`` is for a quick look.
    """
    reason = F.coalesce(
        *(
            F.when(~F.coalesce(is_plain_number(c, symbols), F.lit(False)), F.lit(c))
            for c, symbols in cells.items()
        )
    )
    rejects = df.withColumn("reason", reason).filter(F.col("reason").isNotNull())
    return rejects if limit is None else rejects.limit(limit)
