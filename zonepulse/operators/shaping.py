"""Row shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def derive(df: DataFrame, columns: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
    """Add or replace columns that later filters test.

    As a plain projection the expressions would be copied into every such filter,
    which the optimizer moves below the projection, and be evaluated there once more.
    A generator of one row holds the filters above it.
    """
    kept = [c for c in (keep or df.columns) if c not in columns]
    made = F.struct(*(value.alias(name) for name, value in columns.items()))
    return df.select(*kept, F.inline(F.array(made)))
