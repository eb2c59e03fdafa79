"""Registry of the published queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """The parquet tables of one data directory, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        self.__dict__[name] = table  # one look at the files per query
        return table


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None):
    """Publish a function of ``Tables`` under its own name or the given one. ``sql``
    states the same result for DuckDB; it is left out where SQL cannot."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        key = name or build.__name__
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = Query(key, build, sql)
        return build

    return register


def load() -> dict[str, Query]:
    from . import (  # noqa: F401
        catalog_aggregates,
        catalog_filters,
        catalog_io,
        catalog_joins,
        catalog_models,
        catalog_scalars,
        catalog_shaping,
    )

    return QUERIES
