"""Stored partial results that grow by one part, such as a monthly snapshot, at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.writers import parquet_table
from .correlation import key_moments, merge_moments

PART = "part"


class PartStore:
    """Partial results, one directory to a part, merged when they are read.

    A part is fed once from its own facts, and no other part's facts are read for it; fed
    again it replaces itself.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def partial(self, facts: DataFrame) -> DataFrame:
        raise NotImplementedError

    def feed(self, facts: DataFrame, part: str) -> None:
        parquet_table(self.partial(facts).withColumn(PART, F.lit(part)), self.path, by=[PART], mode="replace")

    def parts(self) -> list[str]:
        """The parts that are stored, by the names of their directories."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        system = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not system.exists(path):
            return []
        names = [s.getPath().getName() for s in system.listStatus(path)]
        return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{PART}="))

    def missing(self, parts: list[str]) -> list[str]:
        """Those of the given parts that are not stored yet: only their facts need be read."""
        known = set(self.parts())
        return [p for p in parts if p not in known]

    def stored(self) -> DataFrame:
        return self.spark.read.parquet(self.path)


class MomentStore(PartStore):
    """Moments of a value per key. Parts must hold different facts."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], value: str):
        super().__init__(spark, path)
        self.keys, self.value = keys, value

    def partial(self, facts: DataFrame) -> DataFrame:
        return key_moments(facts, self.keys, self.value)

    def moments(self) -> DataFrame:
        return merge_moments(self.stored().drop(PART), self.keys)


class SketchStore(PartStore):
    """Distinct-value sketches of columns. Parts may share values: a value in several is
    counted once. ``lg_k`` sets the size, 2^lg_k bytes or less, and the relative standard
    error, 1.04 / sqrt(2^lg_k) or less."""

    def __init__(self, spark: SparkSession, path: str, columns: list[str], lg_k: int = 12):
        super().__init__(spark, path)
        self.columns, self.lg_k = columns, lg_k

    def partial(self, facts: DataFrame) -> DataFrame:
        return facts.agg(*(F.hll_sketch_agg(F.col(c).cast("string"), self.lg_k).alias(c) for c in self.columns))

    def distinct_counts(self) -> DataFrame:
        """(column_name, n_distinct) over all parts."""
        merged = self.stored().agg(*(F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in self.columns))
        rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_distinct")) for c in self.columns]
        return merged.select(F.inline(F.array(*rows)))
