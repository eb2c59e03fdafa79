"""Shards as runs of a Hilbert curve over several metadata dimensions.

Each dimension is quantised into a few bits, the cells' curve index orders the rows, and
the order is cut into runs. Rows that are close in all dimensions lie in the same run, so
minima and maxima per file prune by any of them.

The global position of a row comes from a range partitioning of (index, hash of the id,
id): Spark samples the bounds, so one crowded cell (copies, a hot source) is spread over
many partitions, and a row's position is its place in its partition plus the rows of the
partitions before.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .shipping import ship


@dataclass(frozen=True)
class Dim:
    """A dimension: ``linear`` and ``log`` cut the range between the smallest and largest
    value into equal cells, ``name`` spreads strings by their hash. NULL is cell 0."""

    value: Column
    kind: str = "linear"


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Curve index of points (rows) with ``bits`` bits per coordinate (columns).

    Undoes, from the highest bit down, the exchanges and inversions that the curve's
    orientation makes in each sub-cube, then interleaves the Gray-coded bits.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            odd = (x[i] & q) != 0
            swap = np.where(odd, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(odd, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << 1) | ((x[i] >> b) & 1)
    return index


def _cells(docs: DataFrame, dims: dict[str, Dim], bits: int) -> list[Column]:
    top = (1 << bits) - 1
    scaled = {
        n: (F.log1p(F.greatest(d.value.cast("double"), F.lit(0.0))) if d.kind == "log" else d.value.cast("double"))
        for n, d in dims.items()
        if d.kind != "name"
    }
    ends = docs.agg(*(f(v).alias(f"{n}_{f.__name__}") for n, v in scaled.items() for f in (F.min, F.max))).first() if scaled else {}
    out = []
    for n, d in dims.items():
        if d.kind == "name":
            cell = F.pmod(F.crc32(d.value), F.lit(top)) + 1
        else:
            low, high = ends[f"{n}_min"], ends[f"{n}_max"]
            if low is None or not high > low:
                cell = F.lit(1)
            else:
                cell = F.least(F.floor((scaled[n] - F.lit(low)) / F.lit(high - low) * top), F.lit(top - 1)) + 1
        out.append(F.when(d.value.isNull(), F.lit(0)).otherwise(cell).cast("int"))
    return out


def hilbert_shards(docs: DataFrame, dims: dict[str, Dim], shards: int, bits: int = 6, id_col: str = "doc_id") -> DataFrame:
    """Rows with ``shard``, ``slot`` and ``curve``; counts of shards are at most one apart.

    Shard s holds the s-th of ``shards`` equal runs of the curve, ``slot`` is the place in
    it. All columns stay; ones of these three names are replaced. The rows are evaluated
    once into the shared folder, so give only the columns needed. Ties on the curve go by
    the hash of the id, then the id; equal rows may stand in either order. Fewer rows than
    shards leave the last shards empty or nearly so; no rows give no rows.
    """

    ship(docs.sparkSession)

    @F.pandas_udf("long")
    def index(cells: pd.Series) -> pd.Series:
        if not len(cells):
            return pd.Series([], dtype="int64")
        return pd.Series(hilbert_index(np.stack(cells.to_numpy()), bits))

    kept = [c for c in docs.columns if c not in ("shard", "slot", "curve", "_place")]
    rows = docs.select(*kept, index(F.array(*_cells(docs, dims, bits))).alias("curve"))
    tie = F.xxhash64(id_col)
    ordered = rows.repartitionByRange("curve", tie, id_col).sortWithinPartitions("curve", tie, id_col)
    stored = materialise(ordered.withColumn("_place", F.monotonically_increasing_id()))
    part, local = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    counts = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("_all"),
    )
    # One row per range partition: its size is the session's number of shuffle partitions.
    placed = stored.join(F.broadcast(offsets), part == F.col("_part")).withColumn("_rank", F.col("_before") + local)
    shard = F.expr(f"_rank * {shards} div _all")
    placed = placed.withColumn("shard", shard.cast("int"))
    first = F.expr(f"(shard * _all + {shards - 1}) div {shards}")
    return placed.select(*kept, "curve", "shard", (F.col("_rank") - first).cast("long").alias("slot"))


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id", files_per_shard: int = 1) -> None:
    """Documents as Parquet in ``path``/shard=s, in slot order; needs unique ids.

    A shard is cut into ``files_per_shard`` runs of its slots, at most one row apart in
    size and one file each, so each file covers a small box of the dimensions. Each run is
    written by one task; raise the number with the data.
    """
    if files_per_shard < 1:
        raise ValueError("files_per_shard is at least 1")
    # One row per shard.
    sizes = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("_size"))
    cut = placed.select(id_col, "shard", "slot").join(F.broadcast(sizes), "shard")
    cut = cut.withColumn("_run", F.expr(f"cast(shard * {files_per_shard} + slot * {files_per_shard} div _size as int)")).drop("_size")
    runs = ((placed.agg(F.max("shard")).first()[0] or 0) + 1) * files_per_shard
    joined = docs.drop("shard", "slot").join(cut, id_col).repartitionById(runs, F.col("_run"))
    joined.sortWithinPartitions("shard", "slot").drop("slot", "_run").write.partitionBy("shard").parquet(path)
