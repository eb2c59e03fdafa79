"""Near-duplicate vectors by collision counting on sorted projections.

Vectors of one label are scaled to length one and projected on ``PROJECTIONS`` random
lines. Two vectors collide on a line if one's projection lies in the window centred on
the other's. Of vectors at the threshold the difference is normal with their distance as
deviation, so the window's half width fixes how often they collide, and the count of
collisions is binomial: pairs that reach the largest count which all but a share ``LOSS``
of pairs at the threshold reach are verified by their cosine. Nearer pairs collide more.

1.  Equal vectors of a label are one class, so a crowd of copies is one vector.
2.  Classes of a label are sorted on the line on which they spread most and cut to slabs
    of ``SLAB_ROWS``. Two slabs meet only if their ends are less than ``REACH`` deviations
    apart: a pair further apart on that line is at the threshold with odds of 6e-5.
3.  A task sorts the slabs it compares on every line, finds each window by binary search
    and adds up collisions. It returns how many each vector links with and one
    link to a vector of its linked part, never the pairs; that is as many rows as vectors.

So work grows with the rows of a label squared times the share of slabs in reach, in tasks
of two slabs each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .components import components
from .ranks import ranked
from .shipping import map_arrow

PROJECTIONS = 24
#: Half width of a window in deviations of a pair at the threshold.
WIDTH = 2.0
#: Share of pairs at the threshold that may miss the count.
LOSS = 1e-4
#: Deviations within which slabs meet.
REACH = 4.0
SLAB_ROWS = 1_024
#: Pairs that are verified at a time.
VERIFIED = 1 << 16


def needed(projections: int = PROJECTIONS, width: float = WIDTH, loss: float = LOSS) -> int:
    """The largest count of collisions that all but ``loss`` of pairs at the threshold reach."""
    p = math.erf(width / math.sqrt(2))
    missed = 0.0
    for count in range(projections + 1):
        missed += math.comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if missed > loss:
            return count
    return projections


def deviation(threshold: float) -> float:
    """Distance of two vectors of length one whose cosine is the threshold."""
    return math.sqrt(max(2 - 2 * threshold, 0.0))


def lines(dim: int, projections: int) -> np.ndarray:
    return np.random.default_rng(dim).standard_normal((dim, projections))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _projected(projections: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                rows = batch.filter(pa.array(dims == dim))
                x = unit(_flat(rows.column("vector")).reshape(-1, dim))
                found = (x @ lines(int(dim), projections)).astype(np.float64)
                at = pa.array(np.arange(len(x) + 1, dtype=np.int32) * projections)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.ListArray.from_arrays(at, pa.array(found.ravel()))], [*rows.schema.names, "lines"])

    return run


def collisions(p: np.ndarray, q: np.ndarray, half: float) -> np.ndarray:
    """Per row of ``p`` and of ``q``: on how many lines the latter is in the former's window."""
    count = np.zeros((len(p), len(q)), dtype=np.uint8)
    row = np.arange(len(p))
    for j in range(p.shape[1]):
        order = np.argsort(q[:, j])
        line = q[order, j]
        edge = np.zeros((len(p), len(q) + 1), dtype=np.int8)
        edge[row, np.searchsorted(line, p[:, j] - half, side="left")] += 1
        edge[row, np.searchsorted(line, p[:, j] + half, side="right")] -= 1
        place = np.empty(len(q), dtype=np.int64)
        place[order] = np.arange(len(q))
        count += np.cumsum(edge[:, :-1], axis=1, dtype=np.int8).view(np.uint8)[:, place]
    return count


def _linked(x: np.ndarray, y: np.ndarray, passing: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The passing pairs whose cosine reaches the threshold."""
    left, right = np.nonzero(passing)
    keep = np.zeros(len(left), dtype=bool)
    for at in range(0, len(left), VERIFIED):
        part = slice(at, at + VERIFIED)
        keep[part] = np.einsum("ij,ij->i", x[left[part]], y[right[part]]) >= threshold
    return left[keep], right[keep]


def _least(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One node of each node's linked part, of the links (a, b) among n nodes."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = np.minimum(low, low[low])
        if (low == root).all():
            return root
        root = low


class _Slab:
    def __init__(self, items: pa.Array, dim: int, projections: int):
        flat = items.flatten()
        self.node = flat.field("node").to_numpy()
        self.copies = flat.field("copies").to_numpy()
        self.unit = unit(_flat(flat.field("vector")).astype(np.float64).reshape(len(flat), dim))
        self.lines = _flat(flat.field("lines")).reshape(len(flat), projections)


def _compared(threshold: float, projections: int, half: float, count: int):
    def compare(one: _Slab, two: _Slab, same: bool) -> pa.RecordBatch:
        pairs = []
        for at in range(0, len(one.node), 256):
            passing = collisions(one.lines[at : at + 256], two.lines, half) >= count
            if same:
                passing &= np.arange(len(two.node)) > np.arange(at, at + len(passing))[:, None]
            a, b = _linked(one.unit[at : at + 256], two.unit, passing, threshold)
            pairs.append((a + at, b))
        a, b = (np.concatenate(v) for v in zip(*pairs, strict=True))
        node, copies = (one.node, one.copies) if same else (np.append(one.node, two.node), np.append(one.copies, two.copies))
        if not same:
            b = b + len(one.node)
        n = np.zeros(len(node), dtype=np.int64)
        np.add.at(n, a, copies[b])
        np.add.at(n, b, copies[a])
        hit = np.flatnonzero(n)
        least = _least(len(node), a, b)
        return pa.RecordBatch.from_arrays([pa.array(node[hit]), pa.array(n[hit]), pa.array(node[least[hit]])], ["node", "n", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, ones, twos, same = (batch.column(c) for c in ("dim", "one", "two", "same"))
            for i in range(batch.num_rows):
                one = _Slab(ones.slice(i, 1), dims[i].as_py(), projections)
                yield compare(one, one if same[i].as_py() else _Slab(twos.slice(i, 1), dims[i].as_py(), projections), same[i].as_py())

    return run


def _classes(rows: DataFrame, projections: int) -> DataFrame:
    """(node, label, dim, vector, id, copies, lines): equal vectors of a label once."""
    found = rows.filter("vector IS NOT NULL").groupBy("label", F.size("vector").alias("dim"), "vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    types = dict(found.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in ("label", "dim", "vector", "id", "copies"))
    found = map_arrow(found, _projected(projections), f"{schema}, lines array<double>")
    return materialise(found.withColumn("node", F.monotonically_increasing_id()))


def _slabs(classes: DataFrame, projections: int, rows: int) -> DataFrame:
    """(label, dim, slab, low, high, items): classes in runs of ``rows`` on their label's widest line."""
    spread = F.array(*(F.var_pop(F.col("lines")[j]) for j in range(projections)))
    widest = classes.groupBy("label", "dim").agg(spread.alias("spread")).select("label", "dim", F.expr("int(array_position(spread, array_max(spread)) - 1)").alias("line"))
    along = classes.join(widest, ["label", "dim"]).withColumn("at", F.col("lines")[F.col("line")]).drop("line")
    placed = ranked(along, ["label", "dim"], ["at", "node"])
    items = F.collect_list(F.struct("node", "copies", "vector", "lines")).alias("items")
    slab = F.expr(f"rank div {rows}").alias("slab")
    return materialise(placed.groupBy("label", "dim", slab).agg(F.min("at").alias("low"), F.max("at").alias("high"), items))


def _links(slabs: DataFrame, threshold: float, projections: int, width: float, loss: float) -> DataFrame:
    """(node, n, other): what a vector links with in a pair of slabs, and one of its linked part."""
    far = REACH * deviation(threshold)
    ends = slabs.select("label", "dim", "slab", "low", "high")
    others = ends.select("label", "dim", F.col("slab").alias("other"), F.col("low").alias("from"))
    pairs = ends.join(others, ["label", "dim"]).filter((F.col("slab") <= F.col("other")) & (F.col("from") - F.col("high") <= far))
    pairs = materialise(pairs.select("label", "dim", "slab", "other"))
    tasks = max(slabs.sparkSession.sparkContext.defaultParallelism, pairs.count() // 4)
    ones = pairs.join(slabs.select("label", "dim", "slab", F.col("items").alias("one")), ["label", "dim", "slab"])
    twos = slabs.select("label", "dim", F.col("slab").alias("other"), F.col("items").alias("two"))
    key = ["label", "dim", "other"]
    met = ones.repartition(tasks, *key).join(twos.repartition(tasks, *key), key).select("dim", "one", "two", (F.col("slab") == F.col("other")).alias("same"))
    compare = _compared(threshold, projections, width * deviation(threshold), needed(projections, width, loss))
    return materialise(map_arrow(met, compare, "node bigint, n bigint, other bigint"))


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    projections: int = PROJECTIONS,
    width: float = WIDTH,
    loss: float = LOSS,
    slab_rows: int = SLAB_ROWS,
) -> DataFrame:
    """One row per vector: (id, n_links, component_id, kept).

    ``n_links`` counts other vectors of the same label whose cosine, in double precision,
    is at least ``threshold``; ``component_id`` is the smallest id reachable by links, the
    row's own included; ``kept`` says that it is the row's own.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components, and rows
    without label or id, link with nothing; so do vectors of unlike lengths. Rows repeated
    under one id are vectors of their own. A row without id has no component and is kept.
    Other columns are ignored; an empty table gives no rows.
    """
    v = F.col(vector_col)
    kind = dict(vectors.dtypes)[vector_col]
    if kind not in ("array<float>", "array<double>"):
        v = v.cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    part = sound & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.when(part, v).alias("vector"))
    classes = _classes(rows, projections)
    links = _links(_slabs(classes, projections, slab_rows), threshold, projections, width, loss)
    heads = classes.select("node", F.col("id").alias("head"))
    parts = components(links.select(F.col("node").alias("a"), F.col("other").alias("b"))).join(heads, "node")
    least = parts.groupBy("component").agg(F.min("head").alias("least"))
    named = parts.join(least, "component").select("node", "least")
    direct = links.groupBy("node").agg(F.sum("n").alias("n"))
    found = classes.select("node", "label", "vector", "id", "copies").join(direct, "node", "left").join(named, "node", "left")
    found = found.select(
        "label", "vector", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("least", "id").alias("component_id")
    )
    out = rows.join(found, ["label", "vector"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )
