"""Inverted multi-index for nearest neighbours by inner product.

Vectors are cut into two halves and each half is quantised by its own codebook, so K
centroids per half give K * K cells. A query walks the pairs of centroids by the sum of
its two half products, largest first, from a heap that holds only the frontier, until the
cells walked hold enough entries; these are reranked by the exact inner product. Norms may
differ: a centroid's product is raised by what the spread of its entries adds to the best
of them, as long vectors, the likeliest answers, lie in few and wide cells.

The index is stored in blocks of a bounded number of entries: neighbouring cells share a
block, a crowded cell is dealt over several. Queries are dealt to blocks they have cells
in, in chunks, so a task holds one block and one chunk; each returns its best per query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .shipping import map_arrow, ship

#: Vectors the codebooks are fitted on, those with the smallest seeded hash of their id.
SAMPLE_ROWS = 20_000
CENTROIDS = 64
ROUNDS = 12
#: Share of all entries that a query walks, and the least number of them.
SHARE = 0.5
LEAST = 2_000
#: How many standard deviations of a centroid's entries its product is raised by.
REACH = 2.0
BLOCK_ROWS = 4_096
CHUNK_QUERIES = 1_024


@dataclass(frozen=True)
class Codebooks:
    """Centroids of both halves, (K, half) each, the spread of their entries per
    coordinate, and the vectors' length."""

    left: np.ndarray
    right: np.ndarray
    dim: int
    left_spread: np.ndarray
    right_spread: np.ndarray

    @staticmethod
    def of(x: np.ndarray, k: int) -> Codebooks:
        a, b = _halves(x)
        left, right = _kmeans(a, k), _kmeans(b, k)
        return Codebooks(left, right, x.shape[1], _spread(a, left), _spread(b, right))

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = _halves(x)
        return _nearest(a, self.left) * len(self.right) + _nearest(b, self.right)

    def costs(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per query and centroid of each half what ``walk`` goes by: the product that the
        best entries may have, negated."""
        a, b = _halves(x)
        return _cost(a, self.left, self.left_spread), _cost(b, self.right, self.right_spread)


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = (x.shape[1] + 1) // 2
    return x[:, :cut], x[:, cut:]


def _cost(x: np.ndarray, centroids: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return -(x @ centroids.T) - REACH * np.linalg.norm(x, axis=1)[:, None] * spread


def _spread(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    near = _nearest(x, centroids)
    squares = np.bincount(near, weights=((x - centroids[near]) ** 2).sum(1), minlength=len(centroids))
    return np.sqrt(squares / np.maximum(np.bincount(near, minlength=len(centroids)) * max(x.shape[1], 1), 1))


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmax(2 * x @ centroids.T - (centroids**2).sum(1), axis=1)


def _kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 11) -> np.ndarray:
    distinct = np.unique(x, axis=0)
    k = min(k, len(distinct))
    centroids = distinct[np.random.default_rng(seed).choice(len(distinct), k, replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, centroids)
        size = np.bincount(near, minlength=k)
        total = np.zeros_like(centroids)
        np.add.at(total, near, x)
        full = size > 0
        centroids[full] = total[full] / size[full, None]
    return centroids


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector as doubles) of the rows that take part: not NULL, not zero, all finite."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))) & F.exists("vector", lambda x: x != 0)
    return rows.select(F.col(id_col).cast("long").alias("id"), v.alias("vector")).filter(F.col("id").isNotNull() & good)


def fit(vectors: DataFrame, k: int = CENTROIDS, sample: int = SAMPLE_ROWS) -> Codebooks | None:
    """Codebooks from at most ``sample`` vectors; None if there is none."""
    rows = vectors.orderBy(F.xxhash64(F.lit(29), "id"), "id").limit(sample).select("vector").toArrow()
    if not len(rows):
        return None
    found = rows["vector"].combine_chunks()
    x = np.stack([np.asarray(v) for v in found.to_pylist()])
    return Codebooks.of(x, k)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def _assign(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for batch in batches:
            if batch.num_rows:
                cell = books.cells(_matrix(batch.column(1), books.dim)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell)], ["id", "vector", "cell"])

    return run


def walk(left: np.ndarray, right: np.ndarray, counts: np.ndarray, enough: int) -> list[int]:
    """Cells by ascending ``left[i] + right[j]`` until they hold ``enough`` entries.

    A pair enters the heap when both pairs before it, one row up and one column left in
    sorted order, have left it.
    """
    rows, columns = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    a, b = left[rows].tolist(), right[columns].tolist()
    width = len(b)
    sizes = counts.reshape(len(a), width)[np.ix_(rows, columns)].tolist()
    done = [0] * len(a)  # pairs of each row that have left the heap
    heap, out, held = [(a[0] + b[0], 0, 0)], [], 0
    rows, columns = rows.tolist(), columns.tolist()
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        done[i] = j + 1
        if sizes[i][j]:
            out.append(rows[i] * width + columns[j])
            held += sizes[i][j]
        if j + 1 < width and (i == 0 or done[i - 1] > j + 1):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if i + 1 < len(a) and done[i + 1] == j:
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
    return out


@dataclass(frozen=True)
class Layout:
    """Where each cell's entries lie: its first block and the number of blocks it is dealt over."""

    counts: np.ndarray
    first: np.ndarray
    pieces: np.ndarray

    @staticmethod
    def of(counts: np.ndarray, block_rows: int) -> Layout:
        first, pieces = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
        block, held = 0, 0
        for cell, n in enumerate(counts.tolist()):
            if held and held + n > block_rows:
                block, held = block + 1, 0
            first[cell] = block
            if n > block_rows:
                pieces[cell] = -(-n // block_rows)
                block, held = block + int(pieces[cell]), 0
            else:
                held += n
        return Layout(counts, first, pieces)


def _route(shared, enough: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, layout = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            x = _matrix(batch.column(1), books.dim)
            left, right = books.costs(x)
            for i, query in enumerate(ids.tolist()):
                cells = np.array(walk(left[i], right[i], layout.counts, enough), dtype=np.int64)
                piece = layout.pieces[cells]
                base = np.repeat(layout.first[cells], piece)
                block = base + np.arange(len(base)) - np.repeat(np.cumsum(piece) - piece, piece)
                cells = np.repeat(cells, piece)
                order = np.argsort(block, kind="stable")
                block, cells = block[order], cells[order].astype(np.int32)
                cuts = np.flatnonzero(np.diff(block)) + 1
                lists = np.split(cells, cuts)
                blocks = block[np.concatenate([[0], cuts])] if len(block) else block
                n = len(blocks)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(blocks.astype(np.int32)),
                        pa.array(np.full(n, hash_chunk(query, chunk), dtype=np.int32)),
                        pa.array(np.full(n, query)),
                        pa.array([x[i]] * n, pa.list_(pa.float64())),
                        pa.array([c.tolist() for c in lists], pa.list_(pa.int32())),
                    ],
                    ["block", "chunk", "query_id", "query", "cells"],
                )

    return run


def hash_chunk(query: int, chunks: int) -> int:
    return (query * 0x9E3779B97F4A7C15 & ((1 << 64) - 1)) * chunks >> 64


def _score(dim: int, n_cells: int, k: int):
    columns = ["query_id", "vec_id", "score"]

    def run(key, queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(entries):
            return pd.DataFrame({c: [] for c in columns})
        entries = entries.sort_values("id")
        x = np.stack(entries["vector"].to_numpy()).astype(np.float64)
        ids, cell = entries["id"].to_numpy(), entries["cell"].to_numpy()
        q = np.stack(queries["query"].to_numpy()).astype(np.float64)
        rough = q @ x.T
        out = []
        for i, (query, cells) in enumerate(zip(queries["query_id"].to_numpy(), queries["cells"].to_numpy(), strict=True)):
            walked = np.zeros(n_cells, dtype=bool)
            walked[np.asarray(cells)] = True
            at = np.flatnonzero(walked[cell] & (ids != query))
            near = rough[i, at]
            if len(at) > k:
                # The product of matrices may round equal vectors differently: keep its ties.
                edge = np.partition(near, len(near) - k)[len(near) - k]
                at = at[near >= edge - 1e-9 * max(1.0, abs(edge))]
            exact = (x[at] * q[i]).sum(axis=1)
            best = np.lexsort((ids[at], -exact))[:k]
            out.append((np.full(len(best), query), ids[at][best], exact[best]))
        return pd.DataFrame({c: np.concatenate([o[j] for o in out]) for j, c in enumerate(columns)})

    return run


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    centroids: int = CENTROIDS,
    share: float = SHARE,
    least: int = LEAST,
    block_rows: int = BLOCK_ROWS,
    chunk_queries: int = CHUNK_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its ``k`` largest inner products among
    the entries it walks, ties to the smaller id; the entry of its own id is left out.

    Both inputs have (id, vector) as ``usable`` makes them, with unique ids. A query walks
    at least ``share`` of all entries and at least ``least``; with fewer entries it walks
    all, so small tables are searched exactly. NULL, zero and non-finite vectors are out
    on both sides. No entries or no queries give no rows.
    """
    spark = vectors.sparkSession
    books = fit(vectors, centroids)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if books is None:
        return empty
    if vectors.filter(F.size("vector") != books.dim).limit(1).count():
        raise ValueError("vectors differ in length")
    ship(spark)
    index = materialise(map_arrow(vectors.select("id", "vector"), _assign(spark.sparkContext.broadcast(books)), "id long, vector array<double>, cell int"))
    n_cells = len(books.left) * len(books.right)
    counts = np.zeros(n_cells, dtype=np.int64)
    for row in index.groupBy("cell").count().collect():  # K * K rows at most
        counts[row["cell"]] = row["count"]
    layout = Layout.of(counts, block_rows)
    enough = max(least, int(np.ceil(share * counts.sum())))
    n_queries = queries.count()
    chunks = max(1, -(-n_queries // chunk_queries))
    routed = map_arrow(
        queries.select("id", "vector"),
        _route(spark.sparkContext.broadcast((books, layout)), enough, chunks),
        "block int, chunk int, query_id long, query array<double>, cells array<int>",
    )
    places = spark.createDataFrame(
        pd.DataFrame({"cell": np.arange(n_cells, dtype=np.int32), "first": layout.first, "pieces": layout.pieces}), "cell int, first long, pieces long"
    )
    block = (F.col("first") + F.pmod(F.xxhash64("id"), F.col("pieces"))).cast("int")
    placed = index.join(F.broadcast(places), "cell").select("id", "vector", "cell", block.alias("block"))
    dealt = placed.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    found = routed.groupBy("block", "chunk").cogroup(dealt.groupBy("block", "chunk")).applyInPandas(_score(books.dim, n_cells, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
