"""N-gram Jaccard join: rare-first prefix filtering, verified once per pair.

Texts become sets of word n-grams, hashed to 64 bits. Two sets with Jaccard similarity
of at least t must share an n-gram among the first n - ceil(t n) + 1 of each in any
common order. The order here is rare first: by the number of documents with the n-gram,
as counted over all documents in a table of fixed size, then by hash. So only prefixes
are joined, and common n-grams are hardly ever in one.

Copies (equal sets) are one class with one representative. Classes are linked in two
rounds, neither of which lists the pairs within a group of near copies:

1.  Of the classes that share a prefix n-gram and are of like size, each is verified
    against one pivot only: the class with the fewest prefix n-grams of its own, then the
    smallest. A text that others were made from has none of its own, while two copies of
    it, each changed elsewhere, may be too far apart. The links found are contracted to
    components.
2.  Prefix n-grams that still join different components give all their pairs across
    components, without those already verified. After this every pair above the
    threshold is verified or inside one component, so the components are exact.

Before verification a pair passes the length filter, the positional filter (what may
still follow the shared n-gram in both) and the suffix filter: the n-grams of each set
counted by ranges of their hash bound the overlap from above.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .components import components
from .filters import sketch, split_by
from .shipping import map_arrow
from .text import chunks, ranges

#: Counters of the document frequencies: their number does not grow with the input.
SLOT_BITS = 21
_BLOCK = 1 << 13
CLASSES_PER_FILE = 50_000
#: Hash ranges of the suffix filter.
BINS = 32


def shingle_sets(chunk, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, n-gram hash) sorted by both, each pair once. A text of fewer than k
    words has one n-gram, the whole; one without words has none."""
    n = chunk.n_words()
    owners, grams = [], []
    for size in range(1, k + 1):
        at, h = chunk.windows(size)
        owner = np.searchsorted(chunk.bounds, at, side="right") - 1
        if size < k:
            keep = n[owner] == size
            owner, h = owner[keep], h[keep]
        owners.append(owner)
        grams.append(h)
    owner, gram = np.concatenate(owners), np.concatenate(grams)
    order = np.lexsort((gram, owner))
    owner, gram = owner[order], gram[order]
    fresh = np.ones(len(owner), dtype=bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (gram[1:] != gram[:-1])
    return owner[fresh], gram[fresh]


def _count_grams(k: int, lower: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, dtype=np.int64)
        seen = False
        for batch in batches:
            for chunk in chunks(batch.column(0), lower):
                _, gram = shingle_sets(chunk, k)
                counts += np.bincount((gram >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=len(counts))
                seen = True
        if seen:
            yield _as_rows(counts.reshape(-1, _BLOCK))

    return run


def _as_rows(blocks: np.ndarray, at: np.ndarray | None = None) -> pa.RecordBatch:
    at = np.arange(len(blocks)) if at is None else at
    packed = []
    for block in blocks:
        kind = np.min_scalar_type(int(block.max()))
        packed.append(bytes([kind.itemsize]) + block.astype(kind).tobytes())
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(packed, pa.binary())], ["block", "counts"])


def _unpack(value: bytes) -> np.ndarray:
    return np.frombuffer(value, dtype=f"u{value[0]}", offset=1).astype(np.int64)


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            more = _unpack(value)
            sums[block] = sums[block] + more if block in sums else more
    if sums:
        yield _as_rows(np.stack(list(sums.values())), np.array(list(sums)))


def gram_counts(docs: DataFrame, text_col: str, k: int, lower: bool) -> np.ndarray:
    """Documents per counter; the one table of this operator that the driver holds, 8 bytes
    for each of 2^21 counters. Each task adds up its own documents first."""
    kind = "block int, counts binary"
    parts = map_arrow(docs.select(text_col), _count_grams(k, lower), kind)
    summed = map_arrow(parts.repartition("block"), _sum_counts, kind)
    out = np.zeros((1 << SLOT_BITS) // _BLOCK * _BLOCK, dtype=np.int64).reshape(-1, _BLOCK)
    for row in summed.collect():
        out[row.block] = _unpack(bytes(row.counts))
    return out.reshape(-1)


def _needed(n: np.ndarray, t: tuple[int, int]) -> np.ndarray:
    """ceil(t n) in whole numbers."""
    return -((-n * t[0]) // t[1])


def _set_rows(k: int, lower: bool, t: tuple[int, int], counts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        for batch in batches:
            ids = batch.column(0)
            for chunk in chunks(batch.column(1), lower):
                owner, gram = shingle_sets(chunk, k)
                n = np.bincount(owner, minlength=chunk.n_texts).astype(np.int64)
                first = np.cumsum(n) - n
                rare = np.lexsort((gram, table[(gram >> np.uint64(64 - SLOT_BITS)).astype(np.int64)], owner))
                length = np.where(n > 0, n - _needed(n, t) + 1, 0)
                prefix = gram[rare][ranges(first, length)].view(np.int64)
                bins = np.bincount(owner * BINS + (gram & np.uint64(BINS - 1)).astype(np.int64), minlength=chunk.n_texts * BINS)
                sums = np.zeros((2, len(gram) + 1), dtype=np.uint64)
                np.cumsum(gram, out=sums[0, 1:])
                np.cumsum(gram * (gram >> np.uint64(7)), out=sums[1, 1:])
                sign = (sums[:, first + n] - sums[:, first]).view(np.int64)
                limits = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(chunk.first, chunk.n_texts),
                        pa.array(n),
                        pa.array(sign[0]),
                        pa.array(sign[1]),
                        pa.ListArray.from_arrays(pa.array(limits), pa.array(prefix)),
                        pa.FixedSizeListArray.from_arrays(pa.array(bins.astype(np.int32)), BINS).cast(pa.list_(pa.int32())),
                    ],
                    ["id", "n", "s1", "s2", "prefix", "bins"],
                )

    return run


def _verify(k: int, lower: bool, t: tuple[int, int]):
    def one(text: str | None) -> np.ndarray:
        out = [shingle_sets(c, k)[1] for c in chunks(pa.array([text], pa.string()), lower)]
        return out[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = None, None
        for batch in batches:
            a, b, text_a, text_b = (batch.column(i) for i in range(4))
            good = np.zeros(batch.num_rows, dtype=bool)
            for i in range(batch.num_rows):
                left = text_a[i].as_py()
                if left != held or known is None:  # pairs of one pivot come in a row
                    held, known = left, one(left)
                other = one(text_b[i].as_py())
                shared = len(np.intersect1d(known, other, assume_unique=True))
                good[i] = t[1] * shared >= t[0] * (len(known) + len(other) - shared)
            yield pa.RecordBatch.from_arrays([a, b, pa.array(good)], ["a", "b", "linked"])

    return run


def _like_size(n: str, m: str, t: tuple[int, int]) -> Column:
    """Length filter: the smaller set has at least t of the larger one's size."""
    return (F.col(n) * t[1] >= F.col(m) * t[0]) & (F.col(m) * t[1] >= F.col(n) * t[0])


def _worst(n: Column, m: Column, t: tuple[int, int]) -> Column:
    """The overlap that similarity t asks for, times (t0 + t1)."""
    return (n + m) * t[0]


class JaccardJoin:
    """The join's tables: ``sets`` (one row per document), ``classes`` and ``links``."""

    def __init__(self, docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (4, 5), lower: bool = False, id_col: str = "doc_id", text_col: str = "text"):
        self.k, self.t, self.lower = k, threshold, lower
        self.docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        self._find_sets()

    def _find_sets(self) -> None:
        sc = self.docs.sparkSession.sparkContext
        kind = dict(self.docs.dtypes)["id"]
        counts = sc.broadcast(gram_counts(self.docs, "text", self.k, self.lower))
        made = map_arrow(
            self.docs,
            _set_rows(self.k, self.lower, self.t, counts),
            f"id {kind}, n bigint, s1 bigint, s2 bigint, prefix array<bigint>, bins array<int>",
        )
        self.sets = materialise(made)
        full = self.sets.filter("n > 0 AND id IS NOT NULL")
        self.classes = materialise(
            full.groupBy("n", "s1", "s2").agg(
                F.min("id").alias("rep"),
                F.count(F.lit(1)).alias("copies"),
                F.first("prefix").alias("prefix"),
                F.first("bins").alias("bins"),
            )
        )

    def _prefixes(self) -> DataFrame:
        """Prefix n-grams that two classes or more share, with place, sizes and the number of
        n-grams in the class's prefix that no other class has there."""
        rows = self.classes.select("rep", "n", F.size("prefix").alias("length"), F.posexplode("prefix").alias("place", "gram"))
        # Sizes t apart are in the same or in neighbouring bands.
        band = F.floor(F.log("n") / F.lit(math.log(self.t[1] / self.t[0]))).cast("int")
        rows = rows.withColumn("band", band)
        ends = rows.groupBy("gram").agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
        shared = rows.join(ends.filter("low < high").select("gram"), "gram")
        own = F.col("length") - F.count(F.lit(1)).over(Window.partitionBy("rep"))
        return materialise(shared.withColumn("own", own).drop("length"))

    def _plausible(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that pass the length and suffix filters, each once."""
        size = self.classes.select("rep", "n", "bins")
        rows = pairs.join(size.toDF("a", "n_a", "bins_a"), "a").join(size.toDF("b", "n_b", "bins_b"), "b")
        apart = F.aggregate(F.zip_with("bins_a", "bins_b", lambda x, y: F.abs(x - y).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
        most = (F.col("n_a") + F.col("n_b") - apart) * (self.t[0] + self.t[1])
        enough = most >= 2 * _worst(F.col("n_a"), F.col("n_b"), self.t)
        return rows.filter(_like_size("n_a", "n_b", self.t) & enough).select("a", "b")

    def _verified(self, pairs: DataFrame) -> DataFrame:
        # Pairs follow the classes that have a like, and are a few numbers each.
        files = 1 + self.classes.count() // CLASSES_PER_FILE
        pairs = materialise(pairs, files)
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        near, _ = split_by(self.docs, "id", materialise(sketch(ids, "id"), files=1))
        texts = near.select("id", "text")
        rows = pairs.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a")
        kind = dict(pairs.dtypes)["a"]
        checked = map_arrow(rows.select("a", "b", "text_a", "text_b"), _verify(self.k, self.lower, self.t), f"a {kind}, b {kind}, linked boolean")
        return materialise(checked.groupBy("a", "b").agg(F.max("linked").alias("linked")), files)

    def solve(self) -> DataFrame:
        """(rep, component) of every class that has a link."""
        rows = self._prefixes()
        pivots = rows.groupBy("gram", "band").agg(F.min(F.struct("own", "rep")).alias("pivot"))
        stars = rows.join(pivots, ["gram", "band"]).select(F.col("pivot.rep").alias("a"), F.col("rep").alias("b")).filter("a <> b").distinct()
        first = self._verified(self._plausible(stars))
        self.links = first.filter("linked").select("a", "b")
        found = materialise(components(self.links))
        known = rows.join(found, rows.rep == found.node, "left").withColumn("part", F.coalesce("component", "rep"))
        known = known.select("gram", "rep", "own", "n", "place", "band", "part")
        mixed = known.groupBy("gram").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p < q")
        # The n-gram before this one in the class's order, of those that are joined.
        before = F.lag("gram").over(Window.partitionBy("rep").orderBy("place"))
        known = materialise(known.join(mixed.select("gram"), "gram").withColumn("before", before))
        left = known.select("gram", *(F.col(c).alias(f"{c}_a") for c in ("rep", "own", "n", "place", "part", "before")), F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
        right = known.select("gram", "band", *(F.col(c).alias(f"{c}_b") for c in ("rep", "own", "n", "place", "part", "before")))
        rest = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
        # The first shared n-gram of a pair leaves room enough in both, so the pair stays through it.
        fits = rest * (self.t[0] + self.t[1]) >= _worst(F.col("n_a"), F.col("n_b"), self.t)
        # Where the n-grams before it are one too, the pair is named there: near copies share
        # hundreds, but are named once to a run of them.
        starts = F.col("before_a").isNull() | F.col("before_b").isNull() | (F.col("before_a") != F.col("before_b"))
        # The first of a pair is the one that would be its pivot, as in the first round.
        ordered = F.struct("own_a", "rep_a") < F.struct("own_b", "rep_b")
        two = ordered & (F.col("part_a") != F.col("part_b")) & starts
        across = left.join(right, ["gram", "band"]).filter(two & _like_size("n_a", "n_b", self.t) & fits)
        pairs = across.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
        second = self._verified(self._plausible(pairs))
        self.links = self.links.unionByName(second.filter("linked").select("a", "b"))
        return materialise(components(self.links))


def jaccard_components(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (4, 5), lower: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document (id, n_shingles, component_id): its set's size and the smallest id
    reachable by links, where two documents link when threshold[1] * |intersection| >=
    threshold[0] * |union| of their n-gram sets.

    NULL and empty texts have no n-grams, link with nothing and are their own component.
    A NULL id comes back with its size; its component is that of its copies with an id,
    else NULL. Ids are unique; rows repeated under one id come back as often. Other
    columns are ignored. An empty table gives no rows.
    """
    join = JaccardJoin(docs, k, threshold, lower, id_col, text_col)
    found = join.solve()
    named = join.classes.join(found, join.classes.rep == found.node, "left").select("n", "s1", "s2", F.coalesce("component", "rep").alias("component_id"))
    rows = join.sets.select("id", "n", "s1", "s2").join(named, ["n", "s1", "s2"], "left")
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
