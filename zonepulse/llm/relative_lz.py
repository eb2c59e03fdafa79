"""Substring dedup by relative Lempel-Ziv parsing.

A document is factored greedily against reference blocks: at a word, the window of
``window`` words that starts there is looked up, and if a document with a smaller id has
it, a factor opens at that place of this source and is extended as long as the document's
next window is the source's next. Where the source goes no further the factor ends, and the
next window, which shares all but one word with the factor's last, is looked up in turn, so
no duplicate across a border is lost. All words under factors are duplicates.

Reference blocks are the partitions of an index of windows, each with the smallest id that
has it and the place there; a block is sorted and streamed, never held. Two steps keep them small:

1.  From each window the seed of ``SEED`` words with the smallest hash is chosen. Equal
    windows choose the same seed, so a window can only be shared if its seed is. About
    two seeds in ten words are chosen; those in two documents or more set a bit of a map
    whose size follows their number up to ``MOST_BITS``.
2.  Only windows whose seed's bit is set enter a block. A crowded map lets more through,
    it loses none.

Windows of seeds in ``HOT`` documents or more are few but may have very many rows each:
their sources are found by an aggregate that combines before the shuffle and a join whose
skewed partitions are split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .filters import sketch, split_by
from .shipping import map_arrow
from .text import chunks, ranges

SEED = 5
#: Bits of the map for each shared seed, and the power of two that its size ends at (32 MB).
BITS_PER_SEED = 16
MOST_BITS = 28
#: Seeds in as many documents have their windows aggregated before the shuffle.
HOT = 20_000


def _chosen(chunk, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of a chunk: word number, text number, window hash and hash of its seed."""
    seed = min(SEED, window)
    at, whole = chunk.windows(window)
    owner = np.searchsorted(chunk.bounds, at, side="right") - 1
    if not len(at):
        return at, owner, whole, whole
    inner, hashes = chunk.windows(seed)
    dense = np.full(len(chunk.hashes), np.iinfo(np.uint64).max, dtype=np.uint64)
    dense[inner] = hashes
    least = dense[at]
    for j in range(1, window - seed + 1):
        least = np.minimum(least, dense[at + j])
    return at, owner, whole, least


def _unique_pairs(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    fresh = np.ones(len(owner), dtype=bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[fresh], value[fresh]


def _seeds(window: int):
    """(seed, n): in how many of some documents a chosen seed is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                _, owner, _, seed = _chosen(chunk, window)
                seed, n = np.unique(_unique_pairs(owner, seed)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), pa.array(n.astype(np.int64))], ["seed", "n"])

    return run


def _bit_map(seeds: DataFrame, size: int) -> np.ndarray:
    """A map of ``size`` bits, a power of two, in which each seed has one; all the driver holds."""
    slot = F.col("seed").bitwiseAND(F.lit(size - 1))
    one = F.expr(f"shiftleft(1L, cast((seed & {size - 1}) % 64 as int))")
    rows = seeds.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros(max(size // 64, 1), dtype=np.uint64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def _set(bits: np.ndarray, seed: np.ndarray) -> np.ndarray:
    slot = seed & np.uint64(64 * len(bits) - 1)
    return (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _windows(window: int, maps, hot: bool):
    """(run, id, place): the windows, hot or not, whose seed may be shared, each document's first of a kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, crowded = maps.value
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                at, owner, whole, seed = _chosen(chunk, window)
                may = _set(shared, seed) & (_set(crowded, seed) == hot)
                at, owner, whole = at[may], owner[may], whole[may]
                order = np.lexsort((at, whole, owner))
                at, owner, whole = at[order], owner[order], whole[order]
                first = np.ones(len(at), dtype=bool)
                first[1:] = (owner[1:] != owner[:-1]) | (whole[1:] != whole[:-1])
                at, owner, whole = at[first], owner[first], whole[first]
                ids = batch.column(0).slice(chunk.first, chunk.n_texts).take(pa.array(owner))
                place = (at - chunk.bounds[owner]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(whole.view(np.int64)), ids, pa.array(place)], ["run", "id", "place"])

    return run


def _sources(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (run, id, place) those behind the first id of their run, with that id and place."""
    held = None  # the first row of the run that the rows so far end in
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if not batch.num_rows:
            continue
        run = batch.column("run").to_numpy()
        new = np.ones(len(run), dtype=bool)
        new[1:] = run[1:] != run[:-1]
        first = pa.array(np.flatnonzero(new)[np.cumsum(new) - 1])
        source, place = batch.column("id").take(first), batch.column("place").take(first)
        behind = pc.not_equal(batch.column("id"), source)
        found = pa.RecordBatch.from_arrays([batch.column("id"), batch.column("run"), source, place], ["id", "run", "source", "place"])
        yield found.filter(behind)
        held = batch.slice(int(first[len(run) - 1].as_py()), 1)


def factors(at: np.ndarray, source: np.ndarray, place: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greedy factors of found windows, sorted by where they start: word spans [start, end),
    and the window each opens with. A factor goes on while the next word's window is its
    source's next."""
    if not len(at):
        return at, at, at
    opens = np.ones(len(at), dtype=bool)
    opens[1:] = (np.diff(at) != 1) | (source[1:] != source[:-1]) | (np.diff(place) != 1)
    head = np.flatnonzero(opens)
    last = np.append(head[1:], len(at)) - 1
    return at[head], at[last] + window, head


def united(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted spans, those that touch or overlap made one."""
    if not len(starts):
        return starts, ends
    reach = np.maximum.accumulate(ends)
    opens = np.append(True, starts[1:] > reach[:-1])
    head = np.flatnonzero(opens)
    return starts[head], reach[np.append(head[1:], len(starts)) - 1]


class _Found:
    """The sources that documents have got for their windows."""

    def __init__(self, lists: pa.Array):
        self.lists = lists
        flat = lists.flatten()
        self.run = flat.field("run").to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)
        self.ids = flat.field("source")
        self.source = self.ids.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        self.place = flat.field("place").to_numpy(zero_copy_only=False).astype(np.int64)
        self.row = np.repeat(np.arange(len(lists)), [0 if n is None else n for n in lists.value_lengths().to_pylist()])

    def look_up(self, owner: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Per window, given its document, where its source is in ``run``, or -1."""
        n = len(self.run)
        key_owner, key_run = np.append(self.row, owner), np.append(self.run, whole)
        mine = np.append(np.zeros(n, np.int8), np.ones(len(owner), np.int8))
        sort = np.lexsort((mine, key_run, key_owner))
        key_owner, key_run, mine = key_owner[sort], key_run[sort], mine[sort]
        new = np.ones(len(sort), dtype=bool)
        new[1:] = (key_owner[1:] != key_owner[:-1]) | (key_run[1:] != key_run[:-1])
        head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(new) else sort
        out = np.full(len(owner), -1, dtype=np.int64)
        own = np.flatnonzero(mine == 1)
        listed = mine[head[own]] == 0
        out[sort[own[listed]] - n] = sort[head[own[listed]]]
        return out


def _parse(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                ids = batch.column(0).slice(chunk.first, chunk.n_texts)
                n = chunk.n_words()
                keep = np.ones(int(chunk.bounds[-1]), dtype=bool)
                nothing = np.zeros(0, dtype=np.int64)
                starts, ends, owner, s_starts, s_ends, s_owner, place = (nothing,) * 7
                named = ids.slice(0, 0)
                if batch.num_columns > 2:
                    found = _Found(batch.column(2).slice(chunk.first, chunk.n_texts))
                    at, whole = chunk.windows(window)
                    owner = np.searchsorted(chunk.bounds, at, side="right") - 1
                    hit = found.look_up(owner, whole)
                    at, owner, hit = at[hit >= 0], owner[hit >= 0], hit[hit >= 0]
                    # A gap of a window lies between texts, so that factors and spans end with them.
                    gap = np.arange(chunk.n_texts) * (window + 1)
                    starts, ends, head = factors(at + gap[owner], found.source[hit], found.place[hit], window)
                    s_starts, s_ends = united(starts, ends)
                    owner = owner[head]
                    s_owner = np.searchsorted(chunk.bounds[:-1] + gap, s_starts, side="right") - 1
                    starts, ends, s_starts, s_ends = starts - gap[owner], ends - gap[owner], s_starts - gap[s_owner], s_ends - gap[s_owner]
                    keep[ranges(s_starts, s_ends - s_starts)] = False
                    named, place = found.ids.take(pa.array(hit[head])), found.place[hit[head]]
                gone = np.bincount(s_owner, weights=s_ends - s_starts, minlength=chunk.n_texts).astype(np.int64)
                base, s_base = chunk.bounds[owner], chunk.bounds[s_owner]
                limits, s_limits = (pa.array(np.append(0, np.cumsum(np.bincount(o, minlength=chunk.n_texts))).astype(np.int32)) for o in (owner, s_owner))
                span = pa.StructArray.from_arrays([pa.array(s_starts - s_base), pa.array(s_ends - s_base)], ["start", "end"])
                factor = pa.StructArray.from_arrays([pa.array(starts - base), pa.array(ends - base), named, pa.array(place)], ["start", "end", "source", "place"])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(n.astype(np.int64)),
                        pa.array(gone),
                        pa.ListArray.from_arrays(s_limits, span),
                        pa.ListArray.from_arrays(limits, factor),
                        chunk.joined(keep).cast(pa.string()),
                    ],
                    ["id", "n_words", "n_removed", "spans", "factors", "kept"],
                )

    return run


def _hot_sources(windows: DataFrame) -> DataFrame:
    """As ``_sources``, for windows that very many documents have."""
    index = windows.groupBy("run").agg(F.min(F.struct("id", "place")).alias("low"), F.max("id").alias("high")).filter("low.id < high")
    found = windows.join(index, "run").filter("id > low.id")
    return found.select("id", "run", F.col("low.id").alias("source"), F.col("low.place").alias("place"))


def remove_repeats(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """Per document (id, n_words, n_removed, spans, factors, kept).

    ``factors`` are runs of words, end exclusive, each with the document it is copied from,
    whose id is smaller, and the word at which it starts there; ``spans`` are the
    factors united, the duplicate words; ``kept`` are the other words, joined by one space. A word
    is duplicate if a window over it also starts in a document with a smaller id, judged
    on the input.

    NULL and empty texts have no words. A NULL id is neither smaller nor larger than any
    other: such rows lose nothing and take nothing away. Rows repeated under one id do
    not take from each other and come back as often. Repeats within one document stay.
    Other columns are ignored; an empty table gives no rows. Windows are compared by
    64-bit hashes of their words.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]
    named = rows.filter("id IS NOT NULL")
    seeds = map_arrow(named.select("text"), _seeds(window), "seed bigint, n bigint")
    shared = materialise(seeds.groupBy("seed").agg(F.sum("n").alias("n")).filter("n > 1"))
    size = 1 << min(max((BITS_PER_SEED * shared.count()).bit_length(), 10), MOST_BITS)
    crowded = shared.filter(F.col("n") >= hot)
    maps = spark.sparkContext.broadcast((_bit_map(shared, size), _bit_map(crowded, size)))
    out = f"run bigint, id {kind}, place int"
    windows = map_arrow(named, _windows(window, maps, False), out).repartition("run").sortWithinPartitions("run", "id", "place")
    hits = map_arrow(windows, _sources, f"id {kind}, run bigint, source {kind}, place int")
    if not crowded.isEmpty():
        hits = hits.unionByName(_hot_sources(materialise(map_arrow(named, _windows(window, maps, True), out))))
    found = materialise(hits.groupBy("id").agg(F.collect_list(F.struct("run", "source", "place")).alias("found")))
    near, far = split_by(rows, "id", materialise(sketch(found.select("id"), "id"), files=1))
    out = (
        f"id {kind}, n_words bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>, "
        f"factors array<struct<start: bigint, end: bigint, source: {kind}, place: bigint>>, kept string"
    )
    parsed = map_arrow(near.join(found, "id", "left").select("id", "text", "found"), _parse(window), out)
    return parsed.unionByName(map_arrow(far.select("id", "text"), _parse(window), out)).withColumnRenamed("id", id_col)
