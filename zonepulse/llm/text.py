"""Words of texts: as columns, and as hashed arrays inside tasks.

A word is a maximal run of characters other than space, tab, line feed, vertical tab,
form feed and carriage return. All of these are single bytes in UTF-8 and no byte of a
longer character equals one, so the array form works on the bytes of a whole batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

BREAK = r"[\x20\x09-\x0D]+"

IS_BREAK = np.zeros(256, dtype=bool)
IS_BREAK[[9, 10, 11, 12, 13, 32]] = True
LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def words(text: Column) -> Column:
    """The words of a text, none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAK), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every input bit moves every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * _M1
    h ^= h >> np.uint64(27)
    h *= _M2
    h ^= h >> np.uint64(31)
    return h


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, dtype=np.uint64)
    while len(out) < n:
        step = np.uint64(pow(base, len(out), 1 << 64))
        out = np.concatenate([out, out * step])
    return out[:n]


class _Powers:
    """Powers of the hash base and of its inverse; those of longer chunks are not kept."""

    KEPT = 1 << 21
    up = _powers(_BASE, 1 << 16)
    down = _powers(_UNBASE, 1 << 16)

    @classmethod
    def cover(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) >= n:
            return cls.up, cls.down
        up, down = _powers(_BASE, n), _powers(_UNBASE, n)
        if n <= cls.KEPT:
            cls.up, cls.down = up, down
        return up, down


class Chunk:
    """Some texts with their words as 64-bit hashes.

    ``rows``    row numbers of the batch, from ``first`` on
    ``bytes``   the texts' bytes in one array
    ``starts``, ``ends``  where each word lies in it
    ``bounds``  word numbers at which texts begin, one more at the end
    ``hashes``  one value per word, worked out when asked for
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int, lower: bool):
        self.first = first
        self.bytes = data
        self.offsets = offsets
        self.n_texts = len(offsets) - 1
        inside = ~IS_BREAK[data]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        edges = offsets[:-1]
        edges = edges[edges < len(data)]
        opens[edges] = inside[edges]
        self.starts = np.flatnonzero(opens)
        closes = np.ones(len(data), dtype=bool)
        closes[:-1] = ~inside[1:] | opens[1:]
        closes &= inside
        self.ends = np.flatnonzero(closes) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        self.lower = lower

    @cached_property
    def hashes(self) -> np.ndarray:
        data = LOWER_ASCII[self.bytes] if self.lower else self.bytes
        up, down = _Powers.cover(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def n_words(self) -> np.ndarray:
        return np.diff(self.bounds)

    def joined(self, keep: np.ndarray) -> pa.Array:
        """Per text the words marked in ``keep``, one space between them."""
        starts = self.starts[keep]
        lengths = self.ends[keep] - starts + 1
        out = np.append(self.bytes, np.uint8(32))[ranges(starts, lengths)]
        after = np.cumsum(lengths)
        out[after - 1] = 32
        before = np.concatenate([[0], np.cumsum(keep)])
        counts = before[self.bounds[1:]] - before[self.bounds[:-1]]
        last = before[self.bounds[1:]][counts > 0] - 1
        out = np.delete(out, after[last] - 1)
        ends = np.concatenate([[0], after])[before[self.bounds]] - np.concatenate([[0], np.cumsum(counts > 0)])
        if ends[-1] < 1 << 31:
            return pa.StringArray.from_buffers(self.n_texts, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(out))
        return pa.LargeStringArray.from_buffers(self.n_texts, pa.py_buffer(ends), pa.py_buffer(out))

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers at which k words of one text start, and the hashes of those runs."""
        count = np.maximum(self.n_words() - k + 1, 0)
        at = ranges(self.bounds[:-1], count)
        if not len(at):
            return at, np.zeros(0, dtype=np.uint64)
        total = np.zeros(len(self.hashes) - k + 1, dtype=np.uint64)
        for j in range(k):
            total += self.hashes[j : j + len(total)] * np.uint64(pow(_BASE, 3 + 2 * j, 1 << 64))
        return at, mix(total[at])


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each pair, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, counts)


def chunks(texts: pa.Array, lower: bool = False, most_bytes: int = 1 << 20) -> Iterator[Chunk]:
    """The texts of an Arrow column in runs of about ``most_bytes``; NULL is an empty text.

    A longer text is a run of its own: texts are never cut.
    """
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        texts, kind = texts.cast(pa.string()), np.int32
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    _, where, values = texts.buffers()
    offsets = np.frombuffer(where, dtype=kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + most_bytes, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield Chunk(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], at, lower)
        at = to
