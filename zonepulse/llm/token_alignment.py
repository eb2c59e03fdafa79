"""Alignment of two tokenizers' outputs, put together from fragments.

Both tokenizations of a document spell the same bytes. Where tokens of both end, the
tokens before form a group; a token of one links with each of the other it shares bytes
with. Every link is within a group, and the shared bytes of a linked pair end where either
token does, so there are as many links as different ends.

A document is cut into byte ranges whatever the tokens; a range holds the tokens that end
in it. Its *fragment* is what it knows for sure:

    open prefix    tokens up to the first common end: their group may have begun before
    closed groups  all between the first and the last common end, summed up
    open suffix    tokens behind the last common end

A range without a common end is all prefix. Fragments compose: the left one's suffix and the right
one's prefix are one group. This is associative, so ranges of very long documents are
composed in a tree, ``FAN`` neighbours to a Spark task at a time. A document of one range
is closed where it is encoded.

The file of the first tokenizer is JSON of the tokenizers library, byte-level, whose ids
follow the order of its merges, so that they can be taken for ranks; that of the second is
a sentencepiece model that adds a space.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .shipping import map_arrow, ship
from .trie_bpe import SPACE, byte_letters

#: Bytes of a range.
RANGE_BYTES = 1 << 15
#: Fragments that a task composes.
FAN = 8
#: Characters that are encoded at a time; longer texts are encoded in parts.
MOST_CHARS = 1 << 18
#: Pairs whose counts are sent to every task, about 9 MB; the others are joined.
FREQUENT = 1 << 19
#: Pairs that a task counts before it passes them on.
COUNTED = 1 << 22

# Between two characters other than white space a single space starts a token of either kind.
_CUT = re.compile(f"(?<=[^{SPACE}▁]) (?=[^{SPACE}▁])")

_NONE = np.zeros(0, dtype=np.int64)


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, first: str, second: bytes):
        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN

        model, letters = json.loads(first)["model"], {c: b for b, c in byte_letters().items()}
        spelt = {i: bytes(letters[c] for c in t) for t, i in model["vocab"].items() if all(c in letters for c in t)}
        self.a_bytes = [spelt.get(i, b"") for i in range(max(spelt) + 1)]
        merged = ["".join(pair) if isinstance(pair, list) else pair.replace(" ", "") for pair in model["merges"]]
        if [model["vocab"][t] for t in merged] != list(range(256, 256 + len(merged))):
            raise ValueError("the first file's ids do not follow its merges, so they are no ranks")
        entries = {t: i for i, t in spelt.items()}
        self.a = tiktoken.Encoding("first", pat_str=PATTERN, mergeable_ranks=entries, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=second)
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = len(self.a_bytes), n
        self.a_length, self.b_length = (np.array([len(t) for t in ts], dtype=np.int64) for ts in (self.a_bytes, self.b_bytes))
        # Texts may be cut before a space if no piece has one behind another character.
        self.cuts = not any(re.search("[^▁]▁", p) for p in pieces)
        # Decimal ids with what may follow them: in a group, at the end of its first and of its second half.
        self.printed = [f"{i}{end}" for size, last in ((self.a_size, "|"), (n, ";")) for end in (",", last) for i in range(size)]

    def _parts(self, text: str, most: int) -> list[str]:
        """A text in parts that are encoded apart; the space between two belongs to the second."""
        out, at = [], 0
        while self.cuts and len(text) - at > most:
            found = _CUT.search(text, at + most)
            if found is None:
                break
            out.append(text[at : found.start()])
            at = found.end()
        out.append(text[at:])
        return out

    def encode(self, text: str, most: int = MOST_CHARS) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both; none if either does not spell the text with a space before it."""
        if not text:
            return _NONE, _NONE
        a, b = [], []
        for part in self._parts(text, most):
            x = self.a.encode_ordinary(" " + part)
            y = self.b.encode(part, num_threads=1) if part else []
            whole = (" " + part).encode()
            if b"".join(map(self.a_bytes.__getitem__, x)) != whole or b"".join(map(self.b_bytes.__getitem__, y)) != whole:
                return _NONE, _NONE
            a.append(np.array(x, dtype=np.int64))
            b.append(np.array(y, dtype=np.int64))
        return np.concatenate(a), np.concatenate(b)


@dataclass
class Tokens:
    """Ids and ends in bytes of consecutive tokens of both kinds."""

    a: np.ndarray = field(default_factory=lambda: _NONE)
    a_end: np.ndarray = field(default_factory=lambda: _NONE)
    b: np.ndarray = field(default_factory=lambda: _NONE)
    b_end: np.ndarray = field(default_factory=lambda: _NONE)

    def between(self, low: float, high: float) -> Tokens:
        """Those that end in (low, high]."""
        i, j = np.searchsorted(self.a_end, [low, high], side="right")
        k, m = np.searchsorted(self.b_end, [low, high], side="right")
        return Tokens(self.a[i:j], self.a_end[i:j], self.b[k:m], self.b_end[k:m])

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate([x, y]) for x, y in zip(vars(self).values(), vars(other).values(), strict=True)))


class Closed:
    """Whole groups of tokens, which may be of several documents one after the other.

    ``printed`` numbers what to print per token, in order, and ``printed_at`` where each
    group begins in it; ``ends`` and ``pairs`` are the links' last bytes and pairs.
    """

    def __init__(self, t: Tokens, a_size: int, b_size: int):
        at = np.searchsorted(t.b_end, t.a_end)
        both = t.b_end[np.minimum(at, len(t.b_end) - 1)] == t.a_end if len(t.b_end) else np.zeros(len(t.a_end), dtype=bool)
        self.cuts = t.a_end[both]
        only = np.ones(len(t.b_end), dtype=bool)
        only[at[both]] = False
        self.ends = np.sort(np.concatenate([t.a_end, t.b_end[only]]))
        self.pairs = t.a[np.searchsorted(t.a_end, self.ends)] * b_size + t.b[np.searchsorted(t.b_end, self.ends)]
        a_group, b_group = np.searchsorted(self.cuts, t.a_end), np.searchsorted(self.cuts, t.b_end)
        a_before = np.searchsorted(t.a_end, self.cuts, side="right")
        b_before = np.searchsorted(t.b_end, self.cuts, side="right")
        self.printed = np.empty(len(t.a) + len(t.b), dtype=np.int64)
        a_last, b_last = np.zeros(len(t.a), dtype=np.int64), np.zeros(len(t.b), dtype=np.int64)
        a_last[a_before - 1] = a_size
        b_last[b_before - 1] = b_size
        self.printed[np.arange(len(t.a)) + np.concatenate([[0], b_before])[a_group]] = t.a + a_last
        self.printed[np.arange(len(t.b)) + a_before[b_group]] = 2 * a_size + t.b + b_last
        self.printed_at = np.concatenate([[0], a_before + b_before])


def tallied(pairs: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs and how often each is there."""
    if counts is None:
        return np.unique(pairs, return_counts=True)
    found, where = np.unique(pairs, return_inverse=True)
    total = np.zeros(len(found), dtype=np.int64)
    np.add.at(total, where, counts)
    return found, total


@dataclass
class Fragment:
    """What a byte range of a document is known to hold."""

    n_a: int
    n_b: int
    cut: bool
    prefix: Tokens
    suffix: Tokens
    n_groups: int = 0
    n_links: int = 0
    groups: str = ""
    pairs: np.ndarray = field(default_factory=lambda: _NONE)
    counts: np.ndarray = field(default_factory=lambda: _NONE)

    @staticmethod
    def of(t: Tokens, printed: list[str], sizes: tuple[int, int]) -> Fragment:
        common = np.intersect1d(t.a_end, t.b_end, assume_unique=True)
        if not len(common):
            return Fragment(len(t.a), len(t.b), False, t, Tokens())
        low, high = common[0], common[-1]
        out = Fragment(len(t.a), len(t.b), True, t.between(-1, low), t.between(high, np.inf))
        out._close(t.between(low, high), printed, sizes)
        return out

    def _close(self, t: Tokens, printed: list[str], sizes: tuple[int, int], first: bool = False) -> None:
        """Sum up whole groups behind those closed so far, or before them."""
        if not len(t.a):
            return
        found = Closed(t, *sizes)
        text = "".join(map(printed.__getitem__, found.printed.tolist()))[:-1]
        self._add(len(found.cuts), len(found.ends), text, *tallied(found.pairs), first=first)

    def _add(self, n_groups: int, n_links: int, groups: str, pairs: np.ndarray, counts: np.ndarray, first: bool = False) -> None:
        self.n_groups += n_groups
        self.n_links += n_links
        both = (groups, self.groups) if first else (self.groups, groups)
        self.groups = ";".join(g for g in both if g)
        self.pairs, self.counts = tallied(np.concatenate([self.pairs, pairs]), np.concatenate([self.counts, counts]))

    def then(self, right: Fragment, printed: list[str], sizes: tuple[int, int]) -> Fragment:
        """This fragment and the one behind it. Associative."""
        n_a, n_b = self.n_a + right.n_a, self.n_b + right.n_b
        if not right.cut:
            if not self.cut:
                return Fragment(n_a, n_b, False, self.prefix + right.prefix, Tokens())
            return Fragment(n_a, n_b, True, self.prefix, self.suffix + right.prefix, self.n_groups, self.n_links, self.groups, self.pairs, self.counts)
        if not self.cut:
            return Fragment(n_a, n_b, True, self.prefix + right.prefix, right.suffix, right.n_groups, right.n_links, right.groups, right.pairs, right.counts)
        out = Fragment(n_a, n_b, True, self.prefix, right.suffix, self.n_groups, self.n_links, self.groups, self.pairs, self.counts)
        out._close(self.suffix + right.prefix, printed, sizes)
        out._add(right.n_groups, right.n_links, right.groups, right.pairs, right.counts)
        return out

    def whole(self, printed: list[str], sizes: tuple[int, int]) -> Fragment:
        """The fragment of a whole document: its start and its end are common."""
        out = Fragment(self.n_a, self.n_b, True, Tokens(), Tokens(), self.n_groups, self.n_links, self.groups, self.pairs, self.counts)
        out._close(self.prefix, printed, sizes, first=True)
        return out


_OPEN = ["prefix_a", "prefix_a_end", "prefix_b", "prefix_b_end", "suffix_a", "suffix_a_end", "suffix_b", "suffix_b_end"]
_FIELDS = {
    "row": "bigint", "part": "bigint", "parts": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint",
    "groups": "string", "groups_sha256": "string", "pairs": "array<bigint>", "counts": "array<bigint>", "cut": "boolean", **{c: "array<bigint>" for c in _OPEN},
}
_SCHEMA = ", ".join(f"{c} {t}" for c, t in _FIELDS.items())
_ARROW = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64())}


def _row(f: Fragment, row: int, part: int, parts: int) -> dict:
    tokens = [*vars(f.prefix).values(), *vars(f.suffix).values()]
    return {
        "row": row, "part": part, "parts": parts, "n_a": f.n_a, "n_b": f.n_b, "n_groups": f.n_groups, "n_links": f.n_links, "groups": f.groups,
        "groups_sha256": None, "pairs": f.pairs, "counts": f.counts, "cut": f.cut, **dict(zip(_OPEN, tokens, strict=True)),
    }


def _fragment(r: dict) -> Fragment:
    got = [np.asarray(r[c], dtype=np.int64) for c in _OPEN]
    pairs, counts = (np.asarray(r[c], dtype=np.int64) for c in ("pairs", "counts"))
    return Fragment(r["n_a"], r["n_b"], r["cut"], Tokens(*got[:4]), Tokens(*got[4:]), r["n_groups"], r["n_links"], r["groups"], pairs, counts)


def _digest(groups: str) -> str:
    return hashlib.sha256(groups.encode()).hexdigest() if groups else ""


_WORKER: dict[tuple, Tokenizers] = {}


def _tokenizers(files) -> Tokenizers:
    """One of each per Python worker; they are of fixed size."""
    key = tuple((len(f), hash(f)) for f in files)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Tokenizers(*files)
    return _WORKER[key]


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))


def _closed_rows(rows: list[int], coded: list[tuple[np.ndarray, np.ndarray]], tokenizers: Tokenizers, texts: bool) -> pa.RecordBatch:
    """Whole documents of a range each, closed all at once: a document's end is a common one."""
    n = len(rows)
    n_a, n_b = (np.array([len(c[k]) for c in coded], dtype=np.int64) for k in (0, 1))
    a, b = (np.concatenate([c[k] for c in coded]) for k in (0, 1))
    t = Tokens(a, np.cumsum(tokenizers.a_length[a]), b, np.cumsum(tokenizers.b_length[b]))
    last = np.concatenate([[0], np.cumsum(tokenizers.a_length[a])])[np.cumsum(n_a)]
    groups = np.zeros(n, dtype=np.int64)
    pairs, counts, owner, shown = _NONE, _NONE, _NONE, [""] * n
    links = np.zeros(n, dtype=np.int64)
    if len(a):
        found = Closed(t, tokenizers.a_size, tokenizers.b_size)
        to = np.searchsorted(found.cuts, last, side="right")
        groups = np.diff(to, prepend=0)
        of = np.searchsorted(last, found.ends)
        links = np.bincount(of, minlength=n)
        span = tokenizers.a_size * tokenizers.b_size
        keys, counts = np.unique(of * span + found.pairs, return_counts=True)
        owner, pairs = keys // span, keys % span
        where = found.printed_at[np.concatenate([[0], to])]
        printed = tokenizers.printed
        shown = ["".join(map(printed.__getitem__, found.printed[i:j].tolist()))[:-1] for i, j in zip(where[:-1], where[1:], strict=True)]
    sizes = np.bincount(owner, minlength=n) if len(owner) else np.zeros(n, dtype=np.int64)
    nothing = pa.array([[]] * n, pa.list_(pa.int64()))
    columns = {
        "row": pa.array(rows, pa.int64()), "part": pa.array(np.zeros(n, dtype=np.int64)), "parts": pa.array(np.ones(n, dtype=np.int64)),
        "n_a": pa.array(n_a), "n_b": pa.array(n_b), "n_groups": pa.array(groups), "n_links": pa.array(links),
        "groups": pa.array(shown if texts else [None] * n, pa.string()), "groups_sha256": pa.array([_digest(g) for g in shown]),
        "pairs": _lists(pairs, sizes), "counts": _lists(counts.astype(np.int64), sizes), "cut": pa.array([True] * n), **{c: nothing for c in _OPEN},
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _fragments(files, range_bytes: int, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = _tokenizers(files.value)
        sizes = (tokenizers.a_size, tokenizers.b_size)
        schema = pa.schema([(c, _ARROW[t]) for c, t in _FIELDS.items()])
        for batch in batches:
            ids, numbers = batch.column(0), batch.column(1).to_pylist()

            def named(found: pa.RecordBatch, at: list[int]) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), *found.cast(schema).columns], ["id", *schema.names])  # noqa: B023

            rows, coded, held = [], [], 0
            for i, text in enumerate(batch.column(2)):
                a, b = tokenizers.encode(text.as_py() or "")
                end = int(tokenizers.a_length[a].sum())
                if end > range_bytes:
                    t = Tokens(a, np.cumsum(tokenizers.a_length[a]), b, np.cumsum(tokenizers.b_length[b]))
                    parts = -(-end // range_bytes)
                    for part in range(parts):
                        f = Fragment.of(t.between(part * range_bytes, (part + 1) * range_bytes), tokenizers.printed, sizes)
                        yield named(pa.RecordBatch.from_pylist([_row(f, numbers[i], part, parts)], schema), [i])
                    continue
                rows.append(i)
                coded.append((a, b))
                held += len(a)
                if held > 1 << 18:
                    yield named(_closed_rows([numbers[r] for r in rows], coded, tokenizers, texts), rows)
                    rows, coded, held = [], [], 0
            if rows:
                yield named(_closed_rows([numbers[r] for r in rows], coded, tokenizers, texts), rows)

    return run


def _composed(files, texts: bool):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        tokenizers = _tokenizers(files.value)
        sizes = (tokenizers.a_size, tokenizers.b_size)
        whole = None
        ordered = rows.sort_values("part").to_dict("records")
        for r in ordered:
            f = _fragment(r)
            whole = f if whole is None else whole.then(f, tokenizers.printed, sizes)
        parts = -(-ordered[0]["parts"] // FAN)
        if parts == 1:
            whole = whole.whole(tokenizers.printed, sizes)
        out = _row(whole, key[0], key[1], parts)
        if parts == 1:
            out["groups_sha256"] = _digest(whole.groups)
            if not texts:
                out["groups"] = None
        return pd.DataFrame([out], columns=list(_FIELDS))

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents hold each pair, summed up over many documents at a time."""

    def out(pairs: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts.astype(np.int64))], ["pair", "n"])

    held, most = (_NONE, _NONE), COUNTED
    for batch in batches:
        lists = batch.column(0)
        pairs = lists.flatten().to_numpy(zero_copy_only=False)
        held = tallied(np.concatenate([held[0], pairs]), np.concatenate([held[1], np.ones(len(pairs), dtype=np.int64)]))
        if len(held[0]) > most:
            yield out(*held)
            held = (_NONE, _NONE)
    yield out(*held)


def _looked_up(known):
    """Sums over the links whose counts are known; the other pairs go on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = known.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("counts")
            n = len(lists)
            sizes = np.diff(lists.offsets.to_numpy())
            code, links = lists.flatten().to_numpy(zero_copy_only=False), times.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(n), sizes)
            at = np.minimum(np.searchsorted(pairs, code), max(len(pairs) - 1, 0))
            hit = pairs[at] == code if len(pairs) else np.zeros(len(code), dtype=bool)
            total, most = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
            np.add.at(total, owner[hit], links[hit] * counts[at[hit]])
            np.add.at(most, owner[hit], links[hit] * best[at[hit]])
            rest = np.bincount(owner[~hit], minlength=n)
            kept = [batch.column(c) for c in batch.schema.names if c not in ("pairs", "counts")]
            names = [c for c in batch.schema.names if c not in ("pairs", "counts")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(most), pa.array(total), _lists(code[~hit], rest), _lists(links[~hit], rest)], [*names, "n_best", "count_sum", "pairs", "counts"]
            )

    return run


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """(pair, n, best): documents that hold a pair linked, and whether no pair of its first id has more."""
    partial = map_arrow(aligned.select("pairs"), _counted, "pair bigint, n bigint")
    counts = materialise(partial.groupBy("pair").agg(F.sum("n").alias("n")))
    first = F.expr(f"pair div {b_size}")
    most = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))  # a row per id of the vocabulary
    found = counts.withColumn("a", first).join(F.broadcast(most), "a")
    return materialise(found.select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def read_tokenizers(first: str, second: str) -> tuple[str, bytes]:
    """Both files, a few MB; their paths are read on the driver only."""
    with open(first, encoding="utf-8") as f, open(second, "rb") as g:
        return f.read(), g.read()


def align(
    docs: DataFrame, files: tuple[str, bytes], id_col: str = "doc_id", text_col: str = "text", texts: bool = False, range_bytes: int = RANGE_BYTES, frequent: int = FREQUENT
) -> DataFrame:
    """Per document (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and ``groups`` with ``texts``).

    ``groups`` lists decimal ids, of the first tokenizer and behind a bar of the second, by
    group. A pair's count is the number of rows that hold it linked; ``n_best`` counts the
    links whose pair has the highest count of all pairs of its first id, ties too, and
    ``count_sum`` adds up the counts of all links.

    NULL and empty texts have no tokens, nor have texts that either tokenizer does not
    spell with a space before them; their numbers are zero and their digest is empty.
    Ids may be NULL or repeated: each row is a document. Other columns are ignored; an
    empty table gives no rows. A text is encoded in parts of about ``MOST_CHARS``, cut where
    neither tokenizer sees a difference; only one without such a place is encoded at once.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(files)
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    fragments = materialise(map_arrow(rows, _fragments(sent, range_bytes, texts), f"id {kind}, {_SCHEMA}"))
    ids, fragments = fragments.filter("part = 0").select("row", "id"), fragments.drop("id")
    done = fragments.filter("parts = 1")
    longer, most = fragments.filter("parts > 1"), fragments.agg(F.max("parts")).first()[0] or 0
    while most > 1:
        keys = ["row", F.expr(f"part div {FAN}").alias("part")]
        longer = longer.groupBy(*keys).applyInPandas(_composed(sent, texts), _SCHEMA)
        most = -(-most // FAN)
        longer = materialise(longer)
        done = done.unionByName(longer.filter("parts = 1"))
        longer = longer.filter("parts > 1")
    b_size = Tokenizers(*files).b_size
    counts = pair_counts(done, b_size)
    known = counts.orderBy(F.desc("n"), "pair").limit(frequent).orderBy("pair").toArrow()
    known = spark.sparkContext.broadcast(tuple(known[c].to_numpy().astype(np.int64) for c in ("pair", "n", "best")))
    kept = ["row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", *(["groups"] if texts else [])]
    schema = ", ".join(f"{c} {_FIELDS[c]}" for c in kept)
    sums = map_arrow(done.select(*kept, "pairs", "counts"), _looked_up(known), f"{schema}, n_best bigint, count_sum bigint, pairs array<bigint>, counts array<bigint>")
    sums = materialise(sums)
    rare = sums.select("row", F.inline(F.arrays_zip("pairs", "counts"))).join(counts.withColumnRenamed("pairs", "pair"), F.col("pairs") == F.col("pair"))
    rare = rare.groupBy("row").agg(F.sum(F.col("counts") * F.col("n")).alias("_sum"), F.sum(F.when(F.col("best"), F.col("counts")).otherwise(0)).alias("_best"))
    out = sums.join(rare, "row", "left").join(ids, "row")
    return out.select(
        F.col("id").alias(id_col),
        *(F.col(c) for c in kept[1:5]),
        (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"),
        *(F.col(c) for c in kept[5:]),
    )
