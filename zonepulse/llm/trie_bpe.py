"""Byte-level BPE by prefix-sharing trie traversal.

For every prefix of a word the last token of its encoding is one value, and the encoding
is that of the rest before this token, followed by it. So a word's encoding is found
from its prefixes' last tokens: at each byte the longest vocabulary entry that ends
there, and may follow the last token before it, is the last token. (Two tokens may be
neighbours if BPE leaves their concatenation as these two.)

The distinct new words of a batch in sorted order are a trie in depth-first order: what
consecutive words share is the path of the trie they have in common. The walk holds the
states of one path, the last token and the longest vocabulary prefix that ends there, and
goes back to the node where the next word branches off, so the states of a shared prefix
are computed once. Runs of text that were encoded are remembered within a bound of bytes,
for the length of a task.

The file is the JSON of the tokenizers library: byte-level, without normalizer, with
special tokens that are cut out of a text before anything else.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shipping import map_arrow

#: Bytes of the runs that a worker remembers, and how many pairs of tokens.
MOST_BYTES = 64 << 20
MOST_PAIRS = 200_000
#: What a remembered run takes beside its own and its ids' characters.
ENTRY_BYTES = 200

# The byte-level pattern and the white space of Unicode.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

_PIECES = regex.compile(PIECES.replace(r"[^\s\p{L}\p{N}]", rf"[^{SPACE}\p{{L}}\p{{N}}]").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]"))
# A run without white space and the blank before it is cut alike wherever it stands; so is
# a run of letters and digits that ends before a mark, as a piece ends there.
_RUNS = re.compile(rf" ?[^\W_]+(?=[.,;:!?])| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in vocabulary files: itself where it
    is printable in Latin-1, else the next unused one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return {b: chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)}


class Vocabulary:
    """Tokens as bytes, their merges, and whether two tokens may be neighbours.

    ``states`` are the distinct prefixes of tokens, 0 the empty one. Of a state: ``edge``
    leads on by a byte (key ``state << 8 | byte``), ``fail`` is the longest shorter state it
    ends in, ``entry`` the longest state it ends in, itself included, that is a token.
    """

    def __init__(self, data: str):
        spec = json.loads(data)
        model, letters = spec["model"], byte_letters()
        back = {c: b for b, c in letters.items()}
        self.ids = {bytes(back[c] for c in t): i for t, i in model["vocab"].items() if all(c in back for c in t)}
        self.tokens = {i: t for t, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for t in spec["added_tokens"]:
            if t["lstrip"] or t["rstrip"] or t["single_word"]:
                raise ValueError("special tokens that take their surroundings are not supported")
        if spec["normalizer"] is not None or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("only byte-level files without normalizer or added space")
        #: By pair, the rank of its merge and what it becomes; by token, its rank and halves.
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.halves = {self.ids[bytes([b])]: (-1, -1, -1) for b in range(256)}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b = model["vocab"][a], model["vocab"][b]
            made = self.ids[self.tokens[a] + self.tokens[b]]
            self.merge[a, b] = (rank, made)
            if made in self.halves:
                raise ValueError("a token that two merges make is not supported")
            self.halves[made] = (rank, a, b)
        self.known: dict[int, bool] = {}
        self.width = {i: len(t) for i, t in self.tokens.items()}
        self._link()

    def _link(self) -> None:
        self.edge: dict[int, int] = {}
        self.token, above = [-1], [0]
        for t in sorted(self.ids):
            at = 0
            for byte in t:
                key = at << 8 | byte
                to = self.edge.get(key)
                if to is None:
                    to = self.edge[key] = len(self.token)
                    self.token.append(-1)
                    above.append(key)
                at = to
            if self.ids[t] in self.halves:
                self.token[at] = self.ids[t]
        depth = [0] * len(above)
        for state in range(1, len(above)):
            depth[state] = depth[above[state] >> 8] + 1
        self.fail, self.entry = [0] * len(above), [0] * len(above)
        for state in sorted(range(1, len(above)), key=depth.__getitem__):
            parent, byte = above[state] >> 8, above[state] & 255
            if parent:
                to = self.fail[parent]
                while (to << 8 | byte) not in self.edge:
                    to = self.fail[to]
                self.fail[state] = self.edge[to << 8 | byte]
            self.entry[state] = state if self.token[state] >= 0 else self.entry[self.fail[state]]
        self.size = depth

    def merged(self, data: bytes) -> list[int]:
        """BPE by its definition: merge the pair of lowest rank, leftmost first."""
        out = [self.ids[data[i : i + 1]] for i in range(len(data))]
        while len(out) > 1:
            best, at = None, -1
            for i in range(len(out) - 1):
                found = self.merge.get((out[i], out[i + 1]))
                if found is not None and (best is None or found[0] < best[0]):
                    best, at = found, i
            if best is None:
                break
            out[at : at + 2] = [best[1]]
        return out

    def _apart(self, a: int, b: int) -> bool:
        """Whether no merge reaches over the border of two tokens.

        Their merges are undone from the last on. Whenever the tokens that then touch the
        border could merge, they do so unless one of them is taken by its own side before:
        by a merge of lower rank or, of equal rank, by the one further left.
        """
        merge, halves = self.merge, self.halves
        taken = (1 << 60, 0)  # rank, and 1 if an equal rank over the border comes first
        while True:
            over = merge.get((a, b))
            if over is not None and (over[0], 0) < taken:
                return False
            left, right = halves[a], halves[b]
            if left[0] > right[0]:
                taken, a = (left[0], 0), left[2]
            elif right[0] >= 0:
                taken, b = (right[0], 1), right[1]
            else:
                return True

    def neighbours(self, a: int, b: int) -> bool:
        if len(self.known) >= MOST_PAIRS:
            self.known.clear()
        found = self.known[a << 24 | b] = self._apart(a, b)
        return found


class Trie:
    """Words in the order of their trie; ``last`` and ``states`` are those of the path walked."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.last, self.states = [-1], [0]

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Encodings of distinct words, given in sorted order: a depth-first walk."""
        v = self.vocabulary
        edge, fail, entry, token_of, size, known, neighbours = v.edge, v.fail, v.entry, v.token, v.size, v.known, v.neighbours
        last, states = self.last, self.states
        del last[1:], states[1:]
        width = v.width
        out, before_word = [], b""
        for word in words:
            shared = 0
            for x, y in zip(before_word, word, strict=False):
                if x != y:
                    break
                shared += 1
            before_word = word
            del last[shared + 1 :], states[shared + 1 :]
            state = states[shared]
            end = shared
            for byte in word[shared:]:
                end += 1
                to = edge.get(state << 8 | byte)
                while to is None:
                    state = fail[state]
                    to = edge.get(state << 8 | byte)
                state = to
                at = entry[to]
                while True:
                    token = token_of[at]
                    before = last[end - size[at]]
                    if before < 0:
                        break
                    ok = known.get(before << 24 | token)
                    if neighbours(before, token) if ok is None else ok:
                        break
                    at = entry[fail[at]]
                last.append(token)
                states.append(to)
            tokens, at = [], end
            while at:
                token = last[at]
                tokens.append(token)
                at -= width[token]
            tokens.reverse()
            out.append(tokens)
        return out


def _is_word(run: str) -> bool:
    """Letters only, but for the blank before them: one piece."""
    return run.isalpha() or (run[:1] == " " and run[1:].isalpha())


class Encoder:
    """Texts to ids, with a bounded memory of runs seen before."""

    def __init__(self, data: str):
        self.vocabulary = Vocabulary(data)
        self.trie = Trie(self.vocabulary)
        self.printed = {str(i): t for i, t in self.vocabulary.tokens.items()}
        self.printed |= {str(i): t.encode() for t, i in self.vocabulary.special.items()}
        self.special = {t: str(i) for t, i in self.vocabulary.special.items()}
        self._hold({})
        marks = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, marks)) + ")") if marks else None

    def _runs(self, text: str) -> list[str]:
        if self.cut is None or not any(m in text for m in self.special):
            return _RUNS.findall(text)
        parts = self.cut.split(text)
        return [r for i, p in enumerate(parts) for r in ([p] if i % 2 else _RUNS.findall(p))]

    def _forget(self) -> None:
        """Short runs are the frequent ones."""
        kept = {r: v for r, v in self.seen.items() if len(r) <= 6}
        self._hold(kept)
        if self.held > MOST_BYTES // 2:
            self._hold({})

    def clear(self) -> None:
        self._hold({})
        self.vocabulary.known.clear()

    def _hold(self, runs: dict[str, str]) -> None:
        """Set what is remembered: of each run its ids in decimal, which decode to the run, as is
        tried when it is learnt. A run that spells a special token was cut out of its text."""
        runs = runs | self.special
        self.seen, self.held = runs, sum(len(r) + len(v) + ENTRY_BYTES for r, v in runs.items())

    def encode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(number of ids, ids in decimal joined by commas, text decoded from them) each."""
        if self.held > MOST_BYTES:
            self._forget()
        runs = [self._runs(t) for t in texts]
        new = set().union(*runs)
        new.difference_update(self.seen)
        self._learn(list(new))
        seen = self.seen
        out = []
        for rs in runs:
            ids = ",".join(map(seen.__getitem__, rs))
            out.append((ids.count(",") + 1 if ids else 0, ids, "".join(rs)))
        return out

    def _learn(self, runs: list[str]) -> None:
        pieces = {r: [r.encode()] if _is_word(r) else [p.encode() for p in _PIECES.findall(r)] for r in runs}
        words = sorted({p for ps in pieces.values() for p in ps})
        ids = {w: ",".join(map(str, tokens)) for w, tokens in zip(words, self.trie.encode(words), strict=True)}
        for run, ps in pieces.items():
            found = ids[ps[0]] if len(ps) == 1 else ",".join(map(ids.__getitem__, ps))
            if b"".join(map(self.printed.__getitem__, found.split(","))) != run.encode():
                raise ValueError("ids do not decode to their text")
            self.seen[run] = found
            self.held += len(run) + len(found) + ENTRY_BYTES

    def decode(self, ids: str) -> str:
        """Text of decimal ids; bytes that are no UTF-8 become the replacement character."""
        return b"".join(map(self.printed.__getitem__, ids.split(","))).decode("utf-8", "replace") if ids else ""


_WORKER: dict[str, Encoder] = {}


def _encoder(data: str) -> Encoder:
    """One encoder per Python worker and vocabulary, which is of fixed size; runs are forgotten with the task."""
    key = f"{len(data)}:{hash(data)}"
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Encoder(data)
    return _WORKER[key]


def _rows(data, most_bytes: int = 512 << 10):
    def coded(encoder: Encoder, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(int(np.searchsorted(ends, before + most_bytes, side="right")), at + 1)
            part = batch.slice(at, to - at)
            found = encoder.encode([t or "" for t in part.column(1).to_pylist()])
            n, ids, decoded = zip(*found, strict=True)
            made = [pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays([part.column(0), *part.columns[2:], *made], ["id", *batch.schema.names[2:], "n_tokens", "ids", "decoded"])
            at = to

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(data.value)
        try:
            for batch in batches:
                yield from coded(encoder, batch)
        finally:  # the worker lives on and may do other work
            encoder.clear()
            pa.default_memory_pool().release_unused()

    return run


def read_vocabulary(spark: SparkSession, path: str) -> str:
    """The vocabulary file as text; its path is read on the driver only."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_texts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document (id, columns in ``keep``, n_tokens, ids, decoded); ``ids`` is decimal, joined by commas.

    ``vocabulary`` is the text of the file, a few MB, sent to each executor. NULL and
    empty texts have no ids and decode to an empty text. Ids may be NULL or repeated: rows
    are handled one by one. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    more = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"), *keep)
    data = spark.sparkContext.broadcast(vocabulary)
    return map_arrow(rows, _rows(data), f"id {kind}{more}, n_tokens bigint, ids string, decoded string").withColumnRenamed("id", id_col)
