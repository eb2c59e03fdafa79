"""Language identification: script ranges, per-word scores and Viterbi spans.

Learning counts, per language, the letters of each script and hashed character n-grams of
words, over a bounded sample of labelled rows. A prediction then takes for each word the
languages that use the script of its letters, scores them by n-gram log-likelihood, and
finds the best sequence of languages over the text's words when every change costs a
penalty. Runs of one language are the spans; the text's language is the one with most
letters in its spans.

Everything on texts runs on arrays: all n-grams of some texts at once, and the Viterbi
recursion in step over texts, longest first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shipping import map_arrow
from .text import chunks

#: Labelled rows used for fitting, chosen by the hash of their ids.
SAMPLE_ROWS = 20_000
#: Bytes of text that are worked on at a time; a longer text is one piece.
CHUNK_BYTES = 512 << 10
GRAM_BITS = 15
ORDERS = (1, 2, 3, 4)
#: Cost of a change of language between two words, in nats.
PENALTY = 6.0
#: A language is a candidate for a script that has at least this share of its letters.
SCRIPT_SHARE = 0.005

# First code points of script ranges; what is not listed is no letter range.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xB5, 0xB5), (0xBA, 0xBA), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x2AF), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x373), (0x376, 0x377), (0x37B, 0x37D), (0x37F, 0x37F), (0x386, 0x386), (0x388, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x481), (0x48A, 0x52F)],
    "armenian": [(0x531, 0x556), (0x560, 0x588)],
    "hebrew": [(0x5D0, 0x5EA)],
    "arabic": [(0x620, 0x64A), (0x66E, 0x6D3), (0x750, 0x77F)],
    "indic": [(0x904, 0xDFF)],
    "thai": [(0xE01, 0xE30), (0xE40, 0xE46)],
    "georgian": [(0x10A0, 0x10FF)],
    "ethiopic": [(0x1200, 0x135A)],
    "kana": [(0x3041, 0x3096), (0x30A1, 0x30FA)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7A3)],
}
_NAMES = list(SCRIPTS)
_OTHER = len(_NAMES)  # letters of scripts that are not listed


def _script_table() -> np.ndarray:
    """Script number by code point, -1 where it is no letter; over 0x30000 nothing is one."""
    import unicodedata

    table = np.full(0x30001, -1, dtype=np.int8)
    for point in range(0x30000):
        if unicodedata.category(chr(point))[0] == "L":
            table[point] = _OTHER
    for i, name in enumerate(_NAMES):
        for low, high in SCRIPTS[name]:
            part = table[low : high + 1]
            part[part >= 0] = i
    return table


_TABLE: list[np.ndarray] = []


def script_table() -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_script_table())
    return _TABLE[0]


def _code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of valid UTF-8 and the byte at which each starts."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    first = data[lead].astype(np.int32)
    padded = np.append(data, np.zeros(3, dtype=np.uint8)).astype(np.int32) & 0x3F
    points = first.copy()
    for low, mask, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        at = np.flatnonzero(first >= low)
        value = first[at] & mask
        for j in range(1, more + 1):
            value = (value << 6) | padded[lead[at] + j]
        points[at] = value
    return points, lead


class Letters:
    """The letters of a chunk, folded, with the words they belong to."""

    def __init__(self, chunk):
        points, lead = _code_points(chunk.bytes)
        script = script_table()[np.minimum(points, 0x30000)]
        letter = np.flatnonzero(script >= 0)
        points, lead = points[letter], lead[letter]
        self.script = script[letter]
        # ASCII, Latin-1, Greek and Cyrillic capitals; others count as they are.
        upper = ((points >= 65) & (points <= 90)) | ((points >= 0xC0) & (points <= 0xDE)) | ((points >= 0x391) & (points <= 0x3AB)) | ((points >= 0x410) & (points <= 0x42F))
        points = points + 32 * upper
        self.points = points
        self.word = np.searchsorted(chunk.starts, lead, side="right") - 1
        self.n_words = len(chunk.starts)

    def grams(self) -> Iterator[np.ndarray]:
        """For each order the slot of the n-gram that ends at each letter; letters before the
        word's first one count as a blank."""
        n = len(self.points)
        code = self.points.astype(np.uint64) + np.uint64(1)
        word = self.word
        for order in ORDERS:
            total = np.zeros(n, dtype=np.uint64)
            for j in range(order):
                factor = np.uint64((0x9E3779B97F4A7C15 * (2 * j + 1)) & ((1 << 64) - 1))
                part = np.zeros(n, dtype=np.uint64)
                if j < n:
                    same = word[j:] == word[: n - j]
                    part[j:] = np.where(same, code[: n - j], 0)
                total = (total + part) * factor
                total ^= total >> np.uint64(29)
            total *= np.uint64(0xBF58476D1CE4E5B9)
            yield ((total >> np.uint64(64 - GRAM_BITS)).astype(np.int64) + (ORDERS.index(order) << GRAM_BITS))


@dataclass(frozen=True)
class Model:
    """Languages, their candidates by script and log-probabilities of n-gram slots."""

    languages: list[str]
    by_script: np.ndarray  # (scripts, languages) bool
    scores: np.ndarray  # (slots, languages) float32


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        languages = np.array(batch.column(0).to_pylist(), dtype=object)
        for chunk in chunks(batch.column(1), most_bytes=CHUNK_BYTES):
            own = languages[chunk.first : chunk.first + chunk.n_texts]
            letters = Letters(chunk)
            text = np.searchsorted(chunk.bounds, letters.word, side="right") - 1
            for language in set(own):
                mine = (own == language)[text] if len(text) else np.zeros(0, dtype=bool)
                grams, scripts = sums.setdefault(language, (np.zeros(len(ORDERS) << GRAM_BITS, np.int64), np.zeros(_OTHER + 1, np.int64)))
                scripts += np.bincount(letters.script[mine], minlength=_OTHER + 1)
                for slot in letters.grams():
                    grams += np.bincount(slot[mine], minlength=len(grams))
    for language, (grams, scripts) in sums.items():
        used = np.flatnonzero(grams)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([language] * (len(used) + len(scripts))),
                pa.array(np.concatenate([used, -1 - np.arange(len(scripts))])),
                pa.array(np.concatenate([grams[used], scripts])),
            ],
            ["lang", "slot", "n"],
        )


def fit(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int = SAMPLE_ROWS) -> Model:
    """Learn from at most ``rows`` labelled texts, those with the smallest seeded hash of
    their id; rows with NULL text or language do not count.

    The sample is bounded, so are the counters; they are summed on Spark.
    """
    known = labelled.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    picked = known.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.lit(23), F.col(id_col)).alias("_key"))
    # The bound on the key is found over keys alone, so the texts are not sorted.
    edge = picked.select("_key").orderBy("_key").limit(rows).agg(F.max("_key")).first()[0]
    if edge is None:
        return Model([], np.zeros((_OTHER + 1, 0), bool), np.zeros((len(ORDERS) << GRAM_BITS, 0), np.float32))
    sample = picked.filter(F.col("_key") <= F.lit(edge)).select("lang", "text")
    counted = map_arrow(sample, _count, "lang string, slot bigint, n bigint")
    sums = counted.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    names = sums["lang"].combine_chunks().dictionary_encode()
    languages = sorted(names.dictionary.to_pylist())
    place = np.array([languages.index(x) for x in names.dictionary.to_pylist()])[names.indices.to_numpy()]
    slot, n = sums["slot"].to_numpy(), sums["n"].to_numpy()
    grams = np.zeros((len(ORDERS) << GRAM_BITS, len(languages)))
    scripts = np.zeros((_OTHER + 1, len(languages)))
    is_gram = slot >= 0
    grams[slot[is_gram], place[is_gram]] = n[is_gram]
    scripts[-1 - slot[~is_gram], place[~is_gram]] = n[~is_gram]
    share = scripts / np.maximum(scripts.sum(0), 1)
    weight = np.repeat(np.array([0.5, 0.5, 1.0, 1.0]) / 2, 1 << GRAM_BITS)[:, None]
    smooth = grams.reshape(len(ORDERS), 1 << GRAM_BITS, -1)
    total = smooth.sum(1, keepdims=True)
    scores = np.log((smooth + 0.5) / (total + 0.5 * (1 << GRAM_BITS))).reshape(grams.shape) * weight
    scores -= scores.max(1, keepdims=True)  # only differences between languages count
    return Model(languages, share >= SCRIPT_SHARE, np.maximum(scores, -4.0).astype(np.float32))


def word_scores(letters: Letters, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores (words, languages), letters per word, and those of words whose script some
    language uses. A language that does not use the
    script of most of the word's letters is out; if none does, all stay at zero."""
    size = np.bincount(letters.word, minlength=letters.n_words)
    first = np.cumsum(size) - size
    full = np.flatnonzero(size)
    out = np.zeros((letters.n_words, len(model.languages)), dtype=np.float32)
    if not len(full):
        return out, size, size
    per_letter = np.zeros((len(letters.points), len(model.languages)), dtype=np.float32)
    for slot in letters.grams():
        per_letter += model.scores[slot]
    out[full] = np.add.reduceat(per_letter, first[full], axis=0)
    scripts = np.bincount(letters.word * (_OTHER + 1) + letters.script, minlength=letters.n_words * (_OTHER + 1))
    main = scripts.reshape(letters.n_words, -1).argmax(1)
    allowed = model.by_script[main]
    some = allowed.any(1)
    out[~some] = 0.0
    out[some[:, None] & ~allowed & (size > 0)[:, None]] = -1e4
    return out, size, size * some


def viterbi(scores: np.ndarray, bounds: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of each word when a change between neighbours costs ``penalty``.

    All texts go in step: step i takes the i-th word of every text that has one. Ties go
    to no change, then to the first language.
    """
    n, langs = scores.shape
    counts = np.diff(bounds)
    order = np.argsort(-counts, kind="stable")
    starts, lengths = bounds[:-1][order], counts[order]
    longest = int(lengths[0]) if len(lengths) else 0
    alive = np.searchsorted(-lengths, -np.arange(longest), side="left")
    best = np.zeros((len(order), langs), dtype=np.float64)
    back = np.zeros((n, langs), dtype=np.int8 if langs < 128 else np.int32)
    own = np.arange(langs)
    for i in range(longest):
        a = alive[i]
        at = starts[:a] + i
        now = best[:a]
        top = now.argmax(1)
        jump = now[np.arange(a), top] - penalty
        stay = now >= jump[:, None]
        back[at] = np.where(stay, own, top[:, None])
        best[:a] = np.where(stay, now, jump[:, None]) + scores[at]
    path = np.zeros(n, dtype=np.int64)
    state = best.argmax(1)
    for i in range(longest - 1, -1, -1):
        a = alive[i]
        at = starts[:a] + i
        path[at] = state[:a]
        state[:a] = back[at, state[:a]]
    return path


def _predict(shared, penalty: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = pa.array([*model.languages, "und"])
        langs = len(model.languages)
        for batch in batches:
            for chunk in chunks(batch.column(1), most_bytes=CHUNK_BYTES):
                letters = Letters(chunk)
                scores, size, known = word_scores(letters, model)
                n = chunk.n_texts
                owner = np.repeat(np.arange(n), chunk.n_words())
                path = viterbi(scores, chunk.bounds, penalty) if langs else np.zeros(len(owner), np.int64)
                # Words without letters belong to the span around them and count for nothing.
                share = np.bincount(owner * max(langs, 1) + path, weights=known, minlength=n * max(langs, 1)).reshape(n, -1)
                all_letters = np.bincount(owner, weights=size, minlength=n)
                pick = np.where((all_letters > 0) & (langs > 0), share.argmax(1), langs)
                sure = np.where(pick < langs, share.max(1) / np.maximum(all_letters, 1), 0.0)
                opens = np.ones(len(owner), dtype=bool)
                opens[1:] = (owner[1:] != owner[:-1]) | (path[1:] != path[:-1])
                opens &= (all_letters > 0)[owner] & (langs > 0)
                at = np.flatnonzero(opens)
                follow = np.append(at[1:], len(owner))
                end = np.minimum(follow, chunk.bounds[owner[at] + 1])
                limits = np.concatenate([[0], np.cumsum(np.bincount(owner[at], minlength=n))]).astype(np.int32)
                base = chunk.bounds[owner[at]]
                spans = pa.StructArray.from_arrays([pa.array(at - base), pa.array(end - base), names.take(pa.array(path[at]))], ["start", "end", "lang"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, n),
                        *(c.slice(chunk.first, n) for c in batch.columns[2:]),
                        names.take(pa.array(pick)),
                        pa.array(sure.astype(np.float64)),
                        pa.ListArray.from_arrays(pa.array(limits), spans),
                    ],
                    ["id", *batch.schema.names[2:], "lang_pred", "score", "spans"],
                )
            pa.default_memory_pool().release_unused()

    return run


def predict(docs: DataFrame, model: Model, penalty: float = PENALTY, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document (id, columns in ``keep``, lang_pred, score, spans): its main language, the share of its
    letters in that language's spans (letters of a script that no language uses support none), and the spans in words, end exclusive.

    NULL texts and texts without a letter are ``und`` with score 0 and no spans; so is all
    if nothing was learned. Only the text is used. Ties go to the language first by name.
    Ids may be NULL or repeated, rows are handled one by one. An empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    more = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"), *keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = f"id {kind}{more}, lang_pred string, score double, spans array<struct<start: bigint, end: bigint, lang: string>>"
    return map_arrow(rows, _predict(shared, penalty), out).withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    """A fifth of the ids, by checksum; a NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, **options) -> DataFrame:
    """Learn from the labelled documents that are not held out and predict all."""
    model = fit(docs.filter(~held_out()), "doc_id", "text", "lang")
    return predict(docs, model, **options)
