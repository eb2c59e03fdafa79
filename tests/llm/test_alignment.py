"""Fragments of token alignment against whole documents in plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from zonepulse.llm.token_alignment import Fragment, Tokenizers, Tokens, align, read_tokenizers
from zonepulse.llm.trie_bpe import byte_letters

from .test_bpe import ODD, random_texts

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FILES = read_tokenizers(A, B)


def spelt(library, model, text):
    """[(id, bytes)] of both, none if they do not spell the text."""
    back = {c: b for b, c in byte_letters().items()}
    a = [(i, bytes(back[c] for c in library.id_to_token(i))) for i in library.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in model.encode(text):
        piece = model.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(t for _, t in a) == whole == b"".join(t for _, t in b) else ([], [])


def ends(tokens):
    out, at = [], 0
    for i, t in tokens:
        out.append((i, at, at + len(t)))
        at += len(t)
    return out


def expected(texts):
    """Rows of (n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) and the groups."""
    library, model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    library.encode_special_tokens = True
    found = []
    for text in texts:
        a, b = spelt(library, model, text) if text else ([], [])
        a, b = ends(a), ends(b)
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, low = [], 0
        for cut in cuts:
            halves = (",".join(str(i) for i, _, e in side if low < e <= cut) for side in (a, b))
            groups.append("|".join(halves))
            low = cut
        links, j = [], 0
        for i, s, e in a:
            while j and b[j][1] > s:
                j -= 1
            while b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        found.append((a, b, groups, links))
    count = Counter(p for *_, links in found for p in set(links))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    rows = []
    for a, b, groups, links in found:
        text = ";".join(groups)
        n_best, total = sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links)
        rows.append((len(a), len(b), len(groups), len(links), n_best, total, hashlib.sha256(text.encode()).hexdigest() if a else "", text))
    return rows


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [None, *ODD, *random_texts(40), "same words " * 50, "same words " * 50, "▁ mark", "x▁y", "日本" * 400, "word " * 3000, " lead", "tail\n"]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("range_bytes,frequent", [(1 << 15, 1 << 19), (64, 100), (1 << 10, 0)])
def test_equals_plain_alignment(spark, frame, range_bytes, frequent):
    """Documents of one range, of a hundred, and of some; counts known, joined, and both."""
    got = align(frame, FILES, texts=True, range_bytes=range_bytes, frequent=frequent).collect()
    want = expected(TEXTS)
    assert sorted(r.doc_id for r in got) == list(range(len(TEXTS)))
    for r in got:
        assert (*(r[c] for c in COLUMNS), r.groups) == want[r.doc_id], repr(TEXTS[r.doc_id])[:80]
    assert max(w[0] for w in want) > 2000 and sum(w[0] == 0 for w in want) >= 2


def test_composition_is_associative():
    tokenizers = Tokenizers(*FILES)
    sizes = (tokenizers.a_size, tokenizers.b_size)
    rng = random.Random(1)
    text = " ".join(random_texts(6))
    a, b = tokenizers.encode(text)
    t = Tokens(a, np.cumsum(tokenizers.a_length[a]), b, np.cumsum(tokenizers.b_length[b]))
    total = int(t.a_end[-1])

    def join(parts):
        """Compose in a random tree."""
        while len(parts) > 1:
            i = rng.randrange(len(parts) - 1)
            parts[i : i + 2] = [parts[i].then(parts[i + 1], tokenizers.printed, sizes)]
        return parts[0].whole(tokenizers.printed, sizes)

    whole = join([Fragment.of(t, tokenizers.printed, sizes)])
    assert len(whole.suffix.a) == len(whole.suffix.b) == 0
    for _ in range(20):
        cuts = sorted({0, total, *(rng.randrange(total) for _ in range(rng.randrange(40)))})
        got = join([Fragment.of(t.between(x, y), tokenizers.printed, sizes) for x, y in zip(cuts, cuts[1:], strict=False)])
        assert (got.n_a, got.n_b, got.n_groups, got.n_links, got.groups) == (whole.n_a, whole.n_b, whole.n_groups, whole.n_links, whole.groups)
        assert got.pairs.tolist() == whole.pairs.tolist() and got.counts.tolist() == whole.counts.tolist()


def test_parts_of_a_text_change_nothing():
    tokenizers = Tokenizers(*FILES)
    assert tokenizers.cuts
    for text in [t for t in TEXTS if t]:
        whole, cut = tokenizers.encode(text), tokenizers.encode(text, most=7)
        assert all(x.tolist() == y.tolist() for x, y in zip(whole, cut, strict=True)), repr(text)[:80]


def test_edges(spark, messy, nothing):
    assert align(nothing, FILES).count() == 0
    docs = messy.unionByName(spark.createDataFrame([(None, "one", None, None, 0), (103, "one", None, None, 0)], messy.schema))
    got = align(docs.withColumn("row", F.lit("x")).withColumn("n_a", F.lit(1)), FILES).collect()
    assert len(got) == docs.count()
    ones = [r for r in got if r.n_a == 1 and r.doc_id in (None, 103, 104)]
    assert len(ones) == 4 and len({tuple(r)[1:] for r in ones}) == 1 and {r.count_sum for r in ones} == {4}


def test_query_on_the_given_table(spark, data):
    from zonepulse.llm.queries import op13_fragment_monoid

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    want = dict(zip((i for i, _ in rows), expected([t for _, t in rows]), strict=True))
    got = op13_fragment_monoid(spark, data).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[c] for c in COLUMNS) == want[r.doc_id][:-1]
