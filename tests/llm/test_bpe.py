"""Trie BPE against the tokenizers library, on odd and random texts."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from zonepulse.llm import trie_bpe
from zonepulse.llm.trie_bpe import Encoder, encode_texts, read_vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", "<|endoftext|>", "a<|endoftext|> b <|endoftext|><|endoftext|>", "<|endoftext|", "  x\n\n y\t\tz \x85w \x1c\x1d x", "it's I'LL we'll 're'd",
    "日本語テキスト 😀😀 ñandú", "1234567 12 ½ ² x²", "​﻿᠎ mixed　x y", "é ñ ः a", "a" * 5000, " " * 300 + "x", "\r\n\r\n \r\n",
    "aAbB" * 200, "\x00\x01 \x7f", "trailing  ", "ſK",
]


def random_texts(n):
    rng = random.Random(4)
    parts = "the in er on an Th ' s st re a 1 0 . , = == __ ing tion ER  ".split(" ") + [" ", "\n", "<|endoftext|>"]
    for _ in range(n):
        yield "".join(rng.choice(parts) for _ in range(rng.randrange(1, 60)))
        yield "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x300), rng.randrange(0x2000, 0x2100), rng.randrange(0x10000, 0x11000), 32, 10])) for _ in range(40))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH) as f:
        return Encoder(f.read())


def expected(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return len(ids), ",".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)


def test_equals_the_library(encoder, library):
    texts = [*ODD, *random_texts(400)]
    for text, coded in zip(texts, encoder.encode(texts), strict=True):
        assert coded == expected(library, text), repr(text)
        assert encoder.decode(coded[1]) == coded[2]


def test_trie_equals_merging_by_rank(encoder):
    words = sorted({t.replace(" ", "").encode() for t in random_texts(100)} - {b""})
    assert encoder.trie.encode(words) == [encoder.vocabulary.merged(w) for w in words]


def test_shared_prefixes_are_computed_once(encoder):
    trie = trie_bpe.Trie(encoder.vocabulary)
    trie.encode([b"token", b"tokenize", b"tokenized"])
    assert len(trie.last) == 1 + len("tokenized")


def test_memory_is_bounded_in_bytes(encoder, monkeypatch):
    """What is held before a batch is at most the bound, however long the runs are."""
    monkeypatch.setattr(trie_bpe, "MOST_BYTES", 100_000)
    for n in range(8):
        encoder.encode([f"{n}" * 60_000, " ".join(f"word{n}x{i}" for i in range(300))])
    encoder.encode(["end"])
    assert encoder.held <= 100_000 + 1000
    assert encoder.held == sum(len(r) + len(v) + trie_bpe.ENTRY_BYTES for r, v in encoder.seen.items())


def test_every_kind_of_character(encoder, library):
    """Around letters, digits, marks and blanks, a run of 50 of each 1,000 code points."""
    for low in range(0, 0x30000, 1000):
        text = "".join(f"a{chr(c)}1{chr(c)}. {chr(c)}{chr(c)}, " for c in range(low, low + 50) if not 0xD800 <= c < 0xE000)
        assert encoder.encode([text])[0] == expected(library, text), hex(low)


def test_neighbours_equal_merging(encoder):
    v, rng = encoder.vocabulary, random.Random(9)
    ids = sorted(v.halves)
    short = [i for i in ids if len(v.tokens[i]) < 3]
    for _ in range(3000):
        a, b = rng.choice(short if rng.random() < 0.7 else ids), rng.choice(short if rng.random() < 0.7 else ids)
        assert v._apart(a, b) == (v.merged(v.tokens[a] + v.tokens[b]) == [a, b])


def test_small_memories_change_nothing(encoder, library, monkeypatch):
    monkeypatch.setattr(trie_bpe, "MOST_BYTES", 3000)
    monkeypatch.setattr(trie_bpe, "MOST_PAIRS", 3)
    for text in list(random_texts(20)):
        assert encoder.encode([text])[0] == expected(library, text)


def test_frame(spark, messy, nothing, library):
    vocabulary = read_vocabulary(spark, PATH)
    assert encode_texts(nothing, vocabulary).count() == 0
    docs = messy.unionByName(spark.createDataFrame([(None, t, "en", "s", i) for i, t in enumerate(ODD)], messy.schema)).withColumn("ids", F.lit(1))
    got = encode_texts(docs, vocabulary, keep=("n_chars",)).collect()
    texts = {(r.doc_id, r.n_chars): r.text or "" for r in docs.collect()}
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_tokens, r.ids, r.decoded) == expected(library, texts[r.doc_id, r.n_chars])


