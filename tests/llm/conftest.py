from __future__ import annotations

import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def messy_rows(seed: int = 3, n: int = 60) -> list[tuple]:
    """Small documents with copies, near copies, shared passages, blanks and NULLs."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Été", "straße", "日本", "x" * 50]
    passage = [rng.choice(words) for _ in range(20)]
    rows = []
    for i in range(n):
        kind = i % 6
        body = [rng.choice(words) for _ in range(rng.randint(1, 60))]
        if kind == 1 and rows:
            body = rows[rng.randrange(len(rows))][1].split() or ["a"]
        elif kind == 2 and rows:
            body = (rows[rng.randrange(len(rows))][1].split() or ["a"]) + ["tail"]
        elif kind == 3:
            body = body[:20] + passage + body[20:]
        gaps = [rng.choice([" ", " ", "\n", "\t ", "\r\n", "\x0b"]) for _ in body]
        text = "".join(w + g for w, g in zip(body, gaps, strict=True))
        rows.append((i * 3 % 61, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", "b", None]), len(text)))
    return rows


EDGES = [
    (100, None, None, None, None),
    (101, "", "en", "a", 0),
    (102, " \n\t ", "en", "a", 4),
    (103, "one", "en", "b", 3),
    (104, "one", "en", "b", 3),
    (105, "a b c", "de", "b", 5),
    (106, "long " * 30000, "en", "b", 150000),
    (107, "long " * 30000, "en", "b", 150000),
    (108, "nul\x00 sep    w", "en", "c", 12),
]


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows() + EDGES, COLUMNS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)
