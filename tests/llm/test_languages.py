"""Language identification: held-out accuracy, spans of mixed texts, the recursion itself."""

from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonepulse.llm import language_spans as L

SAMPLES = {
    "en": "the of and in to that is with which house water this from they have been would there their",
    "fr": "le la les des une est dans pour avec qui que maison être où déjà leur nous vous très aussi",
    "el": "και το να είναι που με για από στο την της του θα δεν μια σπίτι νερό αυτό έχουν",
    "ru": "и в не на что он как это по но они мы дом вода этот который был есть для",
}


def rows(n=60):
    rng = np.random.default_rng(3)
    out = []
    for i in range(n):
        lang = list(SAMPLES)[i % len(SAMPLES)]
        out.append((i, " ".join(rng.choice(SAMPLES[lang].split(), 25)), lang))
    return out


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.createDataFrame(rows(), "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def model(spark, labelled):
    return L.fit(labelled.filter(~L.held_out()), "doc_id", "text", "lang")


def test_held_out_accuracy(labelled):
    found = L.identify(labelled).join(labelled.select("doc_id", "lang"), "doc_id").filter(L.held_out())
    assert found.count() > 5 and found.filter("lang <> lang_pred OR score < 0.9").count() == 0


def test_scripts_narrow_candidates(model):
    latin, greek, cyrillic = (model.by_script[L._NAMES.index(s)] for s in ("latin", "greek", "cyrillic"))
    names = np.array(model.languages)
    assert set(names[latin]) == {"en", "fr"} and set(names[greek]) == {"el"} and set(names[cyrillic]) == {"ru"}


def test_spans_and_edges(spark, model):
    rng = np.random.default_rng(8)
    part = {k: " ".join(rng.choice(v.split(), 30)) for k, v in SAMPLES.items()}
    texts = [None, "", " \n", "123 -- 4!", part["en"] + " " + part["fr"], part["ru"] + "\n99 " + part["el"][:40], "日本語", "long " * 50000, "é"]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate([*texts, texts[4]])], "doc_id long, text string, score double")
    got = {r.doc_id: r for r in L.predict(docs, model).collect()}
    assert [(got[i].lang_pred, got[i].score, got[i].spans) for i in range(4)] == [("und", 0.0, [])] * 4
    first, second = got[4].spans
    assert (first.lang, second.lang) == ("en", "fr") and first.start == 0 and abs(first.end - 30) <= 1 and first.end == second.start and second.end == 60
    assert got[9].spans == got[4].spans
    assert [s.lang for s in got[5].spans] == ["ru", "el"] and got[5].lang_pred == "ru"
    assert got[6].lang_pred in model.languages and got[6].score == 0.0  # no language has the script
    assert got[7].lang_pred in ("en", "fr") and got[7].score == 1.0
    assert all(0 <= r.score <= 1 for r in got.values())


def test_nothing_to_learn_or_predict(spark, nothing, labelled):
    assert L.identify(nothing).count() == 0
    blank = labelled.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.identify(blank).collect()} == {"und"}
    model = L.fit(labelled.filter("lang = 'en'"), "doc_id", "text", "lang")
    assert {r.lang_pred for r in L.predict(labelled, model).collect()} == {"en"}


def test_sample_is_bounded(labelled):
    small = L.fit(labelled, "doc_id", "text", "lang", rows=8)
    assert 0 < len(small.languages) <= 4


def test_viterbi_equals_trying_all_paths():
    rng = np.random.default_rng(2)
    for penalty in (0.5, 2.0):
        bounds = np.array([0, 4, 4, 5, 11])
        scores = rng.normal(size=(11, 3))
        got = L.viterbi(scores, bounds, penalty)
        for a, b in itertools.pairwise(bounds):
            value = lambda p, a=a: sum(scores[a + i, s] for i, s in enumerate(p)) - penalty * sum(x != y for x, y in itertools.pairwise(p))
            best = max((value(p) for p in itertools.product(range(3), repeat=b - a)), default=0)
            assert value(got[a:b].tolist()) == pytest.approx(best)


def test_code_points():
    text = "aé日😀z"
    points, _ = L._code_points(np.frombuffer(text.encode(), dtype=np.uint8))
    assert points.tolist() == [ord(c) for c in text]
