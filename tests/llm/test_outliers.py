"""Statistics and robust estimates against numpy, and the verdicts on planted junk."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from zonepulse.llm import outliers as O
from zonepulse.llm.outliers import DIMS, FLOORS, UNIT, chi2_cdf, chi2_quantile, consistency, judge, robust_estimates, text_statistics

from . import brute


def statistics(text):
    w = brute.words(text)
    n = len(w)
    runs = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = set()
    for i in range(n - 2):
        if runs[(w[i], w[i + 1], w[i + 2])] > 1:
            covered.update(range(i, i + 3))
    lines = [x for x in (text or "").split("\n") if brute.WORD.search(x)]
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_statistics(messy):
    extra = messy.sparkSession.createDataFrame([(200, "a b c\na b c\n\n \n#x$\r\na b c", "en", "a", 1), (201, "a a a a a", "en", "a", 1)], messy.schema)
    docs = messy.unionByName(extra)
    got = {r.id: tuple(r)[3:] for r in text_statistics(docs).collect()}
    assert got == {r.doc_id: statistics(r.text) for r in docs.collect()}


def test_chi_square():
    # Fixed values of the distribution.
    assert chi2_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert chi2_cdf(1.386294, 2) == pytest.approx(0.5, abs=1e-6)
    assert consistency(1 - 1e-12, 3) == pytest.approx(1, abs=1e-6)


def plain_estimate(x):
    """Concentration steps in numpy from the same starts."""
    n, p = x.shape
    floor = np.array([(FLOORS[d] * UNIT) ** 2 for d in DIMS])

    def floored(c):
        c[np.diag_indices(p)] = np.maximum(np.diag(c), floor)
        return c

    def moments(rows, factor):
        return rows.mean(0), floored(np.cov(rows.T, bias=True) * factor)

    def distances(m, c):
        return np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)

    def quantile(v, q):
        v = np.sort(v)
        return v[int(np.ceil(len(v) * q)) - 1]

    ends = []
    spread = np.array([(quantile(x[:, i], 0.75) - quantile(x[:, i], 0.25)) / 1.349 for i in range(p)])
    for m, c in [(np.array([quantile(x[:, i], 0.5) for i in range(p)]), floored(np.diag(spread**2))), moments(x, 1.0)]:
        for _ in range(O.STEPS):
            b = np.floor(np.log2(distances(m, c) + 1e-3) * O._BINS)
            cut = np.sort(b)[int(np.ceil(n * O.H_SHARE)) - 1]
            m, c = moments(x[b <= cut], consistency(O.H_SHARE, p))
        ends.append((np.linalg.slogdet(c)[1], m, c))
    _, m, c = min(ends, key=lambda e: e[0])
    return moments(x[distances(m, c) <= chi2_quantile(0.975, p)], consistency(0.975, p))


def test_estimates_equal_numpy(spark):
    rng = np.random.default_rng(5)
    frames, plain = [], {}
    for key, n in (("a", 400), ("b", 90)):
        x = np.round((rng.normal(size=(n, 5)) @ rng.normal(size=(5, 5)) + 3) * UNIT).astype(int)
        x[: n // 10] += 20 * UNIT
        plain[key] = plain_estimate(x.astype(float))
        frames += [(key, *map(int, r)) for r in x]
    rows = spark.createDataFrame(frames, "key string, " + ", ".join(f"{d} long" for d in DIMS))
    for r in robust_estimates(rows).collect():
        m, c = plain[r.key]
        low = np.array([[r[f"l_{d}_{e}"] if j <= i else 0.0 for j, e in enumerate(DIMS)] for i, d in enumerate(DIMS)])
        assert np.allclose([r[f"m_{d}"] for d in DIMS], m)
        assert np.allclose(low @ low.T, c, rtol=1e-6)
        assert np.all(np.abs(m - 3 * UNIT) < 3 * UNIT)  # the shifted tenth has no say


def prose(rng, n):
    return " ".join("".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_junk_goes_and_clean_text_stays(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.choice([60, 120, 400, 3000])), "en", "a" if i % 3 else None) for i in range(240)]
    rows += [(1000 + i, " | ".join(prose(rng, 1) for _ in range(200)), "en", "a") for i in range(12)]
    rows += [(2000, None, "en", "a"), (2001, "", None, None), (2002, "x " * 500, "en", "a"), (2003, prose(rng, 80), "fr", "rare")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, source string, d2 double")
    got = {r.doc_id: r for r in judge(docs).collect()}
    assert len(got) == len(rows)
    assert all(got[i].kept for i in range(240))
    assert not any(got[1000 + i].kept for i in range(12)) and not got[1000].base_failed
    assert all(got[i].base_failed and not got[i].kept for i in (2000, 2001, 2002))
    assert got[2003].kept and got[2003].d2 is None  # no group is large enough to judge it


def test_mild_junk_goes_from_a_clean_group(spark):
    rng = random.Random(6)
    clean = [(i, prose(rng, rng.choice([60, 120, 400])), "en", "a") for i in range(200)]
    # Clean texts with a line said twice, or a few symbols, stay.
    clean += [(300 + i, (line := prose(rng, 9)) + "\n" + prose(rng, 70) + "\n" + line, "en", "a") for i in range(8)]
    clean += [(400 + i, prose(rng, 80) + " #1 & #2", "en", "a") for i in range(4)]
    junk = []
    for i in range(6):
        phrase = prose(rng, 12)
        junk.append((1000 + i, " ".join([prose(rng, 216), *[phrase + " " + prose(rng, 1)] * 15]), "en", "a"))
        marked = prose(rng, 400).split()
        junk.append((2000 + i, " ".join("#" + w if k % 10 == 0 else w for k, w in enumerate(marked)), "en", "a"))
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in judge(docs).collect()}
    assert all(0.42 < got[1000 + i].n_repeat_words / got[1000 + i].n_words < 0.5 for i in range(6))
    assert not any(r.base_failed for r in got.values())
    assert {i for i, r in got.items() if not r.kept} == {r[0] for r in junk}


def test_reruns_and_partitions_agree(spark):
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, prose(rng, 50 + i), "en", "a") for i in range(80)], "doc_id long, text string, lang string, source string")
    one, two = (sorted(map(tuple, judge(d).collect())) for d in (docs.coalesce(1), docs.repartition(7)))
    assert one == two


def test_empty_and_plan(nothing, messy):
    assert judge(nothing).count() == 0
    assert "Python" not in judge(messy)._jdf.queryExecution().executedPlan().toString()
