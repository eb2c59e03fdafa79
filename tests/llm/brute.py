"""Plain versions of what the operators compute."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def repeats(rows, window):
    """{id: (n_words, n_removed, sha of kept)} of (id, text) rows with unique ids."""
    first = {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        w = words(text)
        for p in range(len(w) - window + 1):
            first.setdefault(tuple(w[p : p + window]), i)
    out = {}
    for i, text in rows:
        w = words(text)
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def jaccard_sets(rows, k, lower):
    out = {}
    for i, text in rows:
        if lower and text:
            text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        w = words(text)
        out[i] = {tuple(w[p : p + k]) for p in range(max(len(w) - k + 1, 1))} if w else set()
    return out


def jaccard_components(rows, k, t, lower):
    sets = jaccard_sets(rows, k, lower)
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            s, u = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if s and t[1] * s >= t[0] * u:
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}
