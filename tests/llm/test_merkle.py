"""The manifest against a plain tree in Python."""

from __future__ import annotations

import hashlib
import zlib

from pyspark.sql import functions as F

from zonepulse.llm.merkle import digest, fold, manifest, proof_text


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*fields):
    return h(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree(nodes):
    """Root, and per node the list of (left, right) siblings."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for p, path in enumerate(paths):
            i = at[p]
            run = nodes[i // 16 * 16 : i // 16 * 16 + 16]
            path.append(("".join(run[: i % 16]), "".join(run[i % 16 + 1 :])))
            at[p] = i // 16
        nodes = [h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def expected(rows):
    """{(doc_id, source, leaf): (subroot, root, path)} of unique rows (doc_id, source, leaf)."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    subs, own = [], {}
    for s in sources:
        mine = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        root, paths = tree([r[2] for r in mine])
        subs.append(root)
        own |= {r: (root, p) for r, p in zip(mine, paths, strict=True)}
    root, tops = tree(subs)
    top = dict(zip(sources, tops, strict=True))
    return {r: (sub, root, p + top[r[1]]) for r, (sub, p) in own.items()}


def found(df):
    return {(r.doc_id, r.source, r.leaf): (r.subroot, r.root, [tuple(s) for s in r.path]) for r in df.collect()}


def test_equals_a_plain_tree(spark):
    """Sources of 1, 16, 17, 256, 257 and 700 leaves, and 21 sources."""
    rows, n = [], 0
    for source, size in (("one", 1), ("b", 16), ("c", 17), ("d", 256), ("ü", 257), (None, 700), *((f"s{i}", 2) for i in range(15))):
        for _ in range(size):
            rows.append((n * 7919 % 100_003, source, h(str(n))))
            n += 1
    df = spark.createDataFrame(rows, "doc_id long, source string, leaf string").repartition(7)
    assert found(manifest(df)) == expected(rows)


def test_more_than_a_block(spark):
    rows = [(i, "big" if i % 10 else "small", h(str(i))) for i in range(9000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, leaf string").repartition(5)
    assert found(manifest(df)) == expected(rows)


def test_edges(spark, nothing):
    rows = [(None, None, "-", "x"), (None, None, "-", "y"), (1, None, "a", "p"), (1, None, "a", "q"), (2, "s", None, "z")]
    rows = [(i, s, leaf(i, s, t), k) for i, s, t, k in rows]
    df = spark.createDataFrame(rows, "doc_id long, source string, leaf string, path string").withColumn("tree", F.lit("clash"))
    got = manifest(df).select("doc_id", "source", "leaf", "subroot", "root", F.size("path").alias("n"), fold(F.col("leaf"), F.col("path")).alias("f")).collect()
    assert len(got) == 5 and all(r.f == r.root for r in got) and len({r.root for r in got}) == 1
    assert manifest(nothing.select("doc_id", "source", F.col("text").alias("leaf"))).count() == 0
    alone = manifest(spark.createDataFrame([(5, "s", "ab")], "doc_id long, source string, leaf string")).first()
    assert (alone.subroot, alone.root, alone.path) == ("ab", "ab", [])


def test_leaf_of_odd_fields(spark):
    rows = [(1, "Été", None), (None, "", "a:b"), (-3, None, "\x00\n")]
    df = spark.createDataFrame(rows, "a long, b string, c string")
    assert [r[0] for r in df.select(digest([F.col("a"), F.col("b"), F.col("c")])).collect()] == [leaf(*r) for r in rows]


def test_query_on_messy_rows(spark, messy, tmp_path):
    """The published query against the plain tree, with NULLs and long texts."""
    from zonepulse.llm.queries import op12_merkle_manifest

    messy.write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in messy.collect()}
    leaves = {i: leaf(i, r.source, r.lang, r.n_chars, r.text) for i, r in rows.items()}
    want = {k[0]: v for k, v in expected([(i, r.source, leaves[i]) for i, r in rows.items()]).items()}
    got = op12_merkle_manifest(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    tampered = 0
    for r in got:
        subroot, root, path = want[r.doc_id]
        node, doc = leaves[r.doc_id], rows[r.doc_id]
        if zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
            low = doc.text and "".join(c.lower() if "A" <= c <= "Z" else c for c in doc.text)
            node = leaf(r.doc_id, doc.source, doc.lang, doc.n_chars, low)
            tampered += node != leaves[r.doc_id]
        for left, right in path:
            node = h(left, node, right)
        assert (r.leaf, r.subroot, r.root, r.folded_root) == (leaves[r.doc_id], subroot, root, node)
        assert r.proof_sha256 == h(*(x for s in path for x in s)) and r.verified == (node == root)
    assert tampered == sum(not r.verified for r in got)


def test_proof_text(spark):
    df = spark.createDataFrame([([("a", "b"), ("", "c")],)], "path array<struct<left: string, right: string>>")
    assert df.select(proof_text(F.col("path"))).first()[0] == "abc"

