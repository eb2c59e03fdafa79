"""Merkle manifest of a dataset, its levels kept as concatenated hexadecimal strings.

Nodes of a group stand in order; sixteen consecutive ones become their parent while the
group has more than one. An aligned block of 4,096 nodes keeps each of its levels as one
string of digests, 64 characters each: fixed-width substrings of 1,024 characters, the
runs, hash to the parents, which are the next level's string, and the two substrings of a
run that flank a digest are its siblings. What remains of a block is one node of the next
round, so a tree of n leaves takes log4096(n) rounds; a task never holds more than a block.

The trees of the sources grow side by side; their roots, in order of the sources, are the
leaves of one more tree. Proofs are put together on the way down: the segments of a node
within its block, then those of the block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.shaping import derive
from ..session import materialise
from .ranks import ranked

RUN = 16
#: Nodes of a block: three levels of the tree.
BLOCK = RUN**3
DIGEST = 64

_SEGMENT = "struct<left: string, right: string>"


def digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each as byte count, colon and value, or a dash for NULL."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*(F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts)), 256)


def proof_text(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.flatten(F.transform(path, lambda s: F.array(s["left"], s["right"]))), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def _parents(level: str) -> str:
    runs = f"sequence(0, cast((length({level}) - 1) div {RUN * DIGEST} as int))"
    return f"array_join(transform({runs}, r -> sha2(substring({level}, r * {RUN * DIGEST} + 1, {RUN * DIGEST}), 256)), '')"


def _runs(level: str) -> str:
    runs = f"sequence(0, cast((length({level}) - 1) div {RUN * DIGEST} as int))"
    return f"transform({runs}, r -> substring({level}, r * {RUN * DIGEST} + 1, {RUN * DIGEST}))"


def _flanks(runs: str, i: str) -> str:
    """What stands left and right of the i-th digest of a level in its run."""
    run, at = f"{runs}[cast({i} div {RUN} as int)]", f"(({i}) % {RUN}) * {DIGEST}"
    return f"named_struct('left', substring({run}, 1, {at}), 'right', substring({run}, {at} + {DIGEST + 1}))"


def _blocks(nodes: DataFrame) -> DataFrame:
    """(tree, block, total, depth, items, level strings, top) of nodes (tree, rank, total, digest, load).

    ``depth`` is the number of levels that a tree of ``total`` nodes takes in this round.
    """
    block = F.expr(f"rank div {BLOCK}").alias("block")
    found = nodes.groupBy("tree", block, "total").agg(F.array_sort(F.collect_list(F.struct("rank", "digest", "load"))).alias("items"))
    depth = F.expr(f"CASE WHEN total <= 1 THEN 0 WHEN total <= {RUN} THEN 1 WHEN total <= {RUN**2} THEN 2 ELSE 3 END")
    found = derive(found, {"depth": depth, "level0": F.expr("array_join(transform(items, x -> x.digest), '')")})
    for k in (1, 2, 3):
        found = derive(found, {f"level{k}": F.expr(f"CASE WHEN depth >= {k} THEN {_parents(f'level{k - 1}')} ELSE level{k - 1} END")})
    return found.withColumnRenamed("level3", "top")


def _paths(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """(tree, rank, digest, load, path) of the nodes of blocks, from their blocks' paths
    (tree, rank, path) in the round above."""
    up = above.select(F.col("tree").alias("_tree"), F.col("rank").alias("_block"), F.col("path").alias("_path"))
    rows = blocks.join(up, (F.col("tree") == F.col("_tree")) & (F.col("block") == F.col("_block")))
    rows = derive(rows, {f"runs{k}": F.expr(_runs(f"level{k}")) for k in range(3)}, keep=["tree", "items", "depth", "_path"])
    steps = [f"IF(depth > {k}, array({_flanks(f'runs{k}', f'i div {RUN**k}' if k else 'i')}), cast(array() as array<{_SEGMENT}>))" for k in range(3)]
    each = f"transform(items, (x, i) -> named_struct('rank', x.rank, 'digest', x.digest, 'load', x.load, 'path', concat({', '.join(steps)}, _path)))"
    return rows.select("tree", F.inline(F.expr(each)))


def _grow(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """All rounds' blocks, and (tree, digest) of the roots."""
    rounds = []
    while True:
        blocks = materialise(_blocks(nodes))
        rounds.append(blocks)
        most = blocks.agg(F.max("total")).first()[0]
        total = F.expr(f"(total + {BLOCK - 1}) div {BLOCK}")
        nodes = blocks.select("tree", F.col("block").alias("rank"), total.alias("total"), F.col("top").alias("digest"), F.lit(None).cast("int").alias("load"))
        if most is None or most <= BLOCK:
            return rounds, nodes.select("tree", "digest")


def _descend(rounds: list[DataFrame], paths: DataFrame) -> DataFrame:
    for blocks in reversed(rounds):
        paths = _paths(blocks, paths)
    return paths


def manifest(leaves: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``leaves`` (doc_id, source, leaf) these, the columns in ``keep``, its
    ``subroot``, the ``root`` of all and the ``path`` of siblings, array of (left, right).

    Within a source leaves ascend by doc_id, NULL first; rows repeated under one id stand
    by leaf, and each is a leaf of its own. NULL is a source like any other and the first.
    Other columns are ignored; an empty table gives no rows.
    """
    rows = materialise(leaves.select("doc_id", "source", "leaf", *keep, F.monotonically_increasing_id().alias("_row")))
    sources = rows.select("source").distinct().withColumn("tree", F.lit(0))
    sources = materialise(ranked(materialise(sources), ["tree"], ["source"]).select("source", F.col("rank").alias("_tree"), F.col("total").alias("_all")))
    of = sources.select(F.col("source").alias("_source"), F.col("_tree").alias("tree"))
    numbered = materialise(rows.join(of, F.col("source").eqNullSafe(F.col("_source"))).drop("_source"))
    load = F.struct("doc_id", "source", *keep).alias("load")
    nodes = ranked(numbered, ["tree"], ["doc_id", "leaf", "_row"]).select("tree", "rank", "total", F.col("leaf").alias("digest"), load)
    rounds, roots = _grow(nodes)
    roots = roots.join(sources.select(F.col("_tree").alias("tree"), "_all"), "tree")
    tops = roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), F.col("_all").alias("total"), "digest", F.lit(None).cast("int").alias("load"))
    above, root = _grow(tops)
    end = _bare(root)
    found = root.first()
    subtrees = materialise(_descend(above, end).select(F.col("rank").alias("tree"), F.col("digest").alias("subroot"), "path"))
    starts = subtrees.select("tree", F.lit(0).cast("long").alias("rank"), "path")
    out = _descend(rounds, starts).join(subtrees.select("tree", "subroot"), "tree")
    return out.select("load.*", F.col("digest").alias("leaf"), "subroot", F.lit(found and found["digest"]).alias("root"), "path")


def _bare(roots: DataFrame) -> DataFrame:
    """The empty path of each root."""
    return roots.select("tree", F.lit(0).cast("long").alias("rank"), F.expr(f"cast(array() as array<{_SEGMENT}>)").alias("path"))
