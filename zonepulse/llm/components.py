"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

#: Rows to a file of the stored tables, which are small next to the documents.
ROWS_PER_FILE = 1_000_000


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected links (a, b).

    ``component`` is the smallest node reachable. In each round every node moves to the
    neighbour, or itself, whose seeded hash is smallest, and the links are rewritten
    between the new nodes; so chains and stars both shrink by a share in each round, and
    a node with very many links is an aggregate that is combined before the shuffle. Each
    round's tables are stored in the shared folder. Loops, repeated links and NULLs are
    allowed: a link with a NULL end is none.
    """
    edges = materialise(_ordered(links.filter("a IS NOT NULL AND b IS NOT NULL")))
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    left = edges.count()
    files = 1 + 2 * left // ROWS_PER_FILE  # every table below has at most a row per end of a link
    final = materialise(nodes.withColumn("at", F.col("node")), files)
    seed = 0
    while left:
        key = lambda c: F.xxhash64(F.lit(seed), F.col(c))
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min_by("b", key("b")).alias("near"))
        move = materialise(best.select(F.col("a").alias("old"), F.when(key("near") < key("a"), F.col("near")).otherwise(F.col("a")).alias("new")), files)
        half = edges.join(move, F.col("a") == F.col("old")).select(F.col("new").alias("a"), "b")
        both = half.join(move, F.col("b") == F.col("old")).select("a", F.col("new").alias("b"))
        edges = materialise(_ordered(both), files)
        left = edges.count()
        moved = final.join(move, F.col("at") == F.col("old"), "left")
        final = materialise(moved.select("node", F.coalesce("new", "at").alias("at")), files)
        seed += 1
    least = final.groupBy("at").agg(F.min("node").alias("component"))
    return final.join(least, "at").select("node", "component")
