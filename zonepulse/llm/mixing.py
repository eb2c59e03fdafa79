"""Mixing sources to target weights by capped water-filling.

Sources get shares of a total by weight. A source is clamped where it would be repeated
more than ``max_epochs`` times, and what it cannot take is shared again by weight among
the others until none is above its limit. That fixed point is one water level: with the
sources sorted by (limit / weight), the clamped ones are a prefix, so two running sums
over one row per source give it without repeating the sharing.

A target of r times a source's size is met by floor(r) whole repetitions of every
document and one fractional repetition: in an order seeded by the document's id, as many
documents as fit are taken once more, and the one at the edge with the words still
missing. The edge is found by a radix descent over sums per (source, hash cell), so no
task ever sorts a whole source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .text import words

LEVEL_BITS = 12
LEVELS = 2
SOURCES_PER_FILE = 100_000


def water_fill(totals: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """Targets for (source, source_size), one row per source.

    Weights repeat over the sources in code-point order, the NULL source last. When all
    limits together are below the total, each source gets its limit. No rows give no
    rows; a source without words has the target 0.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.col("_place") - 1) % len(weights) + 1).cast("int"))
    rows = (
        totals.withColumn("_place", F.row_number().over(by_name))
        .withColumn("_weight", pick)
        .withColumn("_cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("_total", F.sum("source_size").over(everything) * F.lit(float(share)))
    )
    by_level = Window.orderBy(F.col("_cap") / F.col("_weight"), "_place")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.withColumn(
        "_level",
        (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(onward),
    ).withColumn("_free", F.col("_weight") * F.col("_level") < F.col("_cap"))
    level = F.min_by(F.when(F.col("_free"), F.col("_level")), F.when(F.col("_free"), F.col("_cap") / F.col("_weight"))).over(everything)
    rows = rows.withColumn("_water", level)
    target = F.when(F.col("_free"), F.col("_weight") * F.col("_water")).otherwise(F.col("_cap"))
    return rows.select("source", F.col("source_size").cast("long"), target.cast("double").alias("target"))


def _cell(level: int):
    shift = 64 - LEVEL_BITS * (level + 1)
    return F.shiftrightunsigned("mix_key", shift).bitwiseAND((1 << LEVEL_BITS) - 1).cast("int")


def mixing_plan(sized: DataFrame, **options) -> DataFrame:
    """Per source: size, target, whole repetitions and where its fractional one ends.

    ``sized`` has (source, mix_size, mix_key), one row per document.
    """
    totals = sized.groupBy("source").agg(F.sum("mix_size").alias("source_size"))
    plan = water_fill(totals, **options)
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = plan.withColumn("mix_whole", times).withColumn(
        "mix_rest", F.round(F.col("target") - F.col("mix_whole") * F.col("source_size")).cast("long")
    )
    plan = materialise(plan)
    files = 1 + plan.count() // SOURCES_PER_FILE
    for level in range(LEVELS):
        narrowed = sized
        if level:
            narrowed = sized.join(
                plan.select(F.col("source").alias("_s"), *(f"mix_cell{i}" for i in range(level))),
                F.col("source").eqNullSafe(F.col("_s")),
            ).drop("_s")
            for i in range(level):
                narrowed = narrowed.filter(_cell(i) == F.col(f"mix_cell{i}"))
        sums = narrowed.groupBy("source", _cell(level).alias("_cell")).agg(F.sum("mix_size").alias("_sum"))
        running = F.sum("_sum").over(Window.partitionBy("source").orderBy("_cell"))
        sums = sums.select(F.col("source").alias("_s"), "_cell", "_sum", running.alias("_until"))
        edge = (
            plan.join(sums, F.col("source").eqNullSafe(F.col("_s")))
            .filter(F.col("_until") > F.col("mix_rest"))
            .groupBy(F.col("_s"))
            .agg(F.min(F.struct("_cell", (F.col("_until") - F.col("_sum")).alias("_before"))).alias("_edge"))
        )
        plan = plan.join(edge, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
        plan = plan.withColumn(f"mix_cell{level}", F.coalesce(F.col("_edge._cell"), F.lit(1 << LEVEL_BITS)))
        plan = plan.withColumn("mix_rest", F.col("mix_rest") - F.coalesce(F.col("_edge._before"), F.lit(0))).drop("_edge")
        plan = materialise(plan, files)
    return plan


def mix(docs: DataFrame, size, id_col: str = "doc_id", source_col: str = "source", seed: int = 17, **options) -> DataFrame:
    """Every document with what the mix takes of it.

    Adds ``mix_size``, ``mix_source_size``, ``mix_target``, ``mix_whole`` (times the whole
    document is taken) and ``mix_part`` (words of the fractional repetition: all, none or,
    for one document per source, some). Columns of those names in the input are replaced;
    all others stay. The result depends on ids, sources and sizes only, so reruns agree.

    NULL sources are one source, the last. Texts without words have size 0 and are never
    taken. Repeated rows with one id lie side by side in the seeded order. An empty table
    gives no rows.
    """
    named = docs.drop(*(c for c in docs.columns if c.startswith("mix_")))
    keyed = named.withColumn("mix_size", size.cast("long")).withColumn("mix_key", F.xxhash64(F.lit(seed), F.col(id_col)))
    sized = materialise(keyed.select(F.col(source_col).alias("source"), "mix_size", "mix_key"))
    plan = mixing_plan(sized, **options).select(
        F.col("source").alias("mix_source"),
        F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"),
        "mix_whole",
        "mix_rest",
        *(f"mix_cell{i}" for i in range(LEVELS)),
    )
    rows = keyed.join(plan, F.col(source_col).eqNullSafe(F.col("mix_source")))
    # In the first cell that differs from the edge's, a smaller one is inside and a larger one outside.
    at_edge = F.lit(True)
    inside = F.lit(False)
    for i in range(LEVELS):
        inside = inside | (at_edge & (_cell(i) < F.col(f"mix_cell{i}")))
        at_edge = at_edge & (_cell(i) == F.col(f"mix_cell{i}"))
    rows = rows.withColumn("mix_edge", at_edge)
    settled = rows.filter(~F.col("mix_edge")).withColumn("mix_part", F.when(inside, F.col("mix_size")).otherwise(F.lit(0)).cast("long"))
    order = Window.partitionBy("mix_source").orderBy("mix_key", id_col, "mix_size")
    until = F.sum("mix_size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    part = F.least(F.col("mix_size"), F.greatest(F.lit(0), F.col("mix_rest") - (until - F.col("mix_size"))))
    edge = rows.filter("mix_edge").withColumn("mix_part", part.cast("long"))
    gone = ["mix_key", "mix_source", "mix_rest", "mix_edge", *(f"mix_cell{i}" for i in range(LEVELS))]
    return settled.unionByName(edge).drop(*gone)


def taken_words():
    return F.col("mix_whole") * F.col("mix_size") + F.col("mix_part")


def repeat_texts(mixed: DataFrame, columns: list[str], text_col: str = "text") -> DataFrame:
    """The mix itself: one row per repetition with the given columns.

    A partly taken document, one per source at most, keeps its first ``mix_part`` words,
    joined by single spaces.
    """
    whole = F.col("mix_whole") + (F.col("mix_part") == F.col("mix_size")).cast("long")
    whole = F.when(F.col("mix_size") > 0, whole).otherwise(F.lit(0))
    cut = (F.col("mix_part") > 0) & (F.col("mix_part") < F.col("mix_size"))
    nothing = F.array().cast("array<boolean>")
    kinds = F.concat(
        F.array_repeat(F.lit(False), whole.cast("int")), F.when(cut, F.array(F.lit(True))).otherwise(nothing)
    )
    leading = F.array_join(F.slice(words(F.col(text_col)), F.lit(1), F.col("mix_part").cast("int")), " ")
    rows = mixed.withColumn("mix_cut", F.explode(kinds))
    return rows.select(
        *(
            F.when(F.col("mix_cut"), leading).otherwise(F.col(text_col)).alias(text_col) if c == text_col else F.col(c)
            for c in columns
        )
    )
