"""A bounded membership sketch that spares rows a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The sketch has this many bits whatever the input: 64 KiB words, about 1 MB when sent.
BITS = 1 << 22


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(5), key), F.lit(BITS))


def sketch(keys: DataFrame, key: str) -> DataFrame:
    """(word, bits) of a bit map in which every key has one bit set."""
    slot = _slot(F.col(key))
    one = F.expr("shiftleft(1L, cast(slot % 64 as int))")
    return (
        keys.select(slot.alias("slot"))
        .groupBy(F.expr("slot div 64").alias("_word"))
        .agg(F.bit_or(one).alias("_bits"))
    )


def split_by(rows: DataFrame, key: str, bitmap: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be in the sketch, and those whose key surely is not.

    The sketch is of fixed size, so it may be broadcast; a crowded one only lets more
    rows through. Rows with a NULL key are with the second kind.
    """
    slot = _slot(F.col(key))
    hit = F.expr("_bits is not null and (shiftright(_bits, cast(_slot % 64 as int)) & 1) = 1")
    marked = (
        rows.withColumn("_slot", F.when(F.col(key).isNotNull(), slot))
        .join(F.broadcast(bitmap), F.expr("_slot div 64") == F.col("_word"), "left")
        .withColumn("_hit", hit)
        .drop("_slot", "_word", "_bits")
    )
    return marked.filter("_hit").drop("_hit"), marked.filter("not _hit").drop("_hit")
