"""One-hot slots and the room-count fill."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import as_col


def one_hot(
    c: Column | str,
    slots: dict[str, str],
    other: str | None = None,
    ignore_case: bool = False,
    aliases: dict[str, str] | None = None,
) -> list[Column]:
    """One 0/1 int column per slot. A value outside the vocabulary sets ``other``
    when that slot is named, otherwise nothing."""
    value = as_col(c)
    for spelling, name in (aliases or {}).items():
        value = F.when(_same(value, spelling, ignore_case), F.lit(name)).otherwise(value)
    hits = [F.coalesce(_same(value, v, ignore_case), F.lit(False)) for v in slots.values()]
    columns = [hit.cast("int").alias(name) for name, hit in zip(slots, hits)]
    if other is not None:
        known = hits[0]
        for hit in hits[1:]:
            known = known | hit
        columns.append((~known).cast("int").alias(other))
    return columns


def _same(value: Column, name: str, ignore_case: bool) -> Column:
    if ignore_case:
        return F.lower(F.trim(value)) == name.lower()
    return value == name


def impute_rooms(bathrooms: str = "bathrooms", bedrooms: str = "bedrooms", beds: str = "beds") -> dict[str, Column]:
    """Fill missing room counts from each other; NULL only when all three are.

    A lone value fills the other two. With two present, bathrooms copy bedrooms,
    bedrooms copy bathrooms and beds copy bedrooms.
    """
    bath, room, bed = (F.col(c).cast("double") for c in (bathrooms, bedrooms, beds))
    full_bath = F.coalesce(bath, room, bed)
    full_room = F.coalesce(room, full_bath)
    return {bathrooms: full_bath, bedrooms: full_room, beds: F.coalesce(bed, full_room)}
