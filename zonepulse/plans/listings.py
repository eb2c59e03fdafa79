"""Listing snapshots: tagged raw rows to clean rows to model features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.encode import impute_rooms, one_hot
from ..functions.months import month_from_slash
from ..functions.text import parse_money
from ..operators.quality import Rules
from ..operators.shaping import derive
from ..schemas import (
    BOROUGH_ALIASES,
    BOROUGH_SLOTS,
    LISTING_FEES,
    LISTING_MONEY,
    LISTING_NUMERIC,
    LISTING_REVIEWS,
    LISTING_ROOMS,
    LISTING_SCHEMA,
    PROPERTY_OTHER,
    PROPERTY_SLOTS,
    ROOM_SLOTS,
)

TAG = "Date"


def clean(raw: DataFrame, strip_commas: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """Raw rows with a ``Date`` tag to the 17 columns of ``LISTING_SCHEMA``.

    Rows go when a fee is missing, the zip is not five digits, all room counts are
    missing, a review score is low or missing, or anything else stays unknown.
    """
    named = raw.withColumnRenamed("neighbourhood_group_cleansed", "borough")
    usable = (
        named.filter(rules.complete(*LISTING_FEES))
        .filter(rules.five_digits("zipcode"))
        .filter(rules.some_present(*LISTING_ROOMS))
        .filter(rules.at_least(LISTING_REVIEWS))
    )
    money = {c: parse_money(c, strip_commas) for c in LISTING_MONEY}
    filled = derive(usable, {**money, **impute_rooms()})
    return filled.filter(rules.complete(*LISTING_SCHEMA.names)).select(*carry, *LISTING_SCHEMA.names)


def row_rules(strip_commas: bool = True) -> Rules:
    """The same rules as a list over raw rows, for the attrition report."""
    money = rules.every(parse_money(c, strip_commas).isNotNull() for c in LISTING_MONEY)
    others = (
        "neighbourhood_group_cleansed",
        "property_type",
        "room_type",
        "accommodates",
        "host_listings_count",
        "availability_90",
        "number_of_reviews",
        "minimum_nights",
        TAG,
    )
    return [
        ("fees present", rules.complete(*LISTING_FEES)),
        ("zip five digits", rules.five_digits("zipcode")),
        ("a room count present", rules.some_present(*LISTING_ROOMS)),
        ("review scores", rules.at_least(LISTING_REVIEWS)),
        ("nothing missing", money & rules.complete(*others)),
    ]


def keyed(listings: DataFrame, *columns: str) -> DataFrame:
    """(month, zone, ...) of clean rows."""
    return listings.select(month_from_slash(TAG).alias("month"), F.col("zipcode").alias("zone"), *columns)


def category_slots(borough: str = "borough", property_type: str = "property_type", room_type: str = "room_type"):
    """The 19 one-hot columns. Names are compared without case, so that rows from the
    listing files and from the request form share one vocabulary."""
    return [
        *one_hot(borough, BOROUGH_SLOTS, ignore_case=True, aliases=BOROUGH_ALIASES),
        *one_hot(property_type, PROPERTY_SLOTS, other=PROPERTY_OTHER, ignore_case=True),
        *one_hot(room_type, ROOM_SLOTS, ignore_case=True),
    ]


def features(listings: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(month, zone) and the 30 listing columns of the training frame."""
    numeric = [F.col(c).cast(kind).alias(c) for c, kind in LISTING_NUMERIC.items()]
    return keyed(listings, *carry, *category_slots(), *numeric)
