"""The two studies: correlation by time shift, and price regression with scoring."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.months import drop_day
from ..functions.text import to_double, to_int
from ..operators.aggregates import mean_by
from ..operators.correlation import correlate_by_shift
from ..operators.joins import attach, combine, shifted
from ..schemas import (
    COMPLAINT_TOTAL,
    COUNT_COLUMNS,
    FEATURE_COLUMNS,
    LABEL,
    LISTING_NUMERIC,
    SALE_PRICE,
    TRAINING_COLUMNS,
)
from . import complaints as complaint_plan
from . import listings as listing_plan
from . import sales as sale_plan

KEYS = ["month", "zone"]
SHIFTS = list(range(7))
# Months by which neighbourhood figures run ahead of the prices they explain.
TRAINING_SHIFT = 2


def monthly_overview(listings: DataFrame, complaints: DataFrame, sales: DataFrame) -> DataFrame:
    """Per month: mean listing price, complaint total, mean unit price of sales."""
    totals = complaint_plan.counts(complaints, ["month"]).select("month", COMPLAINT_TOTAL)
    return combine(
        [mean_by(listings, ["month"], LABEL, LABEL), totals, sale_plan.mean_unit_price(sales, ["month"])],
        ["month"],
    )


def neighbourhood_profile(complaints: DataFrame, sale_means: DataFrame, shift: int = TRAINING_SHIFT) -> DataFrame:
    """Per (month, zone): the 11 complaint counts and the sale price, ``shift`` months
    earlier. One row per key; this is the table that requests are looked up in."""
    table = combine([complaint_plan.counts(complaints, KEYS), sale_means.select(*KEYS, SALE_PRICE)], KEYS)
    table = shifted(table, shift) if shift else table
    return table.select(*KEYS, *COUNT_COLUMNS, SALE_PRICE)


def correlations(
    listings: DataFrame, complaints: DataFrame, sale_means: DataFrame, shifts: list[int] = SHIFTS
) -> DataFrame:
    """Per shift: n and correlation with the sale price and with the complaint total."""
    signals = neighbourhood_profile(complaints, sale_means, shift=0)
    return correlate_by_shift(listings, signals, shifts, LABEL, [SALE_PRICE, COMPLAINT_TOTAL])


def training_frame(listings: DataFrame, profile: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per listing: 11 counts, sale price and 30 listing columns, by name.

    ``listings`` come from ``plans.listings.features``.
    """
    joined = attach(listings, profile, KEYS)
    return joined.select(*carry, *TRAINING_COLUMNS)


def request_rows(requests: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Text requests as keyed feature rows; a field that is no number stays NULL."""
    parse = {"int": to_int, "double": to_double}
    numeric = [parse[kind](F.col(c)).alias(c) for c, kind in LISTING_NUMERIC.items() if c != LABEL]
    return requests.select(
        *carry,
        drop_day("date").alias("month"),
        F.col("zip").alias("zone"),
        *listing_plan.category_slots(),
        F.lit(0.0).alias(LABEL),
        *numeric,
    )


def lookup(requests: DataFrame, profile: DataFrame) -> DataFrame:
    """Every request with its neighbourhood's figures and a ``status``."""
    found = attach(requests, profile, KEYS, how="left")
    key = F.concat(F.col("month"), F.lit("|"), F.col("zone"))
    return found.withColumn(
        "status",
        F.when(F.col(COMPLAINT_TOTAL).isNull(), F.concat(F.lit("No record for "), key)).otherwise("ok"),
    )


def score(requests: DataFrame, profile: DataFrame, model: PipelineModel, id_column: str = "request_id") -> DataFrame:
    """(id, status, prediction) of a batch of requests, in one pass.

    Requests without a record or with an unreadable field get no prediction.
    """
    looked_up = lookup(request_rows(requests, (id_column,)), profile)
    readable = ~F.greatest(*(F.col(c).isNull() for c in LISTING_NUMERIC))
    checked = looked_up.withColumn(
        "status", F.when((F.col("status") == "ok") & ~readable, F.lit("unreadable field")).otherwise(F.col("status"))
    )
    scored = model.transform(checked.na.fill(0, subset=FEATURE_COLUMNS))
    return scored.select(
        id_column, "status", F.when(F.col("status") == "ok", F.col("prediction")).alias("prediction")
    )
