"""Joins of listings, complaints, sales and requests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import mean_by
from ..operators.joins import absent_keys, attach, combine, shifted
from ..schemas import BOROUGH_SLOTS, COMPLAINT_TOTAL, COUNT_COLUMNS, PROPERTY_OTHER, PROPERTY_SLOTS, ROOM_SLOTS, SALE_PRICE
from ..session import scratch_path
from ..sources.writers import bucketed_table
from . import complaints, listings, roles, sales, study
from .catalog import QUERIES, Tables, query
from .catalog_scalars import _NUMERIC_SQL, _slots_sql

KEYS = study.KEYS


def _rounded(df: DataFrame, place: int = 6) -> DataFrame:
    return df.withColumn(SALE_PRICE, F.round(SALE_PRICE, place))


def _sale_means(t: Tables) -> DataFrame:
    return sales.mean_unit_price(roles.sales(t), KEYS)


def profile(t: Tables) -> DataFrame:
    """The neighbourhood table of the training study, with zip text as zone."""
    return roles.as_zip(study.neighbourhood_profile(roles.complaints(t), _sale_means(t)))


def listing_rows(t: Tables) -> DataFrame:
    clean = listings.clean(roles.raw_listings(t), carry=("listing_id",))
    return listings.features(clean, carry=("listing_id",))


def training(t: Tables, neighbourhood: DataFrame | None = None) -> DataFrame:
    table = profile(t) if neighbourhood is None else neighbourhood
    return study.training_frame(listing_rows(t), table, carry=("listing_id",))


_MONTH_TOTALS = f"SELECT month, count(*) AS all_type_complaint FROM ({roles.DUCK_COMPLAINTS}) GROUP BY 1"
_MONTH_UNIT = f"SELECT month, round({roles.DUCK_UNIT_PRICE}, 6) AS real_estate_price FROM ({roles.DUCK_SALES}) GROUP BY 1"
_MONTH_PRICE = f"SELECT month, round(avg(price), 2) AS price FROM ({roles.DUCK_LISTINGS}) GROUP BY 1"


@query(f"SELECT * FROM ({_MONTH_PRICE}) JOIN ({_MONTH_TOTALS}) USING (month) JOIN ({_MONTH_UNIT}) USING (month)")
def join_monthly_overview(t: Tables) -> DataFrame:
    overview = study.monthly_overview(roles.listings(t), roles.complaints(t), roles.sales(t))
    return _rounded(overview).withColumn("price", F.round("price", 2))


@query(
    f"""WITH c AS (SELECT month, zone, count(*) AS all_type_complaint FROM ({roles.DUCK_COMPLAINTS}) GROUP BY ALL),
    s AS (SELECT month, zone, round({roles.DUCK_UNIT_PRICE}, 6) AS real_estate_price FROM ({roles.DUCK_SALES}) GROUP BY ALL)
    SELECT listing_id, month, zone, price, all_type_complaint, real_estate_price
    FROM ({roles.DUCK_LISTINGS}) JOIN c USING (month, zone) JOIN s USING (month, zone)"""
)
def join_month_zone(t: Tables) -> DataFrame:
    totals = complaints.counts(roles.complaints(t), KEYS).select(*KEYS, COMPLAINT_TOTAL)
    per_key = combine([totals, _sale_means(t)], KEYS)
    joined = attach(roles.listings(t), per_key, KEYS)
    return _rounded(joined).select("listing_id", *KEYS, "price", COMPLAINT_TOTAL, SALE_PRICE)


@query(
    f"""WITH s AS (SELECT month, zone, round({roles.DUCK_UNIT_PRICE}, 6) AS real_estate_price FROM ({roles.DUCK_SALES}) GROUP BY ALL),
    m AS (SELECT {roles.DUCK_SHIFT.format(k=3)} AS month, zone, real_estate_price FROM s)
    SELECT listing_id, month, zone, price, real_estate_price FROM ({roles.DUCK_LISTINGS}) JOIN m USING (month, zone)"""
)
def shifted_join(t: Tables) -> DataFrame:
    """Listings beside the sale price of three months before."""
    joined = attach(roles.listings(t), shifted(_sale_means(t), 3), KEYS)
    return _rounded(joined).select("listing_id", *KEYS, "price", SALE_PRICE)


@query(
    f"""SELECT month, price, all_type_complaint, real_estate_price FROM ({_MONTH_PRICE})
    JOIN (SELECT {roles.DUCK_SHIFT.format(k=-1)} AS month, all_type_complaint FROM ({_MONTH_TOTALS})) USING (month)
    JOIN (SELECT {roles.DUCK_SHIFT.format(k=-2)} AS month, real_estate_price FROM ({_MONTH_UNIT})) USING (month)"""
)
def lead_join(t: Tables) -> DataFrame:
    """Mean listing price per month beside complaints one and sales two months later."""
    later = complaints.counts(roles.complaints(t), ["month"], shift=-1).select("month", COMPLAINT_TOTAL)
    unit = sales.mean_unit_price(roles.sales(t), ["month"], shift=-2)
    joined = combine([mean_by(roles.listings(t), ["month"], "price", "price"), later, unit], ["month"])
    return _rounded(joined).withColumn("price", F.round("price", 2))


@query(
    f"""SELECT month, zone, {', '.join(COUNT_COLUMNS)}, round(real_estate_price, 6) AS real_estate_price FROM ({roles.DUCK_PROFILE})"""
)
def neighbourhood_profile(t: Tables) -> DataFrame:
    return _rounded(profile(t))


@query(
    f"""WITH l AS (SELECT listing_id, replace(Date, '/', '-') AS month, zipcode AS zone, {_slots_sql('borough', BOROUGH_SLOTS)},
      {_slots_sql('property_type', PROPERTY_SLOTS, PROPERTY_OTHER)}, {_slots_sql('room_type', ROOM_SLOTS)}, {_NUMERIC_SQL}
      FROM ({roles.DUCK_CLEAN_LISTINGS}))
    SELECT * EXCLUDE (month, zone) REPLACE (round(real_estate_price, 6) AS real_estate_price)
    FROM l JOIN ({roles.DUCK_PROFILE}) p USING (month, zone)"""
)
def training_frame(t: Tables) -> DataFrame:
    return _rounded(training(t))


_TRAINING_SQL = QUERIES["training_frame"].sql
BUCKETS = 8


@query(_TRAINING_SQL)
def training_frame_bucketed(t: Tables) -> DataFrame:
    """``training_frame`` from two tables bucketed by the join keys: the join, which may be
    repeated for every shift or model, reads bucket beside bucket."""
    label = uuid.uuid4().hex
    path = scratch_path(t.spark, "buckets")
    tables = []
    for name, rows in (("listings", listing_rows(t)), ("profile", profile(t))):
        tables.append(bucketed_table(rows, f"{name}_{label}", KEYS, BUCKETS, f"{path}/{name}"))
    # The hint keeps small tables, as here, from being broadcast.
    return _rounded(study.training_frame(tables[0].hint("merge"), tables[1], carry=("listing_id",)))


@query(
    f"""SELECT request_id, CASE WHEN p.month IS NULL THEN 'No record for ' || r.month || '|' || r.zone ELSE 'ok' END AS status,
      all_type_complaint, round(real_estate_price, 6) AS real_estate_price
    FROM (SELECT request_id, substr(date, 1, 7) AS month, zip AS zone FROM ({roles.DUCK_REQUESTS})) r
    LEFT JOIN ({roles.DUCK_PROFILE}) p ON r.month = p.month AND r.zone = p.zone"""
)
def score_lookup_left(t: Tables) -> DataFrame:
    rows = study.request_rows(roles.requests(t), carry=("request_id",))
    looked_up = study.lookup(rows, profile(t))
    return _rounded(looked_up).select("request_id", "status", COMPLAINT_TOTAL, SALE_PRICE)


@query(
    f"""SELECT DISTINCT r.month, r.zone FROM (SELECT substr(date, 1, 7) AS month, zip AS zone FROM ({roles.DUCK_REQUESTS})) r
    WHERE NOT EXISTS (SELECT 1 FROM ({roles.DUCK_PROFILE}) p WHERE p.month = r.month AND p.zone = r.zone)"""
)
def lookup_missing_anti(t: Tables) -> DataFrame:
    return absent_keys(study.request_rows(roles.requests(t)), profile(t), KEYS)
