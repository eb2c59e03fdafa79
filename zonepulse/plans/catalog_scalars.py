"""Scalar functions on derived dirty text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import months
from ..functions.encode import impute_rooms as room_fill
from ..functions.encode import one_hot
from ..functions.text import parse_money as money_value
from ..functions.text import parse_number
from ..schemas import (
    BOROUGH_ALIASES,
    BOROUGH_SLOTS,
    COMPLAINT_SLOTS,
    COMPLAINT_TOTAL,
    LISTING_FEATURE_COLUMNS,
    LISTING_NUMERIC,
    PROPERTY_OTHER,
    PROPERTY_SLOTS,
    ROOM_SLOTS,
)
from . import listings, roles
from .catalog import Tables, query


def _slots_sql(c: str, slots: dict[str, str], other: str | None = None) -> str:
    parts = [f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS {name}" for name, v in slots.items()]
    if other:
        names = ", ".join(f"'{v}'" for v in slots.values())
        parts.append(f"CASE WHEN {c} IN ({names}) THEN 0 ELSE 1 END AS {other}")
    return ", ".join(parts)


@query(
    """SELECT o_orderkey, o_totalprice AS price, CASE WHEN o_totalprice < 1000 THEN o_totalprice END AS price_dollar_only
    FROM orders"""
)
def parse_money(t: Tables) -> DataFrame:
    text = t.orders.selectExpr("o_orderkey", f"{roles.Spark.money('o_totalprice')} AS price")
    return text.select(
        "o_orderkey",
        money_value("price").alias("price"),
        money_value("price", strip_commas=False).alias("price_dollar_only"),
    )


@query(
    """SELECT l_orderkey, l_partkey,
    CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 7 = 0 THEN 0 WHEN l_orderkey % 5 = 0 THEN -l_extendedprice
      ELSE l_extendedprice END AS signed_value,
    CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 7 = 0 THEN 0 ELSE l_extendedprice END AS unsigned_value
    FROM lineitem"""
)
def parse_number_dirty(t: Tables) -> DataFrame:
    text = t.lineitem.selectExpr(
        "l_orderkey",
        "l_partkey",
        "CASE WHEN l_orderkey % 11 = 0 THEN ' - ' WHEN l_orderkey % 7 = 0 THEN '0' "
        "WHEN l_orderkey % 5 = 0 THEN concat('- ', format_number(l_extendedprice, 2)) "
        f"ELSE concat(' ', {roles.Spark.money('l_extendedprice')}, ' ') END AS cell",
    )
    return text.select(
        "l_orderkey",
        "l_partkey",
        parse_number("cell").alias("signed_value"),
        parse_number("cell", legacy_sign=True).alias("unsigned_value"),
    )


@query(
    """SELECT l_orderkey, l_partkey, CASE l_orderkey % 4 WHEN 0 THEN strftime(l_shipdate, '%Y-%m')
      WHEN 1 THEN '20' || strftime(l_shipdate, '%y-%m') WHEN 2 THEN '200' || substr(strftime(l_shipdate, '%Y'), 4, 1) || strftime(l_shipdate, '-%m')
      END AS month FROM lineitem"""
)
def format_month(t: Tables) -> DataFrame:
    text = t.lineitem.selectExpr(
        "l_orderkey",
        "l_partkey",
        "CASE l_orderkey % 4 WHEN 0 THEN date_format(l_shipdate, 'MM/dd/yyyy') WHEN 1 THEN date_format(l_shipdate, 'M/d/yy') "
        "WHEN 2 THEN concat(date_format(l_shipdate, 'M/d/'), substring(date_format(l_shipdate, 'yyyy'), 4, 1)) "
        "ELSE concat(date_format(l_shipdate, 'M/d/'), '123') END AS day",
    )
    return text.select("l_orderkey", "l_partkey", months.format_month("day").alias("month"))


def _order_months(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", months.month_text("o_orderdate").alias("month"))


def _moved(k: str) -> str:
    return f"strftime(date_trunc('month', o_orderdate) + to_months(CAST({k} AS INT)), '%Y-%m')"


@query(f"SELECT o_orderkey, {_moved('1')} AS month FROM orders")
def month_add(t: Tables) -> DataFrame:
    return _order_months(t).select("o_orderkey", months.next_month("month").alias("month"))


@query(f"SELECT o_orderkey, {_moved('-1')} AS month FROM orders")
def month_sub(t: Tables) -> DataFrame:
    return _order_months(t).select("o_orderkey", months.previous_month("month").alias("month"))


@query(
    f"""SELECT o_orderkey, {_moved('3')} AS lag3, {_moved('-3')} AS lead3, {_moved('o_orderkey % 25 - 12')} AS by_row FROM orders"""
)
def month_shift_k(t: Tables) -> DataFrame:
    return _order_months(t).select(
        "o_orderkey",
        months.shift_month("month", 3).alias("lag3"),
        months.shift_month("month", -3).alias("lead3"),
        months.shift_month("month", (F.col("o_orderkey") % 25 - 12).cast("int")).alias("by_row"),
    )


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def month_from_slash(t: Tables) -> DataFrame:
    text = t.orders.selectExpr(
        "o_orderkey", "date_format(o_orderdate, CASE WHEN o_orderkey % 2 = 0 THEN 'yyyy/MM' ELSE 'yyyy/MM/dd' END) AS day"
    )
    return text.select("o_orderkey", months.month_from_slash("day").alias("month"))


@query(
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m') AS month FROM events"""
)
def date_prefix(t: Tables) -> DataFrame:
    text = t.events.selectExpr("event_id", "CAST(ts AS STRING) AS stamp")
    day = text.select("event_id", months.date_prefix("stamp").alias("day"))
    return day.withColumn("month", months.drop_day("day"))


@query("SELECT l_orderkey, l_partkey, strftime(l_shipdate, '%Y/%m/%d') AS day, CAST(l_shipdate AS DATE) AS parsed FROM lineitem")
def date_reorder(t: Tables) -> DataFrame:
    text = t.lineitem.selectExpr("l_orderkey", "l_partkey", "date_format(l_shipdate, 'MM/dd/yyyy') AS us")
    return text.select(
        "l_orderkey",
        "l_partkey",
        months.reorder_us_date("us").alias("day"),
        months.parse_us_date("us").alias("parsed"),
    )


@query(
    f"""SELECT l_orderkey, l_partkey, 1 AS {COMPLAINT_TOTAL}, {_slots_sql('type', COMPLAINT_SLOTS)}
    FROM (SELECT l_orderkey, l_partkey, {roles.COMPLAINT_TYPE} AS type FROM lineitem)"""
)
def one_hot_complaint(t: Tables) -> DataFrame:
    typed = t.lineitem.selectExpr("l_orderkey", "l_partkey", f"{roles.COMPLAINT_TYPE} AS type")
    return typed.select("l_orderkey", "l_partkey", F.lit(1).alias(COMPLAINT_TOTAL), *one_hot("type", COMPLAINT_SLOTS))


@query(
    f"""SELECT listing_id, {_slots_sql('neighbourhood_group_cleansed', BOROUGH_SLOTS)} FROM ({roles.DUCK_RAW_LISTINGS})"""
)
def one_hot_region(t: Tables) -> DataFrame:
    borough = "neighbourhood_group_cleansed"
    return roles.raw_listings(t).select(
        "listing_id", *one_hot(borough, BOROUGH_SLOTS, ignore_case=True, aliases=BOROUGH_ALIASES)
    )


@query(f"SELECT listing_id, {_slots_sql('property_type', PROPERTY_SLOTS, PROPERTY_OTHER)} FROM ({roles.DUCK_RAW_LISTINGS})")
def one_hot_with_other(t: Tables) -> DataFrame:
    return roles.raw_listings(t).select("listing_id", *one_hot("property_type", PROPERTY_SLOTS, other=PROPERTY_OTHER))


@query(
    f"""SELECT request_id, {_slots_sql('room_type', {n: v.title().replace('/Apt', '/apt').replace('Home', 'home') for n, v in ROOM_SLOTS.items()})}
    FROM ({roles.DUCK_REQUESTS})"""
)
def one_hot_status(t: Tables) -> DataFrame:
    return roles.requests(t).select("request_id", *one_hot("room_type", ROOM_SLOTS, ignore_case=True))


@query(
    f"""SELECT listing_id,
    CAST(CASE WHEN bathrooms IS NOT NULL THEN bathrooms WHEN bedrooms IS NOT NULL THEN bedrooms ELSE beds END AS DOUBLE) AS bathrooms,
    CAST(CASE WHEN bedrooms IS NOT NULL THEN bedrooms WHEN bathrooms IS NOT NULL THEN bathrooms ELSE beds END AS DOUBLE) AS bedrooms,
    CAST(CASE WHEN beds IS NOT NULL THEN beds WHEN bedrooms IS NOT NULL THEN bedrooms ELSE bathrooms END AS DOUBLE) AS beds
    FROM ({roles.DUCK_RAW_LISTINGS})"""
)
def impute_rooms(t: Tables) -> DataFrame:
    rooms = roles.raw_listings(t).select("listing_id", "bathrooms", "bedrooms", "beds")
    return rooms.withColumns(room_fill())


@query(
    """SELECT page_id, url AS trimmed, CAST(length(html) AS INT) AS n_chars, substr(html, 16) AS after_doctype,
    regexp_full_match(url, 'https?://[a-z.]+/fr/.*') AS is_french FROM pages"""
)
def string_funcs(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id",
        F.trim(F.concat(F.lit("  "), "url", F.lit(" "))).alias("trimmed"),
        F.length("html").alias("n_chars"),
        F.substring("html", F.lit(16), F.length("html")).alias("after_doctype"),
        F.col("url").rlike("^https?://[a-z.]+/fr/.*$").alias("is_french"),
    )


_NUMERIC_SQL = ", ".join(LISTING_NUMERIC)


@query(
    f"""SELECT listing_id, replace(Date, '/', '-') AS month, zipcode AS zone, {_slots_sql('borough', BOROUGH_SLOTS)},
    {_slots_sql('property_type', PROPERTY_SLOTS, PROPERTY_OTHER)}, {_slots_sql('room_type', ROOM_SLOTS)}, {_NUMERIC_SQL}
    FROM ({roles.DUCK_CLEAN_LISTINGS})"""
)
def listing_features(t: Tables) -> DataFrame:
    clean = listings.clean(roles.raw_listings(t), carry=("listing_id",))
    return listings.features(clean, carry=("listing_id",)).select(
        "listing_id", "month", "zone", *LISTING_FEATURE_COLUMNS
    )
