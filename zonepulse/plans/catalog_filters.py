"""Data-quality filters, audits and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import csv_record
from ..operators import aggregates, quality
from ..session import materialise
from . import complaints, listings, roles, sales
from .catalog import Tables, query

# Text cells with the usual defects, the same expression in both dialects.
LINE = """(CASE WHEN o_orderkey % 13 = 0 THEN CAST(o_orderkey AS STRING)
  ELSE CAST(o_orderkey AS STRING) || ',"' || o_orderpriority || ', x",' || CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderstatus END END)"""
CELLS = {
    "number": "CASE WHEN o_orderkey % 11 = 0 THEN 'N/A' WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(o_custkey AS STRING) END",
    "zip": "CASE o_orderkey % 5 WHEN 0 THEN ' ' WHEN 1 THEN '1001' WHEN 2 THEN '10001-2345' ELSE CAST(10000 + o_custkey % 25 AS STRING) END",
    "amount": "CASE WHEN o_orderkey % 17 = 0 THEN '1d' WHEN o_orderkey % 3 = 0 THEN '12.' ELSE CAST(o_custkey AS STRING) || '.25' END",
}
DUCK_CELLS = f"SELECT o_orderkey, {roles.columns_sql(CELLS)} FROM orders"


def _cells(t: Tables) -> DataFrame:
    return t.orders.selectExpr("o_orderkey", *roles.columns_spark(CELLS))


@query(f"SELECT o_orderkey, {LINE} AS line FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey % 5 <> 0")
def filter_column_count(t: Tables) -> DataFrame:
    lines = t.orders.selectExpr("o_orderkey", f"{LINE} AS line")
    return lines.filter(rules.fits(csv_record("line", 3)))


@query(f"SELECT * FROM ({DUCK_CELLS}) WHERE number <> '' AND zip <> '' AND amount <> ''")
def filter_required_nonempty(t: Tables) -> DataFrame:
    return _cells(t).filter(rules.required("number", "zip", "amount"))


@query(f"SELECT * FROM ({DUCK_CELLS}) WHERE regexp_full_match(number, '[0-9]+') AND TRY_CAST(number AS INT) IS NOT NULL")
def filter_int_castable(t: Tables) -> DataFrame:
    return _cells(t).filter(rules.ints("number"))


@query(f"SELECT * FROM ({DUCK_CELLS}) WHERE amount <> '1d'")
def filter_double_castable(t: Tables) -> DataFrame:
    return _cells(t).filter(rules.doubles("amount"))


@query(f"SELECT first, zip, price FROM ({roles.DUCK_RAW_SALES}) WHERE first <> 'BOROUGH'")
def filter_numeric_first_cell(t: Tables) -> DataFrame:
    return sales.sheet_rows(roles.raw_sales(t)).selectExpr("c0 AS first", "c10 AS zip", "c19 AS price")


@query(f"SELECT zip, area, price, date FROM ({roles.DUCK_RAW_SALES}) WHERE first <> 'BOROUGH' AND split_part(date, '/', 3) = '00'")
def filter_date_suffix(t: Tables) -> DataFrame:
    return sales.select_cells(sales.sheet_rows(roles.raw_sales(t), only_year="00"))


@query(
    """SELECT * FROM (SELECT l_orderkey, l_quantity * (l_orderkey % 3 - 1) AS area, l_extendedprice * (l_partkey % 4 - 1) AS price
    FROM lineitem) WHERE area > 0 AND price > 0"""
)
def filter_positive(t: Tables) -> DataFrame:
    signed = t.lineitem.selectExpr(
        "l_orderkey", "l_quantity * (l_orderkey % 3 - 1) AS area", "l_extendedprice * (l_partkey % 4 - 1) AS price"
    )
    return signed.filter(rules.positive("area", "price"))


@query(f"SELECT o_orderkey, zip FROM ({DUCK_CELLS}) WHERE length(zip) = 5")
def filter_length(t: Tables) -> DataFrame:
    return _cells(t).select("o_orderkey", "zip").filter(rules.text_length("zip", 5))


@query(f"SELECT o_orderkey, zip FROM ({DUCK_CELLS}) WHERE regexp_full_match(zip, '[0-9]{{5}}')")
def filter_regex_full(t: Tables) -> DataFrame:
    return _cells(t).select("o_orderkey", "zip").filter(rules.five_digits("zip"))


@query(f"SELECT listing_id, zipcode FROM ({roles.DUCK_RAW_LISTINGS}) WHERE zipcode IS NOT NULL AND trim(zipcode) <> ''")
def filter_sql_string(t: Tables) -> DataFrame:
    return roles.raw_listings(t).select("listing_id", "zipcode").filter("zipcode != ' '")


@query(
    f"""SELECT listing_id, cleaning_fee, security_deposit, extra_people FROM ({roles.DUCK_RAW_LISTINGS})
    WHERE NOT (cleaning_fee IS NULL OR security_deposit IS NULL OR extra_people IS NULL)"""
)
def filter_any_null(t: Tables) -> DataFrame:
    fees = ["cleaning_fee", "security_deposit", "extra_people"]
    return roles.raw_listings(t).select("listing_id", *fees).na.drop(how="any", subset=fees)


@query(
    f"""SELECT listing_id, bathrooms, bedrooms, beds FROM ({roles.DUCK_RAW_LISTINGS})
    WHERE NOT (bathrooms IS NULL AND bedrooms IS NULL AND beds IS NULL)"""
)
def filter_all_null(t: Tables) -> DataFrame:
    rooms = ["bathrooms", "bedrooms", "beds"]
    return roles.raw_listings(t).select("listing_id", *rooms).na.drop(how="all", subset=rooms)


@query(
    f"""SELECT listing_id, review_scores_location, review_scores_accuracy, review_scores_rating
    FROM ({roles.DUCK_RAW_LISTINGS})
    WHERE NOT (review_scores_location < 5 OR review_scores_accuracy < 5 OR review_scores_rating < 50)"""
)
def filter_threshold_3vl(t: Tables) -> DataFrame:
    minimum = {"review_scores_location": 5, "review_scores_accuracy": 5, "review_scores_rating": 50}
    return roles.raw_listings(t).select("listing_id", *minimum).filter(rules.at_least(minimum))


@query(
    f"""SELECT listing_id, zipcode, bathrooms, bedrooms, beds, cleaning_fee FROM ({roles.DUCK_RAW_LISTINGS})
    WHERE zipcode IS NOT NULL AND bathrooms IS NOT NULL AND bedrooms IS NOT NULL AND beds IS NOT NULL AND cleaning_fee IS NOT NULL"""
)
def na_drop_all(t: Tables) -> DataFrame:
    some = roles.raw_listings(t).select("listing_id", "zipcode", "bathrooms", "bedrooms", "beds", "cleaning_fee")
    return some.na.drop()


@query(
    f"""SELECT zip, area, price, date, CASE WHEN area = '- 5' THEN 'area' ELSE 'price' END AS reason
    FROM ({roles.DUCK_RAW_SALES}) WHERE area = '- 5' OR price IN ('-', '- 0')"""
)
def audit_bad_numbers(t: Tables) -> DataFrame:
    return quality.bad_numbers(sales.select_cells(roles.raw_sales(t)), sales.FIGURES)


@query(
    f"""SELECT month, zone, count(*) AS n, round(avg(price), 2) AS price FROM ({roles.DUCK_LISTINGS})
    WHERE month = '1998-10' AND zone = 7 GROUP BY ALL"""
)
def lookup_by_key(t: Tables) -> DataFrame:
    hit = roles.listings(t, month="1998-10").filter(F.col("zone") == 7)
    return hit.groupBy("month", "zone").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("price"), 2).alias("price"))


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 12")
def having_min_count(t: Tables) -> DataFrame:
    return aggregates.frequent(t.orders, "o_custkey", 12)


_COMPLAINT_STEPS = """SELECT count(*) AS s0, count(*) FILTER (WHERE a) AS s1, count(*) FILTER (WHERE a AND b) AS s2,
  count(*) FILTER (WHERE a AND b AND c) AS s3, count(*) FILTER (WHERE a AND b AND c AND d) AS s4
  FROM (SELECT NOT is_short AND last_cell <> '' AS a, zip <> '' AS b, id <> 'N/A' AND zip <> 'ABC' AS c, lat <> 'N/A' AS d
        FROM ({rows}))"""


@query(
    f"""WITH s AS ({_COMPLAINT_STEPS.format(rows=roles.DUCK_RAW_COMPLAINTS)})
    SELECT 0 AS step, 'all rows' AS rule, s0 AS surviving FROM s UNION ALL SELECT 1, 'cell count', s1 FROM s
    UNION ALL SELECT 2, 'required cells', s2 FROM s UNION ALL SELECT 3, 'int cells', s3 FROM s
    UNION ALL SELECT 4, 'double cells', s4 FROM s"""
)
def dq_attrition_report(t: Tables) -> DataFrame:
    split = complaints.split_lines(roles.raw_complaint_lines(t))
    return quality.attrition(split, complaints.line_rules())


_SALE_STEPS = f"""WITH x AS (SELECT zip <> '' AS a, price <> '-' AS b, area NOT IN ('0', '- 5') AS c, price <> '- 0' AS d,
      length(zip) = 5 AS e, date <> '{roles.BAD_SALE_DATE}' AS f FROM ({roles.DUCK_RAW_SALES})),
    s AS (SELECT count(*) AS s0, count(*) FILTER (WHERE a) AS s1, count(*) FILTER (WHERE a AND b) AS s2,
      count(*) FILTER (WHERE a AND b AND c) AS s3, count(*) FILTER (WHERE a AND b AND c AND d) AS s4,
      count(*) FILTER (WHERE a AND b AND c AND d AND e) AS s5, count(*) FILTER (WHERE a AND b AND c AND d AND e AND f) AS s6 FROM x)
    SELECT 0 AS step, 'all rows' AS rule, s0 AS surviving FROM s UNION ALL SELECT 1, 'required cells', s1 FROM s
    UNION ALL SELECT 2, 'numbers parse', s2 FROM s UNION ALL SELECT 3, 'area positive', s3 FROM s
    UNION ALL SELECT 4, 'price positive', s4 FROM s UNION ALL SELECT 5, 'zip length', s5 FROM s
    UNION ALL SELECT 6, 'date parses', s6 FROM s"""


@query(_SALE_STEPS)
def dq_attrition_sales(t: Tables) -> DataFrame:
    return quality.attrition(sales.figures(sales.select_cells(roles.raw_sales(t))), sales.figure_rules())


@query(_SALE_STEPS + " UNION ALL SELECT 7, 'stored', s6 FROM s")
def clean_sales_observed(t: Tables) -> DataFrame:
    """The audit from the pass that cleans and stores the sales, and the rows stored."""
    kept, seen = quality.observed(sales.figures(sales.select_cells(roles.raw_sales(t))), sales.figure_rules())
    stored = materialise(sales.values(kept))
    steps = quality.observed_attrition(t.spark, seen, sales.figure_rules())
    return steps.unionByName(stored.agg(F.lit(7).alias("step"), F.lit("stored").alias("rule"), F.count(F.lit(1)).alias("surviving")))


@query(
    f"""WITH x AS (SELECT cleaning_fee IS NOT NULL AND security_deposit IS NOT NULL AS a,
      coalesce(regexp_full_match(zipcode, '[0-9]{{5}}'), FALSE) AS b,
      bathrooms IS NOT NULL OR bedrooms IS NOT NULL OR beds IS NOT NULL AS c,
      coalesce(review_scores_location >= 5 AND review_scores_accuracy >= 5 AND review_scores_rating >= 50, FALSE) AS d
      FROM ({roles.DUCK_RAW_LISTINGS})),
    s AS (SELECT count(*) AS s0, count(*) FILTER (WHERE a) AS s1, count(*) FILTER (WHERE a AND b) AS s2,
      count(*) FILTER (WHERE a AND b AND c) AS s3, count(*) FILTER (WHERE a AND b AND c AND d) AS s4 FROM x)
    SELECT 0 AS step, 'all rows' AS rule, s0 AS surviving FROM s UNION ALL SELECT 1, 'fees present', s1 FROM s
    UNION ALL SELECT 2, 'zip five digits', s2 FROM s UNION ALL SELECT 3, 'a room count present', s3 FROM s
    UNION ALL SELECT 4, 'review scores', s4 FROM s UNION ALL SELECT 5, 'nothing missing', s4 FROM s"""
)
def dq_attrition_listings(t: Tables) -> DataFrame:
    return quality.attrition(roles.raw_listings(t), listings.row_rules())
