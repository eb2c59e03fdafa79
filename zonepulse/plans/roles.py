"""Bindings of the study's roles to the star-schema tables.

Each role is given twice: as a DataFrame and as a DuckDB ``SELECT`` for the SQL
twins. Dirty input text is described once as expressions that mean the same in both
dialects; only number and date rendering differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.months import in_month, month_text
from ..schemas import COMPLAINT_POSITIONS, COMPLAINT_SLOTS, COMPLAINT_WIDTH, LISTING_NUMERIC, SALE_POSITIONS
from .catalog import Tables


class Spark:
    @staticmethod
    def money(x: str) -> str:
        return f"concat('$', format_number({x}, 2))"

    @staticmethod
    def whole(x: str) -> str:
        return f"format_number({x}, 0)"

    @staticmethod
    def date(x: str, style: str) -> str:
        return f"date_format({x}, '{_STYLES[style][0]}')"


class Duck:
    @staticmethod
    def money(x: str) -> str:
        return f"('$' || format('{{:,.2f}}', {x}))"

    @staticmethod
    def whole(x: str) -> str:
        return f"format('{{:,.0f}}', {x})"

    @staticmethod
    def date(x: str, style: str) -> str:
        return f"strftime({x}, '{_STYLES[style][1]}')"


_STYLES = {
    "month": ("yyyy-MM", "%Y-%m"),
    "slash": ("yyyy/MM", "%Y/%m"),
    "us": ("MM/dd/yyyy", "%m/%d/%Y"),
    "short": ("M/d/yy", "%-m/%-d/%y"),
    "iso": ("yyyy-MM-dd", "%Y-%m-%d"),
}


def columns_sql(exprs: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {name}" for name, e in exprs.items())


def columns_spark(exprs: dict[str, str]) -> list[str]:
    return [f"{e} AS {name}" for name, e in exprs.items()]


def choose(by: str, names: list[str]) -> str:
    """A CASE that picks a name by the remainder of a key."""
    arms = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names[:-1]))
    return f"CASE {by} % {len(names)} {arms} ELSE '{names[-1]}' END"


COMPLAINT_TYPE = choose("l_partkey", [*COMPLAINT_SLOTS.values(), "Graffiti", "Noise - Street"])

# --- clean roles -------------------------------------------------------------

DUCK_LISTINGS = """SELECT o_orderkey AS listing_id, strftime(o_orderdate, '%Y-%m') AS month,
  c_nationkey AS zone, o_totalprice AS price FROM orders JOIN customer ON o_custkey = c_custkey"""
DUCK_SALES = """SELECT strftime(l_shipdate, '%Y-%m') AS month, s_nationkey AS zone,
  l_quantity AS area, l_extendedprice AS price FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""
DUCK_COMPLAINTS = f"""SELECT strftime(l_shipdate, '%Y-%m') AS month, s_nationkey AS zone,
  {COMPLAINT_TYPE} AS type FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""
DUCK_COUNTS = "count(*) AS all_type_complaint, " + ", ".join(
    f"count(*) FILTER (WHERE type = '{v}') AS {name}" for name, v in COMPLAINT_SLOTS.items()
)
DUCK_UNIT_PRICE = "avg(price / area) FILTER (WHERE area > 0)"
# A month key moved by k months.
DUCK_SHIFT = "strftime(CAST(month || '-01' AS DATE) + to_months(CAST({k} AS INT)), '%Y-%m')"


def listings(t: Tables, month: str | None = None) -> DataFrame:
    orders = t.orders if month is None else t.orders.filter(in_month("o_orderdate", month))
    return orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("listing_id"),
        month_text("o_orderdate").alias("month"),
        F.col("c_nationkey").alias("zone"),
        F.col("o_totalprice").alias("price"),
    )


def sales(t: Tables) -> DataFrame:
    return t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        month_text("l_shipdate").alias("month"),
        F.col("s_nationkey").alias("zone"),
        F.col("l_quantity").alias("area"),
        F.col("l_extendedprice").alias("price"),
    )


def complaints(t: Tables) -> DataFrame:
    return t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        month_text("l_shipdate").alias("month"),
        F.col("s_nationkey").alias("zone"),
        F.expr(COMPLAINT_TYPE).alias("type"),
    )


# --- raw listings ------------------------------------------------------------


def raw_listing_columns(d) -> dict[str, str]:
    def maybe(condition: str, value: str) -> str:
        return f"CASE WHEN {condition} THEN NULL ELSE {value} END"

    return {
        "zipcode": "CASE o_orderkey % 17 WHEN 0 THEN ' ' WHEN 1 THEN '1001' WHEN 2 THEN '10001-2345' "
        "WHEN 3 THEN NULL WHEN 4 THEN '00501' ELSE CAST(10000 + c_nationkey AS STRING) END",
        "neighbourhood_group_cleansed": "CASE WHEN o_orderkey % 29 = 0 THEN 'Elsewhere' ELSE "
        + choose("c_nationkey", ["Brooklyn", "Staten Island", "Manhattan", "Bronx", "Queens"])
        + " END",
        "property_type": choose(
            "o_custkey",
            [
                "Apartment", "Hotel", "House", "Guest suite", "Condominium", "Townhouse",
                "Boutique hotel", "Loft", "Serviced apartment", "Yurt", "Apartment",
            ],
        ),
        "room_type": "CASE o_orderstatus WHEN 'O' THEN 'Entire home/apt' WHEN 'P' THEN 'Private room' ELSE "
        + choose("o_orderkey", ["Shared room", "Hotel room"])
        + " END",
        "accommodates": "CAST(1 + o_orderkey % 8 AS INT)",
        "bathrooms": maybe("o_orderkey % 5 = 0", "CAST(1 + o_orderkey % 4 AS DOUBLE) / 2"),
        "bedrooms": maybe("o_orderkey % 3 = 0", "CAST(1 + o_orderkey % 4 AS INT)"),
        "beds": maybe("o_orderkey % 7 = 0", "CAST(1 + o_orderkey % 6 AS INT)"),
        "price": d.money("o_totalprice"),
        "cleaning_fee": maybe("o_orderkey % 23 = 0", d.money("CAST(20 + o_custkey % 100 AS DOUBLE)")),
        "host_listings_count": "CAST(1 + o_custkey % 5 AS INT)",
        "availability_90": "CAST(o_orderkey % 91 AS INT)",
        "extra_people": d.money("CAST(o_orderkey % 60 AS DOUBLE)"),
        "number_of_reviews": "CAST(o_orderkey % 200 AS INT)",
        "security_deposit": maybe("o_orderkey % 31 = 0", d.money("CAST(o_custkey % 1500 AS DOUBLE)")),
        "minimum_nights": "CAST(1 + o_orderkey % 30 AS INT)",
        "review_scores_location": maybe("o_orderkey % 13 = 0", "CAST(4 + o_orderkey % 7 AS DOUBLE)"),
        "review_scores_rating": "CAST(45 + o_orderkey % 56 AS DOUBLE)",
        "review_scores_accuracy": "CAST(4 + o_custkey % 7 AS DOUBLE)",
    }


def raw_listings(t: Tables, tagged: bool = True) -> DataFrame:
    """The 19 raw columns, the order key and (``tagged``) the ``Date`` tag."""
    base = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    exprs = {"listing_id": "o_orderkey", **raw_listing_columns(Spark)}
    if tagged:
        exprs["Date"] = Spark.date("o_orderdate", "slash")
    return base.selectExpr(*columns_spark(exprs))


DUCK_RAW_LISTINGS = (
    "SELECT o_orderkey AS listing_id, "
    + columns_sql({**raw_listing_columns(Duck), "Date": Duck.date("o_orderdate", "slash")})
    + " FROM orders JOIN customer ON o_custkey = c_custkey"
)

# What cleaning must leave of DUCK_RAW_LISTINGS, written from the rules.
_DUCK_MONEY = "CAST(replace(replace({c}, '$', ''), ',', '') AS DOUBLE)"
DUCK_CLEAN_LISTINGS = f"""SELECT listing_id, zipcode, neighbourhood_group_cleansed AS borough, property_type, room_type,
  accommodates,
  CAST(CASE WHEN bathrooms IS NOT NULL THEN bathrooms WHEN bedrooms IS NOT NULL THEN bedrooms ELSE beds END AS DOUBLE) AS bathrooms,
  CAST(CASE WHEN bedrooms IS NOT NULL THEN bedrooms WHEN bathrooms IS NOT NULL THEN bathrooms ELSE beds END AS DOUBLE) AS bedrooms,
  CAST(CASE WHEN beds IS NOT NULL THEN beds WHEN bedrooms IS NOT NULL THEN bedrooms ELSE bathrooms END AS DOUBLE) AS beds,
  {_DUCK_MONEY.format(c='price')} AS price, {_DUCK_MONEY.format(c='cleaning_fee')} AS cleaning_fee,
  host_listings_count, availability_90, {_DUCK_MONEY.format(c='extra_people')} AS extra_people, number_of_reviews,
  {_DUCK_MONEY.format(c='security_deposit')} AS security_deposit, minimum_nights, Date
FROM ({DUCK_RAW_LISTINGS})
WHERE cleaning_fee IS NOT NULL AND security_deposit IS NOT NULL AND extra_people IS NOT NULL
  AND regexp_full_match(zipcode, '[0-9]{{5}}')
  AND (bathrooms IS NOT NULL OR bedrooms IS NOT NULL OR beds IS NOT NULL)
  AND review_scores_location >= 5 AND review_scores_accuracy >= 5 AND review_scores_rating >= 50"""


# --- raw complaints ----------------------------------------------------------


def raw_complaint_cells(d) -> dict[str, str]:
    """The nine used cells as they stand in a raw line; the board is quoted."""
    return {
        "id": "CASE WHEN l_orderkey % 19 = 0 THEN 'N/A' ELSE CAST(l_orderkey AS STRING) END",
        "date": f"({d.date('l_shipdate', 'us')} || ' 12:00:00 AM')",
        "agency": choose("l_partkey", ["NYPD", "HPD", "DOT"]),
        "type": COMPLAINT_TYPE,
        "zip": "CASE WHEN l_partkey % 37 = 0 THEN '' WHEN l_partkey % 41 = 0 THEN 'ABC' "
        "ELSE CAST(10000 + s_nationkey AS STRING) END",
        "board": "('\"' || lpad(CAST(s_nationkey AS STRING), 2, '0') || ', BOARD\"')",
        "borough": choose("s_nationkey", ["MANHATTAN", "QUEENS", "STATEN ISLAND", "BRONX", "BROOKLYN"]),
        "lat": "CASE WHEN l_orderkey % 43 = 0 THEN 'N/A' ELSE ('40.' || lpad(CAST(s_nationkey AS STRING), 2, '0')) END",
        "lon": "('-73.' || lpad(CAST(s_nationkey AS STRING), 2, '0'))",
    }


RAW_COMPLAINT_LAST = "CASE WHEN l_orderkey % 47 = 0 THEN '' ELSE 'x' END"
RAW_COMPLAINT_SHORT = "l_partkey % 53 = 0"


def raw_complaint_lines(t: Tables) -> DataFrame:
    """Raw 41-cell lines: some short, some with an empty last cell."""
    cells = ["''"] * COMPLAINT_WIDTH
    for name, e in raw_complaint_cells(Spark).items():
        cells[COMPLAINT_POSITIONS[name]] = e
    cells[-1] = RAW_COMPLAINT_LAST
    line = f"CASE WHEN {RAW_COMPLAINT_SHORT} THEN 'short,line' ELSE concat_ws(',', {', '.join(cells)}) END"
    return t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).selectExpr(f"{line} AS value")


DUCK_RAW_COMPLAINTS = (
    "SELECT "
    + columns_sql(raw_complaint_cells(Duck))
    + f", {RAW_COMPLAINT_LAST} AS last_cell, {RAW_COMPLAINT_SHORT} AS is_short"
    + " FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"
)
DUCK_CLEAN_COMPLAINTS = f"""SELECT CAST(id AS INT) AS id, substr(date, 1, 10) AS date, agency, type,
  CAST(zip AS INT) AS zip, replace(board, '"', '') AS board, borough, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon
FROM ({DUCK_RAW_COMPLAINTS})
WHERE NOT is_short AND last_cell <> '' AND id <> 'N/A' AND zip NOT IN ('', 'ABC') AND lat <> 'N/A'"""


# --- raw sales ---------------------------------------------------------------

BAD_SALE_DATE = "13/1/99"
SALE_DISTRICT = choose("s_nationkey", ["manhattan", "bronx", "brooklyn", "queens", "statenisland"])


def raw_sale_cells(d) -> dict[str, str]:
    """The used cells: the number column in front, then zip, area, price and date."""
    return {
        "first": "CASE WHEN l_orderkey % 59 = 0 THEN 'BOROUGH' ELSE CAST(1 + s_nationkey % 5 AS STRING) END",
        "zip": "CASE WHEN l_partkey % 37 = 0 THEN '' WHEN l_partkey % 41 = 0 THEN '1001' "
        "ELSE CAST(10000 + s_nationkey AS STRING) END",
        "area": f"CASE WHEN l_orderkey % 13 = 0 THEN '0' WHEN l_orderkey % 17 = 0 THEN '- 5' ELSE {d.whole('l_quantity * 100')} END",
        "price": f"CASE WHEN l_orderkey % 11 = 0 THEN '-' WHEN l_orderkey % 7 = 0 THEN '- 0' ELSE {d.money('l_extendedprice')} END",
        "date": f"CASE WHEN l_partkey % 43 = 0 THEN '{BAD_SALE_DATE}' ELSE {d.date('l_shipdate', 'short')} END",
    }


def raw_sales(t: Tables) -> DataFrame:
    """Sheet rows c0..c20 with the district and year of the sheet they come from."""
    cells = raw_sale_cells(Spark)
    places = {0: cells["first"], **{SALE_POSITIONS[c]: cells[c] for c in SALE_POSITIONS}}
    exprs = {f"c{i}": places.get(i, "'-'") for i in range(max(places) + 1)}
    exprs |= {"district": SALE_DISTRICT, "year": "year(l_shipdate)"}
    base = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return base.selectExpr(*columns_spark(exprs))


DUCK_RAW_SALES = (
    "SELECT "
    + columns_sql({**raw_sale_cells(Duck), "district": SALE_DISTRICT, "year": "CAST(year(l_shipdate) AS INT)"})
    + " FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"
)
# What cleaning must leave of the rows above, written from the rules.
DUCK_CLEAN_SALES = f"""SELECT '20' || split_part(date, '/', 3) || '-' || lpad(split_part(date, '/', 1), 2, '0') AS month, zip AS zone,
  CAST(replace(area, ',', '') AS DOUBLE) AS area,
  CAST(replace(replace(price, '$', ''), ',', '') AS DOUBLE) AS price
FROM ({DUCK_RAW_SALES})
WHERE zip <> '' AND zip <> '1001' AND area NOT IN ('0', '- 5') AND price NOT IN ('-', '- 0') AND date <> '{BAD_SALE_DATE}'"""


# --- scoring requests --------------------------------------------------------


def request_columns(d) -> dict[str, str]:
    """Form fields as text, in the form's own spelling."""
    return {
        "request_id": "CAST(o_orderkey AS STRING)",
        "date": d.date("o_orderdate", "iso"),
        "zip": "CASE WHEN o_orderkey % 19 = 0 THEN '99999' ELSE CAST(10000 + c_nationkey AS STRING) END",
        "borough": choose("c_nationkey", ["Brooklyn", "Staten Island", "Manhattan", "The Bronx", "Queens"]),
        "property_type": choose("o_custkey", ["Hotel", "House", "Apartment", "Guest suite", "others"]),
        "room_type": choose("o_orderkey", ["Private Room", "Entire home/apt", "Shared Room", "Hotel Room"]),
        **{
            c: f"CAST({1 + i} + o_orderkey % {7 + i} AS STRING)"
            for i, c in enumerate(LISTING_NUMERIC)
            if c != "price"
        },
    }


def requests(t: Tables) -> DataFrame:
    base = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return base.selectExpr(*columns_spark(request_columns(Spark)))


DUCK_REQUESTS = (
    "SELECT " + columns_sql(request_columns(Duck)) + " FROM orders JOIN customer ON o_custkey = c_custkey"
)


# --- zones of the training study, as zip text --------------------------------


def as_zip(df: DataFrame) -> DataFrame:
    """Number zones as five-digit text, to meet the zips of the raw listings."""
    return df.withColumn("zone", (F.col("zone") + 10000).cast("string"))


DUCK_PROFILE = f"""SELECT {DUCK_SHIFT.format(k=2)} AS month, CAST(10000 + zone AS STRING) AS zone,
  {', '.join(['all_type_complaint', *COMPLAINT_SLOTS])}, real_estate_price
FROM (SELECT month, zone, {DUCK_COUNTS} FROM ({DUCK_COMPLAINTS}) GROUP BY ALL)
JOIN (SELECT month, zone, {DUCK_UNIT_PRICE} AS real_estate_price FROM ({DUCK_SALES}) GROUP BY ALL) USING (month, zone)"""
