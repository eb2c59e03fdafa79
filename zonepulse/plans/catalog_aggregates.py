"""Group statistics, correlation, profiles, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.months import month_text
from ..operators import aggregates, profile
from ..operators.correlation import correlate_by_shift, correlate_moments
from ..operators.partials import MomentStore, SketchStore
from ..schemas import COMPLAINT_TOTAL, SALE_PRICE
from ..session import scratch_path
from ..sources.readers import tagged_snapshots
from . import complaints, roles, sales, study
from .catalog import Tables, query
from .catalog_joins import KEYS, _rounded, _sale_means

# --- fixed values: the part types of the tables ---
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
# --- end of fixed values ---


def _counts_sql(keys: str) -> str:
    return f"SELECT {keys}, {roles.DUCK_COUNTS} FROM ({roles.DUCK_COMPLAINTS}) GROUP BY ALL"


@query(f"SELECT month, zone, round({roles.DUCK_UNIT_PRICE}, 6) AS real_estate_price FROM ({roles.DUCK_SALES}) GROUP BY ALL")
def avg_unit_price_month_zone(t: Tables) -> DataFrame:
    return _rounded(_sale_means(t))


@query(f"SELECT month, round({roles.DUCK_UNIT_PRICE}, 6) AS real_estate_price FROM ({roles.DUCK_SALES}) GROUP BY ALL")
def avg_unit_price_month(t: Tables) -> DataFrame:
    return _rounded(sales.mean_unit_price(roles.sales(t), ["month"]))


@query(f"SELECT month, round(avg(price), 2) AS price FROM ({roles.DUCK_LISTINGS}) GROUP BY ALL")
def avg_price_month(t: Tables) -> DataFrame:
    return aggregates.mean_by(roles.listings(t), ["month"], "price", "price").withColumn("price", F.round("price", 2))


@query(_counts_sql("month"))
def category_counts_month(t: Tables) -> DataFrame:
    return complaints.counts(roles.complaints(t), ["month"])


@query(_counts_sql("month, zone"))
def category_counts_month_zone(t: Tables) -> DataFrame:
    return complaints.counts(roles.complaints(t), KEYS)


@query(
    """SELECT strftime(ts, '%Y-%m-%d') AS day, user_id % 25 AS zone, count(*) AS all_events,
    count(*) FILTER (WHERE event_type = 'view') AS views, count(*) FILTER (WHERE event_type = 'purchase') AS purchases
    FROM events GROUP BY ALL"""
)
def category_counts_day(t: Tables) -> DataFrame:
    daily = t.events.select(
        F.col("ts").cast("date").cast("string").alias("day"), (F.col("user_id") % 25).alias("zone"), "event_type"
    )
    slots = {"views": "view", "purchases": "purchase"}
    return aggregates.category_counts(daily, ["day", "zone"], "event_type", slots, total="all_events")


_TYPED = """SELECT strftime(l_shipdate, '%Y-%m') AS month, p_type AS type FROM lineitem JOIN part ON l_partkey = p_partkey"""


def _typed(t: Tables) -> DataFrame:
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(month_text("l_shipdate").alias("month"), F.col("p_type").alias("type"))


@query(
    "SELECT month, "
    + ", ".join(f"count(*) FILTER (WHERE type = '{v}') AS {v}" for v in PART_TYPES)
    + f" FROM ({_TYPED}) GROUP BY month"
)
def category_pivot(t: Tables) -> DataFrame:
    return aggregates.category_pivot(_typed(t), ["month"], "type", PART_TYPES)


_JOINED = f"""SELECT price, real_estate_price, all_type_complaint FROM ({roles.DUCK_LISTINGS})
  JOIN (SELECT month, zone, {roles.DUCK_UNIT_PRICE} AS real_estate_price FROM ({roles.DUCK_SALES}) GROUP BY ALL) USING (month, zone)
  JOIN (SELECT month, zone, count(*) AS all_type_complaint FROM ({roles.DUCK_COMPLAINTS}) GROUP BY ALL) USING (month, zone)"""


def _corr_sql(a: str, b: str) -> str:
    return f"round(covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0), 6)"


@query(
    f"""SELECT {_corr_sql('price', 'real_estate_price')} AS corr_sale_price, {_corr_sql('price', 'all_type_complaint')} AS corr_complaints
    FROM ({_JOINED})"""
)
def pearson_corr(t: Tables) -> DataFrame:
    # The signals are constant within a key, so moments per key stand for the listings.
    found = study.correlations(roles.listings(t), roles.complaints(t), _sale_means(t), shifts=[0])
    return found.select(F.col(f"corr_{SALE_PRICE}").alias("corr_sale_price"), F.col(f"corr_{COMPLAINT_TOTAL}").alias("corr_complaints"))


_CORR_BY_SHIFT = f"""WITH l AS ({roles.DUCK_LISTINGS}),
    s AS (SELECT month, zone, {roles.DUCK_UNIT_PRICE} AS u FROM ({roles.DUCK_SALES}) GROUP BY ALL),
    c AS (SELECT month, zone, count(*) AS a FROM ({roles.DUCK_COMPLAINTS}) GROUP BY ALL),
    x AS (SELECT CAST(k AS INT) AS shift, {roles.DUCK_SHIFT.format(k='k')} AS month, zone, u, a
          FROM s JOIN c USING (month, zone), range(0, 7) r(k))
    SELECT shift, count(*) AS n, {_corr_sql('price', 'u')} AS corr_real_estate_price, {_corr_sql('price', 'a')} AS corr_all_type_complaint
    FROM x JOIN l USING (month, zone) GROUP BY shift"""


@query(_CORR_BY_SHIFT)
def corr_by_shift(t: Tables) -> DataFrame:
    found = study.correlations(roles.listings(t), roles.complaints(t), _sale_means(t))
    return found.select("shift", "n", f"corr_{SALE_PRICE}", f"corr_{COMPLAINT_TOTAL}")


@query(_CORR_BY_SHIFT)
def corr_from_partials(t: Tables) -> DataFrame:
    """``corr_by_shift`` from moments that were stored in three parts, not in their order, one of them twice."""
    rows = roles.listings(t)
    store = MomentStore(t.spark, scratch_path(t.spark, "moments"), KEYS, "price")
    for part in (2, 0, 1, 2):
        store.feed(rows.filter(F.col("listing_id") % 3 == part), str(part))
    signals = study.neighbourhood_profile(roles.complaints(t), _sale_means(t), shift=0)
    found = correlate_moments(store.moments(), signals, study.SHIFTS, [SALE_PRICE, COMPLAINT_TOTAL])
    return found.select("shift", "n", f"corr_{SALE_PRICE}", f"corr_{COMPLAINT_TOTAL}")


@query(
    f"""WITH l AS ({roles.DUCK_LISTINGS}),
    s AS (SELECT month, zone, avg(CASE WHEN zone % 4 <> 1 THEN price / area END) AS u FROM ({roles.DUCK_SALES}) GROUP BY ALL),
    c AS (SELECT month, zone, CASE WHEN zone % 5 <> 2 THEN count(*) END AS a FROM ({roles.DUCK_COMPLAINTS}) GROUP BY month, zone),
    x AS (SELECT CAST(k AS INT) AS shift, {roles.DUCK_SHIFT.format(k='k')} AS month, zone, u, a
          FROM s JOIN c USING (month, zone), range(0, 3) r(k))
    SELECT shift, count(*) AS n, count(u) AS n_real_estate_price, count(a) AS n_all_type_complaint,
      {_corr_sql("CASE WHEN u IS NOT NULL THEN price END", 'u')} AS corr_real_estate_price,
      {_corr_sql("CASE WHEN a IS NOT NULL THEN price END", 'a')} AS corr_all_type_complaint
    FROM x JOIN l USING (month, zone) GROUP BY shift"""
)
def corr_by_shift_nulls(t: Tables) -> DataFrame:
    """Zones without a usable area have no sale price, others no complaint figure: each
    signal is correlated over the listings that have it."""
    rows = roles.sales(t).withColumn("area", F.when(F.col("zone") % 4 != 1, F.col("area")).otherwise(0.0))
    signals = study.neighbourhood_profile(roles.complaints(t), sales.mean_unit_price(rows, KEYS), shift=0)
    signals = signals.withColumn(COMPLAINT_TOTAL, F.when(F.col("zone") % 5 != 2, F.col(COMPLAINT_TOTAL)))
    return correlate_by_shift(roles.listings(t), signals, [0, 1, 2], "price", [SALE_PRICE, COMPLAINT_TOTAL])


@query("SELECT count(*) AS n_rows FROM lineitem")
def profile_counts(t: Tables) -> DataFrame:
    return profile.row_count(t.lineitem)


@query("SELECT DISTINCT p_type, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey")
def distinct_values(t: Tables) -> DataFrame:
    # Distinct keys first: a part with many lines reaches the join once per task.
    keys = profile.distinct_values(t.lineitem, "l_partkey")
    sold = t.part.join(keys, F.col("p_partkey") == F.col("l_partkey"), "left_semi")
    return profile.distinct_values(sold, "p_type", "p_brand")


@query(
    """SELECT 'l_shipdate' AS column_name, count(DISTINCT l_shipdate) AS n_distinct FROM lineitem
    UNION ALL SELECT 'l_returnflag', count(DISTINCT l_returnflag) FROM lineitem
    UNION ALL SELECT 'l_suppkey', count(DISTINCT l_suppkey) FROM lineitem
    UNION ALL SELECT 'l_linenumber', count(DISTINCT l_linenumber) FROM lineitem"""
)
def distinct_counts(t: Tables) -> DataFrame:
    return profile.distinct_counts(t.lineitem, ["l_shipdate", "l_returnflag", "l_suppkey", "l_linenumber"], exact=True)


_SKETCHED = ["l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"]


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_exact, TRUE AS sketch_is_close FROM lineitem" for c in _SKETCHED
    )
)
def approx_distinct_counts(t: Tables) -> DataFrame:
    """Sketches against exact counts: within four standard errors."""
    near = profile.distinct_counts(t.lineitem, _SKETCHED, exact=False, rsd=0.02).withColumnRenamed("n_distinct", "n_near")
    exact = profile.distinct_counts(t.lineitem, _SKETCHED, exact=True).withColumnRenamed("n_distinct", "n_exact")
    close = F.abs(F.col("n_near") - F.col("n_exact")) <= 0.08 * F.col("n_exact")
    return exact.join(near, "column_name").select("column_name", "n_exact", close.alias("sketch_is_close"))


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_exact, TRUE AS sketch_is_close FROM lineitem" for c in _SKETCHED
    )
)
def distinct_counts_merged(t: Tables) -> DataFrame:
    """Sketches stored by ship year, which share most of their keys, some of them fed again,
    against exact counts: within four standard errors of the merged sketch."""
    store = SketchStore(t.spark, scratch_path(t.spark, "sketches"), _SKETCHED)
    rows = t.lineitem.withColumn("year", F.year("l_shipdate"))
    years = sorted(r[0] for r in rows.select("year").distinct().collect())  # a handful
    for year in [*years[::-1], years[0]]:
        store.feed(rows.filter(F.col("year") == year), str(year))
    near = store.distinct_counts().withColumnRenamed("n_distinct", "n_near")
    exact = profile.distinct_counts(t.lineitem, _SKETCHED, exact=True).withColumnRenamed("n_distinct", "n_exact")
    bound = 4 * 1.04 / 2 ** (store.lg_k / 2)
    close = F.abs(F.col("n_near") - F.col("n_exact")) <= bound * F.col("n_exact")
    return exact.join(near, "column_name").select("column_name", "n_exact", close.alias("sketch_is_close"))


_FOOTERS = ["l_orderkey", "l_linenumber", "l_quantity"]


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS n_rows, CAST(min({c}) AS VARCHAR) AS min_value,
        CAST(max({c}) AS VARCHAR) AS max_value FROM lineitem"""
        for c in _FOOTERS
    )
)
def footer_profile(t: Tables) -> DataFrame:
    return profile.footer_profile(f"{t.folder}/lineitem.parquet", t.spark, _FOOTERS)


@query(
    """SELECT 'ts' AS column_name, CAST(min(ts) AS VARCHAR) AS min_value, CAST(max(ts) AS VARCHAR) AS max_value FROM events
    UNION ALL SELECT 'value', CAST(min(value) + 0.0 AS VARCHAR), CAST(max(value) + 0.0 AS VARCHAR) FROM events
    UNION ALL SELECT 'event_type', min(event_type), max(event_type) FROM events"""
)
def min_max_profile(t: Tables) -> DataFrame:
    return profile.value_range(t.events, ["ts", "value", "event_type"])


@query(
    """SELECT 0 AS position, 'c_custkey' AS column_name, 'bigint' AS data_type, count(c_custkey) AS n_filled FROM customer
    UNION ALL SELECT 1, 'c_name', 'string', count(c_name) FROM customer
    UNION ALL SELECT 2, 'c_nationkey', 'int', count(c_nationkey) FROM customer
    UNION ALL SELECT 3, 'c_acctbal', 'double', count(c_acctbal) FROM customer
    UNION ALL SELECT 4, 'c_mktsegment', 'string', count(c_mktsegment) FROM customer"""
)
def profile_schema(t: Tables) -> DataFrame:
    return profile.schema_rows(t.customer)


@query(f"SELECT type, count(*) AS n FROM ({_TYPED}) GROUP BY 1")
def category_frequency(t: Tables) -> DataFrame:
    return aggregates.frequency(_typed(t), "type").orderBy(F.desc("n"), "type")


@query(
    f"""SELECT zone, max(price) AS max_price, round(avg(price), 2) AS avg_price FROM ({roles.DUCK_LISTINGS}) GROUP BY zone"""
)
def price_stats_by_zone(t: Tables) -> DataFrame:
    stats = aggregates.level_by(roles.listings(t), ["zone"], "price", "price")
    return stats.withColumn("avg_price", F.round("avg_price", 2))


def _regions(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("zone"), F.col("r_name").alias("region")
    )


@query(
    f"""SELECT r_name AS region, count(*) AS n FROM ({roles.DUCK_COMPLAINTS})
    JOIN nation ON zone = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1"""
)
def complaints_by_region(t: Tables) -> DataFrame:
    # Counted per zone before the join: 25 rows meet the region names, not all rows.
    per_zone = aggregates.frequency(roles.complaints(t), "zone").join(_regions(t), "zone")
    return per_zone.groupBy("region").agg(F.sum("n").alias("n"))


@query(
    f"""SELECT r_name AS region, round({roles.DUCK_UNIT_PRICE}, 6) AS unit_price FROM ({roles.DUCK_SALES})
    JOIN nation ON zone = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1"""
)
def unit_price_by_region(t: Tables) -> DataFrame:
    unit = aggregates.unit_price("price", "area")
    per_zone = roles.sales(t).groupBy("zone").agg(F.sum(unit).alias("total"), F.count(unit).alias("n"))
    joined = per_zone.join(_regions(t), "zone")
    return joined.groupBy("region").agg(F.round(F.sum("total") / F.sum("n"), 6).alias("unit_price"))


def _profile_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct,
        CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM {table}"""
        for c in columns
    )


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(_profile_sql("orders", ORDER_COLUMNS))
def profile_table(t: Tables) -> DataFrame:
    return profile.profile_table(t.orders, exact=True)


LISTING_PROFILE = ["zipcode", "property_type", "bathrooms", "bedrooms", "price", "cleaning_fee"]


@query(_profile_sql(f"({roles.DUCK_RAW_LISTINGS})", LISTING_PROFILE))
def profile_table_dirty(t: Tables) -> DataFrame:
    return profile.profile_table(roles.raw_listings(t), LISTING_PROFILE, exact=True)


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 10")
def topk_categories(t: Tables) -> DataFrame:
    return aggregates.top_categories(t.orders, "o_custkey", 10)


@query(
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_suppkey, l_linenumber LIMIT 100"""
)
def limit_ordered(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return t.lineitem.select(*keys, "l_extendedprice").orderBy(F.desc("l_extendedprice"), *keys).limit(100)


_TOP3 = f"SELECT type, row_number() OVER (ORDER BY n DESC, type) AS place FROM (SELECT type, count(*) AS n FROM ({_TYPED}) GROUP BY 1)"


@query(
    f"""SELECT month, count(*) AS all_types, count(*) FILTER (WHERE place = 1) AS top1,
    count(*) FILTER (WHERE place = 2) AS top2, count(*) FILTER (WHERE place = 3) AS top3
    FROM ({_TYPED}) JOIN ({_TOP3}) USING (type) GROUP BY month"""
)
def topk_pivot(t: Tables) -> DataFrame:
    typed = _typed(t)
    names = aggregates.top_vocabulary(typed, "type", 3)
    slots = {f"top{i}": name for i, name in enumerate(names, start=1)}
    return aggregates.category_counts(typed, ["month"], "type", slots, total="all_types")


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus AS snapshot FROM orders")
def union_all_snapshots(t: Tables) -> DataFrame:
    def part(status: str, *columns: str) -> DataFrame:
        return t.orders.filter(F.col("o_orderstatus") == status).select(*columns)

    return tagged_snapshots(
        {
            "O": part("O", "o_orderkey", "o_custkey", "o_totalprice"),
            "F": part("F", "o_totalprice", "o_orderkey", "o_custkey"),
            "P": part("P", "o_custkey", "o_totalprice", "o_orderkey"),
        },
        tag="snapshot",
    )
