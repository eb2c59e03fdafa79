"""Projections and row shaping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.months import date_prefix, month_text
from ..functions.text import build_key, split_key, split_outer_comma, to_double, to_int, unquote
from ..operators import aggregates
from ..operators.learning import feature_columns as all_but_label
from .catalog import Tables, query


@query(
    """SELECT doc_id, CAST(4 AS INT) AS n_cells, CAST(doc_id AS VARCHAR) AS first, replace(text, '"', '''') AS second, lang AS third
    FROM documents""",
    name="split_outer_comma",
)
def split_outer_comma_cells(t: Tables) -> DataFrame:
    quoted = F.concat(F.lit('"'), F.translate("text", '"', "'"), F.lit('"'))
    line = F.concat_ws(",", F.col("doc_id").cast("string"), quoted, F.col("lang"), F.lit(""))
    split = t.documents.select("doc_id", F.explode(F.array(split_outer_comma(line))).alias("cells"))
    return split.select(
        "doc_id",
        F.size("cells").alias("n_cells"),
        F.get("cells", F.lit(0)).alias("first"),
        unquote(F.get("cells", F.lit(1))).alias("second"),
        F.get("cells", F.lit(2)).alias("third"),
    )


@query("SELECT l_orderkey, l_partkey, l_extendedprice, l_shipdate FROM lineitem")
def project_columns(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice", "l_shipdate")


@query(
    """SELECT CAST(o_orderkey AS INT) AS id, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderpriority AS kind,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS amount FROM orders"""
)
def typed_record(t: Tables) -> DataFrame:
    text = t.orders.selectExpr(
        "CAST(o_orderkey AS STRING) AS id",
        "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') AS stamp",
        "o_orderpriority AS kind",
        "CASE WHEN o_orderkey % 11 = 0 THEN 'N/A' ELSE CAST(o_totalprice AS STRING) END AS amount",
    )
    return text.select(
        to_int("id").alias("id"), date_prefix("stamp").alias("day"), "kind", to_double("amount").alias("amount")
    )


@query("SELECT c_custkey AS host_id, c_mktsegment AS property_type, c_nationkey AS zone, c_acctbal AS balance FROM customer")
def rename_columns(t: Tables) -> DataFrame:
    names = {"c_custkey": "host_id", "c_mktsegment": "property_type", "c_nationkey": "zone", "c_acctbal": "balance"}
    return t.customer.select(*names).withColumnsRenamed(names)


@query(
    """SELECT o_orderkey,
    CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey AS INT) END AS as_int,
    CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS as_double FROM orders"""
)
def safe_cast(t: Tables) -> DataFrame:
    text = t.orders.selectExpr(
        "o_orderkey",
        "CASE WHEN o_orderkey % 11 = 0 THEN 'N/A' WHEN o_orderkey % 5 = 0 THEN concat(o_custkey, '.5') "
        "ELSE CAST(o_custkey AS STRING) END AS a",
        "CASE WHEN o_orderkey % 7 = 0 THEN concat(o_totalprice, 'd') WHEN o_orderkey % 11 = 0 THEN '' "
        "ELSE CAST(o_totalprice AS STRING) END AS b",
    )
    return text.select("o_orderkey", to_int("a").alias("as_int"), to_double("b").alias("as_double"))


@query("SELECT * EXCLUDE (l_tax, l_discount, l_linestatus) FROM lineitem")
def drop_columns(t: Tables) -> DataFrame:
    return t.lineitem.drop("l_tax", "l_discount", "l_linestatus")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') || '|' || o_custkey AS key FROM orders")
def composite_key_build(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", build_key(month_text("o_orderdate"), "o_custkey").alias("key"))


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, CAST(o_custkey AS VARCHAR) AS zone FROM orders"""
)
def composite_key_split(t: Tables) -> DataFrame:
    keyed = t.orders.select("o_orderkey", build_key(month_text("o_orderdate"), "o_custkey").alias("key"))
    return keyed.select("o_orderkey", split_key("key", 0).alias("month"), split_key("key", 1).alias("zone"))


@query(
    """SELECT l_orderkey, l_partkey, CASE WHEN l_orderkey % 9 = 0 THEN NULL
    ELSE l_extendedprice / l_quantity END AS unit_price FROM lineitem"""
)
def unit_price(t: Tables) -> DataFrame:
    area = F.expr("CASE WHEN l_orderkey % 9 = 0 THEN 0 ELSE l_quantity END")
    return t.lineitem.select(
        "l_orderkey", "l_partkey", aggregates.unit_price("l_extendedprice", area).alias("unit_price")
    )


@query("SELECT * EXCLUDE (o_totalprice) FROM orders")
def feature_columns(t: Tables) -> DataFrame:
    return t.orders.select(all_but_label(t.orders, label="o_totalprice"))
