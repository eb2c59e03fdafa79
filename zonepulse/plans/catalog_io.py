"""Scans, sinks and whole cleaning stages that pass through files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.months import month_text
from ..schemas import LISTING_RAW_SCHEMA, LISTING_SCHEMA, SALE_MEAN_SCHEMA, SALE_PRICE, SALE_RAW_SCHEMA
from ..session import scratch_path
from ..sources import readers, writers
from . import complaints, listings, roles, sales
from .catalog import Tables, query


def _through(t: Tables, df: DataFrame, write: Callable, label: str, **options) -> str:
    """Write a derived frame to a fresh folder and give its path."""
    path = scratch_path(t.spark, label)
    write(df, path, **options)
    return path


def _schema(df: DataFrame, *columns: str) -> T.StructType:
    return df.select(*columns).schema if columns else df.schema


@query("SELECT concat_ws(',', o_orderkey, o_custkey, o_orderstatus) AS value FROM orders")
def scan_text_lines(t: Tables) -> DataFrame:
    lines = t.orders.select(F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus").alias("value"))
    path = scratch_path(t.spark, "lines")
    lines.write.text(path)
    return readers.text_lines(t.spark, path)


@query("SELECT o_orderkey, o_custkey, o_orderstatus AS folder FROM orders")
def scan_glob_multi_dir(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("folder"))
    path = _through(t, rows, writers.partitioned_csv, "glob", by=["folder"], sep=",")
    found = readers.csv_table(
        t.spark, f"{path}/*/*.csv", _schema(rows, "o_orderkey", "o_custkey"), header=False, with_file=True
    )
    folder = F.regexp_extract(readers.FILE, r"folder=([^/]+)/", 1)
    return found.select("o_orderkey", "o_custkey", folder.alias("folder"))


@query("SELECT doc_id, text, lang, source FROM documents")
def scan_csv_multiline(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "text", "lang", "source")
    path = _through(t, rows, writers.csv_header, "multiline", multiline=True)
    return readers.csv_table(t.spark, path, rows.schema, multiline=True)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv_header(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    path = _through(t, rows, writers.csv_header, "header")
    return readers.csv_table(t.spark, path, rows.schema)


@query("SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y') AS day, o_orderstatus, o_totalprice FROM orders")
def scan_tuple_text(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey", F.date_format("o_orderdate", "MM/dd/yyyy").alias("day"), "o_orderstatus", "o_totalprice"
    )
    path = _through(t, rows, writers.tuple_text, "tuple")
    return readers.tuple_text(t.spark, path, rows.schema)


@query(
    f"""SELECT month, CAST(10000 + zone AS VARCHAR) AS zone, round({roles.DUCK_UNIT_PRICE}, 6) AS real_estate_price
    FROM ({roles.DUCK_SALES}) GROUP BY ALL"""
)
def scan_month_zone_price(t: Tables) -> DataFrame:
    means = sales.mean_unit_price(roles.as_zip(roles.sales(t)), ["month", "zone"]).select(SALE_MEAN_SCHEMA.names)
    path = _through(t, means, writers.csv_plain, "means")
    return readers.month_zone_price(t.spark, path).withColumn(SALE_PRICE, F.round(SALE_PRICE, 6))


@query(f"SELECT nullif(zip, '') AS zip, area, price, date FROM ({roles.DUCK_RAW_SALES})")
def scan_csv_semicolon(t: Tables) -> DataFrame:
    rows = roles.raw_sales(t).drop("district", "year")
    path = _through(t, rows, writers.csv_header, "semicolon", header=False, sep=";")
    return sales.select_cells(readers.csv_table(t.spark, path, SALE_RAW_SCHEMA, header=False, sep=";"))


@query("SELECT l_orderkey, l_partkey, l_quantity, l_returnflag FROM lineitem")
def scan_parquet(t: Tables) -> DataFrame:
    rows = readers.parquet_table(t.spark, f"{t.folder}/lineitem.parquet")
    return rows.select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")


@query(
    """SELECT CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' ELSE 'partial' END AS meaning,
    count(*) AS n, max(o_totalprice) AS top_price FROM orders WHERE o_orderstatus IN ('O', 'F', 'P') GROUP BY 1"""
)
def inline_rows(t: Tables) -> DataFrame:
    meanings = readers.inline_rows(
        t.spark, [("O", "open"), ("F", "filled"), ("P", "partial")], "o_orderstatus string, meaning string"
    )
    # The vocabulary has three rows. Grouping first leaves one row per status to join.
    per_status = t.orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top_price")
    )
    return per_status.join(meanings, "o_orderstatus").select("meaning", "n", "top_price")


@query("SELECT o_totalprice AS price, o_orderkey AS listing_id, o_orderstatus AS room_type FROM orders")
def enforce_schema(t: Tables) -> DataFrame:
    declared = T.StructType(
        [
            T.StructField("price", T.DoubleType()),
            T.StructField("listing_id", T.LongType()),
            T.StructField("room_type", T.StringType()),
        ]
    )
    rows = t.orders.select(
        F.col("o_orderkey").alias("listing_id"), F.col("o_orderstatus").alias("room_type"), F.col("o_totalprice").alias("price")
    )
    return readers.enforce_schema(rows, declared)


@query(
    f"SELECT {', '.join(LISTING_RAW_SCHEMA.names)}, substr(Date, 1, 4) AS Date FROM ({roles.DUCK_RAW_LISTINGS})"
)
def snapshot_tag_union(t: Tables) -> DataFrame:
    rows = roles.raw_listings(t).withColumn("period", F.substring("Date", 1, 4)).drop("listing_id", "Date")
    path = _through(t, rows, writers.partitioned_csv, "snapshots", by=["period"], sep=",", header=True)
    # The directories tell the periods; the rows are not evaluated again for them.
    stored = t.spark.read.text(path).select("period").distinct().orderBy("period").collect()
    return readers.snapshot_files(t.spark, {str(r[0]): [f"{path}/period={r[0]}"] for r in stored}, LISTING_RAW_SCHEMA)


@query(f"SELECT nullif(zip, '') AS zip, price, district, year FROM ({roles.DUCK_RAW_SALES})")
def scan_partitioned_dirs(t: Tables) -> DataFrame:
    path = _through(t, roles.raw_sales(t), writers.partitioned_csv, "sheets", by=["district", "year"])
    rows = readers.named_files(
        t.spark,
        f"{path}/*/*/*.csv",
        SALE_RAW_SCHEMA,
        r"district=(\w+)/year=(\d+)/",
        {"district": "string", "year": "int"},
    )
    return rows.select(F.col("c10").alias("zip"), F.col("c19").alias("price"), "district", "year")


@query(
    """SELECT '(' || concat_ws(',', c_custkey, c_name, c_nationkey, c_acctbal) || ')' AS value FROM customer"""
)
def sink_tuple_text(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    return readers.text_lines(t.spark, _through(t, rows, writers.tuple_text, "tuples"))


@query("SELECT concat_ws(',', p_partkey, p_name, p_brand, p_size) AS value FROM part")
def sink_csv_plain(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", "p_name", "p_brand", "p_size")
    return readers.text_lines(t.spark, _through(t, rows, writers.csv_plain, "plain"))


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def sink_csv_header(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return readers.csv_by_name(t.spark, _through(t, rows, writers.csv_header, "titled"), rows.schema, multiline=False)


@query("SELECT o_orderkey, o_totalprice, o_orderstatus AS status, CAST(year(o_orderdate) AS INT) AS year FROM orders")
def sink_partitioned_csv(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("year")
    )
    path = _through(t, rows, writers.partitioned_csv, "tree", by=["status", "year"])
    return readers.partitioned_csv(t.spark, path, rows.schema)


@query("SELECT event_id, user_id, event_type, value FROM events")
def sink_parquet(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    return readers.parquet_table(t.spark, _through(t, rows, writers.parquet_table, "columns"))


@query("SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def sink_replace_period(t: Tables) -> DataFrame:
    """A tree by month, one month of which is spoilt and then written again, and again."""
    rows = t.orders.select("o_orderkey", "o_totalprice", month_text("o_orderdate").alias("month"))
    path = _through(t, rows, writers.parquet_table, "months", by=["month"])
    month = rows.filter(F.col("month") == "1998-01")
    for again in (month.withColumn("o_totalprice", F.lit(0.0)), month, month):
        writers.parquet_table(again, path, by=["month"], mode="replace")
    return readers.parquet_table(t.spark, path).select(*rows.columns[:2], F.col("month").cast("string").alias("month"))


@query(f"SELECT nullif(zip, '') AS zip, price, 'queens' AS district, CAST(1997 AS INT) AS year FROM ({roles.DUCK_RAW_SALES}) WHERE district = 'queens' AND year = 1997")
def scan_one_district_year(t: Tables) -> DataFrame:
    """One sheet of the tree: files whose names tell another district or year are not scanned."""
    path = _through(t, roles.raw_sales(t), writers.partitioned_csv, "sheets", by=["district", "year"])
    parts = {"district": "string", "year": "int"}
    only = {"district": "queens", "year": "1997"}
    rows = readers.named_files(t.spark, f"{path}/*/*/*.csv", SALE_RAW_SCHEMA, r"district=(\w+)/year=(\d+)/", parts, only=only)
    return rows.select(F.col("c10").alias("zip"), F.col("c19").alias("price"), "district", "year")


@query(roles.DUCK_CLEAN_COMPLAINTS)
def clean_complaints(t: Tables) -> DataFrame:
    """Raw lines to clean records, stored as Parquet and read back."""
    path = scratch_path(t.spark, "complaints-raw")
    roles.raw_complaint_lines(t).write.text(path)
    cleaned = complaints.clean(readers.text_lines(t.spark, path))
    # A board holds a comma, which tuple text cannot carry.
    return readers.parquet_table(t.spark, _through(t, cleaned, writers.parquet_table, "complaints-clean"))


@query(
    f"""SELECT month, zone, round({roles.DUCK_UNIT_PRICE}, 6) AS real_estate_price
    FROM ({roles.DUCK_CLEAN_SALES} AND first <> 'BOROUGH') GROUP BY ALL"""
)
def clean_sales(t: Tables) -> DataFrame:
    """Sheets by district and year to the mean unit price per month and zip."""
    path = _through(t, roles.raw_sales(t), writers.partitioned_csv, "sales-raw", by=["district", "year"])
    raw = readers.csv_table(t.spark, f"{path}/*/*/*.csv", SALE_RAW_SCHEMA, header=False, sep=";")
    cleaned = sales.clean(sales.select_cells(sales.sheet_rows(raw)))
    means = sales.mean_unit_price(cleaned, ["month", "zone"])
    return means.withColumn(SALE_PRICE, F.round(SALE_PRICE, 6))


@query(f"SELECT {', '.join(LISTING_SCHEMA.names)} FROM ({roles.DUCK_CLEAN_LISTINGS})")
def clean_listings(t: Tables) -> DataFrame:
    """Monthly listing rows to the 17 clean columns, through a titled CSV file."""
    cleaned = listings.clean(roles.raw_listings(t))
    path = _through(t, cleaned.drop("listing_id"), writers.csv_header, "listings-clean")
    return readers.csv_table(t.spark, path, LISTING_SCHEMA)
