"""Command line for the stages of a study, from raw files to models and scores.

    python -m zonepulse.jobs clean-complaints --input raw.csv --output complaints
    python -m zonepulse.jobs sort-sheets      --input 'sheets/*.csv' --output sheets_by_year
    python -m zonepulse.jobs clean-sales      --input 'sheets_by_year/*/*/*.csv' --output sale_means
    python -m zonepulse.jobs clean-listings   --snapshot 2019/03=mar19.csv --snapshot 2019/04=apr19.csv --output listings
    python -m zonepulse.jobs profile          --input listings --output listing_profile
    python -m zonepulse.jobs overview         --complaints ... --sheets ... --listings ... --output overview
    python -m zonepulse.jobs correlate        --complaints ... --sales ... --listings ... --output correlations
    python -m zonepulse.jobs neighbourhood    --complaints ... --sales ... --output neighbourhood
    python -m zonepulse.jobs train            --neighbourhood ... --listings ... --models models --output metrics
    python -m zonepulse.jobs score            --requests ... --neighbourhood ... --model models/forest --output scores

Stages pass Parquet to each other, or with ``--format`` the study's text forms: ``tuple``
(lines of ``(a,b,c)``), ``csv`` (no header) or ``titled`` (CSV with a header line).
``--input-format`` says what the inputs of a stage are.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import aggregates, learning, profile, quality
from .plans import complaints, listings, sales, study
from .schemas import (
    COMPLAINT_SCHEMA,
    COMPLAINT_WIDTH,
    LISTING_RAW_SCHEMA,
    LISTING_SCHEMA,
    REQUEST_SCHEMA,
    SALE_MEAN_SCHEMA,
    SALE_PRICE,
    SALE_RAW_SCHEMA,
)
from .session import build_session, clear_scratch, materialise
from .sources import readers, writers

ESTIMATORS = {"linear": learning.linear, "boosted_trees": learning.boosted_trees, "forest": learning.forest}
FORMATS = ["parquet", "tuple", "csv", "titled"]
SHEET_NAME = r"(?:^|[/_])(manhattan|bronx|brooklyn|queens|statenisland)_(?:year_)?(\d{4}|rolling)"


def _audited(spark: SparkSession, rows: DataFrame, rules: quality.Rules, shape: Callable, a) -> DataFrame:
    """Shaped rows that pass the rules; with ``--report`` their counts come from the same scan."""
    if not a.report:
        return shape(quality.keep(rows, rules))
    kept, seen = quality.observed(rows, rules)
    stored = materialise(shape(kept))
    writers.parquet_table(quality.observed_attrition(spark, seen, rules), a.report, mode=a.mode)
    return stored


def clean_complaints(spark: SparkSession, a) -> DataFrame:
    lines = readers.text_lines(spark, a.input)
    width = complaints.header_width(lines) if a.width == "infer" else int(a.width)
    split = complaints.split_lines(lines, width=width)
    return _audited(spark, split, complaints.line_rules(), complaints.typed, a)


def sort_sheets(spark: SparkSession, a) -> None:
    """Decoded sheets, named by district and year, to one directory per both.

    What the names tell is known from the listing, so the sheets are read once.
    """
    parts = {"district": "string", "year": "string"}
    names = readers.file_parts(spark, a.input, SHEET_NAME, parts)
    unnamed = [f for f, found in names.items() if found["district"] is None]
    named = [f for f in names if f not in unnamed]
    if unnamed and not a.unnamed:
        raise SystemExit("some file names tell no district and year; name a folder for their rows with --unnamed")
    if not a.rolling_year and any(names[f]["year"] == "rolling" for f in named):
        raise SystemExit("there are rolling sheets; say with --rolling-year which year of them to keep")
    if a.unnamed:
        raw = readers.csv_table(spark, unnamed, SALE_RAW_SCHEMA, header=False, sep=";") if unnamed else spark.createDataFrame([], SALE_RAW_SCHEMA)
        writers.parquet_table(raw, a.unnamed, mode=a.mode)
    if not named:
        return
    rows = sales.sheet_rows(readers.named_files(spark, named, SALE_RAW_SCHEMA, SHEET_NAME, parts))
    if a.rolling_year:
        rolling = F.col("year") == "rolling"
        rows = rows.filter(~rolling | sales.of_year(a.rolling_year[-2:]))
        rows = rows.withColumn("year", F.when(rolling, F.lit(str(int(a.rolling_year)))).otherwise(F.col("year")))
    writers.partitioned_csv(rows, a.output, ["district", "year"], mode=a.mode)


def _sheet_cells(spark: SparkSession, path: str) -> DataFrame:
    raw = readers.csv_table(spark, path, SALE_RAW_SCHEMA, header=False, sep=";")
    return sales.select_cells(sales.sheet_rows(raw))


def clean_sales(spark: SparkSession, a) -> DataFrame:
    cells = _sheet_cells(spark, a.input)
    if a.rejects:  # the four cells are stored, so that the sheets are read once
        cells = materialise(cells)
        writers.parquet_table(quality.bad_numbers(cells, sales.FIGURES), a.rejects, mode=a.mode)
    rows = _audited(spark, sales.figures(cells), sales.figure_rules(), sales.values, a)
    return sales.mean_unit_price(rows, study.KEYS)


def clean_listings(spark: SparkSession, a) -> DataFrame:
    files: dict[str, list[str]] = {}
    for given in a.snapshot:
        period, _, path = given.partition("=")
        files.setdefault(period, []).append(path)
    raw = readers.snapshot_files(spark, files, LISTING_RAW_SCHEMA, listings.TAG)
    return _audited(spark, raw, listings.row_rules(), listings.clean, a) if a.report else listings.clean(raw)


def profile_job(spark: SparkSession, a) -> DataFrame:
    return profile.profile_table(readers.parquet_table(spark, a.input), exact=a.exact)


def domains(spark: SparkSession, a) -> DataFrame:
    """(column, value) of every distinct value of the given columns."""
    rows = readers.parquet_table(spark, a.input)
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in a.column)))
    return rows.select(each.alias("x")).select("x.*").distinct()


def areas(spark: SparkSession, a) -> DataFrame:
    """Per zone: listings with their price statistics, complaints, and mean unit price."""
    prices = aggregates.level_by(_keyed_listings(spark, a), ["zone"], "price", "price")
    reported = _keyed_complaints(spark, a).groupBy("zone").agg(F.count(F.lit(1)).alias("complaints"))
    means = _sale_means(spark, a).groupBy("zone").agg(F.avg(SALE_PRICE).alias(SALE_PRICE))
    return prices.join(reported, "zone", "full").join(means, "zone", "full")


def overview(spark: SparkSession, a) -> DataFrame:
    return study.monthly_overview(
        _keyed_listings(spark, a), _keyed_complaints(spark, a), sales.clean(_sheet_cells(spark, a.sheets))
    )


def correlate(spark: SparkSession, a) -> DataFrame:
    means = _sale_means(spark, a)
    shifts = list(range(a.first_shift, a.last_shift + 1))
    return study.correlations(_keyed_listings(spark, a), _keyed_complaints(spark, a), means, shifts)


def neighbourhood(spark: SparkSession, a) -> DataFrame:
    return study.neighbourhood_profile(_keyed_complaints(spark, a), _sale_means(spark, a), a.shift)


def train(spark: SparkSession, a) -> DataFrame:
    clean = _read(spark, a.listings, LISTING_SCHEMA, a.input_format).selectExpr("*", "xxhash64(*) AS listing_id")
    rows = listings.features(clean, carry=("listing_id",))
    frame = study.training_frame(rows, readers.parquet_table(spark, a.neighbourhood), carry=("listing_id",))
    report, models = learning.compare(frame, "listing_id", {n: ESTIMATORS[n]() for n in a.estimator or ESTIMATORS})
    for name, model in models.items():
        learning.save_model(model, f"{a.models}/{name}")
        weights = learning.coefficients if name == "linear" else learning.importances
        writers.parquet_table(weights(spark, model), f"{a.models}/{name}_weights", mode=a.mode)
    return report


def score(spark: SparkSession, a) -> DataFrame:
    requests = readers.csv_table(spark, a.requests, REQUEST_SCHEMA)
    return study.score(requests, readers.parquet_table(spark, a.neighbourhood), learning.load_model(a.model))


def _keyed_complaints(spark: SparkSession, a) -> DataFrame:
    return complaints.keyed(_read(spark, a.complaints, COMPLAINT_SCHEMA, a.input_format))


def _keyed_listings(spark: SparkSession, a) -> DataFrame:
    return listings.keyed(_read(spark, a.listings, LISTING_SCHEMA, a.input_format), "price")


def _sale_means(spark: SparkSession, a) -> DataFrame:
    return _read(spark, a.sales, SALE_MEAN_SCHEMA, a.input_format)


def _read(spark: SparkSession, path: str, schema, form: str) -> DataFrame:
    if form == "parquet":
        return readers.parquet_table(spark, path)
    if form == "tuple":
        return readers.tuple_text(spark, path, schema)
    return readers.csv_table(spark, path, schema, header=form == "titled")


def _write(result: DataFrame, path: str, form: str, mode: str) -> None:
    if form == "parquet":
        writers.parquet_table(result, path, mode=mode)
    elif form == "tuple":
        writers.tuple_text(result, path, mode=mode)
    else:
        writers.csv_header(result, path, header=form == "titled", mode=mode)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="zonepulse")
    jobs = top.add_subparsers(required=True)

    def job(name: str, run: Callable, *inputs: str) -> argparse.ArgumentParser:
        p = jobs.add_parser(name)
        for i in inputs:
            p.add_argument(f"--{i}", required=True)
        p.add_argument("--output", required=True)
        p.add_argument("--format", default="parquet", choices=FORMATS)
        p.add_argument("--input-format", default="parquet", choices=FORMATS)
        p.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite", "replace"])
        p.set_defaults(run=run)
        return p

    p = job("clean-complaints", clean_complaints, "input")
    p.add_argument("--width", default=str(COMPLAINT_WIDTH), help="cells per line, or 'infer' to take the first line's number")
    p.add_argument("--report")
    p = job("sort-sheets", sort_sheets, "input")
    p.add_argument("--rolling-year", help="the one year to keep of the rolling sheets")
    p.add_argument("--unnamed", help="where rows of files go whose names tell no district and year")
    p = job("clean-sales", clean_sales, "input")
    p.add_argument("--report")
    p.add_argument("--rejects")
    p = job("clean-listings", clean_listings)
    p.add_argument("--snapshot", action="append", required=True, metavar="yyyy/MM=path")
    p.add_argument("--report")
    p = job("profile", profile_job, "input")
    p.add_argument("--exact", action="store_true", help="exact distinct counts instead of sketches")
    p = job("domains", domains, "input")
    p.add_argument("--column", action="append", required=True)
    job("areas", areas, "complaints", "sales", "listings")
    job("overview", overview, "complaints", "sheets", "listings")
    p = job("correlate", correlate, "complaints", "sales", "listings")
    p.add_argument("--first-shift", type=int, default=study.SHIFTS[0])
    p.add_argument("--last-shift", type=int, default=study.SHIFTS[-1])
    p = job("neighbourhood", neighbourhood, "complaints", "sales")
    p.add_argument("--shift", type=int, default=study.TRAINING_SHIFT)
    p = job("train", train, "neighbourhood", "listings", "models")
    p.add_argument("--estimator", action="append", choices=list(ESTIMATORS))
    job("score", score, "requests", "neighbourhood", "model")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or build_session("zonepulse")
    try:
        result = a.run(spark, a)
        if result is not None:
            _write(result, a.output, a.format, a.mode)
    finally:
        clear_scratch(spark)


if __name__ == "__main__":
    main()
