"""Property sales: raw semicolon rows to unit prices to means per month and zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.months import format_month
from ..functions.text import parse_number
from ..operators.aggregates import mean_by, unit_price
from ..operators.joins import shifted
from ..operators.quality import Rules, keep
from ..operators.shaping import derive
from ..schemas import SALE_POSITIONS, SALE_PRICE

# Symbols stripped from each figure before it must be a number.
FIGURES = {"area": ",", "price": "$,"}


def select_cells(raw: DataFrame) -> DataFrame:
    """The four used cells of rows with columns c0, c1, ..."""
    return raw.select(*(F.col(f"c{i}").alias(name) for name, i in SALE_POSITIONS.items()))


def sheet_rows(raw: DataFrame, only_year: str | None = None) -> DataFrame:
    """Rows of a decoded sheet without blank and header rows. ``only_year`` (two
    digits) keeps one year of a rolling sheet, so that years already loaded from
    their own sheets are not counted twice."""
    rows = raw.filter(rules.numbered_row("c0"))
    if only_year is None:
        return rows
    return rows.filter(of_year(only_year))


def of_year(two_digits: str) -> Column:
    """The sale's date is in this year."""
    return rules.date_in_year(f"c{SALE_POSITIONS['date']}", two_digits)


def figures(cells: DataFrame, legacy_sign: bool = False) -> DataFrame:
    """The text cells with ``area_value`` and ``price_value`` beside them; NULL where
    the text is no number. Each figure is parsed once, however many rules test it."""
    return derive(cells, {f"{c}_value": parse_number(c, symbols, legacy_sign) for c, symbols in FIGURES.items()})


def figure_rules() -> Rules:
    """The rules on ``figures`` rows, in order."""
    return [
        ("required cells", rules.required("zip", "area", "price", "date")),
        ("numbers parse", rules.complete("area_value", "price_value")),
        ("area positive", rules.positive("area_value")),
        ("price positive", rules.positive("price_value")),
        ("zip length", rules.text_length(F.trim("zip"), 5)),
        ("date parses", format_month(F.trim("date")).isNotNull()),
    ]


def clean(cells: DataFrame, legacy_sign: bool = False) -> DataFrame:
    """Text cells to (month, zone, area, price)."""
    return values(keep(figures(cells, legacy_sign), figure_rules()))


def values(kept: DataFrame) -> DataFrame:
    """(month, zone, area, price) of ``figures`` rows that pass the rules."""
    return kept.select(
        format_month(F.trim("date")).alias("month"),
        F.trim("zip").alias("zone"),
        F.col("area_value").alias("area"),
        F.col("price_value").alias("price"),
    )


def mean_unit_price(sales: DataFrame, keys: list[str], shift: int = 0) -> DataFrame:
    """Mean price per unit of area per key."""
    table = mean_by(sales, keys, unit_price("price", "area"), SALE_PRICE)
    return shifted(table, shift) if shift else table
