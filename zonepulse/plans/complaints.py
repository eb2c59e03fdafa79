"""Complaint records: raw 41-cell lines to typed rows to counts per month and zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules
from ..functions.months import date_prefix, format_month
from ..functions.text import csv_record, to_double, to_int
from ..operators.aggregates import category_counts
from ..operators.joins import shifted
from ..operators.quality import Rules, keep
from ..schemas import COMPLAINT_POSITIONS, COMPLAINT_SCHEMA, COMPLAINT_WIDTH

INTS = ("id", "zip")
DOUBLES = ("lat", "lon")


def split_lines(lines: DataFrame, column: str = "value", width: int = COMPLAINT_WIDTH) -> DataFrame:
    """Column ``cells`` of each line: a struct of ``width`` cells, or the bad line.

    The parse goes through a generator so that it runs once per line: as a plain
    projection it would be copied into every rule that reads a cell.
    """
    return lines.select(F.explode(F.array(csv_record(column, width))).alias("cells"))


def header_width(lines: DataFrame) -> int:
    """Cell count of the first line."""
    first = lines.first()
    if first is None:
        raise ValueError("there is no first line to take the number of cells from")
    found = lines.sparkSession.range(1).select(F.schema_of_csv(F.lit(first[0].rstrip(",")), {"escape": '"'}))
    return len(T.DataType.fromDDL(found.first()[0]).fields)


def _cells() -> dict[str, Column]:
    return {name: F.col("cells")[f"c{i}"] for name, i in COMPLAINT_POSITIONS.items()}


def line_rules() -> Rules:
    """The rules on ``cells``, in order. The width rule also drops a line whose last cell is
    empty and one with unpaired quotes; the int rule also drops the header."""
    cell = _cells()
    return [
        ("cell count", rules.fits("cells")),
        ("required cells", rules.every(c.isNotNull() for c in cell.values())),
        ("int cells", rules.ints(*(cell[c] for c in INTS))),
        ("double cells", rules.doubles(*(cell[c] for c in DOUBLES))),
    ]


def clean(lines: DataFrame, width: int = COMPLAINT_WIDTH) -> DataFrame:
    """Raw lines to ``COMPLAINT_SCHEMA``."""
    return typed(keep(split_lines(lines, width=width), line_rules()))


def typed(split: DataFrame) -> DataFrame:
    cell = _cells()
    fields = []
    for field in COMPLAINT_SCHEMA:
        value = cell[field.name]
        if field.name in INTS:
            value = to_int(value)
        elif field.name in DOUBLES:
            value = to_double(value)
        elif field.name == "date":
            value = date_prefix(value)
        fields.append(value.alias(field.name))
    return split.select(*fields)


def keyed(complaints: DataFrame) -> DataFrame:
    """(month, zone, type) of clean rows; the zone is the zip as five digits."""
    return complaints.select(
        format_month("date").alias("month"),
        F.lpad(F.col("zip").cast("string"), 5, "0").alias("zone"),
        "type",
    )


def counts(keyed_rows: DataFrame, keys: list[str], shift: int = 0) -> DataFrame:
    """The 11 counts per key. The shift moves the few grouped rows, not the raw ones."""
    table = category_counts(keyed_rows, keys)
    return shifted(table, shift) if shift else table
