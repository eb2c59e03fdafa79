"""Data-quality rules as boolean columns. Each is TRUE for a row to keep."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import as_col
from .text import BAD_LINE, is_double_text, is_int_text


def every(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def has_width(cells: Column | str, width: int) -> Column:
    return F.size(as_col(cells)) == width


def fits(record: Column | str) -> Column:
    """The line of a ``csv_record`` has the width asked for; a NULL line has none."""
    record = as_col(record)
    return record.isNotNull() & record[BAD_LINE].isNull()


def required(*cols: Column | str) -> Column:
    """All given cells hold text; NULL counts as empty."""
    return every(F.coalesce(as_col(c) != "", F.lit(False)) for c in cols)


def ints(*cols: Column | str) -> Column:
    return every(is_int_text(c) for c in cols)


def doubles(*cols: Column | str) -> Column:
    return every(is_double_text(c) for c in cols)


def complete(*cols: str) -> Column:
    """No given column is NULL.

    One test per column, where ``na.drop`` makes a single test over all of them: the
    optimizer derives variants of each test for every renamed column, and their number
    doubles with each column inside one test.
    """
    return every(F.col(c).isNotNull() for c in cols)


def some_present(*cols: str) -> Column:
    """At least one of the given numeric columns is not NULL."""
    return F.coalesce(*(F.col(c).cast("double") for c in cols)).isNotNull()


def numbered_row(first: Column | str) -> Column:
    """Drops blank rows and repeated header rows: the first cell is all digits."""
    return F.coalesce(as_col(first).rlike(r"^\d+$"), F.lit(False))


def date_in_year(c: Column | str, two_digits: str) -> Column:
    """The date text ends in the given two-digit year."""
    return as_col(c).endswith("/" + two_digits)


def positive(*cols: Column | str) -> Column:
    return every(as_col(c) > 0 for c in cols)


def text_length(c: Column | str, n: int) -> Column:
    return F.length(as_col(c)) == n


def five_digits(c: Column | str) -> Column:
    return as_col(c).rlike(r"^\d{5}$")


def at_least(minimum: dict[str, float]) -> Column:
    """No score lies under its minimum. A NULL score leaves the rule undecided,
    and a filter drops undecided rows."""
    below = reduce(lambda a, b: a | b, (F.col(c) < v for c, v in minimum.items()))
    return ~below
