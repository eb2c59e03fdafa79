"""Month parsing and month arithmetic on ``yyyy-MM`` text."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import as_col

_US_DATE = r"^(\d{1,2})/[^/]*/(\d{1,2}|\d{4})(/.*)?$"


def month_text(c: Column | str) -> Column:
    """``yyyy-MM`` of a date or timestamp (through date, so no time zone enters)."""
    return F.substring(as_col(c).cast("date").cast("string"), 1, 7)


def month_start(c: Column | str) -> Column:
    """First day of a ``yyyy-MM`` month; NULL when the text is no month."""
    return F.concat(as_col(c), F.lit("-01")).try_cast("date")


def in_month(c: Column | str, month: str) -> Column:
    """Whether a date or timestamp column lies in a ``yyyy-MM`` month, as a range on
    the bare column, so that a scan can skip the row groups outside of it."""
    first = datetime.date.fromisoformat(f"{month}-01")
    after = (first + datetime.timedelta(days=31)).replace(day=1)
    return (as_col(c) >= F.lit(first)) & (as_col(c) < F.lit(after))


def format_month(c: Column | str) -> Column:
    """``M/d/y`` to ``yyyy-MM``; the month must be 1 to 12 and the year have 1, 2 or 4
    digits, else NULL.

    Left-padding with "200" completes all three widths: 3 -> 2003, 13 -> 2013.
    """
    c = as_col(c)
    month = F.lpad(F.regexp_extract(c, _US_DATE, 1), 2, "0")
    year = F.lpad(F.regexp_extract(c, _US_DATE, 2), 4, "200")
    return F.when(c.rlike(_US_DATE) & month.between("01", "12"), F.concat(year, F.lit("-"), month))


def shift_month(c: Column | str, k: Column | int) -> Column:
    """Move a ``yyyy-MM`` key by k months: k > 0 goes forward (a lag: earlier
    values meet later keys), k < 0 backward (a lead)."""
    k = F.lit(k) if isinstance(k, int) else k
    return month_text(F.add_months(month_start(c), k))


def next_month(c: Column | str) -> Column:
    return shift_month(c, 1)


def previous_month(c: Column | str) -> Column:
    return shift_month(c, -1)


def month_from_slash(c: Column | str) -> Column:
    """``yyyy/MM`` or ``yyyy/MM/dd`` to ``yyyy-MM``."""
    parts = F.split(as_col(c), "/")
    return F.concat(F.get(parts, F.lit(0)), F.lit("-"), F.get(parts, F.lit(1)))


def date_prefix(c: Column | str, width: int = 10) -> Column:
    """The date part of a timestamp text."""
    return F.substring(as_col(c), 1, width)


def drop_day(c: Column | str) -> Column:
    """``yyyy-MM-dd`` to ``yyyy-MM``: everything but the last three characters."""
    c = as_col(c)
    return F.substring(c, F.lit(1), F.length(c) - 3)


def parse_us_date(c: Column | str) -> Column:
    """``MM/dd/yyyy...`` to a date, NULL when it is none."""
    return F.regexp_replace(as_col(c), r"^(\d{2})/(\d{2})/(\d{4}).*$", "$3-$1-$2").try_cast("date")


def reorder_us_date(c: Column | str) -> Column:
    """``MM/dd/yyyy`` to ``yyyy/MM/dd``, the order in which text sorts by time."""
    return F.regexp_replace(as_col(c), r"^(\d{2})/(\d{2})/(\d{4}).*$", "$3/$1/$2")
