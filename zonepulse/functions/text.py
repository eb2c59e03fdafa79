"""Cell splitting and number parsing for dirty text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import as_col

INT_TEXT = r"^[+-]?\d+$"
DOUBLE_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# --- fixed values: the unsigned decimal the sale audit accepts ---
PLAIN_NUMBER = r"^([0-9]*[.])?[0-9]+$"
# --- end of fixed values ---

_MARK = "\u0001"
_ESCAPE = "\u0002"


def _swap(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def is_int_text(c: Column | str) -> Column:
    """Text that parses as a 32-bit int; never NULL."""
    c = as_col(c)
    return F.coalesce(c.rlike(INT_TEXT) & c.try_cast("int").isNotNull(), F.lit(False))


def is_double_text(c: Column | str) -> Column:
    """Text that parses as a double; the pattern keeps out suffixes such as ``1d``."""
    c = as_col(c)
    return F.coalesce(c.rlike(DOUBLE_TEXT) & c.try_cast("double").isNotNull(), F.lit(False))


def to_int(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(c.rlike(INT_TEXT), c.try_cast("int"))


def to_double(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(c.rlike(DOUBLE_TEXT), c.try_cast("double"))


def parse_money(c: Column | str, strip_commas: bool = True) -> Column:
    """``$1,499.00`` to 1499.0.

    With ``strip_commas=False`` only the dollar sign goes, so an amount with a
    thousands separator becomes NULL (and is lost by a later NULL filter).
    """
    return to_double(F.translate(as_col(c), "$," if strip_commas else "$", ""))


def parse_number(c: Column | str, symbols: str = "$,", legacy_sign: bool = False) -> Column:
    """A dirty sale figure as double, NULL when no number is left.

    A dash in front means a negative number (``- 5`` is -5.0);
    ``legacy_sign=True`` deletes dashes instead (``- 5`` is 5.0).
    """
    bare = F.trim(F.translate(as_col(c), symbols, ""))
    if legacy_sign:
        bare = F.trim(F.translate(bare, "-", ""))
    else:
        # Few cells begin with a dash; only those pay for the pattern.
        bare = F.when(bare.startswith("-"), F.regexp_replace(bare, r"^-\s+", "-")).otherwise(bare)
    return to_double(bare)


def is_plain_number(c: Column | str, symbols: str = "$,") -> Column:
    """Whether the stripped cell is an unsigned decimal (the audit's test)."""
    return F.trim(F.translate(as_col(c), symbols, "")).rlike(PLAIN_NUMBER)


def split_outer_comma(line: Column | str, keep_trailing: bool = True) -> Column:
    """Cells of a line, split on the commas outside double quotes.

    A comma separates when an even number of quotes follows it. Cut at its quotes
    and read from the end, a line has every second piece outside of quotes, whether
    or not the quotes pair up; so the work is linear in the line. Quotes stay in the
    cells. With ``keep_trailing=False`` empty cells at the end are dropped.
    """
    line = as_col(line)

    def cells(text: Column, separator: str) -> Column:
        if keep_trailing:
            return F.split(text, separator, -1)
        # The end of a line lies outside of quotes, so the raw line tells if there is work.
        kept = F.when(line.endswith(","), F.rtrim(text, F.lit(separator))).otherwise(text)
        return F.split(kept, separator, -1)

    def mark(text: Column) -> Column:
        # The lambda refers to nothing but its own arguments: anything else would be
        # evaluated again for every piece.
        outer = F.transform(
            F.reverse(F.split(text, '"', -1)),
            lambda piece, i: F.when(i % 2 == 0, _swap(piece, ",", _MARK)).otherwise(piece),
        )
        return F.array_join(F.reverse(outer), '"')

    # A line that holds the mark itself has it spelled in two characters meanwhile.
    spelled = _swap(_swap(line, _ESCAPE, _ESCAPE + "b"), _MARK, _ESCAPE + "a")
    restored = F.transform(
        cells(mark(spelled), _MARK), lambda c: _swap(_swap(c, _ESCAPE + "a", _MARK), _ESCAPE + "b", _ESCAPE)
    )
    split = (
        F.when(~F.contains(line, F.lit('"')), cells(line, ","))
        .when(~F.contains(line, F.lit(_MARK)), cells(mark(line), _MARK))
        .otherwise(restored)
    )
    if keep_trailing:
        return split
    only_commas = line.startswith(",") & (F.rtrim(line, F.lit(",")) == "")
    return F.when(only_commas, F.array().cast("array<string>")).otherwise(split)


BAD_LINE = "_bad"


def csv_record(line: Column | str, width: int) -> Column:
    """The cells ``c0``, ``c1``, ... of a comma line as one struct, read by Spark's CSV parser.

    Empty cells at the end are cut off first, so they do not count. A line of another width
    has its text in the field ``_bad``. One without cells and one with an odd number of
    quotes, of which no parser can tell where its cells end, give NULL. An empty cell is NULL, a quoted empty one is ''.
    """
    line = F.rtrim(as_col(line), F.lit(","))
    fields = ", ".join(f"c{i} STRING" for i in range(width))
    options = {"mode": "PERMISSIVE", "escape": '"', "columnNameOfCorruptRecord": BAD_LINE, "maxColumns": str(1 << 20)}
    paired = (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 0
    return F.from_csv(F.when(paired & (line != ""), line), f"{fields}, {BAD_LINE} STRING", options)


def unquote(cell: Column | str) -> Column:
    """A cell without its enclosing quotes; doubled quotes become one."""
    cell = as_col(cell)
    quoted = (F.length(cell) >= 2) & cell.startswith('"') & cell.endswith('"')
    inner = F.replace(F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))
    return F.when(quoted, inner).otherwise(cell)


def tuple_cells(line: Column | str) -> Column:
    """Cells of a ``(a,b,c)`` line: first and last character dropped, split on commas."""
    line = as_col(line)
    return F.split(F.substring(line, F.lit(2), F.length(line) - 2), ",", -1)


def build_key(*parts: Column | str, sep: str = "|") -> Column:
    """``month|zone``; NULL when a part is."""
    pieces = [as_col(parts[0]).cast("string")]
    for p in parts[1:]:
        pieces += [F.lit(sep), as_col(p).cast("string")]
    return F.concat(*pieces)


def split_key(key: Column | str, index: int, sep: str = "|") -> Column:
    return F.get(F.split(as_col(key), f"\\{sep}"), F.lit(index))
