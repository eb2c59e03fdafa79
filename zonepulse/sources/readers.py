"""Scans. Types are always declared; where columns are found by name, only header lines are
read for it, and a header that does not fit the schema fails."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import to_double, to_int, tuple_cells
from ..schemas import SALE_MEAN_SCHEMA

FILE = "source_file"


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def csv_table(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    header: bool = True,
    sep: str = ",",
    multiline: bool = False,
    with_file: bool = False,
) -> DataFrame:
    """A CSV scan with doubled quotes as escape. An empty cell, quoted or not, is NULL.
    With ``header=True`` each file's header must name the schema's columns in order.

    ``multiline=True`` lets quoted cells hold line breaks; Spark then reads each
    file in one task, so such data should come in files of bounded size.
    """
    df = (
        spark.read.schema(schema)
        .option("header", header)
        .option("enforceSchema", not header)
        .option("sep", sep)
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )
    return df.withColumn(FILE, F.col("_metadata.file_path")) if with_file else df


def csv_by_name(
    spark: SparkSession, path: str | list[str], schema: T.StructType, multiline: bool = True
) -> DataFrame:
    """Wanted columns of a wide CSV file picked by header name, then typed.

    Only the header is read up front. A file whose header differs from the first one's
    fails the scan: read it on its own. A cell that does not parse becomes NULL.
    """
    raw = _titled(spark, path, multiline)
    return raw.select([_typed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema])


def _titled(spark: SparkSession, path: str | list[str], multiline: bool) -> DataFrame:
    read = spark.read.option("header", True).option("enforceSchema", False).option("escape", '"')
    return read.option("multiLine", multiline).csv(path)


def _typed(c, data_type: T.DataType):
    if isinstance(data_type, T.StringType):
        return c
    if isinstance(data_type, T.IntegerType):
        return to_int(c)
    if isinstance(data_type, T.DoubleType):
        return to_double(c)
    return c.try_cast(data_type)


def tuple_text(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Lines of the form ``(a,b,c)`` as typed columns; an empty cell is NULL. A line with
    another number of cells than the schema fails the scan: its cells have no sure place."""
    cells = text_lines(spark, path).select(tuple_cells("value").alias("cells"))
    wrong = F.raise_error(F.concat(F.lit("tuple text of another width: "), F.array_join("cells", ",")))
    cells = cells.select(F.when(F.size("cells") == len(schema), F.col("cells")).otherwise(wrong).alias("cells"))
    return cells.select(
        [
            _typed(F.nullif(F.get("cells", F.lit(i)), F.lit("")), f.dataType).alias(f.name)
            for i, f in enumerate(schema)
        ]
    )


def month_zone_price(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``month,zone,price`` lines without a header."""
    return csv_table(spark, path, SALE_MEAN_SCHEMA, header=False)


def parquet_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.parquet(path)


def inline_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """A frame from a few rows in the program, such as a vocabulary; may be empty."""
    return spark.createDataFrame(list(rows), schema)


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Reorder by name and cast to a declared schema; a missing or unsafe column fails."""
    return df.to(schema)


def tagged_snapshots(frames: Mapping[str, DataFrame], tag: str = "Date") -> DataFrame:
    """UNION ALL of period snapshots by column name, each stamped with its own period."""
    stamped = [df.withColumn(tag, F.lit(period)) for period, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), stamped)


def snapshot_files(
    spark: SparkSession, files: Mapping[str, str | list[str]], schema: T.StructType, tag: str = "Date"
) -> DataFrame:
    """``{period: paths}`` of wide listing files whose column order may differ.

    A path is a file, a folder or a glob. Each is resolved to its files before anything is
    read, and a row's period is that of the very file it is in; a path without files, and
    a file of two periods, are errors. Files are grouped by their path's header; each group
    is one scan.
    """
    by_header: dict[tuple, list[str]] = {}
    period_of: dict[str, str] = {}
    for period, paths in files.items():
        for path in [paths] if isinstance(paths, str) else paths:
            found = listed_files(spark, path)
            if not found:
                raise ValueError(f"no files of {period} at {path}")
            names = tuple(_titled(spark, path, True).columns)
            by_header.setdefault(names, []).extend(f for f in found if f not in period_of)
            for f in found:
                if period_of.setdefault(f, period) != period:
                    raise ValueError(f"{f} is given for {period_of[f]} and for {period}")
    known = spark.createDataFrame([(_plain(f), p) for f, p in period_of.items()], f"{FILE} string, `{tag}` string")
    scans = []
    for group in by_header.values():
        raw = _titled(spark, [unquote(f) for f in group], True)
        cells = [_typed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema]
        rows = raw.select(*cells, _plain_column(F.col("_metadata.file_path")).alias(FILE))
        rows = rows.join(known, FILE, "left")
        missing = F.raise_error(F.concat(F.lit("a file of no known period: "), F.col(FILE)))
        scans.append(rows.select(*schema.names, F.coalesce(F.col(tag), missing).alias(tag)))
    return reduce(lambda a, b: a.unionByName(b), scans)


def listed_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The files that a scan of a file, folder or glob reads, as URIs."""
    return sorted(spark.read.text(path).inputFiles())


def _plain(uri: str) -> str:
    """A URI without escapes and with one slash behind the scheme, as they differ between listings."""
    return re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*):/+", r"\1:/", unquote(uri))


def _plain_column(uri: Column) -> Column:
    plain = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, r"^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def named_files(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    pattern: str,
    parts: Mapping[str, str],
    sep: str = ";",
    header: bool = False,
    only: Mapping[str, str] | None = None,
) -> DataFrame:
    """One scan over many files whose names carry fields.

    ``pattern`` is matched against the file path; ``parts`` maps each new column
    to its type, in the order of the pattern's groups; they are NULL where the name
    does not fit it. ``only`` keeps the files whose name has these texts for some parts:
    the others are left out before the scan, which lists none of them.
    """
    if only is not None:
        path = [unquote(f) for f in listed_files(spark, path) if _fits(_name_parts(f, pattern, parts), only)]
        if not path:
            return spark.createDataFrame([], schema).select("*", *(F.lit(None).cast(kind).alias(c) for c, kind in parts.items()))
    df = csv_table(spark, path, schema, header=header, sep=sep, with_file=True)
    for i, (name, kind) in enumerate(parts.items(), start=1):
        df = df.withColumn(name, F.nullif(F.regexp_extract(FILE, pattern, i), F.lit("")).try_cast(kind))
    return df.drop(FILE)


def _name_parts(file: str, pattern: str, parts: Mapping[str, str]) -> dict[str, str | None]:
    found = re.search(pattern, file)
    return dict(zip(parts, found.groups() if found else [None] * len(parts), strict=True))


def _fits(found: Mapping[str, str | None], only: Mapping[str, str]) -> bool:
    return all(found[c] == text for c, text in only.items())


def file_parts(spark: SparkSession, path: str | list[str], pattern: str, parts: Mapping[str, str]) -> dict[str, dict[str, str | None]]:
    """What the names of a path's files tell, by file; nothing is read but the listing."""
    return {unquote(f): _name_parts(f, pattern, parts) for f in listed_files(spark, path)}


def partitioned_csv(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ";", header: bool = False
) -> DataFrame:
    """A directory tree ``key=value/...``; filters on the keys skip whole directories.
    ``schema`` includes the partition columns."""
    return csv_table(spark, path, schema, header=header, sep=sep)
