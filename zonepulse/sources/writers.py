"""Sinks. All write from the executors, one file set per task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Multi-line CSV cannot be split on reading, so its files are bounded in bytes.
BYTES_PER_FILE = 128 << 20


def tuple_text(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``(a,b,c)`` lines; NULL is written as an empty cell. A cell with a comma or a line
    break fails: the line could not be read back."""

    def cell(c: str):
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        wrong = F.raise_error(F.concat(F.lit(f"tuple text cannot hold this cell of {c}: "), text))
        return F.when(text.rlike(r"[,\r\n]"), wrong).otherwise(text)

    cells = [cell(c) for c in df.columns]
    line = F.concat(F.lit("("), F.concat_ws(",", *cells), F.lit(")"))
    df.select(line.alias("value")).write.mode(mode).text(path)


def csv_plain(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Comma text without a header."""
    csv_header(df, path, header=False, mode=mode)


def csv_header(
    df: DataFrame,
    path: str,
    header: bool = True,
    sep: str = ",",
    mode: str = "errorifexists",
    multiline: bool = False,
    bytes_per_file: int = BYTES_PER_FILE,
) -> None:
    """CSV that keeps every character of a cell: quotes doubled, blanks not trimmed.

    ``multiline=True`` when cells may hold line breaks: the rows are measured in a pass of
    their own, and files get as many of the longest as stay under ``bytes_per_file``.
    """
    writer = _csv_writer(df, header, sep, mode)
    if multiline:
        width = sum((F.octet_length(F.coalesce(F.col(c).cast("string"), F.lit(""))) + 3 for c in df.columns), F.lit(0))
        longest = df.agg(F.max(width)).first()[0] or 1
        writer = writer.option("maxRecordsPerFile", max(1, bytes_per_file // longest))
    writer.csv(path)


def partitioned_csv(
    df: DataFrame, path: str, by: list[str], sep: str = ";", header: bool = False, mode: str = "errorifexists"
) -> None:
    """One directory per value of the ``by`` columns.

    ``mode="replace"`` replaces the directories that ``df`` has rows for and leaves the
    others: so one month of a stored tree can be written again. The rebalance hint gathers each directory's rows into few files and lets AQE
    split a directory that holds a large share of the data over several tasks.
    """
    _csv_writer(df.hint("rebalance", *by), header, sep, mode).partitionBy(*by).csv(path)


def parquet_table(df: DataFrame, path: str, by: list[str] | None = None, mode: str = "errorifexists") -> None:
    """Parquet, in directories by the ``by`` columns if given; modes as for ``partitioned_csv``."""
    if by:
        _moded(df.hint("rebalance", *by), mode).partitionBy(*by).parquet(path)
    elif mode == "replace":
        raise ValueError("only directories by columns can be replaced one by one")
    else:
        df.write.mode(mode).parquet(path)


def bucketed_table(df: DataFrame, name: str, keys: list[str], buckets: int, path: str) -> DataFrame:
    """A catalog table of Parquet files in ``buckets`` by ``keys``, sorted within, read back.

    Tables bucketed alike are joined and grouped by these keys without a shuffle, however
    often. The files are in ``path``; the rows are shuffled once so that each bucket is one
    file, and buckets of a size for one task: take their number from the larger table.
    """
    spread = df.repartition(buckets, *keys)
    spread.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def _moded(df: DataFrame, mode: str):
    if mode == "replace":
        return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    return df.write.mode(mode)


def _csv_writer(df: DataFrame, header: bool, sep: str, mode: str):
    return (
        _moded(df, mode)
        .option("header", header)
        .option("sep", sep)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
