from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepulse.schemas import LISTING_RAW_SCHEMA
from zonepulse.session import materialise, scratch_path, shared_folder
from zonepulse.sources import readers, writers


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


NASTY = [
    (1, 'line\nbreak, "quoted"', 1.5), (2, "  blanks  ", -0.25), (3, "back\\slash", 1e-9), (4, 'ends with "', 3.0),
    (5, "tab\tand\r\nreturn", 2.0), (6, None, None), (7, "é|;x", 1e22),
]
SCHEMA = "id int, text string, v double"


def test_multiline_csv_keeps_every_character(spark, tmp_path):
    df = spark.createDataFrame(NASTY, SCHEMA)
    writers.csv_header(df, str(tmp_path / "x"))
    assert rows(readers.csv_table(spark, str(tmp_path / "x"), df.schema, multiline=True)) == rows(df)


def test_zip_keeps_its_zero(spark, tmp_path):
    writers.csv_plain(spark.createDataFrame([("2018-10", "00501", 3.5)], "m string, z string, p double"), str(tmp_path / "x"))
    assert tuple(readers.month_zone_price(spark, str(tmp_path / "x")).first()) == ("2018-10", "00501", 3.5)


def test_tuple_text(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2.5), (2, None, None)], SCHEMA)
    writers.tuple_text(df, str(tmp_path / "x"))
    assert [r[0] for r in readers.text_lines(spark, str(tmp_path / "x")).orderBy("value").collect()] == ["(1,a,2.5)", "(2,,)"]
    assert rows(readers.tuple_text(spark, str(tmp_path / "x"), df.schema)) == rows(df)


def test_partitioned_csv_prunes(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "concat('d', id % 3) AS district", "cast(2000 + id % 4 AS int) AS year")
    path = str(tmp_path / "tree")
    writers.partitioned_csv(df, path, ["district", "year"])
    back = readers.partitioned_csv(spark, path, df.schema)
    assert rows(back.select(df.columns)) == rows(df)
    one = back.filter("district = 'd1' AND year = 2001")
    assert "PartitionFilters: [isnotnull(district" in one._jdf.queryExecution().executedPlan().toString()
    named = readers.named_files(
        spark, f"{path}/*/*/*.csv", T.StructType([T.StructField("id", T.LongType())]), r"district=(\w+)/year=(\d+)/",
        {"district": "string", "year": "int"},
    )
    assert rows(named) == rows(df)


def test_snapshots_by_name_and_own_period(spark, tmp_path):
    """Column order differs between files, extra columns are ignored, bad cells are NULL."""
    names = LISTING_RAW_SCHEMA.names
    values = {n: "1" for n in names}
    a, b = tmp_path / "mar19.csv", tmp_path / "mar18.csv"
    a.write_text(",".join([*names, "notes"]) + "\n" + ",".join([*values.values(), '"two\nlines"']) + "\n")
    flipped = list(reversed(names))
    b.write_text(",".join(["notes", *flipped]) + "\n" + ",".join(["n", *({**values, "zipcode": "00501", "beds": "x"}[n] for n in flipped)]) + "\n")
    df = readers.snapshot_files(spark, {"2019/03": str(a), "2018/03": str(b)}, LISTING_RAW_SCHEMA)
    got = {r["Date"]: (r["zipcode"], r["beds"], r["accommodates"]) for r in df.collect()}
    assert got == {"2019/03": ("1", 1, 1), "2018/03": ("00501", None, 1)}


def test_snapshots_of_one_period_all_count(spark, tmp_path):
    names = LISTING_RAW_SCHEMA.names
    for name in ("a", "b"):
        (tmp_path / f"{name} 1.csv").write_text(",".join(names) + "\n" + ",".join("1" for _ in names) + "\n")
    df = readers.snapshot_files(spark, {"2019/03": [str(tmp_path / "a 1.csv"), str(tmp_path / "b 1.csv")]}, LISTING_RAW_SCHEMA)
    assert [r.Date for r in df.collect()] == ["2019/03"] * 2


def snapshot(path, zipcode, notes=False):
    names = LISTING_RAW_SCHEMA.names
    path.parent.mkdir(parents=True, exist_ok=True)
    cells = [zipcode if n == "zipcode" else "1" for n in names]
    path.write_text(",".join([*names, *(["notes"] if notes else [])]) + "\n" + ",".join([*cells, *(["x"] if notes else [])]) + "\n")


def test_snapshot_paths_are_files_folders_and_globs(spark, tmp_path):
    """Each row has the period of its own file, also where one path ends like another, or is a glob."""
    snapshot(tmp_path / "x.csv", "1")
    snapshot(tmp_path / "old/x.csv", "2")
    snapshot(tmp_path / "g 1+1/a.csv", "3", notes=True)
    snapshot(tmp_path / "g 1+1/b%20.csv", "4", notes=True)
    snapshot(tmp_path / "whole/x.csv", "5")
    files = {
        "2019/03": str(tmp_path / "x.csv"),
        "2019/04": str(tmp_path / "old/x.csv"),
        "2019/05": str(tmp_path / "g 1+1/*.csv"),
        "2019/06": [str(tmp_path / "whole")],
    }
    df = readers.snapshot_files(spark, files, LISTING_RAW_SCHEMA)
    got = sorted((r.zipcode, r.Date) for r in df.collect())
    assert got == [("1", "2019/03"), ("2", "2019/04"), ("3", "2019/05"), ("4", "2019/05"), ("5", "2019/06")]


def test_relative_snapshot_paths(spark, tmp_path, monkeypatch):
    """Paths relative to where the JVM was started, one of which ends like the other."""
    base = os.path.relpath(tmp_path, spark._jvm.System.getProperty("user.dir"))
    snapshot(tmp_path / "x.csv", "1")
    snapshot(tmp_path / "old/x.csv", "2")
    df = readers.snapshot_files(spark, {"2019/03": f"{base}/x.csv", "2019/04": f"{base}/old/x.csv"}, LISTING_RAW_SCHEMA)
    assert sorted((r.zipcode, r.Date) for r in df.collect()) == [("1", "2019/03"), ("2", "2019/04")]


def test_snapshot_files_of_no_or_two_periods(spark, tmp_path):
    snapshot(tmp_path / "a/x.csv", "1")
    (tmp_path / "empty").mkdir()
    with pytest.raises(Exception, match="2019/03.*2019/04"):
        readers.snapshot_files(spark, {"2019/03": str(tmp_path / "a/x.csv"), "2019/04": str(tmp_path / "a/*.csv")}, LISTING_RAW_SCHEMA)
    for nowhere in ("empty", "a/*.txt"):
        with pytest.raises(Exception, match="(?i)no files|not.exist|path_not_found"):
            readers.snapshot_files(spark, {"2019/03": str(tmp_path / nowhere)}, LISTING_RAW_SCHEMA)


@pytest.mark.parametrize("form", ["csv", "parquet"])
def test_replace_one_period(spark, tmp_path, form):
    df = spark.createDataFrame([(1, "2019-01"), (2, "2019-01"), (3, "2019-02"), (4, "2019-03")], "id int, month string")
    path = str(tmp_path / "tree")

    def write(rows, mode):
        if form == "csv":
            writers.partitioned_csv(rows, path, ["month"], mode=mode)
        else:
            writers.parquet_table(rows, path, ["month"], mode=mode)

    write(df, "errorifexists")
    new = spark.createDataFrame([(9, "2019-02")], "id int, month string")
    for _ in range(2):
        write(new, "replace")
    read = readers.partitioned_csv(spark, path, df.schema) if form == "csv" else readers.parquet_table(spark, path)
    assert sorted((r.id, r.month) for r in read.collect()) == [(1, "2019-01"), (2, "2019-01"), (4, "2019-03"), (9, "2019-02")]
    with pytest.raises(ValueError):
        writers.parquet_table(df, path, mode="replace")


def test_files_of_other_names_are_not_scanned(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.IntegerType())])
    for name, text in (("bronx_2003", "1"), ("bronx_2004", "2"), ("queens_2003", "3"), ("notes", "4")):
        (tmp_path / f"{name}.csv").write_text(text + "\n")
    args = (spark, str(tmp_path / "*.csv"), schema, r"(bronx|queens)_(\d{4})", {"district": "string", "year": "int"})
    only = readers.named_files(*args, only={"district": "bronx", "year": "2004"})
    assert rows(only) == [(2, "bronx", 2004)] and len(only.inputFiles()) == 1
    assert rows(readers.named_files(*args, only={"year": "2003"})) == [(1, "bronx", 2003), (3, "queens", 2003)]
    none = readers.named_files(*args, only={"year": "1900"})
    assert none.columns == ["id", "district", "year"] and none.count() == 0


def test_header_must_fit(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("zip", T.StringType())])
    (tmp_path / "x").mkdir()
    (tmp_path / "x/a.csv").write_text("zip,id\n10001,7\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.csv_table(spark, str(tmp_path / "x/a.csv"), schema).collect()
    assert rows(readers.csv_by_name(spark, str(tmp_path / "x/a.csv"), schema)) == [(7, "10001")]
    (tmp_path / "x/b.csv").write_text("id,zip\n9,10003\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.csv_by_name(spark, str(tmp_path / "x"), schema).collect()


def test_tuple_text_refuses_what_it_cannot_hold(spark, tmp_path):
    df = spark.createDataFrame([(1, "05, MANHATTAN", 2.5)], SCHEMA)
    with pytest.raises(Exception, match="cannot hold"):
        writers.tuple_text(df, str(tmp_path / "x"))
    (tmp_path / "y").write_text("(1,a,b,2.5)\n")
    with pytest.raises(Exception, match="another width"):
        readers.tuple_text(spark, str(tmp_path / "y"), df.schema).collect()


def test_multiline_files_are_bounded_in_bytes(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "repeat('x', 1000) AS text").coalesce(1)
    writers.csv_header(df, str(tmp_path / "x"), multiline=True, bytes_per_file=20_000)
    sizes = [f.stat().st_size for f in (tmp_path / "x").glob("part-*.csv")]
    assert len(sizes) >= 5 and max(sizes) <= 20_000
    assert readers.csv_table(spark, str(tmp_path / "x"), df.schema, multiline=True).count() == 100


def test_scratch_goes(spark):
    from zonepulse.session import clear_scratch

    stored = materialise(spark.range(5))
    path = stored.inputFiles()[0].removeprefix("file:").removeprefix("//").rsplit("/", 1)[0]
    assert os.path.isdir(path)
    clear_scratch(spark)
    assert not os.path.exists(path)


def test_enforce_schema(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    declared = T.StructType([T.StructField("y", T.StringType()), T.StructField("x", T.LongType())])
    out = readers.enforce_schema(df, declared)
    assert out.schema == declared and tuple(out.first()) == ("a", 1)
    assert readers.inline_rows(spark, [], declared).count() == 0


def test_shared_folder_and_lineage(spark):
    folder = shared_folder(spark)
    assert folder == shared_folder(spark)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    cut = materialise(spark.range(10).withColumn("v", F.col("id") * 2))
    assert cut.agg(F.sum("v")).first()[0] == 90
    assert "Range" not in cut._jdf.queryExecution().optimizedPlan().toString()


def test_the_named_folder_is_used(tmp_path):
    """A cluster names the folder in the session; a new process is needed to see it."""
    import subprocess
    import sys

    code = (
        "from zonepulse.session import *\n"
        f"spark = build_session('x', 'local[1]', **{{'spark.checkpoint.dir': '{tmp_path}', 'spark.ui.enabled': 'false'}})\n"
        f"assert shared_folder(spark) == '{tmp_path}'\n"
        f"assert scratch_path(spark, 'a').startswith('{tmp_path}/a-')\n"
        "assert materialise(spark.range(5)).count() == 5\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, timeout=100, capture_output=True)
    assert any(p.name.startswith("stage-") for p in tmp_path.rglob("*"))
