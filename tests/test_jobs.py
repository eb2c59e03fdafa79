"""The whole study on small raw files, by the command line's own path."""

from __future__ import annotations

import itertools

import pytest
from test_plans import complaint_line, listing

from zonepulse.jobs import main
from zonepulse.schemas import COMPLAINT_WIDTH, LISTING_RAW_SCHEMA, REQUEST_SCHEMA, SALE_WIDTH


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("study")
    zips = ["10001", "10002", "10003", "10004"]
    lines = [",".join(f"c{i}" for i in range(COMPLAINT_WIDTH)), "broken,line"]
    for (z, zip_), m in itertools.product(enumerate(zips), range(1, 7)):
        lines += [complaint_line(id=str(i), zip=zip_, date=f"{m:02d}/10/2019 00:00:00") for i in range(1 + (z * 3 + m) % 5)]
    (base / "complaints.csv").write_text("\n".join(lines))

    def sheet(name, rows):
        body = []
        for first, zip_, area, price, date in rows:
            cells = ["-"] * SALE_WIDTH
            cells[0], cells[10], cells[15], cells[19], cells[20] = first, zip_, area, price, date
            body.append(";".join(cells))
        (base / name).write_text("\n".join(body))

    (base / "sheets").mkdir()
    rows = [("1", z, "1,000", f"${(i + 2) * m * 1000:,}", f"{m}/3/19") for (i, z), m in itertools.product(enumerate(zips), range(1, 7))]
    sheet("sheets/real_estate_queens_year_2019.csv", [("BOROUGH", "ZIP", "AREA", "PRICE", "DATE"), *rows, ("1", "10001", "10", "-", "1/3/19")])
    sheet("sheets/real_estate_queens_rolling.csv", [("1", "10001", "100", "$5,000", "2/3/20"), ("1", "10001", "100", "$5,000", "2/3/19")])
    names = LISTING_RAW_SCHEMA.names
    for m in (3, 4, 5):
        rows = [
            listing(zipcode=z, price=f"$1,{i % 9}{(7 * k + m) % 10}0.00" if k % 2 else f"${90 + 10 * i + k}.00", accommodates=1 + k % 4)
            for (i, z), k in itertools.product(enumerate(zips), range(12))
        ]
        text = "\n".join([",".join(names), *(",".join(f'"{c}"' for c in r) for r in rows)])
        (base / f"listings{m}.csv").write_text(text + "\n")
    return base


def run(spark, folder, job, **options):
    args = [job]
    for name, value in options.items():
        for v in value if isinstance(value, list) else [value]:
            args += [f"--{name.replace('_', '-')}", v]
    main(args, spark)


def test_two_files_of_one_period_both_count(spark, folder, tmp_path):
    out = str(tmp_path / "listings")
    run(spark, folder, "clean-listings", snapshot=[f"2019/03={folder}/listings{m}.csv" for m in (3, 4)], output=out)
    back = spark.read.parquet(out)
    assert back.count() == 2 * 4 * 12 and [r.Date for r in back.select("Date").distinct().collect()] == ["2019/03"]


def test_rolling_and_unnamed_sheets_are_not_lost(spark, folder, tmp_path):
    with pytest.raises(SystemExit, match="rolling"):
        run(spark, folder, "sort-sheets", input=str(folder / "sheets/*.csv"), output=str(tmp_path / "a"))
    odd = tmp_path / "sheets"
    odd.mkdir()
    (odd / "atlantis.csv").write_text((folder / "sheets/real_estate_queens_year_2019.csv").read_text())
    with pytest.raises(SystemExit, match="unnamed"):
        run(spark, folder, "sort-sheets", input=str(odd / "*.csv"), output=str(tmp_path / "b"))
    run(spark, folder, "sort-sheets", input=str(odd / "*.csv"), output=str(tmp_path / "c"), unnamed=str(tmp_path / "odd"))
    assert spark.read.parquet(str(tmp_path / "odd")).count() == 26


def test_stages_exchange_the_text_forms(spark, folder, tmp_path):
    at = lambda name: str(tmp_path / name)
    run(spark, folder, "clean-complaints", input=str(folder / "complaints.csv"), output=at("complaints"), format="titled")
    run(spark, folder, "sort-sheets", input=str(folder / "sheets/*2019.csv"), output=at("by_year"))
    run(spark, folder, "clean-sales", input=at("by_year/*/*/*.csv"), output=at("means"), format="titled")
    run(spark, folder, "neighbourhood", complaints=at("complaints"), sales=at("means"), input_format="titled", output=at("area"), format="tuple")
    lines = [r.value for r in spark.read.text(at("area")).collect()]
    assert len(lines) == 24 and all(x.startswith("(2019-") and x.count(",") == 13 for x in lines)


def test_study_from_raw_files(spark, folder):
    at = lambda name: str(folder / name)
    run(spark, folder, "clean-complaints", input=at("complaints.csv"), output=at("complaints"), report=at("complaint_steps"))
    steps = [r.surviving for r in spark.read.parquet(at("complaint_steps")).orderBy("step").collect()]
    n = spark.read.parquet(at("complaints")).count()
    # Header and broken line go; the header passes until its cells must be ints.
    assert steps == [n + 2, n + 1, n + 1, n, n]

    run(spark, folder, "sort-sheets", input=at("sheets/*.csv"), output=at("by_year"), rolling_year="2020")
    assert (folder / "by_year/district=queens/year=2020").is_dir()
    run(spark, folder, "clean-sales", input=at("by_year/*/*/*.csv"), output=at("means"), rejects=at("rejects"))
    assert spark.read.parquet(at("rejects")).count() == 1
    means = {(r.month, r.zone): r.real_estate_price for r in spark.read.parquet(at("means")).collect()}
    assert len(means) == 25 and means[("2020-02", "10001")] == 50.0 and means[("2019-03", "10002")] == 9.0

    snapshots = [f"2019/0{m}={folder}/listings{m}.csv" for m in (3, 4, 5)]
    run(spark, folder, "clean-listings", snapshot=snapshots, output=at("listings"))
    assert spark.read.parquet(at("listings")).count() == 3 * 4 * 12
    run(spark, folder, "profile", input=at("listings"), output=at("listing_profile"))
    assert spark.read.parquet(at("listing_profile")).count() == 17

    both = {"complaints": at("complaints"), "listings": at("listings")}
    run(spark, folder, "overview", sheets=at("by_year/*/*/*.csv"), output=at("overview"), **both)
    assert [r.month for r in spark.read.parquet(at("overview")).orderBy("month").collect()] == ["2019-03", "2019-04", "2019-05"]
    run(spark, folder, "correlate", sales=at("means"), output=at("correlations"), **both)
    found = {r["shift"]: r for r in spark.read.parquet(at("correlations")).collect()}
    assert found[0]["n"] == found[2]["n"] == 144 and found[3]["n"] == 96 and 5 not in found

    run(spark, folder, "neighbourhood", complaints=at("complaints"), sales=at("means"), output=at("area"))
    run(spark, folder, "areas", output=at("areas"), sales=at("means"), **both)
    assert spark.read.parquet(at("areas")).count() == 4
    run(spark, folder, "domains", input=at("listings"), output=at("domains"), column=["zipcode", "Date"])
    assert spark.read.parquet(at("domains")).count() == 4 + 3
    run(spark, folder, "train", neighbourhood=at("area"), listings=at("listings"), models=at("models"), estimator=["linear", "forest"], output=at("metrics"))
    assert spark.read.parquet(at("models/forest_weights")).count() == 41 and spark.read.parquet(at("models/linear_weights")).count() == 42
    metrics = spark.read.parquet(at("metrics")).collect()
    assert {r.model for r in metrics} == {"linear", "forest"} and all(r.rmse >= r.mae > 0 for r in metrics)

    fields = {n: "1" for n in REQUEST_SCHEMA.names} | {"borough": "The Bronx", "property_type": "others", "room_type": "Private Room"}
    requests = [
        {**fields, "request_id": "a", "date": "2019-05-02", "zip": "10001"},
        {**fields, "request_id": "b", "date": "2031-05-02", "zip": "10001"},
        {**fields, "request_id": "c", "date": "2019-05-02", "zip": "10001", "beds": "two"},
    ]
    (folder / "requests.csv").write_text("\n".join([",".join(fields), *(",".join(r[n] for n in fields) for r in requests)]))
    run(spark, folder, "score", requests=at("requests.csv"), neighbourhood=at("area"), model=at("models/forest"), output=at("scores"))
    scores = {r.request_id: (r.status, r.prediction is not None) for r in spark.read.parquet(at("scores")).collect()}
    assert scores == {"a": ("ok", True), "b": ("No record for 2031-05|10001", False), "c": ("unreadable field", False)}
