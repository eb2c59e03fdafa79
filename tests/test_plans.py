from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from zonepulse.operators import quality
from zonepulse.plans import complaints, listings, sales, study
from zonepulse.schemas import (
    COMPLAINT_WIDTH,
    FEATURE_COLUMNS,
    LABEL,
    LISTING_RAW_SCHEMA,
    LISTING_SCHEMA,
    SALE_WIDTH,
    TRAINING_COLUMNS,
)


def complaint_line(**cells) -> str:
    places = {"id": 0, "date": 1, "agency": 3, "type": 5, "zip": 8, "board": 23, "borough": 25, "lat": 38, "lon": 39, "last": 40}
    values = {
        "id": "7", "date": "04/30/2013 10:00:00 AM", "agency": "NYPD", "type": "HEATING", "zip": "10019",
        "board": "05 MANHATTAN", "borough": "MANHATTAN", "lat": "40.7", "lon": "-73.9", "last": "x", **cells,
    }
    line = [""] * COMPLAINT_WIDTH
    for name, value in values.items():
        line[places[name]] = value
    return ",".join(line)


def frame(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_complaint_edge_rows(spark):
    lines = [
        complaint_line(),
        complaint_line(type='"Noise, loud"', board='"05 ""M"""'),
        complaint_line(last=""),
        "1,2,3",
        complaint_line(zip=""),
        complaint_line(zip="ABC"),
        complaint_line(id="Unique Key"),
        complaint_line(lat="N/A"),
        complaint_line(zip="00501"),
    ]
    got = complaints.clean(frame(spark, lines)).collect()
    assert [(r.id, r.date, r.type, r.zip, r.board, r.lat) for r in got] == [
        (7, "04/30/2013", "HEATING", 10019, "05 MANHATTAN", 40.7),
        (7, "04/30/2013", "Noise, loud", 10019, '05 "M"', 40.7),
        (7, "04/30/2013", "HEATING", 501, "05 MANHATTAN", 40.7),
    ]
    assert [tuple(r) for r in complaints.keyed(complaints.clean(frame(spark, lines[-1:]))).collect()] == [("2013-04", "00501", "HEATING")]


def test_complaint_lines_as_a_parser_reads_them(spark):
    """Unpaired quotes are rejected by the width rule and counted; quotes inside are none of its business."""
    lines = [
        complaint_line(type='"Noise, loud'),  # opened, never closed
        complaint_line(type='5" pipe'),
        complaint_line(type='"a ""b"", c"'),
        complaint_line(type='"one"', zip='"10001"'),
        complaint_line() + ",,",  # empty cells beyond the last do not count
        complaint_line() + ",x",
        "",
        None,
    ]
    got = complaints.clean(frame(spark, lines)).collect()
    assert [r.type for r in got] == ['a "b", c', "one", complaints.clean(frame(spark, [complaint_line()])).first().type]
    report = quality.attrition(complaints.split_lines(frame(spark, lines)), complaints.line_rules()).collect()
    assert [r.surviving for r in report] == [8, 3, 3, 3, 3]


def test_audit_from_the_pass_that_cleans(spark, tmp_path):
    lines = [complaint_line(), complaint_line(zip=""), complaint_line(zip="ABC"), "short", complaint_line(lat="N/A"), complaint_line(last="")]
    split = complaints.split_lines(frame(spark, lines))
    kept, seen = quality.observed(split, complaints.line_rules())
    complaints.typed(kept).write.parquet(str(tmp_path / "clean"))
    want = quality.attrition(split, complaints.line_rules())
    got = quality.observed_attrition(spark, seen, complaints.line_rules())
    assert got.dtypes == want.dtypes and got.collect() == want.collect()
    assert spark.read.parquet(str(tmp_path / "clean")).count() == got.collect()[-1].surviving == 1


def test_complaint_header_width(spark, tmp_path):
    header = ",".join(f"c{i}" for i in range(COMPLAINT_WIDTH))
    path = tmp_path / "raw.csv"
    path.write_text("\n".join([header, complaint_line(), "short,row"]))
    lines = spark.read.text(str(path))
    width = complaints.header_width(lines)
    assert width == COMPLAINT_WIDTH
    assert complaints.clean(lines, width).count() == 1


def test_complaint_counts_shift(spark):
    df = spark.createDataFrame([("2018-12", "z", "HEATING"), ("2018-12", "z", "Graffiti")], "month string, zone string, type string")
    row = complaints.counts(df, ["month", "zone"], shift=2).first()
    assert (row.month, row.all_type_complaint, row.heating, row.plumbing) == ("2019-02", 2, 1, 0)


SALES = [
    ("10019", "1,200", "$600,000", "4/30/13"),
    ("10019", "800", "200000", "4/2/2013"),
    ("10019", "0", "- 0", "4/30/13"),
    ("10019", "100", "-", "4/30/13"),
    ("1001", "100", "100", "4/30/13"),
    ("10019", "", "100", "4/30/13"),
    ("10019", "100", "100", "1/5/123"),
    ("10019", "- 100", "100", "4/30/13"),
]


def test_sale_rows(spark):
    cells = spark.createDataFrame(SALES, "zip string, area string, price string, date string")
    got = sales.clean(cells)
    # A date of no month is a reject, so no mean stands under a NULL month.
    assert sorted((r.month, r.price / r.area) for r in got.collect()) == [("2013-04", 250.0), ("2013-04", 500.0)]
    means = {r.month: r.real_estate_price for r in sales.mean_unit_price(got, ["month", "zone"]).collect()}
    assert means["2013-04"] == 375.0
    # Deleting the dash keeps the negative area as a positive one.
    assert sales.clean(cells, legacy_sign=True).count() == 3


def test_sheet_rows(spark):
    blank = ["-"] * SALE_WIDTH
    raw = [[None, *blank[1:]], ["BOROUGH", *blank[1:]], ["1", *blank[1:20], "3/4/19"], ["2", *blank[1:20], "3/4/20"]]
    df = spark.createDataFrame([tuple(r) for r in raw], ", ".join(f"c{i} string" for i in range(SALE_WIDTH)))
    assert sales.sheet_rows(df).count() == 2
    assert [r.c0 for r in sales.sheet_rows(df, only_year="20").collect()] == ["2"]


def listing(**cells):
    row = {
        "zipcode": "10001", "neighbourhood_group_cleansed": "Queens", "property_type": "Loft", "room_type": "Private room",
        "accommodates": 2, "bathrooms": 1.0, "bedrooms": 1, "beds": 1, "price": "$85.00", "cleaning_fee": "$10.00",
        "host_listings_count": 1, "availability_90": 30, "extra_people": "$0.00", "number_of_reviews": 3,
        "security_deposit": "$100.00", "minimum_nights": 2, "review_scores_location": 9.0, "review_scores_rating": 95.0,
        "review_scores_accuracy": 9.0, **cells,
    }
    return tuple(row[n] for n in LISTING_RAW_SCHEMA.names)


def listing_frame(spark, *rows):
    return spark.createDataFrame(list(rows), LISTING_RAW_SCHEMA).withColumn("Date", F.lit("2019/03"))


def test_listing_edge_rows(spark):
    kept = [listing(), listing(price="$1,499.00"), listing(zipcode="00501"), listing(bathrooms=None, bedrooms=None, beds=3)]
    dropped = [
        listing(zipcode=" "), listing(zipcode=None), listing(zipcode="1000"), listing(zipcode="10001-2345"),
        listing(cleaning_fee=None), listing(security_deposit=None), listing(review_scores_rating=None),
        listing(review_scores_location=4.0), listing(review_scores_rating=49.0), listing(property_type=None),
        listing(bathrooms=None, bedrooms=None, beds=None), listing(price="free"), listing(minimum_nights=None),
    ]
    raw = listing_frame(spark, *kept, *dropped)
    clean = listings.clean(raw)
    assert clean.columns == LISTING_SCHEMA.names
    assert sorted((r.zipcode, r.price, r.beds) for r in clean.collect()) == [
        ("00501", 85.0, 1.0), ("10001", 85.0, 1.0), ("10001", 85.0, 3.0), ("10001", 1499.0, 1.0),
    ]
    assert listings.clean(raw, strip_commas=False).count() == 3
    from zonepulse.operators.quality import attrition, keep

    assert keep(raw, listings.row_rules()).count() == 4
    assert attrition(raw, listings.row_rules()).orderBy(F.desc("step")).first()["surviving"] == 4


@pytest.fixture(scope="module")
def study_inputs(spark):
    complaint_rows = [(f"2018-{m:02d}", z, "HEATING") for m in range(1, 11) for z in ("10001", "10002") for _ in range(m)]
    sale_rows = [(f"2018-{m:02d}", z, 100.0 * m) for m in range(1, 11) for z in ("10001", "10002")]
    raw = listing_frame(spark, *[listing(zipcode=z, price=f"${p}.00") for z in ("10001", "10002", "10003") for p in (50, 80, 120)])
    return (
        spark.createDataFrame(complaint_rows, "month string, zone string, type string"),
        spark.createDataFrame(sale_rows, "month string, zone string, real_estate_price double"),
        listings.clean(raw.withColumn("Date", F.lit("2018/05"))),
    )


def test_training_frame_layout(study_inputs):
    complaint_rows, sale_rows, clean = study_inputs
    profile = study.neighbourhood_profile(complaint_rows, sale_rows)
    frame_ = study.training_frame(listings.features(clean), profile)
    assert frame_.columns == TRAINING_COLUMNS and len(frame_.columns) == 42
    assert frame_.columns.index(LABEL) == 35 and len(FEATURE_COLUMNS) == 41
    got = frame_.collect()
    # Zone 10003 has no record; May listings meet the figures of March.
    assert len(got) == 6 and {(r.all_type_complaint, r.real_estate_price) for r in got} == {(3, 300.0)}


def test_lookup_status(spark, study_inputs):
    complaint_rows, sale_rows, _ = study_inputs
    profile = study.neighbourhood_profile(complaint_rows, sale_rows)
    from zonepulse.schemas import REQUEST_SCHEMA

    base = {n: "1" for n in REQUEST_SCHEMA.names} | {"borough": "The Bronx", "property_type": "others", "room_type": "Hotel Room"}
    requests = [
        tuple({**base, "request_id": i, "date": d, "zip": z}[n] for n in REQUEST_SCHEMA.names)
        for i, d, z in [("a", "2018-05-20", "10001"), ("b", "2018-05-20", "99999"), ("c", "2030-05-20", "10001")]
    ]
    df = spark.createDataFrame(requests, REQUEST_SCHEMA)
    found = study.lookup(study.request_rows(df, ("request_id",)), profile).orderBy("request_id").collect()
    assert [r.status for r in found] == ["ok", "No record for 2018-05|99999", "No record for 2030-05|10001"]
    assert (found[0].borough_is_Bronx, found[0].property_is_Other, found[0].room_is_hotel_room) == (1, 1, 1)
