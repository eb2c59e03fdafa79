from __future__ import annotations

import datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zonepulse.functions import encode, months, rules, text
from zonepulse.schemas import BOROUGH_ALIASES, BOROUGH_SLOTS, COMPLAINT_SLOTS, PROPERTY_OTHER, PROPERTY_SLOTS, ROOM_SLOTS


def test_format_month(one):
    given_ = ["10/31/2018", "4/30/13", "1/5/3", "1/5/123", "4/2/2013", "2013-04-02", "", None, "4/30/13 12:00"]
    assert one(given_, months.format_month) == [
        "2018-10", "2013-04", "2003-01", None, "2013-04", None, None, None, None,
    ]


def test_month_shift_examples(one):
    assert one(["2010-12"], months.next_month) == ["2011-01"]
    assert one(["2010-01"], months.previous_month) == ["2009-12"]
    assert one(["2012-01"], lambda c: months.shift_month(c, 3)) == ["2012-04"]
    assert one(["2012-09"], lambda c: months.shift_month(c, -3)) == ["2012-06"]
    assert one(["2018-13", "x", None], months.next_month) == [None, None, None]


def test_month_shift_back_and_forth(spark):
    grid = spark.range(240).select(F.expr("substring(cast(add_months(date'2003-01-01', id) as string), 1, 7)").alias("m"))
    for k in (-25, -1, 0, 1, 6, 13):
        assert grid.filter(months.shift_month(months.shift_month("m", k), -k) != F.col("m")).count() == 0


def test_month_text_needs_no_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Sao_Paulo", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = spark.sql("SELECT timestamp_ntz'2018-11-04 00:00:00' AS ts").select(months.month_text("ts")).first()
            assert row[0] == "2018-11"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_other_dates(one):
    assert one(["2019/03", "2019/03/07"], months.month_from_slash) == ["2019-03", "2019-03"]
    assert one(["04/08/2020 12:00:00 AM"], months.date_prefix) == ["04/08/2020"]
    assert one(["2020-04-08"], months.drop_day) == ["2020-04"]
    assert one(["04/08/2020"], months.reorder_us_date) == ["2020/04/08"]
    assert one(["04/08/2020 01:00", "13/45/2020", ""], months.parse_us_date) == [datetime.date(2020, 4, 8), None, None]


def test_parse_money(one):
    cells = ["$1,499.00", "$85.00", "85", "free", "", None, "1d"]
    assert one(cells, text.parse_money) == [1499.0, 85.0, 85.0, None, None, None, None]
    legacy = one(cells, lambda c: text.parse_money(c, strip_commas=False))
    assert legacy == [None, 85.0, 85.0, None, None, None, None]


def test_parse_number_signs(one):
    cells = ["$600,000", " 1,200 ", "- 0", "-5", "- 5", "-", "", "N/A", "0"]
    assert one(cells, text.parse_number) == [600000.0, 1200.0, 0.0, -5.0, -5.0, None, None, None, 0.0]
    legacy = one(cells, lambda c: text.parse_number(c, legacy_sign=True))
    assert legacy == [600000.0, 1200.0, 0.0, 5.0, 5.0, None, None, None, 0.0]
    assert one(["$5"], lambda c: text.parse_number(c, symbols=",")) == [None]


def test_castable(one):
    cells = ["12", "-3", "12.7", " 12", "99999999999", "ABC", "", None]
    assert one(cells, text.is_int_text) == [True, True, False, False, False, False, False, False]
    numbers = ["1.5", "-73.2", "1e3", ".5", "5.", " 1 ", "1d", "N/A", "", None]
    assert one(numbers, text.is_double_text) == [True, True, True, True, True, True, False, False, False, False]


LINES = [
    'a,"b,c",d', "a,b,,", ",,,", "", "plain", 'x"y,z', 'a,b"c,d', '"a ""q"", b",c', ',a', 'a,"', '"",""', ",,x,,",
]


def cells_of(line: str) -> list[str]:
    """The rule by counting: a comma ends a cell when the quotes to its right pair up."""
    cells, start = [], 0
    for i, letter in enumerate(line):
        if letter == "," and line[i:].count('"') % 2 == 0:
            cells.append(line[start:i])
            start = i + 1
    return [*cells, line[start:]]


def test_split_outer_comma_matches_definition(one):
    assert one(LINES, text.split_outer_comma) == [cells_of(x) for x in LINES]


def test_split_outer_comma_drops_trailing(one):
    def trimmed(line):
        cells = cells_of(line)
        if line == "":
            return [""]
        while cells and cells[-1] == "":
            cells.pop()
        return cells

    got = one(LINES, lambda c: text.split_outer_comma(c, keep_trailing=False))
    assert got == [trimmed(x) for x in LINES]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet='ab,"\u0001\u0002', max_size=14), min_size=1, max_size=25))
def test_split_outer_comma_random(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "i int, v string").orderBy("i")
    got = [r[0] for r in df.select(text.split_outer_comma("v")).collect()]
    assert got == [cells_of(x) for x in lines]


def test_split_outer_comma_long_line(one):
    line = ",".join(f'"{i},{i}"' for i in range(20000))
    assert len(one([line], text.split_outer_comma)[0]) == 20000


def test_unquote_and_tuple(one):
    assert one(['"a,b"', '"say ""x"""', "a", '"', '""'], text.unquote) == ["a,b", 'say "x"', "a", '"', ""]
    assert one(["(1,b,2.5)", "(,)"], text.tuple_cells) == [["1", "b", "2.5"], ["", ""]]


def test_keys(spark):
    row = spark.sql("SELECT '2018-10' AS m, 11418 AS z, cast(null as string) AS n").select(
        text.build_key("m", "z").alias("key"), text.build_key("m", "n").alias("none")
    )
    key, none = row.first()
    assert (key, none) == ("2018-10|11418", None)
    assert row.select(text.split_key("key", 0), text.split_key("key", 1), text.split_key("key", 2)).first() == ("2018-10", "11418", None)


def test_rules(spark):
    df = spark.createDataFrame([("a", "", None), ("b", "x", "12"), ("7", "y", "z")], "p string, q string, r string")
    assert [r.p for r in df.filter(rules.required("p", "q", "r")).collect()] == ["b", "7"]
    assert [r.p for r in df.filter(rules.ints("r")).collect()] == ["b"]
    assert [r.p for r in df.filter(rules.numbered_row("p")).collect()] == ["7"]
    assert [r.p for r in df.filter(rules.complete("p", "q", "r")).collect()] == ["b", "7"]


def test_date_in_year(one):
    assert one(["3/4/20", "3/4/19", "3/4/2020", "20"], lambda c: rules.date_in_year(c, "20")) == [True, False, False, False]


def test_review_thresholds_drop_unknown(spark):
    rows = [(5.0, 5.0, 50.0), (4.0, 9.0, 90.0), (None, 9.0, 90.0), (9.0, 9.0, 49.0), (9.0, None, 40.0)]
    df = spark.createDataFrame(rows, "l double, a double, r double")
    assert df.filter(rules.at_least({"l": 5, "a": 5, "r": 50})).count() == 1


def test_impute_rooms(spark):
    cases = {
        (None, None, 3.0): (3.0, 3.0, 3.0),
        (1.0, None, None): (1.0, 1.0, 1.0),
        (None, 2.0, None): (2.0, 2.0, 2.0),
        (None, 2.0, 4.0): (2.0, 2.0, 4.0),
        (1.5, None, 2.0): (1.5, 1.5, 2.0),
        (2.0, 2.0, None): (2.0, 2.0, 2.0),
        (None, None, None): (None, None, None),
    }
    df = spark.createDataFrame([(*k, i) for i, k in enumerate(cases)], "bathrooms double, bedrooms double, beds double, i int")
    got = [tuple(r)[:3] for r in df.withColumns(encode.impute_rooms()).orderBy("i").collect()]
    assert got == list(cases.values())


def test_impute_rooms_on_every_null_pattern(spark):
    """Bathrooms, bedrooms and beds by hand: a lone figure fills all three; a missing
    bathroom or bedroom count takes the other's, missing beds the bedrooms'."""
    expected = {
        (1.0, 2.0, 3.0): (1.0, 2.0, 3.0),
        (1.0, 2.0, None): (1.0, 2.0, 2.0),
        (1.0, None, 3.0): (1.0, 1.0, 3.0),
        (1.0, None, None): (1.0, 1.0, 1.0),
        (None, 2.0, 3.0): (2.0, 2.0, 3.0),
        (None, 2.0, None): (2.0, 2.0, 2.0),
        (None, None, 3.0): (3.0, 3.0, 3.0),
        (None, None, None): (None, None, None),
    }
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(expected)], "i int, bathrooms double, bedrooms double, beds double")
    got = [tuple(r)[1:] for r in df.withColumns(encode.impute_rooms()).orderBy("i").collect()]
    assert got == list(expected.values())


def test_one_hot(spark):
    df = spark.createDataFrame([("HEATING",), ("heating",), ("Graffiti",), (None,)], "t string")
    rows = df.select(*encode.one_hot("t", COMPLAINT_SLOTS)).collect()
    assert [sum(r) for r in rows] == [1, 0, 0, 0]
    assert rows[0].heating == 1


def test_one_hot_shared_spelling(spark):
    df = spark.createDataFrame(
        [("The Bronx", "Private Room", "others"), ("Bronx", "Private room", "Yurt"), ("Elsewhere", "Tent", "loft")],
        "b string, r string, p string",
    )
    out = df.select(
        *encode.one_hot("b", BOROUGH_SLOTS, ignore_case=True, aliases=BOROUGH_ALIASES),
        *encode.one_hot("r", ROOM_SLOTS, ignore_case=True),
        *encode.one_hot("p", PROPERTY_SLOTS, other=PROPERTY_OTHER, ignore_case=True),
    ).collect()
    assert [r.borough_is_Bronx for r in out] == [1, 1, 0]
    assert [r.room_is_private_room for r in out] == [1, 1, 0]
    assert [r[PROPERTY_OTHER] for r in out] == [1, 1, 0]
    assert out[2].property_is_Loft == 1
    assert sum(out[2][c] for c in BOROUGH_SLOTS) == 0
