"""Text, date and format functions on literals."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import dates as D
from ledgerline.functions import formats as R
from ledgerline.functions import text as X
from ledgerline.operators.filters import all_in, value_list


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


def test_title_case(spark):
    assert apply(spark, X.title_case, ["  HY-VEE #3 / o'brien casey's a_b ", "élan 3rd", "", None]) == [
        "Hy-Vee #3 / O'Brien Casey'S A_B", "Élan 3rd", "", None,
    ]


def test_proper_case(spark):
    assert apply(spark, X.proper_case, ["o'neil A_B 3RD x-y", None]) == ["O'Neil A_b 3rd X-Y", None]


def test_digits(spark):
    assert apply(spark, X.digits_to_int, ["x904631", "12", "abc", "99999999999", None]) == [904631, 12, None, None, None]


def test_points(spark):
    pair = lambda c: F.concat_ws("|", X.point_part(c, 1), X.point_part(c, 2))
    assert apply(spark, pair, ["POINT (-93.5 41.2)", None, "nowhere"]) == ["-93.5|41.2", "0.0|0.0", "nowhere|"]


def test_row_hash_modes(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c")], "p string, q string")
    parts = [X.HashPart("p", "null"), X.HashPart("q", "null")]
    assert len({r[0] for r in df.select(X.row_hash(parts)).collect()}) == 1
    assert len({r[0] for r in df.select(X.row_hash(parts, compat=False)).collect()}) == 2


def test_json(spark):
    texts = ['{"products": 1}', "aaa", '{"products": 1, "tempo":10}', "a", None, "", '{"a":1} x', '{"a":1,"a":2}', "1,2", "1],[2",
             '1},{"v":2', "null", " 5 ", "[1,]", "NaN"]
    assert apply(spark, X.is_valid_json, texts) == [
        True, False, True, False, False, False, False, True, False, False, False, True, True, False, False,
    ]


def test_category_groups(spark):
    names = ["Spiced Rum", "100% Agave Tequila", "Mezcal", "Cocktails/RTD", "Temporary & Specialty Packages", "Tequila Rum", "xyz"]
    assert apply(spark, X.category_group, names) == ["Rum", "Tequila", "Tequila", "Liqueurs", "Speciality", "Rum", "other"]
    assert apply(spark, lambda c: X.category_group(c, match="search"), ["80 Vodka"]) == ["Vodka"]
    with pytest.raises(ValueError):
        X.category_group(F.col("x"), match="prefix")


def test_weeks_agree_with_plain_dates(spark):
    days = [date(1999, 12, 25) + timedelta(days=i) for i in range(800)]
    df = spark.createDataFrame([(x,) for x in days], "d date")
    rows = df.select("d", D.week_code(F.col("d")), D.week_end(day=F.col("d"))).collect()
    assert all(r[1] == D.plain_week_code(r[0]) and r[2] == D.plain_week_end(r[0]) for r in rows)
    assert D.plain_week_end(date(2000, 12, 31)) == date(2000, 12, 31)
    with pytest.raises(ValueError):
        D.week_end()


def test_offsets():
    assert D.plain_offset(week=-52) == D.Offset(0, 0, 0, -1)
    assert D.plain_offset(day=-15, week=1) == D.Offset(-1, -1, 0, 0)
    assert D.plain_offset(week=9, month=11) == D.Offset(0, 1, 1, 1)
    assert D.plain_shift(date(2020, 2, 29), years=-1) == date(2019, 3, 1)


def test_month_shift_rolls(spark):
    shifted = apply(spark, lambda c: D.shift_date(c, months=1), [date(2020, 1, 31), date(2020, 1, 15)], "date")
    assert shifted == [date(2020, 3, 2), date(2020, 2, 15)]
    assert apply(spark, lambda c: D.shift_date(c, years=-1), [date(2020, 2, 29)], "date") == [date(2019, 3, 1)]


def test_numbers_as_text(spark):
    assert apply(spark, R.format_percent, [0.1234, 0.5, 1.0, -0.125, 0.0], "double") == ["12.34 %", "50 %", "100 %", "-12.5 %", "0 %"]
    assert apply(spark, R.format_comma, [1234567.4, -123.0, 0.5, 1.5], "double") == ["1,234,567", "-123", "0", "2"]


@pytest.mark.parametrize(
    "name, label",
    [
        ("Cur_Bottles.Sold", "Current YTD Bottles Sold"),
        ("L_52_Sales", "1 Yr Ago YTD Sales"),
        ("L_60_Cost", "1 Yr and 8 Wks Ago YTD Cost"),
        ("L_110_Cost", "2 Yrs and 6 Wks Ago YTD Cost"),
        ("L_13_Cost", "13 Wks Ago YTD Cost"),
        ("Sales_PercD", "Sales % Diffrence"),
        ("Sales_Delta", "Sales Diffrence"),
        ("Cur_Sales_MkShare", "Current YTD Sales MarketShare"),
        ("Sales_MkShareD", "Sales MarketShare Diffrence"),
        ("Item.Number", "Item Number"),
    ],
)
def test_labels(name, label):
    assert R.report_label(name) == label


def test_label_without_ytd():
    assert R.report_label("L_52_Sales", ytd=False) == "1 Yr Ago Sales"
    assert R.report_label("Cur_Sales", ytd=False) == "Current Sales"


def test_all_in(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "n int, s string")
    count = lambda *p: df.filter(all_in(*p)).count()
    assert (count(), count("s", ["a"]), count("s", ["a"], "n", [3]), count("s", []), count(None, ["a"])) == (3, 2, 1, 3, 3)
    assert count("n", [1], "n", [2, 3]) == 2
    assert [r[0] for r in value_list(df, "n", "s", ["a"]).collect()] == [1, 3]
