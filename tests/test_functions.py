from datetime import date, datetime
from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerlark.functions import dates, formats, text
from tests.conftest import rows


def one(spark, schema, values, *columns):
    return [row for row in rows(spark.createDataFrame(values, schema).select(*columns))]


def test_amount_masks(spark):
    values = [(D(v),) for v in ("0", "0.5", "1234567.125", "2.125", "-0.25", "-12.345")]
    got = one(spark, "v decimal(12,3)", values, formats.plain_amount("v"), formats.percent("v"))
    assert got == [
        (".00", "0.00 %"),
        (".50", "0.50 %"),
        ("1234567.13", "1234567.13 %"),
        ("2.13", "2.13 %"),
        ("-.25", "-0.25 %"),
        ("-12.35", "-12.35 %"),
    ]


def test_masks_round_half_away_from_zero(spark):
    values = [(D("0.5"),), (D("1.5"),), (D("2.5"),), (D("-2.5"),), (D("1234567.5"),), (None,)]
    got = one(spark, "v decimal(9,1)", values, formats.grouped_integer("v"))
    assert got == [("1",), ("2",), ("3",), ("-3",), ("1,234,568",), (None,)]


def test_plain_percent(spark):
    got = one(spark, "v decimal(12,6)", [(D("0.305249"),), (D("12.34565"),)], formats.plain_percent("v"))
    assert got == [(".3052 %",), ("12.3457 %",)]


def test_capitalised_starts_at_every_run_of_letters_or_digits(spark):
    values = [("o'neil-smith X",), ("OLD french",), ("3rd man",), ("",), (None,), ("ünal éva",)]
    got = one(spark, "v string", values, text.capitalised("v"))
    assert got == [("O'Neil-Smith X",), ("Old French",), ("3rd Man",), ("",), (None,), ("Ünal Éva",)]


def test_joined_skips_null_and_merged_skips_blank(spark):
    values = [("a", "b"), ("a", None), ("a", ""), (None, "b"), ("a", " ")]
    got = one(spark, "x string, y string", values, text.joined("x", F.lit(" "), "y"), text.merged("x", "y"))
    assert got == [("a b", "a, b"), ("a ", "a"), ("a ", "a"), (" b", None), ("a  ", "a,  ")]


def test_text_predicates(spark):
    values = [("Love Actually",), ("GLOVE",), ("Zebra",), (None,)]
    got = one(
        spark, "v string", values,
        text.matches("v", "%LOVE%"), text.same_text("v", "zebra"), text.one_of("v", ["GLOVE", "zebra"]),
    )
    assert got == [(True, False, False), (True, False, True), (False, True, True), (None, None, None)]


def test_mapped(spark):
    got = one(
        spark, "v string", [("G",), ("PG",), ("zz",), (None,)],
        text.mapped("v", {"G": "All", "PG": "Guided"}, "Unknown"), text.mapped("v", {"G": "All"}),
    )
    assert got == [("All", "All"), ("Guided", None), ("Unknown", None), ("Unknown", None)]


def test_calendar(spark):
    values = [(datetime(2024, 12, 30, 23, 59, 59),), (datetime(2000, 2, 29, 0, 0),)]
    got = one(
        spark, "t timestamp_ntz", values,
        dates.quarter_start("t"), dates.month_label("t"), dates.second_label("t"),
        dates.day_name("t"), dates.iso_week("t"), dates.month_end("t"),
    )
    assert got == [
        (date(2024, 10, 1), "2024-12", "2024-12-30 23:59:59", "Monday", 1, date(2024, 12, 31)),
        (date(2000, 1, 1), "2000-02", "2000-02-29 00:00:00", "Tuesday", 9, date(2000, 2, 29)),
    ]


def test_day_ranges_include_the_last_day(spark):
    values = [(datetime(2017, 12, 31, 23, 59, 59),), (datetime(2018, 1, 1),), (datetime(2016, 12, 31, 23),)]
    got = one(
        spark, "t timestamp_ntz", values,
        dates.in_years("t", 2017, 2017),
        dates.between_days("t", date(2017, 12, 31), date(2017, 12, 31)),
        dates.in_listed_years("t", [2016, 2018]),
    )
    assert got == [(True, True, False), (False, False, True), (False, False, True)]


def test_quarter_bounds():
    assert dates.quarter_bounds(date(2017, 2, 15)) == (date(2017, 1, 1), date(2017, 4, 1))
    assert dates.quarter_bounds(date(2020, 12, 31)) == (date(2020, 10, 1), date(2021, 1, 1))
