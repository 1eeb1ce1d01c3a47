"""Each rule on values that trigger it, with ANSI mode on and off."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from lendstrata.functions import credit, dates, numeric, text


@pytest.fixture(params=["true", "false"], autouse=True)
def ansi(request, spark):
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.unset("spark.sql.ansi.enabled")


def apply(spark, values, expression, schema="x string"):
    rows = [v if isinstance(v, tuple) else (v,) for v in values]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
    return [r.y for r in df.select("i", expression.alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("value", "want"),
    [("23_", 23), ("_41", 41), ("12.7", 12), ("abc", None), ("", None), (" 12 ", 12), ("-5", -5),
     ("1e2", None), ("99999999999", None), (None, None), ("1_2", 12)],
)
def test_lenient_int(spark, value, want):
    assert apply(spark, [value], text.lenient_int(F.col("x"))) == [want]


def test_lenient_float(spark):
    got = apply(spark, ["1328.5", "1328.5_", "_", None], text.lenient_float(F.col("x"), strip=False))
    assert got == [1328.5, None, None, None]
    assert apply(spark, ["1328.5_", "__10000__", "1.0E7"], text.lenient_float(F.col("x"))) == [1328.5, 10000, 1e7]


def test_keys_and_sentinels(spark):
    assert apply(spark, [" CUS_0xA "], text.normalise_key(F.col("x"))) == ["cus_0xa"]
    marks = ["!@9#%8", "High_spent_Small_value_payments", None]
    assert apply(spark, marks, text.replace_sentinel(F.col("x"), "!@9#%8", "unknown")) == ["unknown", marks[1], None]


def test_negative_to_null(spark):
    c = text.negative_to_null(text.lenient_int(F.col("x")))
    assert apply(spark, ["3", "3_", "-100", "-100_"], c) == [3, 3, None, None]


def test_capture_int(spark):
    ages = ["22 Years and 1 Months", "NA", None]
    assert apply(spark, ages, text.capture_int(F.col("x"), text.YEARS_TEXT)) == [22, None, None]
    assert apply(spark, ages, text.capture_int(F.col("x"), text.MONTHS_TEXT)) == [1, None, None]


def test_list_items(spark):
    lists = ["Auto Loan, Payday Loan, and Auto Loan", "A and B", "", "Not Specified", None]
    want = [["Auto Loan", "Payday Loan"], ["A and B"], [], ["Not Specified"], None]
    assert apply(spark, lists, text.list_items(F.col("x"))) == want


def test_ordinal(spark):
    codes = {"Standard": 2, "Good": 1, "Bad": 0}
    assert apply(spark, ["Standard", "Good", "Bad", "_", None], text.ordinal(F.col("x"), codes)) == [2, 1, 0, None, None]


def test_keep_valid(spark):
    numbers = ["123-45-6789", "#F%$D@*&8", "123456789"]
    assert apply(spark, numbers, text.keep_valid(F.col("x"), text.SSN_TEXT)) == [numbers[0], None, None]


def test_split_part(spark):
    names = ["High_spent_Small_value_payments", "unknown"]
    assert apply(spark, names, text.split_part(F.col("x"), 0)) == ["High", "unknown"]
    assert apply(spark, names, text.split_part(F.col("x"), 2)) == ["Small", None]


def test_parse_date(spark):
    texts = ["1/1/23", "12/1/24", "13/45/23", "12/1/2023"]
    got = apply(spark, texts, dates.parse_date(F.col("x"), dates.SHORT_US_DATE))
    assert got == [date(2023, 1, 1), date(2024, 12, 1), None, None]
    assert apply(spark, ["2023-01-01", "x"], dates.parse_date(F.col("x"))) == [date(2023, 1, 1), None]


def test_month_spine(spark):
    got = [r[0] for r in dates.month_spine_between(spark, date(2023, 1, 15), date(2024, 12, 1)).collect()]
    assert (len(got), got[0], got[-1]) == (24, date(2023, 1, 1), date(2024, 12, 1))
    assert dates.month_spine_between(spark, date(2024, 1, 1), date(2023, 1, 1)).collect() == []


def test_delinquency(spark):
    rows = [
        (100.0, 0.0, date(2023, 7, 1)),
        (100.0, 250.0, date(2023, 7, 1)),
        (100.0, 1.0, date(2023, 3, 31)),
        (0.0, 5.0, date(2023, 7, 31)),
    ]
    schema = "due double, overdue double, snap date"
    missed = credit.installments_missed(F.col("overdue"), F.col("due"))
    first = credit.first_missed_date(F.col("snap"), missed)
    assert apply(spark, rows, missed, schema) == [0, 3, 1, 0]
    assert apply(spark, rows, first, schema) == [None, date(2023, 4, 1), date(2023, 2, 28), None]
    dpd = credit.days_past_due(F.col("overdue"), F.col("snap"), first)
    assert apply(spark, rows, dpd, schema) == [0, 91, 31, None]


def test_label(spark):
    assert apply(spark, [30, 29, None], credit.default_label(F.col("x"), 30), "x int") == [1, 0, 0]
    assert apply(spark, [None], credit.default_label(F.col("x"), 30, null_label=1), "x int") == [1]


def test_ratio_and_indicator(spark):
    pairs = [(5.0, 2.0), (5.0, 0.0), (5.0, None), (None, 2.0)]
    ratio = numeric.guarded_ratio(F.col("a"), F.col("b"))
    assert apply(spark, pairs, ratio, "a double, b double") == [2.5, 0.0, 0.0, None]
    assert apply(spark, ["employed", "Employed", None], numeric.indicator(F.col("x"), "employed")) == [1, 0, 0]
