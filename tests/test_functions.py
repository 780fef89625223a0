"""Casts, hashes, dates and ratios on hand-picked values."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lapwise import functions as fx


def column(spark, values, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, f"i int, v {kind}").select("i", expression.alias("out"))
    return [r["out"] for r in frame.orderBy("i").collect()]


@pytest.mark.parametrize(
    ("text", "ms"),
    [("1:27.452", 87452), ("22.879", 22879), ("junk", None), (None, None), ("1:x", None),
     ("x:1", None), ("1:2:3", 62000), ("NaN", None), ("", None), ("0:00.0005", 1),
     ("99999999999999999999:1", None)],
)
def test_duration(spark, text, ms):
    assert column(spark, [text], fx.duration_to_ms("v")) == [ms]


def test_numbers(spark):
    texts = ["1.5", "2.5", "-1.5", " 12 ", "x", "1e3", None, "99999999999999999999", "01"]
    assert column(spark, texts, fx.try_number("v")) == [
        2, 3, -2, 12, None, 1000, None, None, 1]
    assert column(spark, ["3000000000", "7"], fx.try_int("v")) == [None, 7]
    assert column(spark, ["12.345", "x", "9999999"], fx.try_decimal("v")) == [
        Decimal("12.35"), None, None]
    assert column(spark, ["1.25", "x"], fx.try_double("v")) == [1.25, None]


def test_dates_and_times(spark):
    assert column(spark, ["2020-02-29", "2020-02-30", "2020-2-3", None], fx.try_date("v")) == [
        dt.date(2020, 2, 29), None, None, None]
    assert column(spark, ["9:05:01", "14:00:00", "24:00:00", "14:00:00Z", None], fx.try_time("v")) == [
        "09:05:01", "14:00:00", None, None, None]
    day = F.col("v").cast("date")
    assert column(spark, ["2000-12-31"], fx.year_boundaries(day, F.lit("2001-01-01").cast("date"))) == [1]
    assert column(spark, ["2000-12-31"], fx.first_of_year(day)) == [dt.date(2000, 1, 1)]
    assert column(spark, ["2024-01-01"], fx.day_name(day)) == ["Mon"]


def test_hash_tells_neighbours_apart(spark):
    frame = spark.createDataFrame(
        [("x", None), (None, "x"), ("x||", "y"), ("x", "||y"), ("~", None), (None, None)],
        "a string, b string")
    text = [r[0] for r in frame.select(fx.change_hash(["a", "b"])).collect()]
    exact = [r[0] for r in frame.select(fx.exact_hash(["a", "b"])).collect()]
    assert text[0] != text[1] and text[2] == text[3] and text[4] == text[5]
    assert len(set(exact)) == 6


def test_ratio_and_flag(spark):
    frame = spark.createDataFrame([(1, 3, True), (0, 0, None), (2, 3, False)], "a int, n int, c boolean")
    got = frame.select(fx.percentage(F.col("a"), F.col("n")), fx.flag(F.col("c"))).collect()
    assert [tuple(r) for r in got] == [(33.3, 1), (None, 0), (66.7, 0)]


def test_serving_form_has_no_decimals(spark):
    frame = spark.sql("select cast(1.5 as decimal(8,2)) as d, 1 as i, 'x' as s")
    assert dict(fx.to_serving(frame).dtypes) == {"d": "double", "i": "int", "s": "string"}


def test_null_is_the_largest_value(spark):
    frame = spark.createDataFrame([(1,), (None,), (2,)], "v int")
    assert [r["v"] for r in frame.orderBy(fx.ascending("v")).collect()] == [1, 2, None]
    assert [r["v"] for r in frame.orderBy(fx.descending("v")).collect()] == [None, 2, 1]


def test_numbers_have_no_suffix_or_hexadecimal_form(spark):
    texts = ["1.5d", "1.5f", "0x1p3", "NaN", "Infinity", "1e3", " -2.5 ", ".5", "5.", "1e", ""]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["v"] for r in frame.select("t", fx.try_double("t").alias("v")).collect()}
    assert got == {"1.5d": None, "1.5f": None, "0x1p3": None, "NaN": None, "Infinity": None,
                   "1e3": 1000.0, " -2.5 ": -2.5, ".5": 0.5, "5.": 5.0, "1e": None, "": None}
    late = spark.createDataFrame([("22.879f",), ("1:22.879d",), ("1:22.879",)], "t string")
    assert [r[0] for r in late.select(fx.duration_to_ms("t")).collect()] == [None, None, 82879]
