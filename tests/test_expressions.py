import datetime as dt

import pytest
from pyspark.sql import functions as F

from touchline.functions import expressions as e


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text, day", [
    ("12/08/2026", dt.date(2026, 8, 12)), ("12/08/15", dt.date(2015, 8, 12)), ("2026-08-12", dt.date(2026, 8, 12)),
    (" 1/9/26 ", dt.date(2026, 9, 1)), ("12/08/95", dt.date(1995, 8, 12)), ("31/12/68", dt.date(2068, 12, 31)),
    ("31/02/2026", None), ("garbage", None), ("", None), ("2026-13-01", None), (None, None)])
def test_day_first_dates(spark, text, day):
    assert one(spark, e.day_first_date(F.lit(text).cast("string"))) == day


@pytest.mark.parametrize("text, whole, number", [
    ("3", 3, 3.0), ("2.0", 2, 2.0), (" 7 ", 7, 7.0), ("-1", -1, -1.0), ("2.5", None, 2.5), ("x", None, None),
    ("", None, None), ("1d", None, None), (None, None, None), ("99999999999", None, 99999999999.0)])
def test_numbers(spark, text, whole, number):
    column = F.lit(text).cast("string")
    assert one(spark, e.to_whole(column)) == whole
    assert one(spark, e.to_number(column)) == number


@pytest.mark.parametrize("value, digits, rounded", [
    (1.005, 2, 1.0), (2.675, 2, 2.68), (2.5, 0, 3.0), (-2.5, 0, -3.0), (0.25, 1, 0.3), (0.0, 2, 0.0),
    (1.0e14, 6, 1.0e14), (2.5e15, 4, 2.5e15), (1.0e18, 2, 1.0e18), (-3.0e18, 0, -3.0e18), (123456789.125, 2, 123456789.13)])
def test_rounding(spark, value, digits, rounded):
    assert one(spark, e.round_half_away(F.lit(value), digits)) == rounded


def test_ratios_survive_zero(spark):
    assert one(spark, e.safe_ratio(F.lit(5), F.lit(0), 2)) is None
    assert one(spark, e.safe_ratio(F.lit(5), F.lit(None).cast("int"), 2)) is None
    assert one(spark, e.percent(F.lit(1), F.lit(3), 1)) == 33.3


def test_labels(spark):
    assert one(spark, e.season_label(F.lit("1516"))) == "2015/16"
    assert one(spark, e.season_year(F.lit("1516"), 3)) == 2016
    assert one(spark, e.label_for(F.lit("2021"), {"1920": "a", "2021": "b"}, "normal")) == "b"
    assert one(spark, e.label_for(F.lit("2223"), {}, "normal")) == "normal"
    assert one(spark, e.full_name(F.lit("A"), F.lit(None).cast("string"))) is None
    assert one(spark, e.shorten(F.lit("x" * 35))) == "x" * 34 + "…"
    assert one(spark, e.shorten(F.lit("x" * 34))) == "x" * 34
    none = F.lit(None)
    assert one(spark, e.fixture_label(F.lit(7), F.lit("Leeds"), F.lit(True))) == "7 Leeds (H)"
    assert one(spark, e.fixture_label(F.lit(7), none.cast("string"), F.lit(False))) == "7 ? (A)"
    assert one(spark, e.fixture_label(F.lit(7), F.lit("Leeds"), none.cast("boolean"))) == "7 Leeds"


def test_points(spark):
    rows = spark.createDataFrame([("H",), ("D",), ("A",), (None,)], "r string").select(
        "r", e.points_for("r", "H").alias("h"), e.points_for("r", "A").alias("a")).collect()
    assert [(r.h, r.a) for r in rows] == [(3, 0), (1, 1), (0, 3), (None, None)]


def test_calendar(spark):
    row = spark.range(1).select(F.lit(dt.date(2026, 8, 16)).alias("d")).select(*e.calendar_columns("d")).first()
    assert tuple(row) == (20260816, dt.date(2026, 8, 16), 2026, 8, "August", 16, "Sunday", 33, 1)


def test_utc_date_of_a_late_deadline(spark):
    day = F.date_add(F.to_date(e.utc_timestamp(F.lit("2027-05-30T23:30:00Z"))), 7)
    assert one(spark, day) == dt.date(2027, 6, 6)
    assert one(spark, e.utc_timestamp(F.lit("soon"))) is None
