from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from flightlake.functions import clean, measure, text


def one(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r["o"] for r in df.withColumn("o", expr).orderBy("i").collect()]


def test_clean_text(spark):
    got = one(spark, [" a ", "", " nan", "NONE", None, "\tNA\n"], clean.clean_text("c"))
    assert got == ["a", None, None, None, None, "NA"]


def test_numbers(spark):
    got = one(spark, ["1", " -2.5 ", "1e3", "nan", "inf", "5d", "", "x", None, ".5", "+7."], clean.to_double("c"))
    assert got == [1.0, -2.5, 1000.0, None, None, None, None, None, None, 0.5, 7.0]


def test_times(spark):
    t = datetime(2020, 1, 1, 14, 23, 0)
    texts = ["1577888580", "2020-01-01 14:23:00", "2020-01-01T14:23:00", "2020-01-01 16:23:00+0200", "2020-01-01T14:23:00+00:00", "2020-01-01T14:23:00Z"]
    assert one(spark, texts, clean.to_time("c")) == [t] * 6
    assert one(spark, ["nan", "", None, "01/02/2020", "2020-01-01"], clean.to_time("c")) == [None] * 5


def test_days(spark):
    got = one(spark, ["8/15/2017", "2017-08-15", "15/8/2017", "3/4/2017", "nan", "2017"], clean.to_day("c"))
    d = date(2017, 8, 15)
    assert got == [d, d, d, date(2017, 3, 4), None, None]


def test_iso_and_population(spark):
    assert one(spark, ["-99", "-9", "CN-TW", " NA ", "NG"], clean.iso_code("c")) == [None, None, "TW", "NA", "NG"]
    assert one(spark, [218541212.0, 0.0, -5.0, None], clean.population("c"), "double") == [218541212, None, None, None]


def test_patches(spark):
    got = one(spark, ["BOEING ICAO Manufacturer Code (abc) (B738)", "B738", "long text without marker (X)", None], clean.type_code_patch("c"))
    assert got == ["B738", "B738", "long text without marker (X)", None]
    assert one(spark, ["SWA\t Airline IATA WN", "AA"], clean.operator_code_patch("c")) == ["WN", "AA"]


def test_units_pass_null(spark):
    assert one(spark, [1000.0, None], measure.feet("c"), "double") == [3280.8, None]
    assert one(spark, [250.0], measure.kmh("c"), "double") == [900.0]
    assert one(spark, [-5.08], measure.feet_per_minute("c"), "double") == [-1000.0]


def test_rounding_is_half_away_from_zero(spark):
    got = one(spark, [25, -25, 0], measure.ratio(F.col("c"), F.lit(100), 1), "bigint")
    assert got == [Decimal("0.3"), Decimal("-0.3"), Decimal("0.0")]
    assert one(spark, [1], measure.ratio(F.col("c"), F.lit(0), 1), "bigint") == [None]


def test_clock_numbers(spark):
    assert one(spark, [0, 905, 2359, 2400, 1261, None], measure.hhmm_to_minutes("c"), "int") == [0, 545, 1439, 0, None, None]


@pytest.mark.parametrize("p,label", [(0.0, "ON_TIME"), (0.2999, "ON_TIME"), (0.30, "MINOR_DELAY"), (0.65, "MAJOR_DELAY"), (1.0, "MAJOR_DELAY"), (None, None)])
def test_delay_class(spark, p, label):
    assert one(spark, [p], measure.delay_class("c"), "double") == [label]


def test_age(spark):
    got = one(spark, [date(2010, 1, 1)], measure.age_years("c", F.lit("2020-07-01").cast("date")), "date")
    assert got == [Decimal("10.5")]


def test_texts(spark):
    assert one(spark, [125.0, 45.4, 0.0, None], text.duration_text("c"), "double") == ["2h 5m", "45m", "—", "—"]
    assert one(spark, [34960.0, None], text.altitude_text("c"), "double") == ["35000 ft", "—"]
    assert one(spark, ["LOS", None], text.route_label("c", F.lit("CAI"))) == ["LOS → CAI", None]


def test_monitor_line(spark):
    df = spark.createDataFrame([("DEPARTED", "abc", None, 1234.0)], "event_type string, icao24 string, callsign string, altitude_ft double")
    assert df.select(text.monitor_line()).first()[0] == "DEPARTED     | abc |  unknown | alt=   1,234ft"
