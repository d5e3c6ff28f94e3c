import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from nimbusgrid.functions import bands, indices, physics, scalars


def one(spark, column, **values):
    fields = ", ".join(f"{n} {'string' if isinstance(v, str) else 'double'}"
                       for n, v in values.items())
    df = spark.createDataFrame([tuple(values.values())], fields)
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize("text,expected", [
    ("0,0", 0.0), ("26,2", 26.2), (" 1.5 ", 1.5), ("Ip", 0.05), ("iP ", 0.05), ("-3,5", -3.5),
    ("Acum", None), ("", None), ("1d", None), ("1,2,3", None), ("1e2", 100.0), (".5", 0.5),
    ("+7", 7.0), ("Infinity", math.inf), ("   ", None),
])
def test_locale_number(spark, text, expected):
    assert one(spark, scalars.locale_number(F.col("t")), t=text) == expected


def test_missing_values_stay_missing(spark):
    null = F.lit(None).cast("double")
    row = spark.range(1).select(
        scalars.bounded(null, 0, 100).alias("a"), scalars.locale_number(F.lit(None).cast("string")).alias("b"),
        scalars.no_nan(F.lit(float("nan"))).alias("c"), scalars.bounded(F.lit(-3.0), 0).alias("d"),
        scalars.bounded(F.lit(130.0), 0, 100).alias("e")).first()
    assert tuple(row) == (None, None, None, 0.0, 100.0)


def test_half_to_even_rounding(spark):
    assert one(spark, scalars.rint_to(F.col("v")), v=0.25) == 0.2
    assert one(spark, scalars.rint_to(F.col("v")), v=0.75) == 0.8


@pytest.mark.parametrize("name,expected", [
    ("Prats De Lluçanès", "Prats_De_Lluçanès"), ("Corbera, Pic D'Agulles", "Corbera_Pic_DAgulles"),
    ("Manresa (La Culla)", "Manresa_La_Culla"), ("A - B", "A_-_B"),
])
def test_sanitize_name(spark, name, expected):
    assert one(spark, scalars.sanitize_name(F.col("n")), n=name) == expected


def test_stamps_and_dates(spark):
    day = F.lit(dt.date(2024, 2, 29))
    row = spark.range(1).select(
        scalars.stamp(day).alias("s"), scalars.request_stamp(day.cast("timestamp")).alias("r"),
        scalars.same_day_last_year(day).alias("y"),
        scalars.parse_date(F.lit("not-a-date")).alias("bad")).first()
    assert tuple(row) == ("20240229", "2024-02-29T00%3A00%3A00UTC", dt.date(2023, 2, 28), None)


def test_wind_components(spark):
    df = spark.createDataFrame([(0.0,), (90.0,), (None,), (99.0,)], "d double")
    rows = df.select(*[c.alias(n) for n, c in scalars.wind_components(F.col("d")).items()]).collect()
    assert rows[1].wind_sin == pytest.approx(1) and rows[1].wind_cos == pytest.approx(0, abs=1e-12)
    assert all((r.wind_sin, r.wind_cos) == (0.0, 1.0) for r in rows[2:])
    tens = scalars.wind_components(F.col("d"), unit_scale=10)["wind_sin"]
    assert one(spark, tens, d=9.0) == pytest.approx(1)


def test_cyclic_calendar(spark):
    parts = scalars.cyclic(F.lit(dt.date(2024, 3, 1)))
    row = spark.range(1).select(*[c.alias(n) for n, c in parts.items()]).first()
    assert row.month_sin == pytest.approx(1.0)
    assert row.day_sin == pytest.approx(math.sin(2 * math.pi * 61 / 365.0))


def test_moist_air(spark):
    t, td = F.col("t"), F.col("td")
    assert one(spark, physics.relative_humidity(t, td), t=20.0, td=20.0) == pytest.approx(100.0)
    assert one(spark, physics.relative_humidity(t, td), t=30.0, td=10.0) == pytest.approx(28.938443, abs=1e-5)
    assert one(spark, physics.vapor_pressure_deficit(t, td), t=25.0, td=15.0) == pytest.approx(14.597532, abs=1e-5)
    assert one(spark, physics.dew_point_depression(t, td), t=25.0, td=15.0) == 10.0


@pytest.mark.parametrize("p,sun,hr,expected", [
    (0.10, 12.0, 40.0, 0.0), (0.80, 5.0, 90.0, 86.4), (0.40, 0.0, 95.0, 0.0),
    (0.95, 6.0, 85.0, 67.8), (0.0, 10.0, 30.0, 0.0), (0.70, 6.0, 90.0, 75.6),
    (0.90, 0.0, 90.0, 0.0), (0.5, 5.0, 39.0, 11.7), (0.85, 5.0, 100.0, 95.0),
])
def test_rainbow_score(spark, p, sun, hr, expected):
    score = indices.rainbow_score(F.col("p"), F.col("s"), F.col("h"))
    assert one(spark, score, p=p, s=sun, h=hr) == pytest.approx(expected)


def test_rainbow_score_missing(spark):
    df = spark.createDataFrame([(None, 5.0, 90.0), (0.5, None, 90.0), (0.5, 5.0, None)],
                               "p double, s double, h double")
    rows = df.select(indices.rainbow_score(F.col("p"), F.col("s"), F.col("h"))).collect()
    assert [r[0] for r in rows] == [None, 0.0, None]


@pytest.mark.parametrize("t,h,v,expected", [
    (26.0, 50.0, 10.0, -39.8), (26.0, 60.0, 0.0, -54.4), (30.0, 70.0, 1.0, -103.4),
    (10.0, 40.0, 4.9, 7.6), (5.0, 50.0, 10.0, -0.4), (10.0, 40.0, 1.0, 10.0), (20.0, 60.0, 5.0, 17.1),
])
def test_apparent_temperature(spark, t, h, v, expected):
    felt = indices.apparent_temperature(F.col("t"), F.col("h"), F.col("v"))
    assert one(spark, felt, t=t, h=h, v=v) == pytest.approx(expected)


def test_apparent_temperature_missing(spark):
    df = spark.createDataFrame([(5.0, 50.0, None), (20.0, 60.0, None), (30.0, None, 1.0),
                                (None, 60.0, 5.0)], "t double, h double, v double")
    felt = indices.apparent_temperature(F.col("t"), F.col("h"), F.col("v"))
    assert [r[0] for r in df.select(felt).collect()] == [5.0, None, None, None]


def test_bands(spark):
    df = spark.createDataFrame(
        [(0.6, 3.0, 65.0, 75.0, 4.9), (0.6, 1.0, 30.0, 41.0, 14.9), (0.5, 9.0, 0.0, 40.0, 24.9),
         (0.2, 5.0, 29.9, 71.0, 25.0), (None, None, None, None, None)],
        "p double, s double, r double, h double, f double")
    c = F.col
    rows = df.select(
        bands.weather_icon(c("p"), c("s")), bands.map_marker(c("p"), c("s")).icon,
        bands.rainbow_band(c("r")), bands.humidity_band(c("h")), bands.advice_icon(c("f")),
        bands.rain_label(c("p")), bands.rainbow_label(c("r")), bands.decision(c("p"))).collect()
    assert [tuple(r) for r in rows] == [
        ("sun_shower", "cloud-showers-heavy", "HIGH", "High", "❄️", "YES", "YES", 1),
        ("rain", "cloud-showers-heavy", "MEDIUM", "Medium", "🌬️", "YES", "YES", 1),
        ("sunny", "sun", "LOW", "Low", "😊", "YES", "NO", 1),
        ("partly_cloudy", "cloud", "LOW", "High", "🔥", "NO", "YES", 0),
        ("cloudy", "cloud", "LOW", "Low", "🔥", "NO", "NO", 0)]


def test_difference_and_labels(spark):
    diff = bands.signed_difference(F.col("a"), F.col("b"))
    assert one(spark, diff, a=7.6, b=10.0) == "-2.4°C"
    assert one(spark, diff, a=11.5, b=10.0) == "+1.5°C"
    assert one(spark, diff, a=10.0, b=10.0) == "same"
    assert one(spark, bands.code_name_label(F.col("a"), F.col("b")), a="0076", b="Aero") == "0076 Aero"
    null = F.lit(None).cast("string")
    assert one(spark, bands.code_name_label(F.col("a"), null), a="0076") == "0076"
    assert one(spark, bands.name_code_label(F.col("a"), null), a="0076") == "0076 (0076)"


@pytest.mark.parametrize("felt, actual, text", [
    (0.35, 0.0, "+0.3°C"), (0.25, 0.0, "+0.2°C"), (0.75, 0.0, "+0.8°C"), (2.675, 0.0, "+2.7°C"), (0.45, 0.0, "+0.5°C"),
    (-0.35, 0.0, "-0.3°C"), (1.15, 0.0, "+1.1°C"), (10.05, 0.0, "+10.1°C"), (3.0, 3.0, "same"), (-0.04, 0.0, "-0.0°C")])
def test_difference_text_is_decided_on_the_exact_value(spark, felt, actual, text):
    assert one(spark, bands.signed_difference(F.col("a"), F.col("b")), a=felt, b=actual) == text


def test_tenths_against_exact_formatting(spark):
    import random
    rng = random.Random(1)
    values = [rng.randrange(-99999, 99999) / rng.choice([20, 100, 1000, 40, 7]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", scalars.tenths(F.col("v")).alias("t"))
    assert all("%.1f" % r.v == "%.1f" % r.t for r in df.collect())
