import datetime as dt

import pytest

from nimbusgrid.operators import joins, serving

D = dt.date


@pytest.mark.parametrize("unique", [True, False])
def test_outer_merge(spark, unique):
    a = spark.createDataFrame([(D(2025, 1, 1), "x", 1.0), (D(2025, 1, 2), "x", 2.0)], "fecha date, indicativo string, a double")
    b = spark.createDataFrame([(D(2025, 1, 2), "x", "two")], "fecha date, indicativo string, b string")
    c = spark.createDataFrame([(D(2025, 1, 3), "y", 3)], "fecha date, indicativo string, c int")
    out = joins.outer_merge([a, b, c], unique_keys=unique).select("fecha", "indicativo", "a", "b", "c")
    assert sorted(tuple(r) for r in out.collect()) == [
        (D(2025, 1, 1), "x", 1.0, None, None), (D(2025, 1, 2), "x", 2.0, "two", None), (D(2025, 1, 3), "y", None, None, 3)]


def test_station_lookup_falls_back(spark):
    df = spark.createDataFrame([("0255B",), ("nowhere",)], "indicativo string")
    got = {r.indicativo: (r.map_name, r.lat, r.lon) for r in joins.with_station(df).collect()}
    assert got == {"0255B": ("Santa Susanna", 41.637, 2.71), "nowhere": ("nowhere", 41.38, 2.17)}
    assert joins.station_table(spark).count() == 26


def test_actuals_and_metadata(spark):
    f = spark.createDataFrame([("a", D(2025, 1, 1), 5.0), ("a", D(2025, 1, 2), 6.0)], "indicativo string, fecha date, tmed double")
    out = joins.with_actuals(f, f.filter("tmed = 5"), ["tmed"]).orderBy("fecha").collect()
    assert [r.tmed_real for r in out] == [5.0, None]
    assert joins.first_known(f, ["tmed"]).first().tmed == 5.0


def forecast(spark):
    rows = [(D(2025, 1, d), s, 0.1 * d, 3.0 * d, 40.0 + d, 5.0 * d, 5.0, 1.0, 10.0 * d, 9.0 * d)
            for d in range(1, 11) for s in ("0076", "zz")]
    return spark.createDataFrame(
        rows, "fecha date, indicativo string, prob_rain double, pred_sol double, pred_hrMedia double, "
              "pred_tmed double, pred_tmax double, pred_tmin double, rainbow_prob double, pred_windchill double")


def test_reader_frames(spark):
    df = forecast(spark)
    week = serving.next_days(df, "2025-01-05").collect()
    assert len(week) == 12 and min(r.fecha for r in week) == D(2025, 1, 5)
    assert serving.next_days(df, "2025-01-02").count() == 14
    trend = serving.weekly_trend(df, "2025-01-01").filter("indicativo = 'zz'").orderBy("fecha").collect()
    assert len(trend) == 7 and trend[1].rain_scaled == 1.0
    assert serving.point_lookup(df, "zz", "2025-01-03").first().pred_sol == 9.0
    card = serving.forecast_cards(df).filter("indicativo = 'zz' and fecha = '2025-01-06'").first()
    assert (card.icon, card.tmax_text, card.rain_pct, card.rain_label, card.rainbow_band) == ("sun_shower", "5°", 60, "YES", "HIGH")
    marks = {r.indicativo: r for r in serving.forecast_map(df, "2025-01-03").collect()}
    assert marks["0076"].map_name == "Barcelona - Aeropuerto" and marks["zz"].lat == 41.38
    assert (marks["zz"].icon, marks["zz"].colour, marks["zz"].degrees) == ("sun", "orange", 15)
    days = [r.fecha for r in serving.available_dates(df, "zz", 2025).collect()]
    assert days == sorted(days, reverse=True) and len(days) == 10
    assert serving.available_dates(df, "zz", 2030).count() == 10  # none recent: whole history
    assert [r.indicativo for r in serving.distinct_values(df, "indicativo", True).collect()] == ["zz", "0076"]
    assert serving.preview(df, 3).count() == 3


def test_alerts(spark):
    at = dt.datetime(2025, 1, 1)
    subs = spark.createDataFrame(
        [("1", "0076", "Aero", True, at, at), ("1", "zz", "Zed", True, at, at + dt.timedelta(1)), ("2", "none", "N", True, at, at)],
        "telegram_id string, station_code string, station_name string, active boolean, created_at timestamp, updated_at timestamp")
    (first,) = serving.alerts(subs, forecast(spark)).collect()
    assert (first.telegram_id, first.station_code, first.forecast_date) == ("1", "zz", D(2025, 1, 1))
    assert first.difference == "+4.0°C" and first.advice == "Wear a jacket, it's chilly."
    lines = first.message.split("\n")
    assert lines[0] == "" and lines[1] == " " * 12 + "<b>🌡️ Wind Chill Notification</b>"
    assert " " * 12 + "📍 <b>Station:</b> Zed" in lines and " " * 12 + "📅 <b>Date:</b> 01/01/2025" in lines
    assert " " * 12 + "🎚️ <b>Wind chill:</b> 9.0°C 🌬️" in lines
    (later,) = serving.alerts(subs, forecast(spark), as_of="2025-01-03").collect()
    assert later.pred_tmed == 15.0


def test_outer_merge_with_repeated_keys(spark):
    a = spark.createDataFrame([(1, 5), (1, 2), (2, 7)], "key int, p int")
    b = spark.createDataFrame([(1, 1), (1, 9), (3, 4)], "key int, q int")
    got = {tuple(r) for r in joins.outer_merge([a, b], ["key"]).collect()}
    assert got == {(1, 5, 1), (1, 5, 9), (1, 2, 1), (1, 2, 9), (2, 7, None), (3, None, 4)}
    folded = joins.outer_merge([a, b], ["key"], unique_keys=True)
    with pytest.raises(Exception, match="repeats a key"):
        folded.collect()
    with pytest.raises(Exception, match="repeats a key"):
        folded.select("key").collect()


@pytest.mark.parametrize("most", [4, 4_000_000])
def test_merge_cuts_keys_that_make_many_rows(spark, monkeypatch, most):
    """The same rows as a chain of full joins, null keys included, whatever the size of a piece."""
    monkeypatch.setattr(joins, "ROWS_A_PIECE", most, raising=False)
    a = spark.createDataFrame([(i % 3, 7, f"a{i}") for i in range(9)] + [(None, 7, "null"), (8, None, "half")], "k int, m int, p string")
    b = spark.createDataFrame([(i % 4, 7, "same") for i in range(16)] + [(None, 7, "null"), (9, 7, None)], "k long, m int, q string")
    c = spark.createDataFrame([(1, 7, [1, 2]), (1, 7, None), (5, 7, [3])], "k int, m int, r array<int>")
    want = a.join(b, ["k", "m"], "full").join(c, ["k", "m"], "full")
    got = joins.outer_merge([a, b, c], ["k", "m"])
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_merge_passes_rows_on_before_a_key_is_done(spark):
    """A full join held all rows it made of a key, which repeated keys multiply."""
    a, b = (spark.range(6).selectExpr("id % 2 AS key", f"id AS {c}") for c in "pq")
    plan = joins.outer_merge([a, b], ["key"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join FullOuter" not in plan and "Join LeftOuter" in plan
