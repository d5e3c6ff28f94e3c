import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nimbusgrid.operators import panel, quality
from nimbusgrid.plans.clean import clean_panel

D = dt.date
SCHEMA = "indicativo string, fecha date, v double"
cell = st.one_of(st.none(), st.none(), st.floats(-50, 50).map(lambda x: round(x, 2)))


def frame(spark, series: dict[str, list], start=D(2024, 1, 1)):
    rows = [(s, start + dt.timedelta(i), v) for s, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, SCHEMA)


def values(df, c="v"):
    out = {}
    for r in df.orderBy("indicativo", "fecha").collect():
        out.setdefault(r.indicativo, []).append(r[c])
    return out


def close(a, b):
    return all((x is None) == (y is None or pd.isna(y)) and (x is None or x == pytest.approx(y))
               for x, y in zip(a, b, strict=True))


def test_interpolation_limits(spark):
    given_ = [None, 1.0] + [None] * 9 + [11.0] + [None] * 9
    expected = [None, 1, 2, 3, 4, 5, 6, 7, 8, None, None, 11] + [11] * 7 + [None, None]
    got = values(panel.interpolate(frame(spark, {"a": given_}), ["v"]))["a"]
    assert close(got, [None if x is None else float(x) for x in expected])


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(cell, min_size=1, max_size=40), min_size=1, max_size=12), st.integers(1, 9))
def test_fills_match_pandas(spark, columns, limit):
    series = {f"s{i:02d}": vs for i, vs in enumerate(columns)}
    df = frame(spark, series)
    line = values(panel.interpolate(df, ["v"], limit=limit))
    near = values(panel.fill_adjacent(df, ["v"]))
    for s, vs in series.items():
        p = pd.Series(vs, dtype=float)
        assert close(line[s], list(p.interpolate(limit=limit)))
        assert close(near[s], list(p.ffill().bfill()))


def _expected_fill(vs, days, limit, default):
    """The fill order, step by step on one series."""
    p = pd.Series(vs, index=pd.DatetimeIndex(days), dtype=float)
    p = p.interpolate(limit=limit)
    for key in (p.index.dayofyear, p.index.month):
        p = p.where(p.notna(), p.groupby(key).transform("mean"))
    return list(p.ffill().bfill().fillna(default))


def test_hybrid_impute_matches_pandas(spark):
    rng = np.random.default_rng(7)
    start, n = D(2020, 11, 1), 800
    days = [start + dt.timedelta(i) for i in range(n)]
    rows, series = [], {}
    for s in ("a", "b", "empty"):
        v = rng.normal(10, 5, n).round(2)
        v[rng.random(n) < 0.3] = np.nan
        v[100:160] = np.nan
        v[:20] = np.nan
        if s == "empty":
            v[:] = np.nan
        series[s] = v
        rows += [(s, d, None if np.isnan(x) else float(x)) for d, x in zip(days, v)]
    df = spark.createDataFrame(rows, "indicativo string, fecha date, presion double")
    got = panel.hybrid_impute(df, ["presion"])
    for s, vs in series.items():
        assert close(values(got, "presion")[s], _expected_fill(vs, days, 7, 1013.0))
        assert values(got, "presion_est")[s] == [int(np.isnan(x)) for x in vs]


def test_densify_edges(spark):
    rows = [("in", D(2024, 1, 3), 3.0), ("in", D(2024, 1, 5), 5.0), ("before", D(2023, 12, 1), 1.0),
            ("after", D(2024, 2, 1), 9.0), ("cross", D(2023, 12, 30), 1.0), ("cross", D(2024, 1, 2), 2.0),
            ("cross", D(2024, 2, 2), 4.0)]
    out = values(panel.densify(spark.createDataFrame(rows, SCHEMA), "2024-01-01", "2024-01-06"))
    assert out == {"in": [None, None, 3.0, None, 5.0, None], "before": [None] * 6,
                   "after": [None] * 6, "cross": [None, 2.0, None, None, None, None]}


def test_densify_carries_static_columns(spark):
    rows = [("a", D(2024, 1, 2), None, 1.0), ("a", D(2024, 1, 3), "x", None), ("a", D(2024, 1, 5), None, 2.0)]
    df = spark.createDataFrame(rows, "indicativo string, fecha date, nombre string, v double")
    out = panel.densify(df, "2024-01-01", "2024-01-06", static=["nombre"])
    assert values(out, "nombre")["a"] == ["x"] * 6
    assert values(out)["a"] == [None, 1.0, None, None, 2.0, None]


def test_coverage(spark):
    df = frame(spark, {"full": [1.0] * 10, "most": [1.0] * 8, "few": [1.0] * 3})
    doubled = df.union(df)
    got = {r.indicativo: (r.days, r.coverage)
           for r in panel.coverage(doubled, "2024-01-01", "2024-01-10").collect()}
    assert got["full"] == (10, pytest.approx(10 / 9)) and got["few"][1] == pytest.approx(3 / 9)
    kept = panel.keep_covered(doubled, "2024-01-01", "2024-01-10")
    assert {r.indicativo for r in kept.collect()} == {"full", "most"}
    dense = panel.densify(df, "2024-01-01", "2024-01-10", min_coverage=0.85)
    assert {r.indicativo for r in dense.collect()} == {"full", "most"}


def test_keep_first_on_a_hot_key(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(F.lit(7)).alias("k"), "id")
    out = panel.keep_first(df, ["k"], [F.desc("id")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # cut before the shuffle and after
    expected = df.groupBy("k").agg(F.max("id").alias("id"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, expected.collect()))


def test_one_shuffle_by_series(spark):
    df = panel.densify(frame(spark, {"a": [1.0, None, 3.0]}), "2024-01-01", "2024-01-09")
    filled = panel.hybrid_impute(df, ["v"])
    assert filled._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


RECORD = ("fecha date, indicativo string, nombre string, provincia string, altitud string, "
          "tmed double, prec double, tmin double, tmax double, dir string, velmedia double, "
          "racha double, sol double, presMax double, presMin double, hrMedia double")


def _record(day, tmed, prec):
    return (day, "TEST", "Station A", "Barcelona", "10", tmed, prec) + (None,) * 9


def test_clean_panel(spark):
    df = spark.createDataFrame([_record(D(2024, 1, 1), 15.0, 0.0), _record(D(2024, 1, 2), None, None),
                                _record(D(2024, 1, 3), 16.0, 0.0)], RECORD)
    out = clean_panel(df, min_coverage=None).orderBy("fecha").collect()
    assert len(out) == 6209
    second = out[1]
    assert (second.fecha, second.tmed, second.tmed_est) == (D(2009, 1, 2), 15.5, 1)
    by_day = {r.fecha: r for r in out}
    assert by_day[D(2024, 1, 2)].tmed == 15.5
    assert all(by_day[D(2024, 1, d)].tmed == 16.0 for d in range(4, 11))
    assert (second.presion, second.nombre, second.prec, second.prec_est) == (1013.0, "Station A", 0.0, 1)


def test_second_source_fills_rain_and_sky(spark):
    df = spark.createDataFrame([_record(D(2024, 1, 1), 15.0, None), _record(D(2024, 1, 3), 16.0, 2.0)], RECORD)
    sky = spark.createDataFrame(
        [("TEST", D(2024, 1, 1), 5.0, 1010.0, 120.0, 0.7), ("TEST", D(2024, 1, 2), 30.0, 1012.0, 10.0, None),
         ("OTHER", D(2024, 1, 2), 1.0, 1.0, 1.0, 1.0)],
        "indicativo string, fecha date, sol double, presion double, nubes double, om_prec double")
    out = clean_panel(df, sky, start="2024-01-01", end="2024-01-03", min_coverage=0.5,
                      keep_quality_score=True).orderBy("fecha").collect()
    assert [r.indicativo for r in out] == ["TEST"] * 3
    assert [r.prec for r in out] == [0.7, 0.0, 2.0] and [r.prec_est for r in out] == [0, 1, 0]
    assert [r.sol for r in out] == [5.0, 24.0, 24.0] and [r.nubes for r in out] == [100.0, 10.0, 10.0]
    assert out[2]._quality_score > out[0]._quality_score


def test_quality_report(spark):
    df = spark.createDataFrame([("a", "A", 1, 0), ("a", "A", 1, 1), ("b", "B", 0, 0)],
                               "indicativo string, nombre string, tmed_est int, prec_est int")
    shares = {r.variable: r.estimated_pct for r in quality.estimated_share(df).collect()}
    assert shares == {"tmed": pytest.approx(200 / 3), "prec": pytest.approx(100 / 3)}
    worst = quality.worst_series(quality.with_quality_score(df)).collect()
    assert [(r.nombre, r.estimated_pct) for r in worst] == [("A", 75.0), ("B", 0.0)]
    assert tuple(quality.dataset_summary(df).first()) == (2, 3)


def test_repeated_days_prefer_values(spark):
    df = spark.createDataFrame([_record(D(2024, 1, 1), None, None), _record(D(2024, 1, 1), 9.0, 1.0)], RECORD)
    (row,) = clean_panel(df, start="2024-01-01", end="2024-01-01", min_coverage=None).collect()
    assert (row.tmed, row.tmed_est, row.prec) == (9.0, 0, 1.0)


def test_hot_series_is_averaged_before_the_series_shuffle(spark):
    events = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).cast("string").alias("indicativo"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 7).cast("int")).alias("fecha"),
        (F.col("id") % 11).cast("double").alias("x"))
    daily = panel.daily_mean(events, {"v": F.col("x")})
    out = panel.densify(daily, "2024-01-01", "2024-01-10")
    assert out.count() == 40 * 10
    pdf = events.toPandas().groupby(["indicativo", "fecha"])["x"].mean()
    for r in out.filter("v is not null").collect():
        assert r.v == pytest.approx(pdf[r.indicativo, r.fecha])
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan
