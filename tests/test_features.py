import datetime as dt

import numpy as np
import pandas as pd

from nimbusgrid.operators import features, labels

D = dt.date


def panel_frame(spark, n=60, series=("b", "a", "c"), start=D(2023, 12, 1), gaps=False):
    rng = np.random.default_rng(3)
    cols = ["tmed", "tmin", "tmax", "hrMedia", "presion", "nubes", "velmedia", "sol", "prec", "dir", "racha"]
    rows = []
    for s in series:
        for i in range(n):
            v = [float(x) for x in rng.normal(10, 4, len(cols)).round(2)]
            if gaps and i % 9 == 4:
                v[0] = None
            rows.append((s, start + dt.timedelta(i), *v))
    return spark.createDataFrame(rows, "indicativo string, fecha date, " + ", ".join(f"{c} double" for c in cols))


def test_lag_and_rolling_match_pandas(spark):
    df = panel_frame(spark, gaps=True)
    out = features.add_rolling(features.add_lags(df, ["tmed", "absent"], (1, 2)), ["tmed"], (3, 7))
    got = out.toPandas().sort_values(["indicativo", "fecha"])
    grouped = got.groupby("indicativo")["tmed"]
    for k in (1, 2):
        np.testing.assert_allclose(got[f"tmed_lag_{k}"], grouped.shift(k))
    for w in (3, 7):
        want = grouped.transform(lambda s, w=w: s.rolling(w).mean())
        np.testing.assert_allclose(got[f"tmed_roll_{w}"], want)
    assert "absent_lag_1" not in got.columns


def test_targets_by_split(spark):
    df = features.add_split(panel_frame(spark), "2023-12-20", "2024-01-10")
    out = df.select("indicativo", "fecha", "split", "tmed", "prec",
                    features.next_day_target("tmed").alias("y"),
                    features.next_day_rain().alias("wet")).toPandas()
    for _, part in out.groupby(["indicativo", "split"]):
        part = part.sort_values("fecha")
        np.testing.assert_allclose(part["y"], part["tmed"].shift(-1))
    for _, part in out.groupby("indicativo"):
        part = part.sort_values("fecha")
        assert list(part["wet"]) == list((part["prec"].shift(-1) > 0.1).astype(float))


def test_padded_date_filter_equals_full_history(spark):
    df = panel_frame(spark)
    full = features.build_features(df).filter("fecha >= '2024-01-10' and fecha <= '2024-01-20'")
    cut = features.build_features(df, from_date="2024-01-10", to_date="2024-01-20")
    key = ["indicativo", "fecha"]
    a, b = (x.toPandas().sort_values(key).reset_index(drop=True) for x in (full, cut))
    pd.testing.assert_frame_equal(a, b)
    assert not a.isna().any().any()


def test_feature_set_sizes(spark):
    df = panel_frame(spark)
    for spec in (features.RAIN, features.TEMPERATURE, features.ATMOSPHERE):
        made = set(features.build_features(df.limit(0), spec).columns) - set(df.columns)
        without_min_pressure = [c for c in spec.derived() if not c.startswith("presMin")]
        assert made == set(without_min_pressure)
    # 4 cyclic + (9 measures + 2 derived) * 3 lags + 3 rolls + 2 derived
    assert len([c for c in features.RAIN.derived() if not c.startswith("presMin")]) == 42


def test_features_need_one_shuffle(spark):
    plan = features.build_features(panel_frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_valid_time_last_row_and_history(spark):
    df = panel_frame(spark, n=5)
    moved = features.to_valid_time(df, ["tmed"]).toPandas().sort_values(["indicativo", "fecha"])
    want = df.toPandas().sort_values(["indicativo", "fecha"]).groupby("indicativo")["tmed"].shift(1)
    np.testing.assert_allclose(moved["tmed"], want)
    assert {r.fecha for r in features.last_row(df).collect()} == {D(2023, 12, 5)}
    assert features.trailing_history(df, 2).count() == 9


def test_missing_features_become_zero(spark):
    df = panel_frame(spark, n=1).select(*features.project_features(panel_frame(spark, n=1), ["tmed", "nope"]))
    assert df.columns == ["tmed", "nope"] and df.first().nope == 0.0


def test_labels_are_dense_and_alphabetical(spark):
    keys = [f"k{i:05d}" for i in range(3000)] + ["Ñ", "a b", ""]
    df = spark.createDataFrame([(k,) for k in keys[::-1] * 2], "indicativo string").repartition(7)
    got = {r.indicativo: r.station_id for r in labels.label_series(df).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_unique_columns_keep_order():
    assert features.unique_columns(["b", "a"], ["a", "c"]) == ["b", "a", "c"]
