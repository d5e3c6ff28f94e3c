import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from nimbusgrid.operators import metrics, ranking

D = dt.date


def scored(spark, n=700, seed=1, ties=True, hot=False):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    s = np.clip(rng.normal(0.4 + 0.1 * y, 0.2), 0, 1)
    if ties:
        s = s.round(2)
    if hot:
        s[: n // 3] = 0.5
    rows = [(int(a), float(b)) for a, b in zip(y, s)]
    return spark.createDataFrame(rows, "y int, p double").repartition(5), y, s


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


@pytest.mark.parametrize("ties,hot", [(True, False), (False, False), (True, True)])
def test_roc_auc(spark, ties, hot):
    df, y, s = scored(spark, ties=ties, hot=hot)
    assert metrics.roc_auc(df, "y", "p", partitions=8).first().roc_auc == pytest.approx(brute_auc(y, s), abs=1e-12)


def test_roc_auc_by_group_and_single_class(spark):
    df, y, s = scored(spark)
    both = df.withColumn("g", F.lit("a")).union(df.withColumn("g", F.lit("b")).filter("y = 1"))
    got = {r.g: r.roc_auc for r in metrics.roc_auc(both, "y", "p", by=["g"], partitions=4).collect()}
    assert got["a"] == pytest.approx(brute_auc(y, s)) and got["b"] is None


def brute_curve(y, s):
    cuts = np.unique(s)[::-1]
    pts = [(c, (s[y == 0] >= c).mean(), (s[y == 1] >= c).mean()) for c in cuts]
    counts = [((s == c) & (y == 1)).sum() for c in cuts], [((s == c) & (y == 0)).sum() for c in cuts]
    keep = [i for i in range(len(cuts)) if i in (0, len(cuts) - 1)
            or any(c[i] != c[i + 1] for c in counts)]
    return pts, [pts[i] for i in keep]


@pytest.mark.parametrize("partitions", [2, 16])
def test_roc_curve(spark, partitions):
    df, y, s = scored(spark, n=300)
    every, kept = brute_curve(y, s)
    for drop, want in ((False, every), (True, kept)):
        rows = metrics.roc_curve(df, "y", "p", drop_collinear=drop, partitions=partitions).collect()
        got = sorted(map(tuple, rows), reverse=True)
        assert got[0] == (math.inf, 0.0, 0.0)
        np.testing.assert_allclose(np.array(got[1:]), np.array(want))


@pytest.mark.parametrize("n", [1, 2, 7, 500])
def test_exact_quantiles(spark, n):
    rng = np.random.default_rng(n)
    v = rng.normal(0, 1, n).round(1)
    v[: n // 3] = 0.3
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,)], "v double").repartition(3)
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = ranking.exact_quantiles(df, "v", probs, partitions=8).first()
    for name, p in probs.items():
        assert got[name] == pytest.approx(np.quantile(v, p), abs=1e-12)


def test_running_totals(spark):
    rows = [("a", float(i), i % 5 + 1) for i in range(50)] + [("b", 1.0, 9)]
    df = spark.createDataFrame(rows, "g string, v double, n long")
    got = ranking.running_totals(df, "v", ["n"], by=["g"], descending=True, following=True, partitions=4)
    by_value = {(r.g, r.v): r for r in got.collect()}
    assert len(by_value) == 51
    before = 0
    for i in reversed(range(50)):
        r = by_value["a", float(i)]
        assert r.n_before == before and r.n_all == 150
        assert r.n_next == ((i - 1) % 5 + 1 if i else None)
        before += r.n
    assert tuple(by_value["b", 1.0])[3:] == (0, 9, None)


def test_regression_metrics(spark):
    rng = np.random.default_rng(5)
    y, p = rng.normal(0, 2, 200), rng.normal(0, 2, 200)
    rows = [(float(a), float(b)) for a, b in zip(y, p)]
    df = spark.createDataFrame(rows + [(None, 1.0), (1.0, None)], "real_t double, pred_t double")
    pairs = {"t": ("real_t", "pred_t"), "absent": ("real_x", "pred_x")}
    (got,) = metrics.regression_metrics(df, pairs).collect()
    assert got.mae == pytest.approx(np.abs(y - p).mean())
    assert got.rmse == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert got.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    with pytest.raises(ValueError):
        metrics.regression_metrics(df, {"absent": ("real_x", "pred_x")})


def test_degradation_table(spark):
    rows = [(1.0, 1.0, 2.0), (2.0, 4.0, 5.0), (3.0, 3.5, 9.0)]
    df = spark.createDataFrame(rows, "real_a double, a_onestep double, a_recursive double").withColumns(
        {"real_b": F.col("real_a"), "b_onestep": F.col("real_a"), "b_recursive": F.col("a_recursive")})
    got = {r.target: r for r in metrics.degradation_table(df, ["a", "b", "missing"]).collect()}
    assert set(got) == {"a", "b"}
    assert got["a"].mae_onestep == pytest.approx(2.5 / 3) and got["a"].medae_onestep == 0.5
    assert got["a"].degradation_pct == pytest.approx((10 / 3 - 2.5 / 3) / (2.5 / 3) * 100)
    assert got["b"].degradation_pct == 0.0


def test_classification_metrics(spark):
    rows = [(1, 1)] * 30 + [(1, 0)] * 10 + [(0, 1)] * 5 + [(0, 0)] * 55
    r = metrics.classification_metrics(spark.createDataFrame(rows, "y int, p int"), "y", "p").first()
    assert (r.tn, r.fp, r.fn, r.tp) == (55, 5, 10, 30) and r.tp_pct == 30.0
    assert (r.accuracy, r.precision, r.recall) == (0.85, pytest.approx(30 / 35), 0.75)
    assert r.f1 == pytest.approx(60 / 75)
    assert r.mcc == pytest.approx((30 * 55 - 5 * 10) / math.sqrt(35 * 40 * 60 * 65)) and not r.conservative
    none = metrics.classification_metrics(spark.createDataFrame([(1, 0)], "y int, p int"), "y", "p").first()
    assert (none.precision, none.recall, none.f1, none.mcc) == (0.0, 0.0, 0.0, 0.0)


def test_histogram_and_box(spark):
    df = spark.createDataFrame([(0.1, 0.0), (0.15, None), (0.9, 5.0), (0.5, 0.2), (None, 1.0)],
                               "p double, mm double")
    bins = {(r.condition, r.bin): r.n for r in metrics.probability_histogram(df, "p", "mm", 0.1).collect()}
    assert bins == {("Dry Day", 1): 2, ("Rainy Day", 9): 1, ("Rainy Day", 5): 1}
    box = {r.condition: r for r in metrics.probability_box(df, "p", "mm").collect()}
    assert box["Rainy Day"].median == pytest.approx(0.7) and box["Dry Day"].q1 == pytest.approx(0.1125)


@pytest.mark.parametrize("binary,values,status", [
    (True, (0.9, 0.7, 0.0), "overfitting"), (True, (0.6, 0.55, 0.0), "underfitting"),
    (True, (0.8, 0.7, 0.0), "good fit"), (False, (1.0, 1.5, 0.9), "overfitting"),
    (False, (1.0, 1.3, 0.3), "underfitting"), (False, (1.0, 1.4, 0.35), "good fit"),
])
def test_fit_status(spark, binary, values, status):
    names = ("auc_train", "auc_test", "_") if binary else ("mae_train", "mae_test", "r2_train")
    df = spark.createDataFrame([values], ", ".join(f"{n} double" for n in names))
    assert metrics.fit_status(df, binary).first().status == status


def test_correlation_pairwise_complete(spark):
    import pandas as pd

    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(size=(80, 3)), columns=list("abc"))
    pdf.loc[::7, "b"] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(x) else float(x) for x in r) for r in pdf.to_numpy()],
                               "a double, b double, c double")
    want = pdf.corr()
    for r in metrics.correlation_matrix(df, ["a", "b", "c", "absent"]).collect():
        assert r.correlation == pytest.approx(want.loc[r.row_name, r.col_name])


def test_sample_is_repeatable(spark):
    df = spark.range(5000).withColumn("v", F.col("id") * 2)
    a = metrics.sample_rows(df, ["id"], 100).collect()
    b = metrics.sample_rows(df.repartition(7), ["id"], 100).collect()
    assert sorted(a) == sorted(b) and len(a) == 100
    assert metrics.sample_rows(df.limit(10), ["id"], 100).count() == 10


def test_comparative_and_seasonal_frames(spark):
    onestep = spark.createDataFrame([(D(2025, 4, 1), "x", 1.0, 2.0, 0.3, 1.0, 0.0), (D(2025, 4, 2), "x", 1.0, 2.0, 0.3, 1.0, 3.0)],
        "fecha date, indicativo string, real_tmed double, pred_tmed double, pred_prob_rain double, pred_is_raining double, real_prec double")
    recursive = spark.createDataFrame([(D(2025, 4, 2), "x", 5.0, 5.0, 0.2)],
        "fecha date, indicativo string, tmed double, pred_tmed double, prob_rain double")
    out = metrics.comparative_frame(onestep, recursive)
    (row,) = out.collect()
    assert (row.tmed_onestep, row.tmed_recursive, row.real_tmed) == (2.0, 5.0, 1.0)
    assert (row.rain_onestep, row.rain_recursive, row.rain_class_recursive) == (0.3, 0.2, 0)
    season = metrics.seasonal_frame(out, "tmed", "x").collect()
    assert {(r.kind, r.value, r.season) for r in season} == {
        ("real", 1.0, "Spring (Apr-Jun)"), ("onestep", 2.0, "Spring (Apr-Jun)"), ("recursive", 5.0, "Spring (Apr-Jun)")}
    assert {(r.kind, r.value) for r in metrics.seasonal_frame(out, "rain").collect()} == {
        ("real", 1.0), ("onestep", 0.3), ("recursive", 0.2)}
