import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from nimbusgrid import constants as k
from nimbusgrid.operators import features, metrics
from nimbusgrid.operators.labels import label_series
from nimbusgrid.plans import boosting, forecast, training

D = dt.date
TARGETS = ("tmed", "hrMedia", "rain")
VAL, TEST, END = "2021-01-01", "2021-07-01", D(2021, 8, 31)


@pytest.fixture(scope="module")
def panel(spark):
    """Two years of a seasonal signal with memory for six series."""
    rng = np.random.default_rng(11)
    start = D(2019, 9, 1)
    n = (END - start).days + 1
    frames = []
    for i in range(6):
        season = np.sin(2 * np.pi * np.arange(n) / 365)
        noise = np.zeros(n)
        for t in range(1, n):
            noise[t] = 0.7 * noise[t - 1] + rng.normal()
        tmed = 15 + 8 * season + 2 * noise + i
        hr = np.clip(65 - 6 * noise + rng.normal(0, 2, n), 0, 100)
        prec = np.where(hr + rng.normal(0, 4, n) > 68, 5.0, 0.0)
        frames.append(pd.DataFrame({
            "indicativo": f"S{i}", "fecha": [start + dt.timedelta(d) for d in range(n)], "nombre": f"N{i}",
            "provincia": "P", "altitud": str(100 * i), "tmed": tmed, "tmin": tmed - 4, "tmax": tmed + 5,
            "hrMedia": hr, "velmedia": rng.gamma(2, 1, n), "racha": rng.gamma(4, 2, n),
            "presion": 1013 - noise, "nubes": np.clip(hr - 10, 0, 100), "sol": np.clip(12 - hr / 10, 0, 24),
            "prec": prec, "dir": rng.integers(0, 36, n) * 10.0, "tmed_est": 0, "prec_est": 0}))
    df = spark.createDataFrame(pd.concat(frames))
    return training.with_ids(df, label_series(df)).cache()


@pytest.fixture(scope="module")
def trained(panel, tmp_path_factory):
    models, frame = training.train(panel, TARGETS, val_start=VAL, test_start=TEST, max_iter=8, parallel=3)
    folder = str(tmp_path_factory.mktemp("models"))
    training.save_models(models, folder)
    return models, frame, folder


def test_training_frame(panel, trained):
    _, frame, _ = trained
    # 13 warm-up days per series are lost to the longest window
    assert frame.count() == panel.count() - 6 * 13
    last = frame.filter(F.col("fecha") == F.lit(END)).first()
    assert last.label_tmed is None and last.label_rain == 0.0
    ends = frame.groupBy("split").agg(F.sum(F.col("label_tmed").isNull().cast("int")).alias("n"))
    assert {r.split: r.n for r in ends.collect()} == {"train": 6, "val": 6, "test": 6}


def test_feature_lists(panel, trained):
    models, _, _ = trained
    names = training.model_features(models["tmed"])
    assert "station_id" in names and "altitud" in names and "tmed_trend" in names
    assert not {"fecha", "indicativo", "nombre", "provincia", "label_tmed", "split"} & set(names)
    assert "presion_diff" not in names and "presion_diff" in training.model_features(models["rain"])
    assert "wind_sin_lag_7" in training.model_features(models["hrMedia"])


def test_models_beat_simple_baselines(trained):
    models, frame, _ = trained
    scored = training.score_all(frame.filter("split = 'test'"), models).cache()
    got = metrics.regression_metrics(scored, {"model": ("label_tmed", "pred_tmed"), "season": ("label_tmed", "tmed_roll_14")})
    r = {x.target: x for x in got.collect()}
    assert r["model"].mae < r["season"].mae and r["model"].r2 > 0.3
    assert metrics.roc_auc(scored, "label_rain", "prob_rain").first().roc_auc > 0.6


def test_evaluate(trained):
    models, frame, _ = trained
    rows = {r.target: r for r in training.evaluate(frame, models).collect()}
    assert set(rows) == set(models)
    assert 0.5 < rows["rain"].auc_test <= 1 and rows["rain"].status in ("good fit", "overfitting", "underfitting")
    assert rows["tmed"].mae_train > 0 and rows["tmed"].auc_test is None


def test_judged_waits_for_patience():
    """The score rises once and then falls: the later blocks are kept."""
    def after(values, larger=False, most=1500):
        return boosting.judged([(25 * (i + 1), v) for i, v in enumerate(values)], larger_is_better=larger, patience=50, most=most)

    assert after([5.0]) == (1, None)
    assert after([5.0, 5.2]) == (1, None)
    assert after([5.0, 5.2, 4.8]) == (3, None)
    assert after([5.0, 5.2, 4.8, 4.9, 4.8]) == (3, "patience")  # a tie is no gain
    assert after([5.0, 5.2, 5.1]) == (1, "patience")
    assert after([0.6, 0.5, 0.7], larger=True) == (3, None)
    assert after([5.0, 4.9], most=50) == (2, "rounds")
    nan = float("nan")
    assert after([nan, nan])[1] is None
    assert after([nan, 4.0]) == (2, None)


def rows_of(trained, target="tmed"):
    models, frame, _ = trained
    names = training.model_features(models[target])
    data = models[target].stages[0].transform(frame.filter(f"split in ('train', 'val') and label_{target} is not null"))
    return names, data.select("features", F.col(f"label_{target}").alias("label"), (F.col("split") == "val").alias("is_validation")).repartition(2).cache()


def test_blocks_after_a_rise_are_kept_and_stored(spark, trained, tmp_path, monkeypatch):
    names, rows = rows_of(trained)
    scores = iter([5.0, 5.5, 4.0, 4.5, 4.6])
    monkeypatch.setattr(boosting, "validation_score", lambda *_: next(scores))
    model = boosting.boost(rows, "tmed", names, k.BOOSTING["tmed"], str(tmp_path), block=2, patience=4, max_iter=100)
    assert len(model.stages) - 1 == 3
    stored = boosting.read_scores(spark, str(tmp_path)).orderBy("block").collect()
    assert [(r.block, r.rounds, r.score) for r in stored] == [(0, 2, 5.0), (1, 4, 5.5), (2, 6, 4.0), (3, 8, 4.5), (4, 10, 4.6)]


def test_fit_resumes_with_the_next_block(spark, trained, tmp_path, monkeypatch):
    names, rows = rows_of(trained)
    options = {"block": 3, "max_iter": 9}
    whole = boosting.boost(rows, "tmed", names, k.BOOSTING["tmed"], str(tmp_path / "whole"), **options)
    real, calls = boosting.validation_score, []

    def lost_after_one(found, target):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("driver lost")
        return real(found, target)

    monkeypatch.setattr(boosting, "validation_score", lost_after_one)
    with pytest.raises(RuntimeError):
        boosting.boost(rows, "tmed", names, k.BOOSTING["tmed"], str(tmp_path / "cut"), **options)
    assert boosting.read_scores(spark, str(tmp_path / "cut")).count() == 1
    again = boosting.boost(rows, "tmed", names, k.BOOSTING["tmed"], str(tmp_path / "cut"), **options)
    assert len(calls) == 4  # blocks 2 and 3; the first was read
    assert len(again.stages) == len(whole.stages)
    row = rows.limit(20)
    one, two = (boosting._with_margin(row, m.stages[1:]).agg(F.sum("_sum")).first()[0] for m in (whole, again))
    assert one == pytest.approx(two, abs=1e-9)


def test_blocks_lower_the_training_error(trained, tmp_path):
    for target in ("tmed", "rain"):
        names, rows = rows_of(trained, target)
        model = boosting.boost(rows, target, names, k.BOOSTING[target], str(tmp_path / target), block=4, patience=100, max_iter=12)
        blocks, train, errors = model.stages[1:], rows.filter("not is_validation"), []
        for n in range(1, len(blocks) + 1):
            scored = boosting._with_margin(train, blocks[:n])
            loss = F.log1p(F.exp((1 - 2 * F.col("label")) * F.col("_sum"))) if target == "rain" else (F.col("label") - F.col("_sum")) ** 2
            errors.append(scored.agg(F.avg(loss)).first()[0])
        assert errors == sorted(errors, reverse=True)


def test_fit_without_validation_rows(spark, trained, tmp_path):
    names, rows = rows_of(trained)
    model = boosting.boost(rows.filter("not is_validation"), "tmed", names, k.BOOSTING["tmed"], str(tmp_path), block=2, max_iter=4)
    assert len(model.stages) >= 2


def test_importances_from_stored_trees(spark, trained):
    models, _, folder = trained
    nodes = boosting.stored_nodes(spark, f"{folder}/tmed")
    got = boosting.importances(nodes, training.model_features(models["tmed"]))
    assert got.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    trees = nodes.select("block", "tree").distinct().count()
    assert trees == sum(len(b.treeWeights) for b in models["tmed"].stages[1:])


def test_saved_models_load(spark, trained):
    models, frame, folder = trained
    loaded = training.load_models(spark, folder)
    assert set(loaded) == set(TARGETS)  # targets without a model are left out
    row = frame.limit(1)
    assert training.score(row, "tmed", loaded["tmed"]).first().pred_tmed == \
        training.score(row, "tmed", models["tmed"]).first().pred_tmed
    top = training.feature_importance(spark, folder, "tmed", loaded["tmed"], 5).collect()
    assert len(top) == 5 and top[0].importance >= top[4].importance


def test_final_forecast(trained):
    models, frame, _ = trained
    out = training.final_forecast(frame, models)
    assert out.count() == frame.filter("split = 'test'").count()
    assert {"prob_rain", "is_raining", "pred_tmed", "pred_hrMedia", "station_id"} <= set(out.columns)
    bad = out.filter("pred_hrMedia < 0 or pred_hrMedia > 100 or prob_rain < 0 or prob_rain > 1")
    assert bad.count() == 0


def test_onestep_forecast(panel, trained):
    models, frame, _ = trained
    out = forecast.onestep_forecast(panel, models, 2021).cache()
    assert out.agg(F.min("fecha")).first()[0] == D(2021, 1, 2)  # the first day has no issue day in the year
    issued = training.score(frame, "tmed", models["tmed"]).select("indicativo", "fecha", "pred_tmed")
    shifted = issued.select("indicativo", F.date_add("fecha", 1).alias("fecha"), F.col("pred_tmed").alias("p"))
    both = out.join(shifted, ["indicativo", "fecha"])
    assert both.count() == out.count()
    assert both.filter(F.abs(F.col("pred_tmed") - F.col("p")) > 1e-9).count() == 0
    assert out.filter("pred_is_raining not in (0.0, 1.0)").count() == 0


def test_onestep_needs_one_shuffle(panel, trained):
    models, _, _ = trained
    plan = forecast.onestep_forecast(panel, models, 2021)._jdf.queryExecution().executedPlan().toString()
    body = plan.split("InMemoryRelation")[0]
    assert body.count("Exchange hashpartitioning") == 1


def test_rollout_first_step_equals_onestep(panel, trained):
    models, _, _ = trained
    out = forecast.recursive_forecast(panel, models, TEST, 40).cache()
    assert out.count() == 6 * 40
    onestep = forecast.onestep_forecast(panel, models, 2021).filter(F.col("fecha") == F.lit(TEST).cast("date"))
    pairs = out.filter(F.col("fecha") == F.lit(TEST).cast("date")).join(
        onestep.withColumnsRenamed({"pred_tmed": "t1", "pred_hrMedia": "h1"}), ["indicativo", "fecha"]).collect()
    assert len(pairs) == 6
    for r in pairs:
        assert r.pred_tmed == pytest.approx(r.t1, abs=1e-9)
        assert r.pred_hrMedia == pytest.approx(r.h1, abs=1e-9)
        assert r.prob_rain == pytest.approx(r.pred_prob_rain, abs=1e-9)


def test_rollout_feeds_back(spark, panel, trained):
    """Second step: append the first prediction as a row, rebuild the features with Spark, score."""
    models, _, _ = trained
    out = forecast.recursive_forecast(panel, models, TEST, 2)
    day1, day2 = (out.filter(F.col("fecha") == F.lit(d).cast("date")) for d in (TEST, "2021-07-02"))
    history = panel.filter(F.col("fecha") < F.lit(TEST).cast("date"))
    # Targets without a model stay missing in the rollout; only fed-back and carried columns are set.
    last = history.filter(F.col("fecha") == F.lit("2021-06-30").cast("date"))
    step = day1.select("indicativo", "fecha", "tmed", "hrMedia", "prec")
    carried = last.select("indicativo", "nombre", "provincia", "altitud", "station_id", "racha", "presion", "nubes",
                          "dir", F.lit(1).cast("bigint").alias("tmed_est"), F.lit(1).cast("bigint").alias("prec_est"))
    grown = history.unionByName(step.join(carried, "indicativo"), allowMissingColumns=True)
    rows = features.build_features(grown).filter(F.col("fecha") == F.lit(TEST).cast("date"))
    names = training.model_features(models["tmed"])
    nan = rows.select("indicativo", "fecha", *[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in names])
    from pyspark.ml import PipelineModel
    keep = models["tmed"].stages[0].copy().setHandleInvalid("keep")
    again = training.score(nan, "tmed", PipelineModel([keep, models["tmed"].stages[1]]))
    want = {r.indicativo: r.pred_tmed for r in again.collect()}
    for r in day2.collect():
        assert r.pred_tmed == pytest.approx(want[r.indicativo], abs=1e-9)
    first = day1.first()
    assert first.prec in (0.0, 10.0) and first.prec == (10.0 if first.prob_rain > 0.5 else 0.0)


def test_rollout_with_short_history(panel, trained):
    models, _, _ = trained
    short = panel.filter((F.col("indicativo") != "S0") | (F.col("fecha") >= F.lit("2021-06-28").cast("date")))
    out = forecast.recursive_forecast(short, models, TEST, 3)
    assert out.filter("indicativo = 'S0' and pred_tmed is not null").count() == 3


def test_constants_are_consistent():
    assert set(training.SPECS) == set(k.BOOSTING) == set(k.TARGETS)
    assert boosting.rounds_allowed(k.BOOSTING["tmax"]) == 3000 and boosting.rounds_allowed(k.BOOSTING["tmed"]) == 1500
    depth = {t: boosting.block_booster(k.BOOSTING[t], rounds=5).getMaxDepth() for t in ("tmax", "rain")}
    assert depth == {"tmax": 6, "rain": 4}


def test_publishing_goes_on_where_it_ended(spark, panel, tmp_path):
    folder = str(tmp_path / "published")
    options = {"val_start": VAL, "test_start": TEST, "year": 2021, "horizon": 5, "parallel": 3, "max_iter": 3}
    forecast.publish(panel, folder, steps=["features"], **options)
    assert not (tmp_path / "published" / "models").exists()
    forecast.publish(panel, folder, steps=["recursive"], **options)  # models are made for it
    assert spark.read.parquet(f"{folder}/recursive").count() == 6 * 5
    assert not (tmp_path / "published" / "onestep").exists()
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "published" / "recursive").iterdir()}
    forecast.publish(panel, folder, **options)
    assert before == {p: p.stat().st_mtime_ns for p in (tmp_path / "published" / "recursive").iterdir()}
    assert spark.read.parquet(f"{folder}/onestep").count() > 0 and spark.read.parquet(f"{folder}/final").count() > 0


def test_a_fit_reads_its_rows_in_their_partitions(spark, trained, monkeypatch):
    """Splits of a file beyond these hold no row, yet every round ran a task for each."""
    models, frame, _ = trained
    seen = []
    monkeypatch.setattr(boosting, "boost", lambda rows, *_, **__: seen.append(rows))
    monkeypatch.setattr(training, "stage", lambda df, label: df.repartition(9))
    for partitions in (None, 2):
        training.fit_target(frame, "tmed", training.model_features(models["tmed"]), partitions=partitions)
    assert [rows.rdd.getNumPartitions() for rows in seen] == [1, 2]
