"""Learning and forecasting queries.

The publishing plan writes features, models and forecasts of a data folder; the queries read its
tables, as readers of a forecast do, and the first to read a table has it made.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid import constants as k
from nimbusgrid.functions.indices import apparent_temperature, rainbow_score
from nimbusgrid.operators import joins, metrics, serving
from nimbusgrid.operators.labels import label_series
from nimbusgrid.plans import boosting, forecast, training
from nimbusgrid.session import stage, staging_path
from nimbusgrid.sources import storage
from nimbusgrid.workload import frames as fr
from nimbusgrid.workload.frames import s6
from nimbusgrid.workload.panels import CLEAN_SQL, station_panel
from nimbusgrid.workload.registry import query

VAL, TEST, YEAR = "2000-01-01", "2001-01-01", 2001
#: Days from the start of the test span to the end of the panel.
HORIZON = 212
_FOLDERS: dict[tuple[str, str], str] = {}


def _folder(spark: SparkSession, sf: str) -> str:
    """The folder an application publishes a data folder's panel, models and forecasts in."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FOLDERS:
        _FOLDERS[key] = staging_path(spark, "published")
    return _FOLDERS[key]


def published(spark: SparkSession, sf: str, *steps: str) -> str:
    """That folder, with the named steps (or all) in it: each is made when it is first read."""
    folder = _folder(spark, sf)
    if not storage.path_exists(spark, f"{folder}/panel/_SUCCESS"):
        panel = stage(station_panel(spark, sf), "panel")  # labels and rows read the same panel: it is computed once
        training.with_ids(panel, label_series(panel)).write.mode("overwrite").parquet(f"{folder}/panel")
    forecast.publish(spark.read.parquet(f"{folder}/panel"), folder, val_start=VAL, test_start=TEST, year=YEAR,
                     horizon=HORIZON, parallel=7, steps=[s for s in steps if s != "panel"] if steps else None)
    return folder


def _stored(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{published(spark, sf, name)}/{name}")


def _models(spark: SparkSession, sf: str):
    return training.load_models(spark, f"{published(spark, sf, 'models')}/models")


@query()
def fitted_models(spark: SparkSession, sf: str) -> DataFrame:
    """Scores and fit status of each model on train and test rows."""
    return training.evaluate(_stored(spark, sf, "features"), _models(spark, sf))


@query()
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    models = _models(spark, sf)
    return reduce(DataFrame.unionByName, [
        training.feature_importance(spark, f"{_folder(spark, sf)}/models", t, m) for t, m in models.items()])


@query()
def final_forecast(spark: SparkSession, sf: str) -> DataFrame:
    return _stored(spark, sf, "final")


@query()
def onestep_forecast(spark: SparkSession, sf: str) -> DataFrame:
    return _stored(spark, sf, "onestep")


@query()
def recursive_forecast(spark: SparkSession, sf: str) -> DataFrame:
    return joins.with_actuals(_stored(spark, sf, "recursive"), _stored(spark, sf, "panel"),
                              ["tmed", "tmin", "tmax"])


@query()
def forecast_report(spark: SparkSession, sf: str) -> DataFrame:
    """One-step against recursive errors per target."""
    compared = metrics.comparative_frame(_stored(spark, sf, "onestep"),
                                         _stored(spark, sf, "recursive"))
    compared, targets = stage(compared, "compared"), [t for t in k.TARGETS if t != "rain"]
    return metrics.degradation_table(compared, targets, partitions=boosting.tasks_for(len(targets) * compared.count()))


@query()
def rollout_drift(spark: SparkSession, sf: str) -> DataFrame:
    """How the recursive error grows month by month."""
    return metrics.monthly_mae(recursive_forecast(spark, sf), "tmed_real", "tmed")


_PLAIN = ("tmed", "tmin", "tmax", "sol", "hrMedia", "velmedia")


@query(f"""WITH {CLEAN_SQL},
long AS (SELECT * FROM (SELECT fecha, unnest([{", ".join(f"{{'target': '{t}', 'value': {q}}}" for t, q in zip(
    _PLAIN, ("tmed", "tmin", "tmax", "sol", '"hrMedia"', "velmedia")))}], recursive := true) FROM clean)),
means AS (SELECT target, avg(value) AS mean FROM long WHERE fecha < DATE '{TEST}' GROUP BY 1)
SELECT target, {s6("avg(abs(value - mean))")} AS mean_mae, true AS beats_mean
FROM long JOIN means USING (target) WHERE fecha >= DATE '{TEST}' GROUP BY 1""")
def beats_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Test error of the training span's mean as a constant forecast, and whether each model beats it."""
    c = F.col
    long = station_panel(spark, sf).select("fecha", F.inline(F.array(*[
        F.struct(F.lit(t).alias("target"), c(t).alias("value")) for t in _PLAIN])))
    means = long.filter(c("fecha") < F.lit(TEST).cast("date")).groupBy("target").agg(F.avg("value").alias("mean"))
    constant = (long.filter(c("fecha") >= F.lit(TEST).cast("date")).join(means, "target")
                .groupBy("target").agg(F.avg(F.abs(c("value") - c("mean"))).alias("mean_mae")))
    return constant.join(fitted_models(spark, sf).select("target", "mae_test"), "target").select(
        "target", fr.r6("mean_mae"), (c("mae_test") < c("mean_mae")).alias("beats_mean"))


@query(f"""WITH {CLEAN_SQL}
SELECT indicativo, fecha FROM clean WHERE fecha BETWEEN DATE '{TEST}' AND DATE '{fr.ORDER_END}'""")
def rollout_days(spark: SparkSession, sf: str) -> DataFrame:
    """The rollout covers every station and every day of the test span."""
    return _stored(spark, sf, "recursive").select("indicativo", "fecha")


@query(f"""WITH {CLEAN_SQL}
SELECT indicativo, fecha, {", ".join(f"{s6(q)} AS real_{t}" for t, q in zip(
    ("tmed", "tmin", "tmax", "prec", "sol", "hrMedia", "velmedia"),
    ("tmed", "tmin", "tmax", "prec", "sol", '"hrMedia"', "velmedia")))}
FROM clean WHERE fecha BETWEEN DATE '{YEAR}-01-02' AND DATE '{YEAR}-12-31'""")
def onestep_days(spark: SparkSession, sf: str) -> DataFrame:
    """Valid days of the one-step forecast beside the values observed on them."""
    rows = _stored(spark, sf, "onestep")
    return rows.select("indicativo", "fecha", *[fr.r6(f"real_{t}") for t in forecast.REAL_COLS])


_WARM = 13


@query(f"""WITH {CLEAN_SQL},
placed AS (SELECT *, row_number() OVER s AS rn, CASE WHEN fecha < DATE '{VAL}' THEN 'train'
    WHEN fecha < DATE '{TEST}' THEN 'val' ELSE 'test' END AS split FROM clean
  WINDOW s AS (PARTITION BY indicativo ORDER BY fecha))
SELECT indicativo, fecha, split,
  {s6("lead(tmed) OVER p")} AS label_tmed, {s6("lead(sol) OVER p")} AS label_sol,
  CASE WHEN lead(prec) OVER s > 0.1::DOUBLE THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label_rain
FROM placed WHERE rn > {_WARM} WINDOW p AS (PARTITION BY indicativo, split ORDER BY fecha),
  s AS (PARTITION BY indicativo ORDER BY fecha)""")
def training_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Complete feature rows with their split and next-day labels."""
    return _stored(spark, sf, "features").select(
        "indicativo", "fecha", "split", fr.r6("label_tmed"), fr.r6("label_sol"), "label_rain")


@query()
def stored_week(spark: SparkSession, sf: str) -> DataFrame:
    """A reader's next seven days of every station, from the published final forecast."""
    return serving.weekly_trend(_stored(spark, sf, "final"), TEST)


_LABELS = f"""placed AS (SELECT *, row_number() OVER s AS rn, dense_rank() OVER (ORDER BY indicativo) - 1 AS station_id,
    CASE WHEN fecha < DATE '{VAL}' THEN 'train' WHEN fecha < DATE '{TEST}' THEN 'val' ELSE 'test' END AS split FROM clean
  WINDOW s AS (PARTITION BY indicativo ORDER BY fecha)),
labelled AS (SELECT indicativo, fecha, station_id, split,
  {", ".join(f"lead({q}) OVER p AS l_{t}" for t, q in zip(_PLAIN, ("tmed", "tmin", "tmax", "sol", '"hrMedia"', "velmedia")))},
  CASE WHEN lead(prec) OVER s > 0.1::DOUBLE THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS l_rain
FROM placed WHERE rn > {_WARM} WINDOW p AS (PARTITION BY indicativo, split ORDER BY fecha),
  s AS (PARTITION BY indicativo ORDER BY fecha))"""


@query(f"""WITH {CLEAN_SQL}, {_LABELS},
long AS (SELECT split, unnest([{", ".join(f"{{'target': '{t}', 'value': l_{t}}}" for t in k.TARGETS)}], recursive := true) FROM labelled)
SELECT target, CASE WHEN target = 'rain' THEN 'auc' ELSE 'mae' END AS metric, count(value) AS val_rows,
  CASE WHEN target = 'rain' THEN 0.5::DOUBLE ELSE {s6("avg(abs(value))")} END AS start_score,
  true AS improved, {boosting.PATIENCE} AS waited, 'patience' AS stopped, true AS kept_best
FROM long WHERE split = 'val' GROUP BY 1, 2""")
def boosting_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """How each fit went, by the scores stored after its blocks: from the score without trees, whether
    the best block improves on it, how many rounds passed without a gain, why it stopped, and whether the
    model holds the blocks up to the best."""
    c, rain = F.col, F.col("target") == "rain"
    models = _models(spark, sf)
    held = spark.createDataFrame([(t, len(m.stages) - 1) for t, m in models.items()], "target string, held int")
    start = _stored(spark, sf, "features").filter("split = 'val'").select(F.inline(F.array(*[
        F.struct(F.lit(t).alias("target"), c(f"label_{t}").cast("double").alias("value")) for t in k.TARGETS])))
    start = start.groupBy("target").agg(F.count("value").alias("val_rows"), F.avg(F.abs("value")).alias("start_score")).withColumn(
        "start_score", F.when(rain, 0.5).otherwise(c("start_score")))
    loss = F.when(rain, -c("score")).otherwise(c("score"))
    scores = boosting.read_scores(spark, f"{_folder(spark, sf)}/boosting").groupBy("target").agg(
        F.first("metric").alias("metric"), F.min(F.struct(loss.alias("loss"), "block", "rounds")).alias("best"), F.max("rounds").alias("last"))
    most = F.when(c("target").isin(*[t for t in k.TARGETS if boosting.rounds_allowed(k.BOOSTING[t]) == 3000]), 3000).otherwise(1500)
    waited = c("last") - c("best.rounds")
    return scores.join(start, "target").join(held, "target").select(
        "target", "metric", "val_rows", fr.r6("start_score"),
        (c("best.loss") < F.when(rain, -c("start_score")).otherwise(c("start_score"))).alias("improved"), waited.alias("waited"),
        F.when(c("last") >= most, "rounds").when(waited >= boosting.PATIENCE, "patience").alias("stopped"),
        (c("held") == c("best.block") + 1).alias("kept_best"))


def _inside(bounds: dict, columns: Mapping[str, str]):
    """Whether every bounded prediction of a row lies within its bounds, or is missing."""
    checks = [F.coalesce(F.col(columns[t]).between(-math.inf if low is None else low, math.inf if high is None else high), F.lit(True))
              for t, (low, high) in bounds.items() if t in columns]
    return reduce(lambda a, b: a & b, checks, F.lit(True))


@query(f"""WITH {CLEAN_SQL}, {_LABELS}
SELECT indicativo, fecha, station_id, true AS in_bounds, true AS decided, true AS indexed FROM labelled WHERE split = 'test'""")
def final_checks(spark: SparkSession, sf: str) -> DataFrame:
    """The stored final forecast: its days and stations, and on each row bounds, rain decision and indices."""
    rows, c = _stored(spark, sf, "final"), F.col
    plain = {t: f"pred_{t}" for t in _PLAIN}
    indices = (rainbow_score(c("prob_rain"), c("pred_sol"), c("pred_hrMedia")) == c("rainbow_prob")) & (
        apparent_temperature(c("pred_tmed"), c("pred_hrMedia"), c("pred_velmedia")) == c("pred_windchill"))
    return rows.select("indicativo", "fecha", c("station_id").cast("long").alias("station_id"), _inside(k.TRAINING_BOUNDS, plain).alias("in_bounds"),
                       ((c("prob_rain") > k.RAIN_THRESHOLD).cast("double") == c("is_raining").cast("double")).alias("decided"), indices.alias("indexed"))


@query(f"""WITH {CLEAN_SQL}
SELECT indicativo, fecha, true AS in_bounds, true AS decided FROM clean
WHERE fecha BETWEEN DATE '{YEAR}-01-02' AND DATE '{YEAR}-12-31'""")
def onestep_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Bounds and rain decisions of the stored one-step forecast."""
    rows, c = _stored(spark, sf, "onestep"), F.col
    return rows.select("indicativo", "fecha", _inside(k.PREDICTION_BOUNDS, {t: f"pred_{t}" for t in _PLAIN}).alias("in_bounds"),
                       ((c("pred_prob_rain") > k.RAIN_THRESHOLD).cast("double") == c("pred_is_raining")).alias("decided"))


@query(f"""WITH {CLEAN_SQL}, {_LABELS},
ranked AS (SELECT indicativo, fecha, row_number() OVER (PARTITION BY indicativo ORDER BY fecha) AS rn FROM labelled WHERE fecha >= DATE '{TEST}')
SELECT indicativo, fecha FROM ranked WHERE rn <= 7""")
def week_checks(spark: SparkSession, sf: str) -> DataFrame:
    """The days that a reader of the stored final forecast is shown for each station."""
    return stored_week(spark, sf).select("indicativo", "fecha")


@query(f"""WITH {CLEAN_SQL}
SELECT indicativo, fecha, {", ".join(f"{s6(t)} AS {t}_real" for t in ("tmed", "tmin", "tmax"))}, true AS in_bounds, true AS decided
FROM clean WHERE fecha BETWEEN DATE '{TEST}' AND DATE '{fr.ORDER_END}'""")
def rollout_actuals(spark: SparkSession, sf: str) -> DataFrame:
    """The stored rollout beside the observed values, with its bounds and the rain it feeds back."""
    rows, c = recursive_forecast(spark, sf), F.col
    rain = F.when(c("prob_rain") > k.ROLLOUT_RAIN_THRESHOLD, F.lit(float(k.ROLLOUT_RAIN_MM))).otherwise(0.0)
    return rows.select("indicativo", "fecha", *[fr.r6(f"{t}_real") for t in ("tmed", "tmin", "tmax")],
                       _inside(k.PREDICTION_BOUNDS, {t: f"pred_{t}" for t in _PLAIN}).alias("in_bounds"), (c("prec") == rain).alias("decided"))


@query(f"""WITH {CLEAN_SQL}, {_LABELS},
rate AS (SELECT avg(l_rain) AS rate FROM labelled WHERE split <> 'test')
SELECT count(*) AS test_rows, sum(l_rain)::BIGINT AS rainy, {s6("avg((l_rain - rate) ** 2)")} AS rate_error, true AS beats_rate, true AS beats_chance
FROM labelled, rate WHERE split = 'test'""")
def rain_beats_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Test error of the constant rain rate as a forecast, and whether the rain model beats it and chance."""
    rows, c = _stored(spark, sf, "features"), F.col
    rate = rows.filter("split <> 'test'").agg(F.avg("label_rain").alias("rate"))
    scored = stage(training.score(rows.filter("split = 'test'"), "rain", _models(spark, sf)["rain"]).select("label_rain", "prob_rain"), "rain")
    errors = scored.join(F.broadcast(rate)).agg(
        F.count("*").alias("test_rows"), F.sum("label_rain").cast("long").alias("rainy"), F.avg((c("label_rain") - c("rate")) ** 2).alias("rate_error"),
        F.avg((c("label_rain") - c("prob_rain")) ** 2).alias("error"))
    curve = metrics.roc_auc(scored, "label_rain", "prob_rain").select("roc_auc")
    return errors.join(F.broadcast(curve)).select(
        "test_rows", "rainy", fr.r6("rate_error"), (c("error") < c("rate_error")).alias("beats_rate"), (c("roc_auc") > 0.5).alias("beats_chance"))
