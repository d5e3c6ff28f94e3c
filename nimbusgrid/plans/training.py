"""Gradient-boosted models per target: fit, judge, store, score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbusgrid import DATE, SERIES
from nimbusgrid import constants as k
from nimbusgrid.functions.bands import decision
from nimbusgrid.functions.indices import apparent_temperature, rainbow_score
from nimbusgrid.functions.scalars import bounded
from nimbusgrid.operators import features as ops
from nimbusgrid.operators.metrics import fit_status, regression_metrics, roc_auc
from nimbusgrid.plans import boosting
from nimbusgrid.session import shared_folder, stage, staging_path
from nimbusgrid.sources import storage

SPECS = {"rain": ops.RAIN, "tmed": ops.TEMPERATURE, "tmin": ops.TEMPERATURE,
         "tmax": ops.TEMPERATURE, "sol": ops.ATMOSPHERE, "hrMedia": ops.ATMOSPHERE,
         "velmedia": ops.ATMOSPHERE}
NOT_FEATURES = ("fecha", "indicativo", "nombre", "provincia")


def prediction_column(target: str) -> str:
    return "prob_rain" if target == "rain" else f"pred_{target}"


def with_ids(panel: DataFrame, labels: DataFrame, *, series: str = SERIES) -> DataFrame:
    """Attach the series label and read the altitude as a number."""
    out = panel.join(labels, series, "left")
    if "altitud" in out.columns:
        out = out.withColumn("altitud", F.col("altitud").try_cast("double"))
    return out


def base_features(panel: DataFrame, *, series: str = SERIES, date: str = DATE) -> list[str]:
    """Numeric columns of the panel itself."""
    return [f.name for f in panel.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in (series, date)
            and f.name not in NOT_FEATURES]


def target_features(panel: DataFrame, target: str, *, series: str = SERIES,
                    date: str = DATE) -> list[str]:
    """Feature names of one target: the panel's own plus those its spec can derive."""
    have = set(panel.columns)
    derived = ops.build_features(panel.limit(0), SPECS[target], series=series, date=date).columns
    return base_features(panel, series=series, date=date) + [
        c for c in SPECS[target].derived() if c in derived and c not in have]


def training_frame(panel: DataFrame, targets: Sequence[str] = k.TARGETS, *,
                   val_start: str = k.VAL_START_DATE, test_start: str = k.TEST_START_DATE,
                   series: str = SERIES, date: str = DATE) -> DataFrame:
    """Rows whose features are complete, with ``split`` and one ``label_{target}`` column each.

    One frame serves every target: the feature sets differ only in columns, and the rows lost to
    warm-up are those of the longest window, which all sets share.
    """
    keys = {"series": series, "date": date}
    used = ops.unique_columns(*[target_features(panel, t, **keys) for t in targets])
    rows = ops.build_features(panel, ops.EVERYTHING, **keys).na.drop("any", subset=used)
    rows = ops.add_split(rows, val_start, test_start, date=date)
    return rows.select("*", *[
        (ops.next_day_rain(**keys) if t == "rain" else ops.next_day_target(t, **keys))
        .alias(f"label_{t}") for t in targets])


def fit_target(frame: DataFrame, target: str, names: Sequence[str], *, folder: str | None = None,
               partitions: int | None = None, settings: Mapping[str, float] | None = None,
               series: str = SERIES, date: str = DATE, **options) -> PipelineModel:
    """Fit on train rows, judged on val rows (see ``boosting``); rows without a label are left out.

    Rows are dealt by (series, date) to partitions sized by their number, so a fit depends neither on
    the number of cores nor on that of files.  ``folder`` keeps the blocks for resuming.
    """
    spark = frame.sparkSession
    shared_folder(spark)  # boosting checkpoints its long lineage there
    label = f"label_{target}"
    rows = frame.filter(F.col("split").isin("train", "val") & F.col(label).isNotNull())
    partitions = partitions or boosting.tasks_for(rows.count())
    assembler = VectorAssembler(inputCols=list(names), outputCol="features", handleInvalid="error")
    dealt = assembler.transform(rows).select(
        series, date, "features", F.col(label).cast("double").alias("label"), (F.col("split") == "val").alias("is_validation"))
    dealt = stage(dealt.repartition(partitions, series, date).sortWithinPartitions(series, date), "rows")
    # a file is read in as many splits as there are cores, all but one of them empty: thousands of tasks without a row
    dealt = dealt.coalesce(partitions)
    return boosting.boost(dealt, target, names, settings or k.BOOSTING[target], folder or staging_path(spark, "boosting"), **options)


def model_features(model: PipelineModel) -> list[str]:
    return list(model.stages[0].getInputCols())


def score(frame: DataFrame, target: str, model: PipelineModel, *, missing: float = 0.0,
          name: str | None = None) -> DataFrame:
    """Add the target's prediction; features the frame lacks count as ``missing``."""
    absent = [c for c in model_features(model) if c not in frame.columns]
    out = model.transform(frame.withColumns({c: F.lit(missing) for c in absent})
                          if absent else frame)
    blocks = len(model.stages) - 1
    return out.withColumn(name or prediction_column(target), boosting.prediction(target, blocks)).drop(
        "features", *[f"_block_{i}" for i in range(blocks)], *absent)


def score_all(frame: DataFrame, models: Mapping[str, PipelineModel]) -> DataFrame:
    """All predictions side by side: a chain of projections, no join."""
    return reduce(lambda df, item: score(df, *item), models.items(), frame)


def evaluate(frame: DataFrame, models: Mapping[str, PipelineModel]) -> DataFrame:
    """One row per target: train and test scores and the fit status.

    All targets are scored in one pass over the train and test rows, whose scores are staged.
    """
    rows = frame.filter(F.col("split").isin("train", "test"))
    scored = stage(score_all(rows, models).select(
        "split", *[c for t in models for c in (f"label_{t}", prediction_column(t))]), "scored")
    parts, plain = [], [t for t in models if t != "rain"]

    def wide(measures: Sequence[str]) -> list[Column]:
        return [F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{m}_{s}".replace("roc_", ""))
                for m in measures for s in ("train", "test")]

    if plain:
        scores = regression_metrics(scored, {t: (f"label_{t}", prediction_column(t)) for t in plain},
                                    by=["split"])
        parts.append(fit_status(scores.groupBy("target").agg(*wide(("mae", "r2"))), False))
    if "rain" in models:
        scores = roc_auc(scored.filter(F.col("label_rain").isNotNull()), "label_rain", "prob_rain",
                         by=["split"], partitions=boosting.tasks_for(scored.count()))
        parts.append(fit_status(scores.agg(*wide(("roc_auc",))), True)
                     .withColumn("target", F.lit("rain")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def save_models(models: Mapping[str, PipelineModel], folder: str) -> None:
    """Store each model with its feature list (kept by its assembler stage)."""
    for target, model in models.items():
        model.write().overwrite().save(f"{folder}/{target}")


def load_models(spark: SparkSession, folder: str,
                targets: Sequence[str] = k.TARGETS) -> dict[str, PipelineModel]:
    """The stored models; targets without one are left out."""
    return {t: PipelineModel.load(f"{folder}/{t}") for t in targets
            if storage.path_exists(spark, f"{folder}/{t}")}


def feature_importance(spark: SparkSession, folder: str, target: str, model: PipelineModel,
                       n: int = 20) -> DataFrame:
    """The ``n`` features whose splits gain most, from the trees stored in ``folder``."""
    shares = boosting.importances(boosting.stored_nodes(spark, f"{folder}/{target}"), model_features(model))
    return shares.select(F.lit(target).alias("target"), "feature", "importance").orderBy(F.desc("importance"), "feature").limit(n)


def fit_all(frame: DataFrame, names: Mapping[str, Sequence[str]], *, folder: str | None = None, parallel: int = 1,
            series: str = SERIES, date: str = DATE, **options) -> dict[str, PipelineModel]:
    """Fit the targets of ``names`` on one stored frame, ``parallel`` at a time."""
    fit = inheritable_thread_target(frame.sparkSession)(
        lambda t: fit_target(frame, t, names[t], folder=folder, series=series, date=date, **options))
    with ThreadPool(max(1, parallel)) as pool:
        return dict(zip(names, pool.map(fit, names)))


def train(panel: DataFrame, targets: Sequence[str] = k.TARGETS, *, val_start=k.VAL_START_DATE,
          test_start=k.TEST_START_DATE, series: str = SERIES, date: str = DATE,
          parallel: int = 1, **options) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Fit every target on one feature frame; returns the models and that frame.

    The frame is staged: its windows run once for all fits, and each fit reads its own columns.
    ``parallel`` fits share the cluster; each keeps its own copy of the binned rows in memory, so
    raise it only while those fit.
    """
    keys = {"series": series, "date": date}
    frame = stage(training_frame(panel, targets, val_start=val_start, test_start=test_start,
                                 **keys), "features")
    names = {t: target_features(panel, t, **keys) for t in targets}
    return fit_all(frame, names, parallel=parallel, **keys, **options), frame


def final_forecast(frame: DataFrame, models: Mapping[str, PipelineModel], *,
                   series: str = SERIES, date: str = DATE) -> DataFrame:
    """Scored test rows keyed by issue day, bounded, with the rainbow and felt-temperature index."""
    out = score_all(frame.filter(F.col("split") == "test"), models)
    out = out.select(date, series, "station_id", *[prediction_column(t) for t in models])
    out = out.withColumns({
        f"pred_{t}": bounded(F.col(f"pred_{t}"), low, high)
        for t, (low, high) in k.TRAINING_BOUNDS.items() if t in models})
    if "rain" in models:
        out = out.withColumn("is_raining", decision(F.col("prob_rain")))
    if {"rain", "sol", "hrMedia"} <= set(models):
        out = out.withColumn("rainbow_prob", rainbow_score(
            F.col("prob_rain"), F.col("pred_sol"), F.col("pred_hrMedia")))
    if {"tmed", "hrMedia", "velmedia"} <= set(models):
        out = out.withColumn("pred_windchill", apparent_temperature(
            F.col("pred_tmed"), F.col("pred_hrMedia"), F.col("pred_velmedia")))
    return out
