"""One-step and recursive forecasts from stored models, and the plan that writes them all."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid import DATE, SERIES
from nimbusgrid import constants as k
from nimbusgrid.functions.bands import decision
from nimbusgrid.functions.scalars import bounded, cyclic, wind_components
from nimbusgrid.operators import features as ops
from nimbusgrid.plans import boosting, training
from nimbusgrid.plans.training import model_features, prediction_column, score_all
from nimbusgrid.session import stage, staging_path
from nimbusgrid.sources import storage

REAL_COLS = ("tmed", "tmin", "tmax", "prec", "sol", "hrMedia", "velmedia")


def onestep_forecast(panel: DataFrame, models: Mapping[str, PipelineModel],
                     year: int = k.TARGET_YEAR, *, series: str = SERIES,
                     date: str = DATE) -> DataFrame:
    """Teacher-forced forecast of one year, keyed by valid day, beside the observed values.

    Scoring is a chain of projections and the shift by a day reuses the feature windows'
    partitioning, so the whole plan has one exchange.
    """
    keys = {"series": series, "date": date}
    rows = ops.build_features(panel, ops.EVERYTHING, from_date=f"{year}-01-01",
                              to_date=f"{year}-12-31", **keys)
    feature_cols = sorted({c for m in models.values() for c in model_features(m)}
                          & set(rows.columns))
    # A row without all features of a model gets no prediction of that model; the others, and the
    # row, stay.
    have = set(rows.columns)
    filled = rows.selectExpr(
        f"`{date}`", f"`{series}`",
        *[" AND ".join(["true", *(f"`{c}` IS NOT NULL" for c in model_features(m) if c in have)])
          + f" AS `_ready_{t}`" for t, m in models.items()],
        *[f"`{c}` AS `real_{c}`" for c in REAL_COLS if c in rows.columns],
        *[f"coalesce(cast(`{c}` AS double), 0D) AS `{c}`" for c in feature_cols])
    names = [prediction_column(t) for t in models]
    scored = score_all(filled, models).withColumns(
        {prediction_column(t): F.when(F.col(f"_ready_{t}"), F.col(prediction_column(t)))
         for t in models})
    moved = ops.to_valid_time(scored, names, **keys)
    out = moved.select(
        date, series, *[c for c in moved.columns if c.startswith("real_")],
        *[bounded(F.col(f"pred_{t}"), *k.PREDICTION_BOUNDS.get(t, (None, None)))
          .alias(f"pred_{t}") for t in models if t != "rain"],
        *([F.col("prob_rain").alias("pred_prob_rain"),
           decision(F.col("prob_rain")).cast("double").alias("pred_is_raining")]
          if "rain" in models else []))
    return out.na.drop(subset=["pred_tmed"]) if "tmed" in models else out


# --- recursive rollout ---------------------------------------------------------------------

def _before(c: Column, days: int) -> Column:
    """A measure ``days`` before the latest day, from its history array."""
    return F.element_at(c, -1 - days)


def _past(c: str, days: int, history: Mapping[str, Column]) -> Column | None:
    """A measure or a column derived from measures, ``days`` before the latest day."""
    if c in history:
        return _before(history[c], days)
    if c in ("wind_sin", "wind_cos") and "dir" in history:
        return wind_components(_before(history["dir"], days))[c]
    if c == "presion_diff" and "presion" in history:
        return _before(history["presion"], days) - _before(history["presion"], days + 1)
    if c == "cloud_moisture" and {"nubes", "hrMedia"} <= set(history):
        return _before(history["nubes"], days) * _before(history["hrMedia"], days)
    return None


def _latest_feature(name: str, history: Mapping[str, Column], current: Mapping[str, Column]) -> Column:
    """One feature of the latest day; 0 if nothing can derive it, as in scoring."""
    value = current.get(name, _past(name, 0, history))
    stem, _, tail = name.rpartition("_")
    base, _, kind = stem.rpartition("_")
    if value is None and kind == "lag":
        value = _past(base, int(tail), history)
    if value is None and kind == "roll" and base in history:
        days = [_past(base, d, history) for d in range(int(tail))]
        value = sum(days[1:], days[0]) / len(days)
    if value is None and tail == "trend" and stem in history:
        value = _past(stem, 1, history) - _past(stem, 2, history)
    missing = F.lit(0.0) if value is None else value.cast("double")
    return F.coalesce(missing, F.lit(float("nan")))  # trees send both unknown and NaN right


def tree_arrays(spark: SparkSession, folder: str, features: Mapping[str, Sequence[str]], every: Sequence[str]) -> DataFrame:
    """One row with each target's trees as arrays of nodes, their features numbered as in ``every``."""
    place, parts = {n: i for i, n in enumerate(every)}, []
    for target, names in features.items():
        number = F.element_at(F.array(*[F.lit(place[n]) for n in names]), F.col("feature") + 1)
        nodes = boosting.stored_nodes(spark, f"{folder}/{target}").withColumn(
            "feature", F.when(F.col("left") >= 0, number).otherwise(-1))
        whole = F.sort_array(F.collect_list(F.struct("node", "feature", "threshold", "left", "right", "value")))
        trees = nodes.groupBy("block", "tree").agg(F.first("weight").alias("weight"), whole.alias("n")).select(
            F.struct("block", "tree", "weight", *[F.col(f"n.{c}").alias(c) for c in ("feature", "threshold", "left", "right", "value")]).alias("tree"))
        parts.append(trees.agg(F.sort_array(F.collect_list("tree")).alias("trees")).withColumn("target", F.lit(target)))
    every_target = parts[0]
    for part in parts[1:]:
        every_target = every_target.unionByName(part)
    return every_target.agg(*[F.first(F.when(F.col("target") == t, F.col("trees")), ignorenulls=True).alias(f"_trees_{t}") for t in features])


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is referred to."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _ensemble(trees: Column, x: Column, depth: int) -> Column:
    """The weighted sum of what the trees say of the feature array ``x``."""
    def leaf(tree: Column) -> Column:
        def down(node: Column, _: Column) -> Column:
            at = F.get(x, F.get(tree["feature"], node))
            turn = F.when(at <= F.get(tree["threshold"], node), F.get(tree["left"], node)).otherwise(F.get(tree["right"], node))
            return F.when(F.get(tree["left"], node) < 0, node).otherwise(turn)
        return F.get(tree["value"], F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), down))
    return F.aggregate(trees, F.lit(0.0), lambda total, tree: total + tree["weight"] * leaf(tree))


def recursive_forecast(history: DataFrame, models: Mapping[str, PipelineModel],
                       start: str = f"{k.TARGET_YEAR}-01-01", horizon: int = k.HORIZON_DAYS, *,
                       folder: str | None = None, rain_threshold: float = k.ROLLOUT_RAIN_THRESHOLD,
                       rain_mm: float = k.ROLLOUT_RAIN_MM, partitions: int | None = None,
                       series: str = SERIES, date: str = DATE) -> DataFrame:
    """Forecast ``horizon`` days from ``start``, feeding each day's predictions into the next.

    Series do not depend on each other: each is one row with its last days as arrays, and the days
    are one fold over those arrays (features, trees, the arrays moved on), so the plan is as long for
    a year as for a day and nothing shuffles between days.  The trees are read from the stored models
    (``folder``, or a copy in the shared folder) and sent to every executor once as arrays of nodes.
    Variables no model predicts are carried forward; ``_est`` flags of predicted days are 1.
    """
    spark = history.sparkSession
    if folder is None:
        folder = staging_path(spark, "models")
        training.save_models(models, folder)
    past_rows = ops.trailing_history(
        history.filter(F.col(date) < F.lit(start).cast("date")), date=date)
    statics = [c for c in ("nombre", "provincia", "altitud", "station_id")
               if c in history.columns]
    flags = [c for c in history.columns if c.endswith("_est") or c == "_quality_score"]
    measures = [c for c in ops.unique_columns([*k.LAG_COLS, *k.PERSISTED_COLS])
                if c in history.columns]
    reach, known = ops.EVERYTHING.reach + 1, set(measures)

    rows = F.sort_array(F.collect_list(F.struct(date, *measures, *flags, *statics)))
    packed = past_rows.groupBy(series).agg(rows.alias("_rows"))
    latest = F.element_at("_rows", -1)

    def window(c: str) -> Column:
        """The last ``reach`` values, short histories padded in front."""
        values = F.col(f"_rows.{c}").cast("array<double>")
        return F.slice(F.concat(F.array_repeat(F.lit(None).cast("double"), reach), values),
                       -reach, reach)

    # A fixed count: the rows are few and small, but each is a long computation.
    state = packed.select(
        series, latest[date].alias("_last"), *[window(c).alias(c) for c in measures],
        *[latest[c].cast("double").alias(c) for c in flags],
        *[latest[c].alias(c) for c in statics],
    ).repartition(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), series)

    names = {t: model_features(m) for t, m in models.items()}
    every = ops.unique_columns(*names.values())
    depth = max(b.getMaxDepth() for m in models.values() for b in m.stages[1:])
    trees = stage(tree_arrays(spark, folder, names, every), "trees")
    targets = [t for t in models if t != "rain"]
    carried = [c for c in k.PERSISTED_COLS if c not in targets]
    nothing = F.lit(None).cast("double")
    shown_names = [date, *[c for t in targets for c in (t, f"pred_{t}")],
                   *(["prec", "prob_rain"] if "rain" in models else []), *carried]
    shown_type = "struct<" + ",".join(f"`{c}`:{'date' if c == date else 'double'}" for c in shown_names) + ">"

    def day(acc: Column, _: Column) -> Column:
        past = {c: acc[c] for c in measures}
        current = {c: acc[c] for c in flags} | {c: F.col(c) for c in ("station_id", "altitud") if c in statics}
        current |= cyclic(acc["_last"])

        def moved(p: Column) -> Column:
            said = {t: F.element_at(p, i + 1) for i, t in enumerate(models)}
            fresh = {t: bounded(said[t], *k.PREDICTION_BOUNDS.get(t, (None, None))) for t in targets}
            shown = [acc["_day"].alias(date), *[c for t in targets for c in (fresh[t].alias(t), fresh[t].alias(f"pred_{t}"))]]
            if "rain" in models:
                chance = 1.0 / (1.0 + F.exp(-said["rain"]))
                fresh["prec"] = F.when(chance > rain_threshold, F.lit(float(rain_mm))).otherwise(0.0)
                shown += [fresh["prec"].alias("prec"), chance.alias("prob_rain")]
            fresh.update({c: _before(past[c], 0) if c in known else F.lit(0.0) for c in carried})
            shown += [fresh[c].alias(c) for c in carried]
            return F.struct(
                acc["_day"].alias("_last"), F.date_add(acc["_day"], 1).alias("_day"),
                *[F.concat(F.slice(past[c], 2, reach - 1), F.array(fresh.get(c, nothing))).alias(c) for c in measures],
                *[F.lit(1.0).alias(c) for c in flags], F.concat(acc["_days"], F.array(F.struct(*shown))).alias("_days"))

        features = F.array(*[_latest_feature(n, past, current) for n in every])
        return _bound(features, lambda x: _bound(
            F.array(*[_ensemble(F.col(f"_trees_{t}"), x, depth) for t in models]), moved))

    begin = F.struct("_last", F.lit(start).cast("date").alias("_day"), *measures, *flags,
                     F.array().cast(f"array<{shown_type}>").alias("_days"))
    rolled = state.crossJoin(F.broadcast(trees)).select(series, *statics, F.inline(F.aggregate(
        F.sequence(F.lit(1), F.lit(horizon)), begin, day, lambda acc: acc["_days"])))
    return rolled.select(date, series, *statics, *shown_names[1:])


# --- the published tables -------------------------------------------------------------------

def publish(panel: DataFrame, folder: str, *, val_start: str = k.VAL_START_DATE,
            test_start: str = k.TEST_START_DATE, year: int = k.TARGET_YEAR,
            horizon: int = k.HORIZON_DAYS, parallel: int = 1, steps: Sequence[str] | None = None, series: str = SERIES, date: str = DATE,
            **options) -> None:
    """Write feature frame, models and the three forecasts to ``folder``.

    Readers of a forecast scan the stored tables; nothing is computed again for them.  Each of
    ``features``, ``models``, ``final``, ``onestep`` and ``recursive`` (all, or those named in
    ``steps``) is made from stored ones, which are made first if they are not there; one that is
    there stays, so a publication that was cut short goes on where it ended.
    """
    keys = {"series": series, "date": date}
    spark = panel.sparkSession

    def there(name: str) -> bool:
        return storage.path_exists(spark, f"{folder}/{name}/_SUCCESS")

    def write(df: DataFrame, name: str) -> None:
        storage.write_table(df, f"{folder}/{name}", sort_by=(series, date))

    def features() -> DataFrame:
        if not there("features"):
            write(training.training_frame(panel, val_start=val_start, test_start=test_start, **keys), "features")
        return spark.read.parquet(f"{folder}/features")

    def models() -> dict[str, PipelineModel]:
        found = training.load_models(spark, f"{folder}/models")
        missing = {t: training.target_features(panel, t, **keys) for t in k.TARGETS if t not in found}
        if missing:
            fitted = training.fit_all(features(), missing, folder=f"{folder}/boosting", parallel=parallel, **keys, **options)
            training.save_models(fitted, f"{folder}/models")
            found = training.load_models(spark, f"{folder}/models")
        return found

    makers = {
        "features": features, "models": models,
        "final": lambda: write(training.final_forecast(features(), models(), **keys), "final"),
        "onestep": lambda: write(onestep_forecast(panel, models(), year, **keys), "onestep"),
        "recursive": lambda: write(recursive_forecast(panel, models(), test_start, horizon, folder=f"{folder}/models", **keys), "recursive"),
    }
    for step in makers if steps is None else steps:
        if step in ("features", "models") or not there(step):
            makers[step]()
