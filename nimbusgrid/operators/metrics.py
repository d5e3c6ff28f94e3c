"""Forecast audit: regression and classification metrics, curves, report frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbusgrid import DATE, SERIES
from nimbusgrid import constants as k
from nimbusgrid.functions.bands import decision, rained
from nimbusgrid.operators.joins import season_table
from nimbusgrid.operators.ranking import exact_quantiles, running_totals


def _both(actual: str, predicted: str, value: Column) -> Column:
    return F.when(F.col(actual).isNotNull() & F.col(predicted).isNotNull(), value)


def mae(actual: str, predicted: str) -> Column:
    return F.avg(F.abs(F.col(actual) - F.col(predicted)))


def r_squared(actual: str, predicted: str) -> Column:
    """1 - SSE/SST over rows where both sides are known; a constant actual scores 1 or 0."""
    y = _both(actual, predicted, F.col(actual))
    sse = F.sum((F.col(actual) - F.col(predicted)) ** 2)
    sst = F.var_pop(y) * F.count(y)
    return F.when(sst > 0, 1 - sse / sst).otherwise(F.when(sse > 0, 0.0).otherwise(1.0))


def regression_metrics(df: DataFrame, pairs: Mapping[str, tuple[str, str]], *,
                       by: Sequence[str] = ()) -> DataFrame:
    """Rows (target, mae, rmse, r2) for each named (actual, predicted) pair, one aggregate.

    Pairs whose columns are absent are skipped.
    """
    pairs = {n: p for n, p in pairs.items() if set(p) <= set(df.columns)}
    if not pairs:
        raise ValueError("none of the column pairs is in the frame")
    wide = df.groupBy(*by).agg(*[
        c for n, (a, p) in pairs.items() for c in (
            mae(a, p).alias(f"{n}_mae"),
            F.sqrt(F.avg((F.col(a) - F.col(p)) ** 2)).alias(f"{n}_rmse"),
            r_squared(a, p).alias(f"{n}_r2"))])
    return wide.select(*by, F.inline(F.array(*[
        F.struct(F.lit(n).alias("target"), F.col(f"{n}_mae").alias("mae"),
                 F.col(f"{n}_rmse").alias("rmse"), F.col(f"{n}_r2").alias("r2"))
        for n in pairs])))


def degradation_table(df: DataFrame, targets: Sequence[str], *,
                      partitions: int | None = None) -> DataFrame:
    """Per target: one-step MAE, exact median error and R², recursive MAE, and the growth in %.

    Columns are ``real_{t}``, ``{t}_onestep`` and ``{t}_recursive``; a target that lacks one is
    skipped.
    """
    targets = [t for t in targets
               if {f"real_{t}", f"{t}_onestep", f"{t}_recursive"} <= set(df.columns)]
    wide = df.agg(*[c for t in targets for c in (
        mae(f"real_{t}", f"{t}_onestep").alias(f"{t}_os"),
        r_squared(f"real_{t}", f"{t}_onestep").alias(f"{t}_r2"),
        mae(f"real_{t}", f"{t}_recursive").alias(f"{t}_rec"))])
    growth = (F.col("mae_recursive") - F.col("mae_onestep")) / F.col("mae_onestep") * 100
    table = wide.select(F.inline(F.array(*[
        F.struct(F.lit(t).alias("target"), F.col(f"{t}_os").alias("mae_onestep"),
                 F.col(f"{t}_r2").alias("r2_onestep"), F.col(f"{t}_rec").alias("mae_recursive"))
        for t in targets])))
    errors = df.select(F.inline(F.array(*[
        F.struct(F.lit(t).alias("target"),
                 F.abs(F.col(f"real_{t}") - F.col(f"{t}_onestep")).alias("error"))
        for t in targets])))
    medians = exact_quantiles(errors, "error", {"medae_onestep": 0.5}, by=["target"],
                              partitions=partitions)
    return table.join(medians, "target").withColumn(
        "degradation_pct", F.when(F.col("mae_onestep") > 0, growth).otherwise(F.lit(0.0)))


def monthly_mae(df: DataFrame, actual: str, predicted: str, *, date: str = DATE) -> DataFrame:
    return df.groupBy(F.month(date).alias("month")).agg(mae(actual, predicted).alias("mae"))


# --- classification ------------------------------------------------------------------------

def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """tn, fp, fn, tp and their shares of the total in percent, one row."""
    def cell(y: int, p: int) -> Column:
        hit = (F.col(label) == y) & (F.col(predicted) == p)
        return F.coalesce(F.sum(hit.cast("bigint")), F.lit(0).cast("bigint"))

    cells = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    counts = df.agg(*[cell(y, p).alias(n) for n, (y, p) in cells.items()])
    total = reduce(lambda a, b: a + b, [F.col(n) for n in cells])
    return counts.withColumns({
        f"{n}_pct": F.when(total > 0, F.col(n) / total * 100) for n in cells})


def classification_metrics(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Accuracy, precision, recall, F1 and Matthews correlation beside the confusion matrix.

    A ratio with a zero denominator is 0; ``conservative`` marks a correlation below 0.5.
    """
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))

    def ratio(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))

    spread = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    scored = confusion(df, label, predicted).withColumns({
        "accuracy": ratio(tp + tn, tn + fp + fn + tp),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
        "mcc": ratio(tp * tn - fp * fn, spread),
    })
    return scored.withColumn("conservative", F.col("mcc") < 0.5)


def _score_counts(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    known = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    positive = F.col(label).cast("bigint")
    return known.groupBy(*by, score).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))


def roc_auc(df: DataFrame, label: str, score: str, *, by: Sequence[str] = (),
            partitions: int | None = None) -> DataFrame:
    """Area under the ROC curve, ties counted half; null when a class is absent."""
    ranked = running_totals(_score_counts(df, label, score, by), score, ["pos"], by=by,
                            descending=True, partitions=partitions)
    won = F.sum(F.col("neg") * (F.col("pos_before") + F.col("pos") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.groupBy(*by).agg(F.when(pairs > 0, won / pairs).alias("roc_auc"))


def roc_curve(df: DataFrame, label: str, score: str, *, drop_collinear: bool = True,
              partitions: int | None = None) -> DataFrame:
    """Points (threshold, fpr, tpr) per distinct score, from the added (inf, 0, 0) on.

    ``drop_collinear`` leaves out points inside a straight stretch: those whose step into the
    point equals the step out of it.
    """
    steps = running_totals(_score_counts(df, label, score), score, ["pos", "neg"],
                           descending=True, following=drop_collinear, partitions=partitions)
    points = steps.withColumns({
        "threshold": F.col(score),
        "tps": F.col("pos_before") + F.col("pos"),
        "fps": F.col("neg_before") + F.col("neg"),
    })
    if drop_collinear:
        first = F.col("pos_before") + F.col("neg_before") == 0
        last = F.col("pos_next").isNull()
        turns = (F.col("pos_next") != F.col("pos")) | (F.col("neg_next") != F.col("neg"))
        points = points.filter(first | last | turns)
    curve = points.select("threshold", (F.col("fps") / F.col("neg_all")).alias("fpr"),
                          (F.col("tps") / F.col("pos_all")).alias("tpr"))
    origin = df.sparkSession.createDataFrame(
        [(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return curve.withColumn("threshold", F.col("threshold").cast("double")).unionByName(origin)


def probability_histogram(df: DataFrame, probability: str, millimetres: str,
                          width: float = 0.02) -> DataFrame:
    """Counts per (condition, bin) of the predicted probability, split by observed rain."""
    condition = F.when(rained(F.col(millimetres)) == 1, "Rainy Day").otherwise("Dry Day")
    slot = F.floor(F.col(probability) / F.lit(width))
    return (df.filter(F.col(probability).isNotNull())
            .groupBy(condition.alias("condition"), slot.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")))


def probability_box(df: DataFrame, probability: str, millimetres: str, *,
                    partitions: int | None = None) -> DataFrame:
    """Exact quartiles of the predicted probability per observed condition."""
    condition = F.when(rained(F.col(millimetres)) == 1, "Rainy Day").otherwise("Dry Day")
    return exact_quantiles(
        df.select(condition.alias("condition"), F.col(probability)), probability,
        {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}, by=["condition"],
        partitions=partitions)


# --- diagnosis and report frames -----------------------------------------------------------

def fit_status(df: DataFrame, binary: bool) -> DataFrame:
    """``status`` from train/test scores: auc_* when binary, else mae_* and r2_train."""
    if binary:
        over = F.col("auc_train") - F.col("auc_test") > 0.15
        under = F.col("auc_test") < 0.6
    else:
        over = F.col("mae_test") > F.col("mae_train") * 1.4
        under = F.col("r2_train") < 0.35
    return df.withColumn(
        "status", F.when(over, "overfitting").when(under, "underfitting").otherwise("good fit"))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlations below the diagonal, pairwise complete, from one aggregate."""
    cols = [c for c in cols if c in df.columns]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[:i]]

    def pair(a: str, b: str) -> Column:
        known = F.col(a).isNotNull() & F.col(b).isNotNull()
        return F.corr(F.when(known, F.col(a)), F.when(known, F.col(b)))

    wide = df.agg(*[pair(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("row_name"), F.lit(b).alias("col_name"),
                 F.col(f"c{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)])))


def axis_bounds(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(F.least(F.min(a), F.min(b)).alias("low"),
                  F.greatest(F.max(a), F.max(b)).alias("high"))


def sample_rows(df: DataFrame, keys: Sequence[str], n: int = 2000, seed: int = 42) -> DataFrame:
    """A repeatable sample of up to ``n`` rows: the smallest hashes of the keys.

    Each task keeps its ``n`` smallest, so no more than that travels.
    """
    mark = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in keys], F.lit(str(seed))))
    return df.withColumn("_mark", mark).orderBy("_mark", *keys).limit(n).drop("_mark")


def scatter_frame(df: DataFrame, target: str, keys: Sequence[str] = (SERIES, DATE),
                  n: int = 2000) -> DataFrame:
    return sample_rows(df.select(*keys, f"real_{target}", f"pred_{target}"), keys, n)


def _shown(frame: DataFrame, wanted: Mapping[str, str]) -> list[Column]:
    """The wanted columns (name -> source) the frame has."""
    return [F.col(source).alias(name) for name, source in wanted.items() if source in frame.columns]


def comparative_frame(onestep: DataFrame, recursive: DataFrame,
                      targets: Sequence[str] = k.TARGETS, *, series: str = SERIES,
                      date: str = DATE) -> DataFrame:
    """One-step beside recursive predictions and actuals, on days both have.

    Per target ``{t}_onestep`` and ``{t}_recursive``, for rain also the classes; what a side lacks
    is left out.
    """
    keys, plain = [date, series], [t for t in targets if t != "rain"]
    ahead = {f"{t}_onestep": f"pred_{t}" for t in plain}
    rolled = {f"{t}_recursive": t for t in plain}
    classes = []
    if "rain" in targets:
        ahead |= {"rain_onestep": "pred_prob_rain", "rain_class_onestep": "pred_is_raining"}
        rolled["rain_recursive"] = "prob_rain"
        if "prob_rain" in recursive.columns:
            classes.append(decision(F.col("prob_rain")).alias("rain_class_recursive"))
    observed = [c for c in onestep.columns if c.startswith("real_")]
    return onestep.select(*keys, *observed, *_shown(onestep, ahead)).join(
        recursive.select(*keys, *_shown(recursive, rolled), *classes), keys)


def seasonal_frame(df: DataFrame, variable: str, station: str | None = None, *,
                   series: str = SERIES, date: str = DATE) -> DataFrame:
    """Long rows (series, day, season, kind, value) of actual, one-step and recursive values."""
    if station is not None:
        df = df.filter(F.col(series) == station)
    if variable == "rain":
        actual = rained(F.col("real_prec")).cast("double")
    else:
        actual = F.col(f"real_{variable}")
    kinds = [("real", actual), ("onestep", F.col(f"{variable}_onestep")),
             ("recursive", F.col(f"{variable}_recursive"))]
    long = df.select(series, date, F.inline(F.array(*[
        F.struct(F.lit(n).alias("kind"), c.alias("value")) for n, c in kinds])))
    seasons = F.broadcast(season_table(df.sparkSession))
    return (long.withColumn("month", F.month(date)).join(seasons, "month").drop("month"))
