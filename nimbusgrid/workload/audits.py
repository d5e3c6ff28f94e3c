"""Metric, curve and report queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nimbusgrid.functions.bands import decision
from nimbusgrid.functions.scalars import absolute_error
from nimbusgrid.operators import metrics
from nimbusgrid.workload import frames as fr
from nimbusgrid.workload.frames import r6, s6
from nimbusgrid.workload.registry import query
from nimbusgrid.workload.timeseries import FILLED_REGIONS, filled_regions

# Two simple forecasts of region revenue: yesterday's value, and the mean of the last seven days.
_COMPARED_SQL = FILLED_REGIONS + """,
compared AS (SELECT * FROM (SELECT region, day, revenue AS real_revenue,
    lag(revenue, 1) OVER w AS revenue_onestep,
    avg(revenue) OVER (PARTITION BY region ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
      AS revenue_recursive,
    revenue / 8 AS real_load, lag(revenue, 2) OVER w / 8 AS load_onestep,
    lag(revenue, 7) OVER w / 8 AS load_recursive
  FROM filled WINDOW w AS (PARTITION BY region ORDER BY day))
  WHERE load_recursive IS NOT NULL)"""
_TARGETS = ("revenue", "load")


def _compared(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("region").orderBy("day")
    c = F.col("revenue")
    return filled_regions(spark, sf).select(
        "region", "day", c.alias("real_revenue"), F.lag(c, 1).over(w).alias("revenue_onestep"),
        F.avg(c).over(w.rowsBetween(-7, -1)).alias("revenue_recursive"),
        (c / 8).alias("real_load"), (F.lag(c, 2).over(w) / 8).alias("load_onestep"),
        (F.lag(c, 7).over(w) / 8).alias("load_recursive"),
    ).filter(F.col("load_recursive").isNotNull())


def _r2_sql(y: str, p: str) -> str:
    return f"1 - sum(({y} - {p}) * ({y} - {p})) / (var_pop({y}) * count({y}))"


@query(f"""WITH {_COMPARED_SQL}
{" UNION ALL ".join(f'''SELECT '{t}' AS target, {s6(f"avg(abs(real_{t} - {t}_onestep))")} AS mae,
  {s6(f"sqrt(avg((real_{t} - {t}_onestep) * (real_{t} - {t}_onestep)))")} AS rmse,
  {s6(_r2_sql(f"real_{t}", f"{t}_onestep"))} AS r2 FROM compared''' for t in _TARGETS)}""")
def regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.regression_metrics(_compared(spark, sf), {
        t: (f"real_{t}", f"{t}_onestep") for t in _TARGETS})
    return out.select("target", r6("mae"), r6("rmse"), r6("r2"))


@query(f"""WITH {_COMPARED_SQL}
{" UNION ALL ".join(f'''SELECT '{t}' AS target, {s6("os")} AS mae_onestep, {s6("r2")} AS r2_onestep,
  {s6("rec")} AS mae_recursive, {s6("med")} AS medae_onestep,
  CASE WHEN os > 0 THEN {s6("(rec - os) / os * 100")} ELSE 0 END AS degradation_pct
FROM (SELECT avg(abs(real_{t} - {t}_onestep)) AS os, avg(abs(real_{t} - {t}_recursive)) AS rec,
  median(abs(real_{t} - {t}_onestep)) AS med, {_r2_sql(f"real_{t}", f"{t}_onestep")} AS r2
  FROM compared)''' for t in _TARGETS)}""")
def degradation(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.degradation_table(_compared(spark, sf), _TARGETS)
    return out.select("target", *[r6(c) for c in (
        "mae_onestep", "r2_onestep", "mae_recursive", "medae_onestep", "degradation_pct")])


@query(f"""WITH {_COMPARED_SQL}
SELECT CAST(month(day) AS INTEGER) AS month, {s6("avg(abs(real_revenue - revenue_recursive))")} AS mae
FROM compared GROUP BY 1""")
def monthly_errors(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.monthly_mae(_compared(spark, sf), "real_revenue", "revenue_recursive",
                              date="day")
    return out.select("month", r6("mae"))


@query(f"""WITH {_COMPARED_SQL}
SELECT {s6("least(min(real_revenue), min(revenue_recursive))")} AS low,
  {s6("greatest(max(real_revenue), max(revenue_recursive))")} AS high FROM compared""")
def axis_bounds(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.axis_bounds(_compared(spark, sf), "real_revenue", "revenue_recursive")
    return out.select(r6("low"), r6("high"))


@query(f"""WITH {_COMPARED_SQL}
SELECT region, day, real_revenue, pred_revenue FROM (
  SELECT region, day, real_revenue, revenue_onestep AS pred_revenue FROM compared
  ORDER BY md5(region || '|' || CAST(day AS VARCHAR) || '|42'), region, day LIMIT 2000)""")
def scatter_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = _compared(spark, sf).withColumnRenamed("revenue_onestep", "pred_revenue")
    return metrics.scatter_frame(rows, "revenue", ["region", "day"])


_KINDS = ("real", "onestep", "recursive")


@query(f"""WITH {_COMPARED_SQL},
long AS ({" UNION ALL ".join(
    f"SELECT region, day, '{n}' AS kind, {'real_load' if n == 'real' else 'load_' + n} AS value "
    f"FROM compared" for n in _KINDS)})
SELECT region, day, kind, value, CASE WHEN month(day) <= 3 THEN 'Winter (Jan-Mar)'
  WHEN month(day) <= 6 THEN 'Spring (Apr-Jun)' WHEN month(day) <= 9 THEN 'Summer (Jul-Sep)'
  ELSE 'Autumn (Oct-Dec)' END AS season FROM long WHERE region = 'EUROPE'""")
def seasonal_rows(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.seasonal_frame(_compared(spark, sf), "load", "EUROPE", **fr.REGION)
    return out.select("region", "day", "kind", "value", "season")


@query(f"""WITH {_COMPARED_SQL}
SELECT region, day, {s6("abs(real_revenue - revenue_recursive)")} AS error FROM compared""")
def absolute_errors(spark: SparkSession, sf: str) -> DataFrame:
    rows = _compared(spark, sf).withColumn(
        "error", absolute_error(F.col("real_revenue"), F.col("revenue_recursive")))
    return rows.select("region", "day", r6("error"))


# --- classification: document quality against a score from its length ----------------------

_SCORED_SQL = """scored AS (SELECT doc_id, quality AS label,
  CAST(n_chars % 1000 AS DOUBLE) / 1000 AS score,
  CASE WHEN CAST(n_chars % 1000 AS DOUBLE) / 1000 > 0.25::DOUBLE THEN 1 ELSE 0 END AS predicted
  FROM labels JOIN documents USING (doc_id))"""


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    rows = fr.table(spark, sf, "labels").join(
        fr.table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    score = (F.col("n_chars") % 1000).cast("double") / 1000
    return rows.select("doc_id", F.col("quality").alias("label"), score.alias("score"),
                       decision(score).alias("predicted"))


@query(f"""WITH {_SCORED_SQL},
counts AS (SELECT CAST(coalesce(sum(CASE WHEN label = 0 AND predicted = 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS tn,
  CAST(coalesce(sum(CASE WHEN label = 0 AND predicted = 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS fp,
  CAST(coalesce(sum(CASE WHEN label = 1 AND predicted = 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS fn,
  CAST(coalesce(sum(CASE WHEN label = 1 AND predicted = 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS tp FROM scored),
f AS (SELECT CAST(tn AS DOUBLE) AS tn, CAST(fp AS DOUBLE) AS fp, CAST(fn AS DOUBLE) AS fn,
  CAST(tp AS DOUBLE) AS tp FROM counts)
SELECT c.tn, c.fp, c.fn, c.tp, {", ".join(s6(f"f.{x} / (f.tn + f.fp + f.fn + f.tp) * 100") + f" AS {x}_pct" for x in ("tn", "fp", "fn", "tp"))},
  {s6("(f.tp + f.tn) / (f.tn + f.fp + f.fn + f.tp)")} AS accuracy,
  {s6("CASE WHEN f.tp + f.fp > 0 THEN f.tp / (f.tp + f.fp) ELSE 0 END")} AS precision,
  {s6("CASE WHEN f.tp + f.fn > 0 THEN f.tp / (f.tp + f.fn) ELSE 0 END")} AS recall,
  {s6("CASE WHEN 2 * f.tp + f.fp + f.fn > 0 THEN 2 * f.tp / (2 * f.tp + f.fp + f.fn) ELSE 0 END")} AS f1,
  {s6("(f.tp * f.tn - f.fp * f.fn) / sqrt((f.tp + f.fp) * (f.tp + f.fn) * (f.tn + f.fp) * (f.tn + f.fn))")} AS mcc,
  (f.tp * f.tn - f.fp * f.fn) / sqrt((f.tp + f.fp) * (f.tp + f.fn) * (f.tn + f.fp) * (f.tn + f.fn)) < 0.5 AS conservative
FROM counts c, f""")
def classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.classification_metrics(_scored(spark, sf), "label", "predicted")
    exact = ("tn", "fp", "fn", "tp", "conservative")
    return out.select(*[F.col(c) if c in exact else r6(c) for c in out.columns])


_COUNTS_SQL = _SCORED_SQL + """,
counts AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1)"""


@query(f"""WITH {_COUNTS_SQL},
ranked AS (SELECT *, coalesce(sum(pos) OVER (ORDER BY score DESC
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above FROM counts)
SELECT {s6("CAST(sum(neg * (above + pos / 2.0)) AS DOUBLE) / CAST(sum(pos) * sum(neg) AS DOUBLE)")} AS roc_auc
FROM ranked""")
def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.roc_auc(_scored(spark, sf), "label", "score").select(r6("roc_auc"))


@query(f"""WITH {_COUNTS_SQL},
steps AS (SELECT score, pos, neg, lead(pos) OVER o AS next_pos, lead(neg) OVER o AS next_neg,
    row_number() OVER o AS rn, CAST(sum(pos) OVER o AS DOUBLE) AS tps,
    CAST(sum(neg) OVER o AS DOUBLE) AS fps, CAST(sum(pos) OVER () AS DOUBLE) AS p,
    CAST(sum(neg) OVER () AS DOUBLE) AS n
  FROM counts WINDOW o AS (ORDER BY score DESC))
SELECT score AS threshold, {s6("fps / n")} AS fpr, {s6("tps / p")} AS tpr FROM steps
WHERE rn = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
UNION ALL SELECT CAST('infinity' AS DOUBLE), 0, 0""")
def roc_curve(spark: SparkSession, sf: str) -> DataFrame:
    curve = metrics.roc_curve(_scored(spark, sf), "label", "score")
    return curve.select("threshold", r6("fpr"), r6("tpr"))


@query(f"""WITH {_SCORED_SQL}
SELECT CASE WHEN label > 0.1 THEN 'Rainy Day' ELSE 'Dry Day' END AS condition,
  CAST(floor(score / 0.05::DOUBLE) AS BIGINT) AS bin, count(*) AS n FROM scored GROUP BY 1, 2""")
def probability_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.probability_histogram(_scored(spark, sf), "score", "label", 0.05)


@query(f"""WITH {_SCORED_SQL}
SELECT CASE WHEN label > 0.1 THEN 'Rainy Day' ELSE 'Dry Day' END AS condition,
  {", ".join(s6(f"quantile_cont(score, {p})") + f" AS {n}" for n, p in (
      ("low", 0.0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("high", 1.0)))}
FROM scored GROUP BY 1""")
def probability_box(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.probability_box(_scored(spark, sf), "score", "label")
    return out.select("condition", *[r6(c) for c in ("low", "q1", "median", "q3", "high")])


@query(f"""WITH {_SCORED_SQL},
halves AS (SELECT doc_id % 2 AS half, score, label FROM scored),
counts AS (SELECT half, score, sum(label) AS pos, sum(1 - label) AS neg FROM halves GROUP BY 1, 2),
ranked AS (SELECT *, coalesce(sum(pos) OVER (PARTITION BY half ORDER BY score DESC
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above FROM counts),
aucs AS (SELECT half, CAST(sum(neg * (above + pos / 2.0)) AS DOUBLE) / CAST(sum(pos) * sum(neg) AS DOUBLE) AS auc
  FROM ranked GROUP BY 1),
wide AS (SELECT max(CASE WHEN half = 0 THEN auc END) AS auc_train,
  max(CASE WHEN half = 1 THEN auc END) AS auc_test FROM aucs)
SELECT {s6("auc_train")} AS auc_train, {s6("auc_test")} AS auc_test,
  CASE WHEN auc_train - auc_test > 0.15::DOUBLE THEN 'overfitting'
    WHEN auc_test < 0.6::DOUBLE THEN 'underfitting' ELSE 'good fit' END AS status FROM wide""")
def fit_diagnosis(spark: SparkSession, sf: str) -> DataFrame:
    halves = _scored(spark, sf).withColumn("half", F.col("doc_id") % 2)
    aucs = metrics.roc_auc(halves, "label", "score", by=["half"])
    wide = aucs.agg(*[F.max(F.when(F.col("half") == i, F.col("roc_auc"))).alias(f"auc_{n}")
                      for i, n in enumerate(("train", "test"))])
    return metrics.fit_status(wide, binary=True).select(
        r6("auc_train"), r6("auc_test"), "status")


_CORR = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "gappy")
_CORR_SQL = """items AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax,
  CASE WHEN l_returnflag <> 'R' THEN l_quantity * l_tax END AS gappy FROM lineitem)"""


@query(f"""WITH {_CORR_SQL}
{" UNION ALL ".join(f"SELECT '{a}' AS row_name, '{b}' AS col_name, {s6(f'corr({a}, {b})')} AS correlation FROM items"
                    for i, a in enumerate(_CORR) for b in _CORR[:i])}""")
def correlation_matrix(spark: SparkSession, sf: str) -> DataFrame:
    items = fr.table(spark, sf, "lineitem").select(
        *_CORR[:4], F.when(F.col("l_returnflag") != "R", F.col("l_quantity") * F.col("l_tax"))
        .alias("gappy"))
    return metrics.correlation_matrix(items, _CORR).select(
        "row_name", "col_name", r6("correlation"))
