"""Feature, target and row-selection queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid import constants as k
from nimbusgrid.functions.scalars import cyclic, stamp, wind_components
from nimbusgrid.operators import features, panel
from nimbusgrid.operators.labels import label_series
from nimbusgrid.sources.storage import year_between
from nimbusgrid.workload import frames as fr
from nimbusgrid.workload.frames import r6, s6
from nimbusgrid.workload.panels import CLEAN_SQL, station_panel
from nimbusgrid.workload.registry import query

VAL, TEST = "2000-01-01", "2001-01-01"


def filled_regions(spark: SparkSession, sf: str) -> DataFrame:
    return panel.fill_adjacent(fr.dense_regions(spark, sf), ["revenue"], **fr.REGION)


FILLED_REGIONS = fr.DENSE_REGIONS + """,
filled AS (SELECT region, day, coalesce(
    last_value(revenue IGNORE NULLS) OVER (PARTITION BY region ORDER BY day
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(revenue IGNORE NULLS) OVER (PARTITION BY region ORDER BY day
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS revenue FROM dense)"""


@query(f"""WITH {FILLED_REGIONS}
SELECT region, day, {", ".join(f"lag(revenue, {n}) OVER w AS revenue_lag_{n}" for n in k.LAGS)}
FROM filled WINDOW w AS (PARTITION BY region ORDER BY day)""")
def lags(spark: SparkSession, sf: str) -> DataFrame:
    return features.add_lags(filled_regions(spark, sf), ["revenue"], **fr.REGION).drop("revenue")


@query(f"""WITH {fr.DENSE_REGIONS}
SELECT region, day, {", ".join(
    f"CASE WHEN count(revenue) OVER w{n} = {n} THEN {s6(f'avg(revenue) OVER w{n}')} END "
    f"AS revenue_roll_{n}" for n in k.WINDOWS)}
FROM dense WINDOW {", ".join(
    f"w{n} AS (PARTITION BY region ORDER BY day ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    for n in k.WINDOWS)}""")
def rolling_full(spark: SparkSession, sf: str) -> DataFrame:
    out = features.add_rolling(fr.dense_regions(spark, sf), ["revenue"], **fr.REGION)
    return out.select("region", "day", *[r6(f"revenue_roll_{n}") for n in k.WINDOWS])


@query(f"""WITH {FILLED_REGIONS}
SELECT region, day, revenue - lag(revenue, 1) OVER w AS revenue_diff,
  lag(revenue, 1) OVER w - lag(revenue, 2) OVER w AS revenue_trend
FROM filled WINDOW w AS (PARTITION BY region ORDER BY day)""")
def difference_and_trend(spark: SparkSession, sf: str) -> DataFrame:
    df = features.add_difference(filled_regions(spark, sf), "revenue", **fr.REGION)
    df = features.add_trends(features.add_lags(df, ["revenue"], **fr.REGION), ["revenue"])
    return df.select("region", "day", "revenue_diff", "revenue_trend")


@query(f"""WITH {FILLED_REGIONS},
split AS (SELECT *, CASE WHEN day < DATE '{VAL}' THEN 'train'
  WHEN day < DATE '{TEST}' THEN 'val' ELSE 'test' END AS split FROM filled)
SELECT region, day, split, lead(revenue) OVER (PARTITION BY region, split ORDER BY day) AS target,
  CASE WHEN lead(revenue) OVER (PARTITION BY region ORDER BY day) > 0.1 THEN 1.0 ELSE 0.0 END::DOUBLE
    AS rain_label
FROM split""")
def next_day_targets(spark: SparkSession, sf: str) -> DataFrame:
    """Split by date, value of the next day within the split, label of the next day overall."""
    df = features.add_split(filled_regions(spark, sf), VAL, TEST, date="day")
    return df.select("region", "day", "split",
                     features.next_day_target("revenue", **fr.REGION).alias("target"),
                     features.next_day_rain("revenue", **fr.REGION).alias("rain_label"))


@query(f"""WITH {FILLED_REGIONS}
SELECT region, day, lag(revenue * 2) OVER (PARTITION BY region ORDER BY day) AS predicted
FROM filled WHERE day BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'""")
def valid_time(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions issued on a day, moved to the day they are for."""
    year = filled_regions(spark, sf).filter(year_between("day", 2000))
    issued = year.select("region", "day", (F.col("revenue") * 2).alias("predicted"))
    return features.to_valid_time(issued, ["predicted"], **fr.REGION)


@query("""SELECT user_id, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events)
WHERE rn = 1""")
def latest_per_series(spark: SparkSession, sf: str) -> DataFrame:
    events = fr.table(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    return features.last_row(events, series="user_id", date="ts")


@query(f"""WITH {fr.REGION_DAYS}
SELECT region, day, revenue FROM region_days
WHERE day >= (SELECT max(day) FROM region_days) - INTERVAL 40 DAY""")
def trailing_history(spark: SparkSession, sf: str) -> DataFrame:
    days = fr.region_days(spark, sf).select("region", "day", "revenue")
    return features.trailing_history(days, date="day")


@query("""SELECT c_name, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS INTEGER) AS station_id
FROM (SELECT DISTINCT c_name FROM customer)""")
def series_labels(spark: SparkSession, sf: str) -> DataFrame:
    return label_series(fr.table(spark, sf, "customer"), series="c_name")


@query(f"""SELECT DISTINCT CAST(l_shipdate AS DATE) AS day,
  {s6("sin(month(l_shipdate) * (2 * pi()) / 12)")} AS month_sin,
  {s6("cos(month(l_shipdate) * (2 * pi()) / 12)")} AS month_cos,
  {s6("sin(dayofyear(l_shipdate) * (2 * pi()) / 365.0::DOUBLE)")} AS day_sin,
  {s6("cos(dayofyear(l_shipdate) * (2 * pi()) / 365.0::DOUBLE)")} AS day_cos,
  strftime(l_shipdate, '%Y%m%d') AS stamp
FROM lineitem""")
def cyclic_calendar(spark: SparkSession, sf: str) -> DataFrame:
    days = fr.table(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("day")).distinct()
    names = list(cyclic(F.col("day")))
    return days.withColumns({**cyclic(F.col("day")), "stamp": stamp(F.col("day"))}).select(
        "day", "stamp", *[r6(n) for n in names])


@query(f"""SELECT p_partkey, {s6("sin(radians(d))")} AS wind_sin, {s6("cos(radians(d))")} AS wind_cos
FROM (SELECT p_partkey, CASE WHEN a IS NULL OR a = 99 THEN 0 ELSE a END AS d FROM (
  SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 11 = 0 THEN 99
    ELSE p_size * 7 END AS a FROM part))""")
def wind_direction(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    angle = F.when(size % 7 == 0, None).when(size % 11 == 0, 99).otherwise(size * 7)
    parts = fr.table(spark, sf, "part").select("p_partkey", angle.cast("double").alias("a"))
    both = wind_components(F.col("a"))
    return parts.withColumns(both).select("p_partkey", r6("wind_sin"), r6("wind_cos"))


_BASE = ["tmed", "tmin", "tmax", '"hrMedia"', "presion", "nubes", "velmedia", "sol", "prec"]
_ROLLS = ["tmed", '"hrMedia"', "presion", "nubes"]


def _bare(c: str) -> str:
    return c.strip('"')


_LAGGED = [*_BASE, "presion_diff", "cloud_moisture", "wind_sin", "wind_cos"]
_TRENDS = [c for c in k.TREND_COLS if c in _BASE or f'"{c}"' in _BASE]
_FEATURES = ["presion_diff", "cloud_moisture", "wind_sin", "wind_cos",
             *[f'"{_bare(c)}_lag_{n}"' for c in _LAGGED for n in k.LAGS],
             *[f'"{_bare(c)}_roll_{n}"' for c in _ROLLS for n in k.WINDOWS]]


@query(f"""WITH {CLEAN_SQL},
derived AS (SELECT *, presion - lag(presion) OVER s AS presion_diff,
    nubes * "hrMedia" AS cloud_moisture,
    sin(radians(CASE WHEN dir = 99 THEN 0 ELSE dir END)) AS wind_sin,
    cos(radians(CASE WHEN dir = 99 THEN 0 ELSE dir END)) AS wind_cos
  FROM clean WINDOW s AS (PARTITION BY indicativo ORDER BY fecha)),
featured AS (SELECT *,
  {", ".join(f'lag({c}, {n}) OVER s AS "{_bare(c)}_lag_{n}"'
             for c in _LAGGED for n in k.LAGS)},
  {", ".join(f'CASE WHEN count({c}) OVER w{n} = {n} THEN avg({c}) OVER w{n} END '
             f'AS "{_bare(c)}_roll_{n}"' for c in _ROLLS for n in k.WINDOWS)}
  FROM derived WINDOW s AS (PARTITION BY indicativo ORDER BY fecha), {", ".join(
    f"w{n} AS (PARTITION BY indicativo ORDER BY fecha ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    for n in k.WINDOWS)})
SELECT indicativo, fecha, {", ".join(f'{s6(_q)} AS {_q}' for _q in _FEATURES)},
  {", ".join(f'{s6(f"{c}_lag_1 - {c}_lag_2")} AS {c}_trend' for c in _TRENDS)},
  {s6("sin(month(fecha) * (2 * pi()) / 12)")} AS month_sin,
  {s6("cos(month(fecha) * (2 * pi()) / 12)")} AS month_cos,
  {s6("sin(dayofyear(fecha) * (2 * pi()) / 365.0::DOUBLE)")} AS day_sin,
  {s6("cos(dayofyear(fecha) * (2 * pi()) / 365.0::DOUBLE)")} AS day_cos
FROM featured WHERE fecha BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'""")
def feature_frame(spark: SparkSession, sf: str) -> DataFrame:
    """All model features of one year; the windows see only the history they need."""
    df = features.build_features(station_panel(spark, sf), from_date="2000-01-01",
                                 to_date="2000-12-31")
    names = [c for c in features.EVERYTHING.derived() if c in df.columns]
    return df.select("indicativo", "fecha", *[r6(c) for c in names])


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, 0.0::DOUBLE AS absent, l_tax
FROM lineitem WHERE l_quantity IS NOT NULL AND l_tax IS NOT NULL""")
def feature_projection(spark: SparkSession, sf: str) -> DataFrame:
    """Columns in feature order, unknown ones as zero, incomplete rows dropped."""
    items = fr.table(spark, sf, "lineitem")
    names = ["l_quantity", "absent", "l_tax"]
    out = items.select("l_orderkey", "l_linenumber", "l_partkey",
                       *features.project_features(items, names))
    return out.na.drop(subset=["l_quantity", "l_tax"])
