"""Join, lookup and forecast-reader queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid.functions import indices
from nimbusgrid.functions.bands import decision
from nimbusgrid.operators import joins, metrics, serving
from nimbusgrid.workload import frames as fr
from nimbusgrid.workload.formulas import _FELT_SQL, _RAINBOW_SQL
from nimbusgrid.workload.registry import query

_DAY = "2000-06-01"


def _daily(spark: SparkSession, sf: str, name: str, date: str, value: str) -> DataFrame:
    return fr.table(spark, sf, name).groupBy(F.col(date).cast("date").alias("fecha")).agg(
        F.count(F.lit(1)).alias(f"{name}_rows"), F.max(value).alias(f"{name}_max"))


_DAILY_SQL = """d_orders AS (SELECT CAST(o_orderdate AS DATE) AS fecha, count(*) AS orders_rows,
  max(o_totalprice) AS orders_max FROM orders GROUP BY 1),
d_lineitem AS (SELECT CAST(l_shipdate AS DATE) AS fecha, count(*) AS lineitem_rows,
  max(l_extendedprice) AS lineitem_max FROM lineitem GROUP BY 1),
d_events AS (SELECT CAST(ts AS DATE) AS fecha, count(*) AS events_rows, max(value) AS events_max
  FROM events GROUP BY 1)"""


@query(f"""WITH {_DAILY_SQL}
SELECT fecha, orders_rows, orders_max, lineitem_rows, lineitem_max, events_rows, events_max
FROM d_orders FULL JOIN d_lineitem USING (fecha) FULL JOIN d_events USING (fecha)""")
def outer_merge(spark: SparkSession, sf: str) -> DataFrame:
    return joins.outer_merge([
        _daily(spark, sf, "orders", "o_orderdate", "o_totalprice"),
        _daily(spark, sf, "lineitem", "l_shipdate", "l_extendedprice"),
        _daily(spark, sf, "events", "ts", "value")], ["fecha"], unique_keys=True)


@query("""SELECT key, a.n_name AS nation, b.s_name AS supplier, c.c_name AS customer
FROM (SELECT n_nationkey % 30 AS key, n_name FROM nation) a
FULL JOIN (SELECT s_nationkey AS key, s_name FROM supplier) b USING (key)
FULL JOIN (SELECT c_nationkey AS key, c_name FROM customer) c USING (key)""")
def outer_merge_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Frames that repeat their keys: every combination of a key's rows."""
    c = F.col
    return joins.outer_merge([
        fr.table(spark, sf, "nation").select(
            (c("n_nationkey") % 30).alias("key"), c("n_name").alias("nation")),
        fr.table(spark, sf, "supplier").select(c("s_nationkey").alias("key"), c("s_name").alias("supplier")),
        fr.table(spark, sf, "customer").select(
            c("c_nationkey").alias("key"), c("c_name").alias("customer"))], ["key"])


@query("""SELECT key, o.o_totalprice AS price, l.l_linenumber AS line, l.l_quantity AS quantity, f.l_returnflag AS flag, f.lines
FROM (SELECT o_orderkey AS key, o_totalprice FROM orders) o
FULL JOIN (SELECT l_orderkey AS key, l_linenumber, l_quantity FROM lineitem) l USING (key)
FULL JOIN (SELECT l_orderkey AS key, l_returnflag, count(*) AS lines FROM lineitem GROUP BY 1, 2) f USING (key)""")
def outer_merge_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Whole tables by order key: every line with every flag of its order, and orders without lines."""
    c = F.col
    lineitem = fr.table(spark, sf, "lineitem").withColumn("key", c("l_orderkey"))
    return joins.outer_merge([
        fr.table(spark, sf, "orders").select(c("o_orderkey").alias("key"), c("o_totalprice").alias("price")),
        lineitem.select("key", c("l_linenumber").alias("line"), c("l_quantity").alias("quantity")),
        lineitem.groupBy("key", c("l_returnflag").alias("flag")).agg(F.count(F.lit(1)).alias("lines"))], ["key"])


@query(f"""WITH {fr.STATION_DAYS}, {fr.SKY_DAYS}
SELECT fecha, indicativo, tmed, sol, presion, nubes FROM station_days
LEFT JOIN sky_days USING (fecha, indicativo)""")
def second_source(spark: SparkSession, sf: str) -> DataFrame:
    out = joins.enrich(fr.station_days(spark, sf), fr.sky_days(spark, sf))
    return out.select("fecha", "indicativo", "tmed", "sol", "presion", "nubes")


_ONESTEP_SQL = fr.FORECAST_DAYS + f""", {fr.SKY_DAYS},
onestep AS (SELECT fecha, indicativo, pred_tmed, pred_sol, prob_rain AS pred_prob_rain,
  CASE WHEN prob_rain > 0.25::DOUBLE THEN 1.0 ELSE 0.0 END AS pred_is_raining,
  pred_tmax AS real_tmed, pred_tmin AS real_sol FROM forecast_days),
recursive_f AS (SELECT fecha, indicativo, presion AS tmed, sol, nubes / 100 AS prob_rain
  FROM sky_days)"""


@query(f"""WITH {_ONESTEP_SQL}
SELECT fecha, indicativo, o.pred_tmed AS tmed_onestep, o.pred_sol AS sol_onestep,
  o.pred_prob_rain AS rain_onestep, CAST(o.pred_is_raining AS DOUBLE) AS rain_class_onestep,
  o.real_tmed, o.real_sol, r.tmed AS tmed_recursive, r.sol AS sol_recursive,
  r.prob_rain AS rain_recursive, CASE WHEN r.prob_rain > 0.25::DOUBLE THEN 1 ELSE 0 END AS rain_class_recursive
FROM onestep o JOIN recursive_f r USING (fecha, indicativo)""")
def comparative_frame(spark: SparkSession, sf: str) -> DataFrame:
    f = fr.forecast_days(spark, sf)
    onestep = f.select(
        "fecha", "indicativo", "pred_tmed", "pred_sol", F.col("prob_rain").alias("pred_prob_rain"),
        decision(F.col("prob_rain")).cast("double").alias("pred_is_raining"),
        F.col("pred_tmax").alias("real_tmed"), F.col("pred_tmin").alias("real_sol"))
    recursive = fr.sky_days(spark, sf).select(
        "fecha", "indicativo", F.col("presion").alias("tmed"), "sol",
        (F.col("nubes") / 100).alias("prob_rain"))
    return metrics.comparative_frame(onestep, recursive)


@query(f"""WITH {fr.FORECAST_DAYS}, {fr.SKY_DAYS}
SELECT fecha, indicativo, pred_tmed, sol AS sol_real, nubes AS nubes_real FROM forecast_days
LEFT JOIN sky_days USING (fecha, indicativo)""")
def with_actuals(spark: SparkSession, sf: str) -> DataFrame:
    out = joins.with_actuals(fr.forecast_days(spark, sf).select("fecha", "indicativo", "pred_tmed"),
                             fr.sky_days(spark, sf), ["sol", "nubes"])
    return out.select("fecha", "indicativo", "pred_tmed", "sol_real", "nubes_real")


@query("""SELECT c_custkey, coalesce(n_name, 'unknown') AS n_name,
  coalesce(CAST(n_regionkey AS INTEGER), -1) AS n_regionkey
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON c_nationkey = n_nationkey""")
def dimension_fallback(spark: SparkSession, sf: str) -> DataFrame:
    dim = fr.table(spark, sf, "nation").filter("n_regionkey <> 2").withColumnRenamed(
        "n_nationkey", "c_nationkey")
    customers = fr.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return joins.lookup(customers, dim, "c_nationkey", {
        "n_name": "unknown", "n_regionkey": -1}).drop("c_nationkey")


@query(f"""WITH {fr.STATION_DAYS}
SELECT indicativo, nombre, provincia, altitud FROM (SELECT *, row_number() OVER (
  PARTITION BY indicativo ORDER BY fecha) AS rn FROM station_days) WHERE rn = 1""")
def station_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return joins.first_known(fr.station_days(spark, sf), ["nombre", "provincia", "altitud"])


def _indexed(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    return fr.forecast_days(spark, sf).withColumns({
        "rainbow_prob": indices.rainbow_score(c("prob_rain"), c("pred_sol"), c("pred_hrMedia")),
        "pred_windchill": indices.apparent_temperature(
            c("pred_tmed"), c("pred_hrMedia"), c("pred_velmedia"))})


_INDEXED_SQL = fr.FORECAST_DAYS + f""",
indexed AS (SELECT fecha, indicativo, prob_rain, pred_sol, hr AS "pred_hrMedia",
    v AS pred_velmedia, t AS pred_tmed, pred_tmin, pred_tmax, {_RAINBOW_SQL} AS rainbow_prob,
    {_FELT_SQL} AS pred_windchill
  FROM (SELECT *, "pred_hrMedia" AS hr, pred_velmedia AS v, pred_tmed AS t FROM forecast_days))"""
_NEXT_SQL = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY indicativo ORDER BY fecha) AS rn
  FROM indexed WHERE fecha >= DATE '{_DAY}') WHERE rn <= 7)"""


@query(f"""WITH {_INDEXED_SQL}
SELECT fecha, indicativo, pred_tmax, pred_tmin, pred_tmed, prob_rain * 5 AS rain_scaled,
  pred_windchill FROM {_NEXT_SQL}""")
def weekly_trend(spark: SparkSession, sf: str) -> DataFrame:
    return serving.weekly_trend(_indexed(spark, sf), _DAY)


@query(f"""WITH {_INDEXED_SQL}
SELECT fecha, indicativo, CASE WHEN prob_rain > 0.5 THEN CASE WHEN pred_sol > 2 THEN 'sun_shower' ELSE 'rain' END
    WHEN pred_sol > 8 THEN 'sunny' WHEN pred_sol > 4 THEN 'partly_cloudy' ELSE 'cloudy' END AS icon,
  CAST(round_even(pred_tmax, 0) AS INTEGER) || '°' AS tmax_text,
  CAST(round_even(pred_tmin, 0) AS INTEGER) || '°' AS tmin_text,
  CAST(round_even(prob_rain * 100, 0) AS INTEGER) AS rain_pct,
  CASE WHEN rainbow_prob > 0 THEN 'YES' ELSE 'NO' END AS rainbow_label FROM {_NEXT_SQL}""")
def forecast_cards(spark: SparkSession, sf: str) -> DataFrame:
    week = serving.next_days(_indexed(spark, sf), _DAY)
    return serving.forecast_cards(week).select(
        "fecha", "indicativo", "icon", "tmax_text", "tmin_text", "rain_pct", "rainbow_label")


@query(f"""WITH {_INDEXED_SQL}
SELECT indicativo, indicativo AS map_name, 41.38::DOUBLE AS lat, 2.17::DOUBLE AS lon,
  CAST(round_even(pred_tmed, 0) AS INTEGER) AS degrees, pred_windchill,
  CASE WHEN prob_rain > 0.5 THEN 'cloud-showers-heavy' WHEN pred_sol > 8 THEN 'sun' ELSE 'cloud' END AS icon,
  CASE WHEN prob_rain > 0.5 THEN 'blue' WHEN pred_sol > 8 THEN 'orange' ELSE 'gray' END AS colour
FROM indexed WHERE fecha = DATE '{_DAY}'""")
def forecast_map(spark: SparkSession, sf: str) -> DataFrame:
    """Map markers of a day; these stations are not in the fixed table and get the defaults."""
    return serving.forecast_map(_indexed(spark, sf), _DAY)


@query("""SELECT o_custkey, o_orderkey, day, o_totalprice FROM (
  SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day, o_totalprice, row_number() OVER (
    PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders WHERE o_orderdate >= DATE '1998-01-01') WHERE rn <= 7""")
def next_seven(spark: SparkSession, sf: str) -> DataFrame:
    orders = fr.table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"), "o_totalprice")
    return serving.next_days(orders, "1998-01-01", series="o_custkey", date="day",
                             then=["o_orderkey"])


@query("""SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders
WHERE o_custkey = 149 AND CAST(o_orderdate AS DATE) = (
  SELECT min(CAST(o_orderdate AS DATE)) FROM orders WHERE o_custkey = 149)""")
def point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    orders = fr.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"), "o_totalprice")
    first = orders.filter("o_custkey = 149").agg(F.min("day")).scalar()
    return serving.point_lookup(orders, 149, first, series="o_custkey", date="day")


@query("""SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders
WHERE o_custkey = 149 AND o_orderdate >= DATE '2000-01-01' ORDER BY day DESC""")
def available_dates(spark: SparkSession, sf: str) -> DataFrame:
    orders = fr.table(spark, sf, "orders").select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    return serving.available_dates(orders, 149, 2000, series="o_custkey", date="day")


@query("SELECT DISTINCT event_type FROM events ORDER BY event_type")
def distinct_types(spark: SparkSession, sf: str) -> DataFrame:
    return serving.distinct_values(fr.table(spark, sf, "events"), "event_type")


@query(f"""WITH {fr.FORECAST_DAYS}
SELECT fecha, indicativo, prob_rain, pred_tmed FROM forecast_days ORDER BY indicativo, fecha LIMIT 100""")
def preview_rows(spark: SparkSession, sf: str) -> DataFrame:
    return serving.preview(fr.forecast_days(spark, sf)).select(
        "fecha", "indicativo", "prob_rain", "pred_tmed")


# --- subscriptions and alerts --------------------------------------------------------------

_SUBSCRIPTIONS_SQL = """subs AS (SELECT CAST(c_custkey AS VARCHAR) AS telegram_id,
  'NATION_' || c_nationkey AS station_code, c_name AS station_name, c_custkey % 4 <> 0 AS active,
  TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-01 00:00:00' AS updated_at
  FROM customer)"""


def _subscriptions(spark: SparkSession, sf: str) -> DataFrame:
    c, start = F.col, F.lit("2024-01-01").cast("timestamp_ntz")
    return fr.table(spark, sf, "customer").select(
        c("c_custkey").cast("string").alias("telegram_id"),
        F.concat(F.lit("NATION_"), c("c_nationkey")).alias("station_code"),
        c("c_name").alias("station_name"), (c("c_custkey") % 4 != 0).alias("active"),
        start.alias("created_at"), start.alias("updated_at"))


@query(f"""WITH {_INDEXED_SQL}, {_SUBSCRIPTIONS_SQL},
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY indicativo ORDER BY fecha) AS rn
  FROM indexed) WHERE rn = 1)
SELECT telegram_id, station_code, station_name, fecha AS forecast_date, pred_windchill, pred_tmed,
  CASE WHEN pred_windchill < 5 THEN 'Bundle up, it''s very cold!' WHEN pred_windchill < 15 THEN 'Wear a jacket, it''s chilly.'
    WHEN pred_windchill < 25 THEN 'Pleasant weather, enjoy it!' ELSE 'It''s hot, stay hydrated!' END AS advice
FROM subs JOIN firsts ON station_code = indicativo""")
def alerts(spark: SparkSession, sf: str) -> DataFrame:
    out = serving.alerts(_subscriptions(spark, sf), _indexed(spark, sf))
    return out.drop("message", "difference")


@query(f"""WITH {_INDEXED_SQL}, {_SUBSCRIPTIONS_SQL},
a AS (SELECT *, pred_windchill - pred_tmed AS gap,
    CASE WHEN pred_windchill < 5 THEN 1 WHEN pred_windchill < 15 THEN 2
      WHEN pred_windchill < 25 THEN 3 ELSE 4 END AS band
  FROM subs JOIN indexed ON station_code = indicativo AND fecha = DATE '{_DAY}')
SELECT telegram_id, chr(10) || repeat(' ', 12) || '<b>🌡️ Wind Chill Notification</b>' || chr(10) || chr(10)
  || repeat(' ', 12) || '📍 <b>Station:</b> ' || station_name || chr(10)
  || repeat(' ', 12) || '📅 <b>Date:</b> ' || strftime(fecha, '%d/%m/%Y') || chr(10)
  || repeat(' ', 12) || '🕗 <b>Time:</b> 07:00 AM' || chr(10) || chr(10)
  || repeat(' ', 12) || '🌡️ <b>Actual temperature:</b> ' || printf('%.1f', pred_tmed) || '°C' || chr(10)
  || repeat(' ', 12) || '🎚️ <b>Wind chill:</b> ' || printf('%.1f', pred_windchill) || '°C '
  || CASE band WHEN 1 THEN '❄️' WHEN 2 THEN '🌬️' WHEN 3 THEN '😊' ELSE '🔥' END || chr(10)
  || repeat(' ', 12) || '📊 <b>Difference:</b> '
  || CASE WHEN pred_windchill - pred_tmed = 0 THEN 'same' ELSE printf('%+.1f', gap) || '°C' END || chr(10) || chr(10)
  || repeat(' ', 12) || '💡 <b>Tip:</b> ' || CASE band WHEN 1 THEN 'Bundle up, it''s very cold!' WHEN 2 THEN 'Wear a jacket, it''s chilly.'
    WHEN 3 THEN 'Pleasant weather, enjoy it!' ELSE 'It''s hot, stay hydrated!' END || chr(10) || chr(10)
  || repeat(' ', 12) || '<i>Automated notification from the weather system.</i>' || chr(10) || repeat(' ', 8) AS message
FROM a""")
def alert_messages(spark: SparkSession, sf: str) -> DataFrame:
    return serving.alerts(_subscriptions(spark, sf), _indexed(spark, sf), as_of=_DAY).select(
        "telegram_id", "message")
