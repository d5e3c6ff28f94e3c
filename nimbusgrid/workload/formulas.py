"""Scalar formula, index, band and parsing queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid import constants as k
from nimbusgrid.functions import bands, indices, physics, scalars
from nimbusgrid.sources import records, subscriptions
from nimbusgrid.sources.landing import station_folder
from nimbusgrid.workload import frames as fr
from nimbusgrid.workload.frames import r6, s6
from nimbusgrid.workload.registry import query

_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_KEYS_SQL = ", ".join(_KEYS)


def _raw_text(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as decimal-comma text with trace, accumulated, blank and missing entries."""
    key = F.col("l_orderkey") + F.col("l_linenumber")
    number = F.translate(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), ".", ",")
    text = (F.when(key % 11 == 0, "Ip").when(key % 13 == 0, "Acum").when(key % 17 == 0, "")
            .when(key % 19 == 0, None).when(key % 23 == 0, F.concat(F.lit("  "), number))
            .otherwise(number))
    return fr.table(spark, sf, "lineitem").select(*_KEYS, text.alias("text"))


@query(f"""SELECT {_KEYS_SQL}, CASE WHEN lower(trim(text)) = 'ip' THEN 0.05
  ELSE try_cast(replace(trim(text), ',', '.') AS DOUBLE) END AS value
FROM (SELECT {_KEYS_SQL}, CASE WHEN key % 11 = 0 THEN 'Ip' WHEN key % 13 = 0 THEN 'Acum'
    WHEN key % 17 = 0 THEN '' WHEN key % 19 = 0 THEN NULL WHEN key % 23 = 0 THEN '  ' || num
    ELSE num END AS text
  FROM (SELECT {_KEYS_SQL}, l_orderkey + l_linenumber AS key,
      replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS num
    FROM lineitem))""")
def locale_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return _raw_text(spark, sf).select(*_KEYS, scalars.locale_number(F.col("text")).alias("value"))


@query("""SELECT p_partkey, regexp_replace(
  regexp_replace(p_name || ', Sant (' || p_brand || ')', '[^\\p{L}\\p{N}_\\s-]', '', 'g'),
  '\\s+', '_', 'g') AS clean,
  'Station_' || p_partkey || '_' || regexp_replace(
  regexp_replace(p_name, '[^\\p{L}\\p{N}_\\s-]', '', 'g'), '\\s+', '_', 'g') AS folder
FROM part""")
def sanitized_names(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.col("p_name"), F.lit(", Sant ("), F.col("p_brand"), F.lit(")"))
    return fr.table(spark, sf, "part").select(
        "p_partkey", scalars.sanitize_name(name).alias("clean"),
        station_folder(F.col("p_partkey").cast("string"), F.col("p_name")).alias("folder"))


@query("""SELECT o_orderkey,
  replace(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || 'UTC', ':', '%3A') AS request_stamp,
  CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 YEAR AS DATE) AS last_year FROM orders""")
def request_stamps(spark: SparkSession, sf: str) -> DataFrame:
    when = F.col("o_orderdate")
    return fr.table(spark, sf, "orders").select(
        "o_orderkey", scalars.request_stamp(when).alias("request_stamp"),
        scalars.same_day_last_year(when.cast("date")).alias("last_year"))


def _air(spark: SparkSession, sf: str) -> DataFrame:
    return fr.table(spark, sf, "lineitem").select(
        *_KEYS, (F.col("l_quantity") - 10).alias("t"),
        (F.col("l_quantity") - 12 - F.col("l_tax") * 50).alias("td"))


_ES = "6.1094::DOUBLE * exp(17.625::DOUBLE * {c} / (243.04::DOUBLE + {c}))"
_AIR_SQL = f"""SELECT {_KEYS_SQL}, l_quantity - 10 AS t, l_quantity - 12 - l_tax * 50 AS td
  FROM lineitem"""


@query(f"""SELECT {_KEYS_SQL}, {s6("es")} AS saturation, {s6("ea")} AS vapor,
  {s6("es - ea")} AS deficit, {s6("least(greatest(100 * (ea / es), 0), 100)")} AS humidity,
  {s6("t - td")} AS depression
FROM (SELECT *, {_ES.format(c="t")} AS es, {_ES.format(c="td")} AS ea FROM ({_AIR_SQL}))""")
def moist_air(spark: SparkSession, sf: str) -> DataFrame:
    t, td = F.col("t"), F.col("td")
    out = _air(spark, sf).withColumns({
        "saturation": physics.saturation_vapor_pressure(t),
        "vapor": physics.vapor_pressure(td),
        "deficit": physics.vapor_pressure_deficit(t, td),
        "humidity": physics.relative_humidity(t, td),
        "depression": physics.dew_point_depression(t, td)})
    return out.select(*_KEYS, *[r6(c) for c in (
        "saturation", "vapor", "deficit", "humidity", "depression")])


def _forecast_items(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    return fr.table(spark, sf, "lineitem").select(
        *_KEYS, (c("l_discount") * 10).alias("prob_rain"), (c("l_quantity") / 4).alias("pred_sol"),
        (c("l_discount") * 1000).alias("pred_hrMedia"), (c("l_tax") * 200).alias("pred_velmedia"),
        (c("l_quantity") - 10).alias("pred_tmed"))


_ITEMS_SQL = f"""SELECT {_KEYS_SQL}, l_discount * 10 AS prob_rain, l_quantity / 4 AS pred_sol,
  l_discount * 1000 AS hr, l_tax * 200 AS v, l_quantity - 10 AS t FROM lineitem"""
_TENTH = "round_even(({e}) * 10, 0) / 10"
_RAINBOW_SQL = _TENTH.format(e="""least(greatest(
  CASE WHEN prob_rain < 0.25::DOUBLE THEN 0.0::DOUBLE WHEN prob_rain > 0.85::DOUBLE THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END * prob_rain
  * CASE WHEN pred_sol < 1 THEN 0.0::DOUBLE WHEN pred_sol < 4 THEN 0.6::DOUBLE WHEN pred_sol < 10 THEN 1.0::DOUBLE
      WHEN pred_sol >= 10 THEN 0.8::DOUBLE ELSE 0.0::DOUBLE END
  * (hr / 100.0::DOUBLE * CASE WHEN hr < 40 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END) * 120, 0), 95)""")
_FELT_SQL = _TENTH.format(e="""CASE
  WHEN t <= 10 AND v * 3.6::DOUBLE > 4.8::DOUBLE THEN 13.12::DOUBLE + 0.6215::DOUBLE * t
    - 11.37::DOUBLE * pow(v * 3.6::DOUBLE, 0.16::DOUBLE) + 0.3965::DOUBLE * t * pow(v * 3.6::DOUBLE, 0.16::DOUBLE)
  WHEN t >= 26 THEN -8.784::DOUBLE + 1.611::DOUBLE * t + 2.338::DOUBLE * hr - 0.146::DOUBLE * (t * hr)
  WHEN t > 10 AND t < 26 THEN t + 0.33::DOUBLE * (hr / 100.0::DOUBLE * (6.112::DOUBLE * exp(17.67::DOUBLE * t / (t + 243.5::DOUBLE))))
    - 0.70::DOUBLE * v - 4.00::DOUBLE
  ELSE t END""")


@query(f"SELECT {_KEYS_SQL}, {_RAINBOW_SQL} AS rainbow_prob FROM ({_ITEMS_SQL})")
def rainbow_score(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    return _forecast_items(spark, sf).select(*_KEYS, indices.rainbow_score(
        c("prob_rain"), c("pred_sol"), c("pred_hrMedia")).alias("rainbow_prob"))


@query(f"SELECT {_KEYS_SQL}, {_FELT_SQL} AS pred_windchill FROM ({_ITEMS_SQL})")
def apparent_temperature(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    return _forecast_items(spark, sf).select(*_KEYS, indices.apparent_temperature(
        c("pred_tmed"), c("pred_hrMedia"), c("pred_velmedia")).alias("pred_windchill"))


@query(f"""SELECT {_KEYS_SQL},
  CASE WHEN prob_rain > 0.25::DOUBLE THEN 1 ELSE 0 END AS is_raining,
  CASE WHEN t > 0.1::DOUBLE THEN 1 ELSE 0 END AS rained,
  CASE WHEN prob_rain > 0.5 THEN CASE WHEN pred_sol > 2 THEN 'sun_shower' ELSE 'rain' END
    WHEN pred_sol > 8 THEN 'sunny' WHEN pred_sol > 4 THEN 'partly_cloudy' ELSE 'cloudy' END AS icon,
  CASE WHEN felt < 5 THEN 'Bundle up, it''s very cold!' WHEN felt < 15 THEN 'Wear a jacket, it''s chilly.'
    WHEN felt < 25 THEN 'Pleasant weather, enjoy it!' ELSE 'It''s hot, stay hydrated!' END AS advice,
  CASE WHEN felt - t = 0 THEN 'same' ELSE printf('%+.1f', felt - t) || '°C' END
    AS difference,
  CASE WHEN rainbow >= 60 THEN 'HIGH' WHEN rainbow >= 30 THEN 'MEDIUM' ELSE 'LOW' END AS rainbow_band,
  CASE WHEN hr > 70 THEN 'High' WHEN hr > 40 THEN 'Medium' ELSE 'Low' END AS humidity_band,
  CASE WHEN prob_rain >= 0.5 THEN 'YES' ELSE 'NO' END AS rain_label,
  CASE WHEN rainbow > 0 THEN 'YES' ELSE 'NO' END AS rainbow_label,
  CAST(round_even(t, 0) AS INTEGER) AS degrees
FROM (SELECT *, {_RAINBOW_SQL} AS rainbow, {_FELT_SQL} AS felt FROM ({_ITEMS_SQL}))""")
def forecast_bands(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    rows = _forecast_items(spark, sf).withColumns({
        "rainbow": indices.rainbow_score(c("prob_rain"), c("pred_sol"), c("pred_hrMedia")),
        "felt": indices.apparent_temperature(c("pred_tmed"), c("pred_hrMedia"),
                                             c("pred_velmedia"))})
    return rows.select(
        *_KEYS, bands.decision(c("prob_rain")).alias("is_raining"),
        bands.rained(c("pred_tmed")).alias("rained"),
        bands.weather_icon(c("prob_rain"), c("pred_sol")).alias("icon"),
        bands.advice(c("felt")).alias("advice"),
        bands.signed_difference(c("felt"), c("pred_tmed")).alias("difference"),
        bands.rainbow_band(c("rainbow")).alias("rainbow_band"),
        bands.humidity_band(c("pred_hrMedia")).alias("humidity_band"),
        bands.rain_label(c("prob_rain")).alias("rain_label"),
        bands.rainbow_label(c("rainbow")).alias("rainbow_label"),
        bands.whole_degrees(c("pred_tmed")).alias("degrees"))


@query("""SELECT c_custkey, CASE WHEN regexp_full_match(trim(id), '[0-9]+') THEN trim(id) END AS telegram_id,
  name || ' (' || id || ')' AS name_code, concat_ws(' ', id, name) AS code_name
FROM (SELECT c_custkey, c_name AS name, CASE WHEN c_custkey % 5 = 0 THEN 'x' || c_custkey
  WHEN c_custkey % 7 = 0 THEN '  ' || c_custkey || ' ' ELSE CAST(c_custkey AS VARCHAR) END AS id
  FROM customer)""")
def subscriber_ids(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    text = key.cast("string")
    entered = (F.when(key % 5 == 0, F.concat(F.lit("x"), text))
               .when(key % 7 == 0, F.concat(F.lit("  "), text, F.lit(" "))).otherwise(text))
    rows = fr.table(spark, sf, "customer").select("c_custkey", "c_name", entered.alias("id"))
    return rows.select(
        "c_custkey", subscriptions.clean_id(F.col("id")).alias("telegram_id"),
        bands.name_code_label(F.col("id"), F.col("c_name")).alias("name_code"),
        bands.code_name_label(F.col("id"), F.col("c_name")).alias("code_name"))


# --- records -------------------------------------------------------------------------------

def raw_records(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as raw text records, some with broken dates or missing identity."""
    key, c = F.col("o_orderkey"), F.col
    number = F.translate(c("o_totalprice").cast("decimal(18,2)").cast("string"), ".", ",")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    fields = {
        "fecha": F.when(key % 29 == 0, "not-a-date").otherwise(day),
        "indicativo": F.when(key % 31 != 0, c("o_custkey").cast("string")),
        "nombre": c("o_orderpriority"), "provincia": c("o_orderstatus"),
        "altitud": key.cast("string"), "tmed": number,
        "prec": F.when(key % 3 == 0, "Ip").when(key % 5 == 0, "Acum").otherwise("0,0"),
        "dir": F.when(key % 4 == 0, "99")}
    return fr.table(spark, sf, "orders").select(*[
        fields.get(name, F.lit(None).cast("string")).alias(name)
        for name in k.RECORD_FIELDS])


RAW_RECORDS = """raw AS (
  SELECT CASE WHEN o_orderkey % 29 = 0 THEN 'not-a-date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS fecha,
    CASE WHEN o_orderkey % 31 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS indicativo,
    o_orderpriority AS nombre, o_orderstatus AS provincia, CAST(o_orderkey AS VARCHAR) AS altitud,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS tmed,
    CASE WHEN o_orderkey % 3 = 0 THEN 0.05 WHEN o_orderkey % 5 = 0 THEN NULL ELSE 0.0 END::DOUBLE AS prec,
    CASE WHEN o_orderkey % 4 = 0 THEN '99' END AS dir FROM orders)"""
_VALID = ["fecha", "indicativo", "nombre", "provincia", "altitud", "tmed", "prec", "dir"]


@query(f"""WITH {RAW_RECORDS}
SELECT try_cast(fecha AS DATE) AS fecha, indicativo, nombre, provincia, altitud, tmed, prec, dir
FROM raw WHERE try_cast(fecha AS DATE) >= DATE '1996-01-01' AND indicativo IS NOT NULL""")
def valid_records(spark: SparkSession, sf: str) -> DataFrame:
    typed = records.valid_records(raw_records(spark, sf), start="1996-01-01")
    return typed.select(*_VALID)


@query(f"""WITH {RAW_RECORDS}
SELECT altitud, fecha, indicativo FROM raw WHERE try_cast(fecha AS DATE) IS NULL OR indicativo IS NULL""")
def rejected_records(spark: SparkSession, sf: str) -> DataFrame:
    return records.rejected_records(raw_records(spark, sf)).select(
        "altitud", "fecha", "indicativo")
