"""Panels derived from the given tables, as Spark frames and as SQL for the checks.

``user_days``     events as a (user, day) panel with natural gaps, 30 days.
``region_days``   orders as a (region, day) panel, 1995-01-01 to 2001-07-31.
``station_days``  line items by supplier nation as a station panel with all measures.
``sky_days``      orders by customer nation as the second daily source of the same stations.
``forecast_days`` station days in the shape of a forecast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from nimbusgrid.operators.panel import daily_mean, densify

EVENT_START, EVENT_END = "2024-01-01", "2024-01-30"
ORDER_START, ORDER_END = "1995-01-01", "2001-07-31"
USER = {"series": "user_id", "date": "day"}
REGION = {"series": "region", "date": "day"}


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table; its schema is read from the files once, not by a job per query."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def r6(c: str, name: str | None = None):
    """Six decimals, in arithmetic both engines do alike.

    The engines' ``round`` differ on ties, and means that end in ...5 sit on a tie give or take
    summation order, so the border between two results lies just off the ties.
    """
    return (F.floor(F.col(c) * 1000000 + 0.5003) / 1000000).alias(name or c)


def s6(expression: str) -> str:
    """``r6`` as SQL."""
    return f"floor(({expression}) * 1000000 + 0.5003) / 1000000"


def _eighths(c):
    """Whole eighths: sums of these are exact in any order, so both engines agree to the bit."""
    return F.floor(c * 8) / 8.0


def dated_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))


def user_days(spark: SparkSession, sf: str) -> DataFrame:
    return daily_mean(dated_events(spark, sf), {"value": F.col("value")}, **USER)


USER_DAYS = """user_days AS (
  SELECT user_id, CAST(ts AS DATE) AS day, avg(value) AS value FROM events GROUP BY 1, 2)"""


def covered_users(spark: SparkSession, sf: str) -> DataFrame:
    return densify(user_days(spark, sf), EVENT_START, EVENT_END, min_coverage=0.85, **USER)


COVERED_USERS = USER_DAYS + """,
covered AS (SELECT user_id FROM user_days GROUP BY 1 HAVING count(DISTINCT day) / 29.0 >= 0.85),
grid AS (
  SELECT user_id, CAST(g.d AS DATE) AS day FROM covered,
    generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY) g(d)),
dense AS (SELECT user_id, day, value FROM grid LEFT JOIN user_days USING (user_id, day))"""


def region_days(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").cast("date").alias("day"),
        "o_totalprice")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("region"))
    rows = orders.join(customers, "c_custkey").join(nations, "c_nationkey")
    return rows.groupBy("region", "day").agg(
        F.floor(F.sum(F.rint(F.col("o_totalprice") * 100)) / 100000).cast("double")
        .alias("revenue"), F.count(F.lit(1)).alias("n"))


REGION_DAYS = """region_days AS (
  SELECT r_name AS region, CAST(o_orderdate AS DATE) AS day,
         floor(sum(round_even(o_totalprice * 100, 0)) / 100000) AS revenue,
         count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1, 2)"""


def dense_regions(spark: SparkSession, sf: str) -> DataFrame:
    return densify(region_days(spark, sf).drop("n"), ORDER_START, ORDER_END, **REGION)


DENSE_REGIONS = REGION_DAYS + """,
regions AS (SELECT DISTINCT region FROM region_days),
grid AS (
  SELECT region, CAST(g.d AS DATE) AS day FROM regions,
    generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-07-31', INTERVAL 1 DAY) g(d)),
dense AS (SELECT region, day, revenue FROM grid LEFT JOIN region_days USING (region, day))"""


def _mean(c: str):
    """Mean from a sum of whole hundredths: the same double whatever the order of rows."""
    return F.sum(F.rint(F.col(c) * 100)) / 100 / F.count(F.lit(1))


def _mean_sql(c: str) -> str:
    return f"sum(round_even({c} * 100, 0)) / 100 / count(*)"


def station_days(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"), F.col("l_shipdate").cast("date").alias("fecha"),
        "l_quantity", "l_discount", "l_tax")
    suppliers = table(spark, sf, "supplier").select(
        "s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    nations = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name")
    # Rows are folded per (supplier nation, day) before the names are attached.
    daily = (items.join(suppliers, "s_suppkey").groupBy("n_nationkey", "fecha").agg(
        _mean("l_quantity").alias("q"), _mean("l_discount").alias("d"), _mean("l_tax").alias("t"),
        F.min("l_quantity").alias("q_low"), F.max("l_quantity").alias("q_high"),
        F.max("l_tax").alias("t_high"), F.count(F.lit(1)).alias("n")))
    return daily.join(nations, "n_nationkey").select(
        "fecha", F.col("n_name").alias("indicativo"), F.col("n_name").alias("nombre"),
        F.col("r_name").alias("provincia"),
        (F.col("n_nationkey") * 10).cast("string").alias("altitud"),
        (_eighths(F.col("q")) - 10).alias("tmed"),
        F.when(F.col("d") > 0.06, F.floor("q") / 8.0).otherwise(F.lit(0.0)).alias("prec"),
        (F.col("q_low") - 12).alias("tmin"), (F.col("q_high") - 5).alias("tmax"),
        F.when(F.col("n") % 7 == 0, "Varias").otherwise((F.col("n") * 30 % 360).cast("string"))
        .alias("dir"),
        F.when(F.col("n") % 5 != 0, _eighths(F.col("t") * 100)).alias("velmedia"),
        _eighths(F.col("t_high") * 200).alias("racha"),
        F.when(F.col("q") < 45, _eighths(F.col("d") * 1000)).alias("hrMedia"))


STATION_DAYS = f"""station_days AS (
  SELECT fecha, n_name AS indicativo, n_name AS nombre, r_name AS provincia,
    CAST(n_nationkey * 10 AS VARCHAR) AS altitud, floor(q * 8) / 8 - 10 AS tmed,
    CASE WHEN d > 0.06 THEN floor(q) / 8 ELSE 0 END AS prec, q_low - 12 AS tmin, q_high - 5 AS tmax,
    CASE WHEN n % 7 = 0 THEN 'Varias' ELSE CAST(n * 30 % 360 AS VARCHAR) END AS dir,
    CASE WHEN n % 5 <> 0 THEN floor(t * 100 * 8) / 8 END AS velmedia,
    floor(t_high * 200 * 8) / 8 AS racha,
    CASE WHEN q < 45 THEN floor(d * 1000 * 8) / 8 END AS "hrMedia"
  FROM (SELECT s_nationkey AS n_nationkey, CAST(l_shipdate AS DATE) AS fecha,
      {_mean_sql("l_quantity")} AS q,
      {_mean_sql("l_discount")} AS d,
      {_mean_sql("l_tax")} AS t,
      min(l_quantity) AS q_low, max(l_quantity) AS q_high, max(l_tax) AS t_high, count(*) AS n
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
  JOIN nation USING (n_nationkey) JOIN region ON n_regionkey = r_regionkey)"""


def sky_days(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").cast("date").alias("fecha"),
        "o_totalprice")
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    nations = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("indicativo"))
    daily = orders.join(customers, "c_custkey").groupBy("n_nationkey", "fecha").agg(
        _mean("o_totalprice").alias("p"), F.count(F.lit(1)).alias("n"))
    return daily.join(nations, "n_nationkey").select(
        "fecha", "indicativo", _eighths(F.col("p") / 20000).alias("sol"),
        (_eighths(F.col("p") / 5000) + 990).alias("presion"),
        (F.col("n") * 23 % 101.0).alias("nubes"),
        F.when(F.col("n") % 3 == 0, _eighths(F.col("p") / 100000)).otherwise(F.lit(0.0))
        .alias("om_prec"))


SKY_DAYS = f"""sky_days AS (
  SELECT fecha, n_name AS indicativo, floor(p / 20000 * 8) / 8 AS sol,
    floor(p / 5000 * 8) / 8 + 990 AS presion,
    CAST(n * 23 % 101 AS DOUBLE) AS nubes,
    CASE WHEN n % 3 = 0 THEN floor(p / 100000 * 8) / 8 ELSE 0 END AS om_prec
  FROM (SELECT c_nationkey AS n_nationkey, CAST(o_orderdate AS DATE) AS fecha,
      {_mean_sql("o_totalprice")} AS p, count(*) AS n
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
  JOIN nation USING (n_nationkey))"""


def forecast_days(spark: SparkSession, sf: str) -> DataFrame:
    s = station_days(spark, sf).filter(F.col("hrMedia").isNotNull()
                                       & F.col("velmedia").isNotNull())
    return s.select(
        "fecha", "indicativo", (F.col("hrMedia") / 100).alias("prob_rain"),
        ((F.col("tmed") + 10) / 4).alias("pred_sol"), F.col("hrMedia").alias("pred_hrMedia"),
        F.col("velmedia").alias("pred_velmedia"), F.col("tmed").alias("pred_tmed"),
        F.col("tmin").alias("pred_tmin"), F.col("tmax").alias("pred_tmax"))


FORECAST_DAYS = STATION_DAYS + """,
forecast_days AS (
  SELECT fecha, indicativo, "hrMedia" / 100 AS prob_rain, (tmed + 10) / 4 AS pred_sol,
    "hrMedia" AS "pred_hrMedia", velmedia AS pred_velmedia, tmed AS pred_tmed,
    tmin AS pred_tmin, tmax AS pred_tmax
  FROM station_days WHERE "hrMedia" IS NOT NULL AND velmedia IS NOT NULL)"""
