"""Queries over state that landed batches maintain: day bitmaps, climatology, bracketed quantiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid.operators import quantiles
from nimbusgrid.session import staging_path
from nimbusgrid.sources import climatology, dayindex, landing
from nimbusgrid.workload import frames as fr
from nimbusgrid.workload import panels  # noqa: F401  its SQL checks serve here too
from nimbusgrid.workload.frames import r6, s6
from nimbusgrid.workload.registry import ORACLES, query


def _day_index(spark: SparkSession, rows: DataFrame, number: str, **keys) -> str:
    """An index kept by three batches, the second landed twice, then folded with a fourth of known days."""
    path = staging_path(spark, "days")
    for turn in (0, 1, 1, 2):
        dayindex.add_batch(rows.filter(F.col(number) % 3 == turn), path, f"part-{turn}", **keys)
    dayindex.fold(spark, path, series=keys["series"])
    dayindex.add_batch(rows.filter(F.col(number) % 7 == 0), path, "late", **keys)
    return path


@query(ORACLES["coverage_ratio"])
def indexed_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Coverage per user from the day index alone."""
    path = _day_index(spark, fr.dated_events(spark, sf), "event_id", **fr.USER)
    found = dayindex.coverage(dayindex.read_index(spark, path, series="user_id"), fr.EVENT_START, fr.EVENT_END, series="user_id")
    return found.select("user_id", "days", r6("coverage"))


def _order_days(spark: SparkSession, sf: str) -> DataFrame:
    return fr.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").cast("date").alias("day"))


@query("""WITH planned AS (SELECT c_custkey, CAST(g.w AS DATE) AS window_start,
  least(CAST(g.w + INTERVAL 6 MONTH - INTERVAL 1 DAY AS DATE), DATE '2001-07-31') AS window_end
  FROM customer, generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-07-31', INTERVAL 6 MONTH) g(w)
  WHERE g.w < TIMESTAMP '2001-07-31')
SELECT c_custkey, window_start, window_end FROM planned ANTI JOIN orders
  ON o_custkey = c_custkey AND CAST(o_orderdate AS DATE) BETWEEN window_start AND window_end""")
def indexed_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Half-year windows in which a customer ordered nothing, from the day index alone."""
    path = _day_index(spark, _order_days(spark, sf), "o_orderkey", series="c_custkey", date="day")
    planned = landing.request_windows(fr.table(spark, sf, "customer").select("c_custkey"), fr.ORDER_START, fr.ORDER_END)
    return dayindex.gaps(dayindex.read_index(spark, path, series="c_custkey"), planned, series="c_custkey")


@query("""WITH days AS (SELECT DISTINCT o_custkey AS c_custkey, CAST(o_orderdate AS DATE) AS day FROM orders),
grid AS (SELECT c_custkey, CAST(g.d AS DATE) AS day FROM (SELECT DISTINCT c_custkey FROM days),
  generate_series(TIMESTAMP '1998-02-20', TIMESTAMP '1998-06-10', INTERVAL 1 DAY) g(d))
SELECT c_custkey, day FROM grid ANTI JOIN days USING (c_custkey, day)""")
def indexed_missing_days(spark: SparkSession, sf: str) -> DataFrame:
    """Days of a span on which a known customer ordered nothing, from the day index alone."""
    path = _day_index(spark, _order_days(spark, sf), "o_orderkey", series="c_custkey", date="day")
    index = dayindex.read_index(spark, path, series="c_custkey")
    return dayindex.missing_days(index, "1998-02-20", "1998-06-10", series="c_custkey", date="day")


@query(ORACLES["climatology_fill"])
def maintained_climatology(spark: SparkSession, sf: str) -> DataFrame:
    """Fill from the climatology's state after two batches, of which the first has wrong and empty values, a batch
    of corrections that lands twice, and a fold."""
    within = F.col("day").between(F.lit(fr.ORDER_START).cast("date"), F.lit(fr.ORDER_END).cast("date"))
    days, value = fr.region_days(spark, sf).drop("n").filter(within), F.col("revenue")
    odd = F.dayofmonth("day") % 2 == 1
    wrong = days.filter(odd).withColumn("revenue", F.when(F.dayofmonth("day") == 5, None).otherwise(value + 64))
    rows, state = staging_path(spark, "days"), staging_path(spark, "climatology")
    batches = [("first", wrong), ("second", days.filter(~odd)), ("corrected", days.filter(odd)), ("corrected", days.filter(odd))]
    for name, batch in batches:
        climatology.apply_batch(spark, batch, rows, state, name, ["revenue"], **fr.REGION)
    climatology.fold(spark, state, ["revenue"], series="region")
    kept = climatology.read_state(spark, state, ["revenue"], series="region")
    filled = climatology.fill(fr.dense_regions(spark, sf), kept, ["revenue"], fr.ORDER_START, fr.ORDER_END, **fr.REGION)
    return filled.select("region", "day", r6("revenue"))


_SHARES = {"low": 0.0, "tenth": 0.1, "median": 0.5, "high": 1.0}


@query(f"""SELECT l_returnflag, l_linestatus, {", ".join(s6(f"quantile_cont(abs(l_extendedprice - l_quantity * 1500), {p})") + f" AS {n}" for n, p in _SHARES.items())}
FROM lineitem GROUP BY 1, 2""")
def bracketed_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Exact quantiles of the error of a flat unit price, by flag and status: a sketch, then a small selection."""
    errors = fr.table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", F.abs(F.col("l_extendedprice") - F.col("l_quantity") * 1500).alias("error"))
    found = quantiles.bracketed_quantiles(errors, "error", _SHARES, by=["l_returnflag", "l_linestatus"])
    return found.select("l_returnflag", "l_linestatus", *[r6(c) for c in _SHARES])
