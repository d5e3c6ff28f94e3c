"""Reanalysis payloads: one row of parallel arrays per series, decoded to daily rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbusgrid import DATE, SERIES
from nimbusgrid.functions.scalars import bounded, rint_to


def decode(payload: DataFrame, *, series: str = SERIES, date: str = DATE,
           shift_hours: int = 6) -> DataFrame:
    """Rows (series, day, sol, om_prec, presion, nubes) from ``sunshine`` (s), ``precipitation``,
    ``pressure`` and ``cloud`` arrays on the epoch axis ``start``, ``start+step``, ... < ``end``.

    Axis and arrays are cut to the shorter of axis and sunshine; times are moved ``shift_hours``
    on and floored to the day.
    """
    axis = F.when(F.col("start") < F.col("end"),
                  F.sequence(F.col("start"), F.col("end") - 1, F.col("step")))
    sized = payload.withColumn("_t", axis).withColumn(
        "_n", F.least(F.size("_t"), F.size("sunshine")))
    arrays = ["_t", "sunshine", "precipitation", "pressure", "cloud"]
    rows = sized.select(series, F.inline(F.arrays_zip(*[
        F.slice(c, F.lit(1), F.col("_n")).alias(c) for c in arrays])))
    # Whole days since the epoch, so the session time zone plays no part.
    day = F.floor((F.col("_t") + shift_hours * 3600) / 86400).cast("int")
    return rows.select(
        series,
        F.date_from_unix_date(day).alias(date),
        bounded(rint_to(F.col("sunshine") / 3600.0, 2), 0).alias("sol"),
        bounded(rint_to(F.col("precipitation"), 1), 0).alias("om_prec"),
        rint_to(F.col("pressure"), 1).alias("presion"),
        bounded(rint_to(F.col("cloud"), 0), 0, 100).alias("nubes"),
    )
