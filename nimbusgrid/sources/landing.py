"""Planned requests, landed partial batches and their compaction into yearly masters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid import DATE, SERIES
from nimbusgrid import constants as k
from nimbusgrid.functions.scalars import sanitize_name, stamp
from nimbusgrid.operators.panel import keep_first
from nimbusgrid.session import stage
from nimbusgrid.sources import storage


def station_folder(code: Column, name: Column) -> Column:
    return F.concat(F.lit("Station_"), code, F.lit("_"), sanitize_name(name))


def request_windows(stations: DataFrame, start: str = k.START_DATE, end: str = k.END_DATE,
                    months: int = k.REQUEST_MONTHS) -> DataFrame:
    """Every station's download windows: ``months`` long from ``start``, clamped to ``end``.

    A window opens ``months`` after the one before it opened, so the end of a short month, once
    reached, sets the day of all that follow (31 August, 28 February, 28 August).
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    steps = F.greatest(F.ceil(F.months_between(last, first) / months).cast("int") + 1, F.lit(1))
    starts = F.aggregate(F.sequence(F.lit(1), steps), F.array(first), lambda opened, _: F.concat(
        opened, F.array(F.add_months(F.element_at(opened, -1), months))))
    opened = stations.withColumn("window_start", F.explode(starts))
    return opened.filter(F.col("window_start") < last).withColumn(
        "window_end", F.least(F.date_sub(F.add_months("window_start", months), 1), last))


def clamp_request(df: DataFrame, start: str = "start", end: str = "end",
                  today: Column | None = None) -> DataFrame:
    """Drop requests that start in the future, end the rest no later than today."""
    now = F.current_date() if today is None else today
    return df.filter(F.col(start) <= now).withColumn(end, F.least(F.col(end), now))


def gap_ledger(planned: DataFrame, landed: DataFrame,
               keys: Sequence[str] = (SERIES, "window_start")) -> DataFrame:
    """Planned windows for which nothing landed."""
    return planned.join(landed.select(*keys).distinct(), list(keys), "left_anti")


def as_batch(records: DataFrame, window_start: Column, window_end: Column,
             position: Column) -> DataFrame:
    """Tag records with their batch; a batch belongs to the year its window starts in."""
    return records.withColumns({
        "batch_id": F.concat(F.lit("part_"), stamp(window_start), F.lit("_"), stamp(window_end)),
        "year": F.year(window_start),
        "position": position,
    })


def land_batch(batch: DataFrame, path: str) -> None:
    """Append a tagged batch to the landing table."""
    batch.write.mode("append").partitionBy("year").parquet(path)


def compact(landed: DataFrame, *, series: str = SERIES, date: str = DATE) -> DataFrame:
    """Last writer wins per (series, year, day): later batch first, then later position."""
    return keep_first(landed, [series, "year", date], [F.desc("batch_id"), F.desc("position")])


def between(rows: DataFrame, column: str, like: DataFrame) -> DataFrame:
    """``rows`` cut to the range of ``column`` in ``like``: constants, so they prune a partitioned scan."""
    low, high = like.agg(F.min(column), F.max(column)).first()
    return rows.filter(F.col(column).between(F.lit(low), F.lit(high)))


def consolidate(spark: SparkSession, landing: str, master: str, *,
                include_existing: bool = True, remove_parts: bool = True,
                series: str = SERIES, date: str = DATE) -> None:
    """Compact the landing table into yearly masters and drop the parts that went in.

    Landed records win over those of the master on the same day.  Without ``include_existing`` the
    landed (series, year) pairs are replaced as a whole; all other pairs of those years stay either
    way.  Only the years between the first and the last landed are read and rewritten.  The result
    is staged before the overwrite, so a failed run can be repeated; parts that land meanwhile are
    left for the next, and without any part nothing happens.
    """
    if not storage.has_files(spark, landing):
        return
    landed = spark.read.parquet(landing)
    parts = landed.inputFiles()
    if storage.has_files(spark, master):
        known = between(spark.read.parquet(master), "year", landed)
        if not include_existing:
            known = known.join(landed.select(series, "year").distinct(), [series, "year"], "left_anti")
        known = known.withColumns({"batch_id": F.lit(""), "position": F.lit(0).cast("bigint")})
        landed = landed.unionByName(known, allowMissingColumns=True)
    result = stage(compact(landed, series=series, date=date).drop("batch_id", "position"),
                   "consolidate")
    # By range: balanced whatever the years hold, and few files per year.
    (result.repartitionByRange("year", series, date).sortWithinPartitions("year", series, date)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("year").parquet(master))
    if remove_parts:
        storage.delete_files(spark, parts)
