"""Climatology as maintained state: sums and counts per series and day of year, changed by deltas.

The state has (series, month, doy, sum, count) per value column, month kept beside the day of year
because leap years move days between months.  A landed batch is compared with the rows it replaces, and
their difference is appended: new values are added, corrected ones' old values subtracted.  Reading
adds the deltas up; ``fold`` does so in place.  Fills read the state, never the observations.

A batch is applied in two steps, its delta and then the rows.  The delta is written once and by name:
a run that was cut short and is repeated finds it, does not compute it again from rows that may
have changed already, and goes on with the rows, whose replacement can be repeated.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid import DATE, SERIES
from nimbusgrid.operators.panel import keep_first
from nimbusgrid.session import stage
from nimbusgrid.sources import storage
from nimbusgrid.sources.landing import between


def _kept(cols: Sequence[str]) -> list[str]:
    return [f"{kind}_{c}" for c in cols for kind in ("sum", "count")]


def _signed(rows: DataFrame, cols: Sequence[str], sign: int, series: str, date: str) -> DataFrame:
    return rows.select(series, F.month(date).alias("month"), F.dayofyear(date).alias("doy"), *[
        x for c in cols for x in (
            (F.lit(sign) * F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(f"sum_{c}"),
            (F.lit(sign) * F.col(c).isNotNull().cast("long")).alias(f"count_{c}"))])


def _added(rows: DataFrame, cols: Sequence[str], series: str) -> DataFrame:
    return rows.groupBy(series, "month", "doy").agg(*[F.sum(c).alias(c) for c in _kept(cols)])


def delta(batch: DataFrame, replaced: DataFrame, cols: Sequence[str], *, series: str = SERIES, date: str = DATE) -> DataFrame:
    """What the state gains by ``batch``: its values less those of the rows it replaces."""
    gained = _signed(batch, cols, 1, series, date).unionByName(_signed(replaced, cols, -1, series, date))
    some = " or ".join(f"{c} <> 0" for c in _kept(cols))
    return _added(gained, cols, series).filter(some)


def apply_batch(spark: SparkSession, batch: DataFrame, rows: str, state: str, batch_id: str, cols: Sequence[str], *,
                newest_first: Sequence[Column] = (), series: str = SERIES, date: str = DATE) -> None:
    """Replace the batch's (series, day) rows in the table ``rows`` and move the state by the difference.

    A batch has one row per (series, day), or ``newest_first`` says which one counts.  Only the years
    between the batch's first and last day are read and rewritten.
    """
    if newest_first:
        batch = keep_first(batch, [series, date], list(newest_first))
    batch = stage(batch.select(series, date, *cols).withColumn("year", F.year(date)), "batch")
    if not batch.take(1):
        return
    known = None
    if storage.has_files(spark, rows):
        known = between(spark.read.parquet(rows), "year", batch)
    if not storage.path_exists(spark, f"{state}/batch={batch_id}/_SUCCESS"):
        replaced = batch.limit(0) if known is None else known.join(batch.select(series, date), [series, date], "left_semi")
        delta(batch, replaced, cols, series=series, date=date).write.mode("overwrite").parquet(f"{state}/batch={batch_id}")
    merged = batch if known is None else batch.unionByName(known.join(batch.select(series, date), [series, date], "left_anti"))
    merged = stage(merged, "merged")
    (merged.repartitionByRange("year", series, date).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("year").parquet(rows))


def read_state(spark: SparkSession, state: str, cols: Sequence[str], *, series: str = SERIES) -> DataFrame:
    return _added(spark.read.parquet(state), cols, series)


def fold(spark: SparkSession, state: str, cols: Sequence[str], *, series: str = SERIES) -> None:
    """Add all deltas up in one table.

    Deltas do not add twice, so the folded table takes the place of what it was made of in one rename:
    the old folder is moved aside, not deleted, and goes last.
    """
    whole = stage(read_state(spark, state, cols, series=series), "climatology")
    done = [r[0] for r in spark.read.parquet(state).select("batch").distinct().collect()]
    fresh, old = f"{state}-{uuid.uuid4().hex}", f"{state}-{uuid.uuid4().hex}"
    whole.repartitionByRange(series).sortWithinPartitions(series, "month", "doy").write.parquet(f"{fresh}/batch=folded")
    empty = whole.limit(0)
    for name in done:  # a repeated batch still finds its delta
        if name != "folded":
            empty.write.parquet(f"{fresh}/batch={name}")
    fs, target = storage._filesystem(spark, state)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs.rename(target, path(old))
    fs.rename(path(fresh), target)
    fs.delete(path(old), True)


def means(state: DataFrame, cols: Sequence[str], start, end, *, series: str = SERIES) -> tuple[DataFrame, DataFrame]:
    """((series, doy, means), (series, month, means)) of a calendar from ``start`` to ``end``.

    The month's mean is over values as filled by day of year, so every calendar day without a value
    counts with its day's mean: calendar days less observed ones, by month and day of year.
    """
    by_day = state.groupBy(series, "doy").agg(*[F.sum(c).alias(c) for c in _kept(cols)]).select(
        series, "doy", *[F.when(F.col(f"count_{c}") > 0, F.col(f"sum_{c}") / F.col(f"count_{c}")).alias(f"mean_{c}") for c in cols])
    spark = state.sparkSession
    calendar = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day"))
    calendar = calendar.groupBy(F.month("day").alias("month"), F.dayofyear("day").alias("doy")).agg(F.count("*").alias("days"))
    every = state.select(series).distinct().join(F.broadcast(calendar))  # at most 732 rows a series
    filled = every.join(state, [series, "month", "doy"], "left").join(by_day, [series, "doy"], "left")

    def month_mean(c: str) -> Column:
        own, seen = F.coalesce(f"sum_{c}", F.lit(0.0)), F.coalesce(f"count_{c}", F.lit(0))
        filling = F.when(F.col(f"mean_{c}").isNotNull(), F.col("days") - seen).otherwise(0)
        total = F.sum(own + filling * F.coalesce(f"mean_{c}", F.lit(0.0)))
        count = F.sum(seen + filling)
        return F.when(count > 0, total / count).alias(f"mean_{c}")

    return by_day, filled.groupBy(series, "month").agg(*[month_mean(c) for c in cols])


def fill(df: DataFrame, state: DataFrame, cols: Sequence[str], start, end, *, series: str = SERIES, date: str = DATE) -> DataFrame:
    """Fill gaps with the mean of the day of year, then of the month, from the state.

    Equals ``fill_with_mean`` by day of year and then by month over the dense panel of that calendar,
    which is what the state's batches should be cut to.
    """
    by_day, by_month = means(state, cols, start, end, series=series)
    named = [f"mean_{c}" for c in cols]
    out = df.withColumns({"doy": F.dayofyear(date), "month": F.month(date)})
    for table, key in ((by_day, "doy"), (by_month, "month")):
        out = out.join(table, [series, key], "left").withColumns(
            {c: F.coalesce(F.col(c), F.col(f"mean_{c}")) for c in cols}).drop(*named)
    return out.select(*df.columns)
