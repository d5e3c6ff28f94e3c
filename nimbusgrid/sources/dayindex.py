"""A bitmap index of observed days, kept up to date by each landed batch.

One row holds 64 days of a series as the bits of a number: ``word`` is the day number (days since
1970-01-01) over 64, bit ``i`` its i-th day.  Bitmaps merge by OR, so a batch adds its own words and reads
neither records nor the index; a batch that lands twice, or days that were known, change nothing.
Readers merge what they find.  (Spark's own bitmap aggregates hold 4 KB for every bucket, many times a
series' days; words hold eight bytes and merge by the same rule.)

``fold`` puts the batches together.  A folded copy beside the batches it was made of is harmless, so a fold
that was cut short needs no repair.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid import DATE, SERIES
from nimbusgrid.session import stage
from nimbusgrid.sources import storage


def _number(day: Column) -> Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date"))


def _word(day: Column) -> Column:
    return F.shiftright(_number(day), 6)


def day_words(records: DataFrame, *, series: str = SERIES, date: str = DATE) -> DataFrame:
    """(series, word, bits) of the days in ``records``; rows without a day are left out."""
    numbered = records.filter(F.col(date).isNotNull()).select(
        series, _word(F.col(date)).alias("word"), _number(F.col(date)).bitwiseAND(F.lit(63)).alias("_bit"))
    return numbered.groupBy(series, "word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("bits"))


def add_batch(batch: DataFrame, path: str, batch_id: str, *, series: str = SERIES, date: str = DATE) -> None:
    """Add a landed batch's days; the same batch again takes its own place."""
    day_words(batch, series=series, date=date).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_index(spark: SparkSession, path: str, *, series: str = SERIES) -> DataFrame:
    """(series, word, bits), merged over batches."""
    return spark.read.parquet(path).groupBy(series, "word").agg(F.bit_or("bits").alias("bits"))


def fold(spark: SparkSession, path: str, *, series: str = SERIES) -> None:
    """Put all batches together in one sorted table; batches that land meanwhile stay."""
    parts = spark.read.parquet(path)
    files = parts.inputFiles()
    whole = stage(parts.groupBy(series, "word").agg(F.bit_or("bits").alias("bits")), "days")
    whole.repartitionByRange(series, "word").sortWithinPartitions(series, "word").write.parquet(
        f"{path}/batch=folded-{uuid.uuid4().hex}")
    storage.delete_files(spark, files)


def _since(word: Column, first: Column) -> Column:
    """Bits of the days of ``word`` from ``first`` on."""
    skipped = F.least(F.greatest(first - word * 64, F.lit(0)), F.lit(64)).cast("int")
    return F.when(skipped >= 64, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(-1).cast("long"), skipped))


def _within(word: Column, first: Column, last: Column) -> Column:
    """Bits of the days of ``word`` from ``first`` to ``last``, as day numbers."""
    return _since(word, first).bitwiseAND(F.bitwise_not(_since(word, last + 1)))


def coverage(index: DataFrame, start, end, *, since=None, series: str = SERIES) -> DataFrame:
    """Observed days per series over ``datediff(end, start)``, as ``operators.panel.coverage`` counts them.

    ``since`` leaves earlier days out, as the start date does when records are read.
    """
    first, last = (F.lit(x).cast("date") for x in (start, end))
    bits = F.col("bits") if since is None else F.col("bits").bitwiseAND(_since(F.col("word"), _number(F.lit(since).cast("date"))))
    days = index.groupBy(series).agg(F.sum(F.bit_count(bits)).cast("long").alias("days")).filter("days > 0")
    return days.select(series, "days", (F.col("days") / F.datediff(last, first)).alias("coverage"))


def gaps(index: DataFrame, planned: DataFrame, *, first: str = "window_start", last: str = "window_end",
         series: str = SERIES) -> DataFrame:
    """The planned windows on none of whose days a series was observed.

    A window meets the words of its series, one row each, so neither records nor days are listed.  Spark takes
    exploded windows for as small as the table of series they come from: the join is told not to broadcast.
    """
    start, stop = F.col("_first"), F.col("_last")
    held = index.groupBy(F.col(series).alias("_series")).agg(F.collect_list(F.struct("word", "bits")).alias("_words"))
    ends = planned.withColumns({"_first": _number(F.col(first)), "_last": _number(F.col(last))})
    met = ends.join(held.hint("merge"), F.col(series) == F.col("_series"), "left")
    seen = F.exists("_words", lambda w: w["bits"].bitwiseAND(_within(w["word"], start, stop)) != 0)
    return met.filter(~F.coalesce(seen, F.lit(False))).select(*planned.columns)


def missing_days(index: DataFrame, start, end, *, series: str = SERIES, date: str = DATE) -> DataFrame:
    """(series, day): days of the calendar without an observation, for every series in the index."""
    first, last = (_number(F.lit(x).cast("date")) for x in (start, end))
    words = index.select(series).distinct().withColumn("word", F.explode(F.sequence(F.shiftright(first, 6), F.shiftright(last, 6))))
    empty = words.join(index, [series, "word"], "left").withColumn(
        "_empty", F.bitwise_not(F.coalesce("bits", F.lit(0).cast("long"))).bitwiseAND(_within(F.col("word"), first, last)))
    bit = F.explode(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit(F.col("_empty"), i) == 1))
    return empty.select(series, "word", bit.alias("_bit")).select(
        series, F.date_add(F.lit("1970-01-01").cast("date"), (F.col("word") * 64 + F.col("_bit")).cast("int")).alias(date))
