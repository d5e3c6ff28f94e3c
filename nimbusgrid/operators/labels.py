"""Dense alphabetical labels for series keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nimbusgrid import SERIES
from nimbusgrid.session import stage

_ROW_BITS = 33


def label_series(df: DataFrame, *, series: str = SERIES, name: str = "station_id") -> DataFrame:
    """(series, label) with labels 0, 1, 2, ... in alphabetical order.

    The distinct keys are range-sorted and staged with their partition and place, so neither the
    driver nor one task sees them all; labels add each partition's offset, one row per partition.
    """
    keys = df.select(series).filter(F.col(series).isNotNull()).distinct().orderBy(series)
    placed = stage(keys.withColumn("_id", F.monotonically_increasing_id()), "labels").select(
        series, F.shiftright("_id", _ROW_BITS).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_place"))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return placed.join(F.broadcast(offsets), "_part").select(
        series, (F.col("_base") + F.col("_place")).cast("int").alias(name))
