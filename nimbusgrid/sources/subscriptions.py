"""Alert subscriptions: scan, id check, upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid.sources import storage

SCHEMA = ("telegram_id string, station_code string, station_name string, active boolean, "
          "created_at timestamp, updated_at timestamp")


def load(spark: SparkSession, path: str) -> DataFrame:
    """Subscriptions from a JSON list; a missing or corrupt file reads as empty."""
    if not storage.path_exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(SCHEMA).option("multiLine", True).json(path)
    return rows.filter(F.col("telegram_id").isNotNull())


def clean_id(text: Column) -> Column:
    """Trimmed digits-only id, null when it is anything else."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike("^[0-9]+$"), trimmed)


def upsert(base: DataFrame, changes: DataFrame) -> DataFrame:
    """Apply (telegram_id, station_code, station_name, at) changes.

    A known id takes the station of its latest change and keeps ``active`` and ``created_at``; a
    new id starts active.  Several changes to one id fold map-side before the join.
    """
    latest = F.max_by(F.struct("station_code", "station_name"),
                      F.struct("at", "station_code", "station_name"))
    folded = changes.groupBy("telegram_id").agg(
        latest.alias("_new"), F.min("at").alias("_first"), F.max("at").alias("_last"))
    joined = base.join(folded, "telegram_id", "full")
    changed = F.col("_new").isNotNull()
    return joined.select(
        "telegram_id",
        F.when(changed, F.col("_new.station_code")).otherwise(F.col("station_code"))
        .alias("station_code"),
        F.when(changed, F.col("_new.station_name")).otherwise(F.col("station_name"))
        .alias("station_name"),
        F.coalesce("active", F.lit(True)).alias("active"),
        F.coalesce("created_at", "_first").alias("created_at"),
        F.coalesce("_last", "updated_at").alias("updated_at"),
    )
