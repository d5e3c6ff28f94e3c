"""Incremental landing and compaction of record batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from nimbusgrid import constants as k
from nimbusgrid.operators.panel import keep_first
from nimbusgrid.session import stage
from nimbusgrid.sources import records, storage
from nimbusgrid.sources.landing import between


def record_stream(spark: SparkSession, path: str, start: str = k.START_DATE) -> DataFrame:
    """Typed records from line-delimited JSON files as they arrive, tagged with their file."""
    raw = spark.readStream.schema(records.RAW_SCHEMA).json(path)
    tagged = raw.withColumn("batch_id", F.col("_metadata.file_name"))
    return records.valid_records(tagged, start, keep=["batch_id"])


def land(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived, then stop; rerun to pick up what came since."""
    return (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(path))


def master_part(spark: SparkSession, master: str, batch: DataFrame, partition_by: str) -> DataFrame:
    """The master's rows in the partitions that ``batch`` touches; others are not read."""
    known = between(spark.read.schema(batch.schema).parquet(master), partition_by, batch)
    return known.join(batch.select(partition_by).distinct(), partition_by, "left_semi")


def compact_into(stream: DataFrame, master: str, checkpoint: str, *, keys: Sequence[str],
                 newest_first: Sequence[str], partition_by: str) -> StreamingQuery:
    """Keep the newest row per key in a partitioned master table.

    Each micro-batch is merged with the master partitions it touches and those alone are
    rewritten.  The ordering columns stay in the master, so a replayed batch changes nothing.
    """
    spark = stream.sparkSession

    def merge(arrived: DataFrame, _: int) -> None:
        batch = stage(arrived, "arrived")  # read twice below
        rows = batch
        if storage.has_files(spark, master):
            rows = batch.unionByName(master_part(spark, master, batch, partition_by))
        newest = keep_first(rows, keys, [F.desc(c) for c in newest_first])
        (stage(newest, "merge").repartitionByRange(partition_by, *keys)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition_by).parquet(master))

    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
