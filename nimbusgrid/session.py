"""Session helpers: the shared folder used for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without the setting (tests, bench) gets a temporary folder; anywhere
    else the setting is required, since a machine-local folder is lost with its machine.
    """
    context = spark.sparkContext
    named = spark.conf.get(_CONF, None)
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_CONF} to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="nimbusgrid-"))
    return context.getCheckpointDir()


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove staged folders that nothing reads any more."""
    for path in paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
