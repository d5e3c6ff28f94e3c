"""Tables at rest: panel and forecast sinks, scans, safe replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbusgrid import DATE, SERIES
from nimbusgrid.functions.scalars import no_nan
from nimbusgrid.session import stage


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _filesystem(spark, path)
    return fs.exists(target)


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists and holds at least one Parquet file, at any depth."""
    fs, target = _filesystem(spark, path)
    if not fs.exists(target):
        return False
    found = fs.listFiles(target, True)
    while found.hasNext():
        if found.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def delete_files(spark: SparkSession, files: Sequence[str]) -> None:
    """Delete the named files, as a DataFrame lists its inputs, and nothing else."""
    jvm = spark.sparkContext._jvm
    for name in files:  # listed URL-encoded
        target = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, False)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", *,
                sort_by: Sequence[str] = (SERIES, DATE),
                partition_by: Sequence[str] = ()) -> None:
    """Overwrite a table, globally sorted (range partitioned on the whole sort key)."""
    out = df.orderBy(*sort_by) if sort_by else df
    writer = out.write.mode("overwrite").option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: str | T.StructType | None = None) -> DataFrame:
    """Scan a table; NaN in floating columns becomes null."""
    reader = spark.read.format(fmt).option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    floats = [f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: no_nan(F.col(c)) for c in floats}) if floats else df


def replace_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite a table that ``df`` may itself read: the result is staged first."""
    stage(df, "replace").write.mode("overwrite").format(fmt).save(path)


def year_between(date: str, first: int, last: int | None = None):
    """Year predicate as a date range, so it reaches the scan."""
    return F.col(date).between(F.lit(f"{first}-01-01").cast("date"),
                               F.lit(f"{last or first}-12-31").cast("date"))
