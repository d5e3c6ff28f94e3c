"""Helpers the operators of this folder share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nimbusgrid.session import staging_path

WORD = r"[^\x20\x09-\x0D]+"
#: Text handed to a Python task at once.  Long texts make short batches instead of large ones.
BATCH_BYTES = 32 << 20
#: By operator, the dictionary in which its tasks leave things in a Python worker for its next ones.
WORKER_STATES: dict[str, dict] = {}


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return df.select(*columns) if columns else df


def _lean(fn: Callable, batches: Iterator[pa.RecordBatch], state: str | None) -> Iterator[pa.RecordBatch]:
    """``fn`` in a worker that first drops what other operators left there, and gives freed memory back after it."""
    for name, left in WORKER_STATES.items():
        if name != state:
            left.clear()
    try:
        yield from fn(batches)
    finally:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str, state: str | None = None) -> DataFrame:
    """``mapInArrow`` with batches bounded by bytes as well as by rows.

    Workers outlive tasks: of :data:`WORKER_STATES` only ``state`` stays for the next task.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return df.mapInArrow(lambda batches: _lean(fn, batches, state), schema)


def keep(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read back, with its path for :func:`discard`."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove folders that :func:`keep` wrote once nothing reads them any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


#: Rows of ids that are sent to every executor to pick rows by, some 16 to 32 bytes each.
BROADCAST_IDS = 1 << 20


def picked(rows: DataFrame, ids: DataFrame, on, how: str) -> DataFrame:
    """``rows`` joined with ids (one row each), which are broadcast if they are few, as counted."""
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, on, how)


def uniform(*columns: Column | str, seed: str = "") -> Column:
    """A number in (0, 1) that depends on the columns alone: 48 bits of MD5, as SQL can form too."""
    text = F.concat_ws("|", F.lit(seed), *[F.col(c) if isinstance(c, str) else c for c in columns])
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def sql_crc32(number: str) -> str:
    """SQL for the unsigned crc32 of a number in decimal, which the checking engine has no function for."""
    step = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))"
    letters = f"list_transform(string_split(cast({number} as varchar), ''), lambda x: ord(x)::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {letters}), lambda a, b: {step}), 4294967295)"


def sampled(df: DataFrame, by: Column, rows: int, total: int) -> DataFrame:
    """About ``rows`` of ``total`` rows, chosen by a hash of ``by``: narrow, and alike in reruns."""
    if total <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(by, F.lit("sample")), F.lit(1 << 20)) < int(rows / total * (1 << 20)) + 1)


def text_hash(text: Column) -> Column:
    return F.xxhash64(text, F.lit("sample"))


def drawn_texts(df: DataFrame, text: str, rows: int, by: str | None = None, hashed_as: str | None = None) -> DataFrame:
    """Rows of ``df`` whose text is among the ``rows`` texts of least hash, of each value of ``by``.

    A text counts once however often it is repeated, and texts are drawn alike in reruns.  Distinct
    hashes (column ``drawn``, which :func:`once` reads) are thinned by rate to about twice as many
    as asked before they are ranked, so the ranking is small whatever the table.  ``hashed_as``
    names a column of :func:`text_hash` that was formed before a join, so no text is shuffled for it.
    """
    spark, hashed = df.sparkSession, df.withColumn("drawn", F.col(hashed_as) if hashed_as else text_hash(F.col(text)))
    value = F.col(by) if by else F.lit(0)
    texts, path = keep(hashed.select(value.alias("value"), "drawn").distinct(), "drawn")
    counts = texts.groupBy("value").count().withColumnRenamed("value", "counted")
    share = F.col("drawn") / float(1 << 64) + 0.5
    thin = texts.join(counts, texts["value"].eqNullSafe(counts["counted"])).where(share <= (2 * rows + 64) / F.col("count"))
    rank = F.row_number().over(Window.partitionBy("value").orderBy("drawn"))
    limits = thin.withColumn("rank", rank).where(F.col("rank") <= rows).groupBy("value").agg(F.max("drawn").alias("limit")).collect()
    discard(spark, path)
    if not limits:
        return hashed.where(F.lit(False))
    upto = F.create_map(*[F.lit(v) for r in limits for v in (r["value"], r["limit"])])
    return hashed.where(F.col("drawn") <= upto[value])


def once(batches: Iterator[pa.RecordBatch], *columns: int) -> Iterator[pa.RecordBatch]:
    """The rows a task sees first of each value of ``columns``, which are those drawn, so few."""
    seen: set[tuple] = set()
    for batch in batches:
        fresh = []
        for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in columns))):
            if key not in seen:
                seen.add(key)
                fresh.append(i)
        if fresh:
            yield batch.take(pa.array(fresh))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of the undirected edges, component being the smallest node reachable.

    Alternates the large-star and the small-star step: each is a minimum per node, combined
    before the shuffle, and a join on the node.  Every round is written to the shared folder.
    """
    spark = edges.sparkSession
    current, path = keep(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
                         .where("u <> v and u is not null and v is not null")
                         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                         .distinct(), "edges")
    before = None
    while True:
        both = current.union(current.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        following, next_path = keep(small, "edges")
        state = following.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1000003), F.sum("v")).first()
        discard(spark, path)
        current, path = following, next_path
        if state == before:
            break
        before = state
    return (current.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(current.select("v", "v")).distinct())
