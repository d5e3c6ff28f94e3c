"""Yearly masters read without compaction: landed turns are merged as they are read.

A root folder holds three tables:

* ``landed``: the rows of each landing's batches, by ``turn``, the landing's number, and year;
* ``master``: rows of the (series, year) pairs that a compaction rewrote, by ``gen``, its number,
  and year;
* ``pairs``: (series, year, rows, upto) of these pairs by ``gen``; ``upto`` is the last turn that
  went in.

A pair's rows are those of its newest ``gen``, overridden by what landed after ``upto``.  Compacting
appends a ``gen`` that holds the pairs over a rule, and no others; ``pairs`` is written last, so a
run that was cut short leaves nothing that is read, and can be repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid import DATE, SERIES
from nimbusgrid.operators.panel import keep_first
from nimbusgrid.session import discard, staging_path
from nimbusgrid.sources import storage

#: Pairs that are sent to every executor, some 30 bytes each; more are joined by a shuffle.
BROADCAST_PAIRS = 1 << 20


def _read(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    path = f"{root}/{table}"
    return spark.read.parquet(path) if storage.has_files(spark, path) else None


def _few(pairs: DataFrame) -> DataFrame:
    return F.broadcast(pairs) if pairs.count() <= BROADCAST_PAIRS else pairs


def land(batch: DataFrame, root: str, turn: int) -> None:
    """Write a tagged batch (``landing.as_batch``) as ``turn``; landing it again replaces it.

    A turn that a compaction has passed is closed, since its pairs would not be merged again.
    """
    spark = batch.sparkSession
    pairs = _read(spark, root, "pairs")
    if pairs is not None and pairs.where(F.col("upto") >= turn).limit(1).count():
        raise ValueError(f"turn {turn} is compacted; land in a later one")
    batch.write.mode("overwrite").partitionBy("year").parquet(f"{root}/landed/turn={turn}")


def _newest(pairs: DataFrame, series: str) -> DataFrame:
    newest = F.max_by(F.struct("gen", "rows", "upto"), "gen").alias("n")
    return pairs.groupBy(series, "year").agg(newest).select(
        series, "year", F.col("n.gen").alias("gen"), F.col("n.rows").alias("base_rows"), F.col("n.upto").alias("upto"))


def _open(spark: SparkSession, root: str, series: str, upto: int | None = None) -> DataFrame | None:
    """Landed rows that no compaction has taken in, with ``base_rows`` of their pair."""
    landed, pairs = _read(spark, root, "landed"), _read(spark, root, "pairs")
    if landed is None:
        return None
    if upto is not None:
        landed = landed.where(F.col("turn") <= upto)
    if pairs is None:
        return landed.withColumn("base_rows", F.lit(0).cast("bigint"))
    newest = _newest(pairs, series).drop("gen")
    return (landed.join(_few(newest), [series, "year"], "left")
            .where(F.col("turn") > F.coalesce("upto", F.lit(-1))).drop("upto").fillna(0, ["base_rows"]))


def _master(spark: SparkSession, root: str, series: str) -> DataFrame | None:
    """Rows of each compacted pair at its newest generation."""
    master, pairs = _read(spark, root, "master"), _read(spark, root, "pairs")
    if master is None or pairs is None:
        return None
    return master.join(_few(_newest(pairs, series).select(series, "year", "gen")), [series, "year", "gen"], "left_semi").drop("gen")


def _merged(rows: DataFrame, known: DataFrame | None, series: str, date: str) -> DataFrame:
    """Last writer wins: later turn, then later batch, then later position; the master loses."""
    if known is not None:
        rows = rows.unionByName(known.withColumns({
            "turn": F.lit(-1), "batch_id": F.lit(""), "position": F.lit(0).cast("bigint")}))
    newest_first = [F.desc("turn"), F.desc("batch_id"), F.desc("position")]
    return keep_first(rows, [series, "year", date], newest_first).drop("turn", "batch_id", "position")


def read(spark: SparkSession, root: str, *, series: str = SERIES, date: str = DATE) -> DataFrame:
    """One row per (series, year, day), as a compaction of everything landed would leave it.

    Pairs without newer rows pass from the master as they are; only the others are shuffled.
    Raises ``ValueError`` where nothing has landed.
    """
    rows, known = _open(spark, root, series), _master(spark, root, series)
    if known is None:
        if rows is None:
            raise ValueError(f"nothing has landed in {root}")
        return _merged(rows.drop("base_rows"), None, series, date)
    if rows is None:
        return known
    touched = _few(rows.select(series, "year").distinct())
    merged = _merged(rows.drop("base_rows"), known.join(touched, [series, "year"], "left_semi"), series, date)
    return known.join(touched, [series, "year"], "left_anti").unionByName(merged)


def due_pairs(rows: DataFrame, share: float, series: str) -> DataFrame:
    """Pairs whose landed rows are more than ``share`` of their rows in the master; new pairs always are.

    Rows without a series or year are never compacted; readers merge them.
    """
    return (rows.where(F.col(series).isNotNull() & F.col("year").isNotNull()).groupBy(series, "year").agg(F.count("*").alias("landed_rows"), F.first("base_rows").alias("base_rows"))
            .where(F.col("landed_rows") > share * F.col("base_rows")).select(series, "year"))


def compact(spark: SparkSession, root: str, *, share: float = 0.1, series: str = SERIES, date: str = DATE) -> int | None:
    """Rewrite the pairs over the rule as a generation of the master; its number, or None if no pair is.

    Later turns that land meanwhile stay open.
    """
    landed, pairs = _read(spark, root, "landed"), _read(spark, root, "pairs")
    if landed is None:
        return None
    upto = landed.agg(F.max("turn")).first()[0]
    gen = 0 if pairs is None else pairs.agg(F.max("gen")).first()[0] + 1
    rows = _open(spark, root, series, upto)
    path = staging_path(spark, "due-pairs")
    due_pairs(rows, share, series).write.parquet(path)
    due = spark.read.schema(rows.select(series, "year").schema).parquet(path)
    if due.isEmpty():
        discard(spark, path)
        return None
    few = _few(due)
    known = _master(spark, root, series)
    merged = _merged(rows.drop("base_rows").join(few, [series, "year"], "left_semi"),
                     None if known is None else known.join(few, [series, "year"], "left_semi"), series, date)
    (merged.repartitionByRange("year", series, date).sortWithinPartitions("year", series, date)
     .write.mode("overwrite").partitionBy("year").parquet(f"{root}/master/gen={gen}"))
    written = spark.read.parquet(f"{root}/master/gen={gen}")
    (written.groupBy(series, "year").agg(F.count("*").alias("rows")).withColumn("upto", F.lit(upto))
     .write.mode("overwrite").parquet(f"{root}/pairs/gen={gen}"))
    discard(spark, path)
    return gen


def vacuum(spark: SparkSession, root: str, *, series: str = SERIES) -> list[str]:
    """Remove turns and generations that no pair needs; only while nothing is read.  Their folders."""
    pairs, landed, master = (_read(spark, root, t) for t in ("pairs", "landed", "master"))
    if pairs is None:
        return []
    gone = []
    if landed is not None:
        needed = {r[0] for r in _open(spark, root, series).select("turn").distinct().collect()}
        closed = pairs.agg(F.max("upto")).first()[0]
        gone += [f"{root}/landed/turn={r[0]}" for r in landed.select("turn").distinct().collect()
                 if r[0] not in needed and r[0] <= closed]
    if master is not None:
        used = {r[0] for r in _newest(pairs, series).select("gen").distinct().collect()}
        gone += [f"{root}/master/gen={r[0]}" for r in master.select("gen").distinct().collect() if r[0] not in used]
    discard(spark, *gone)
    return sorted(gone)
