"""Running totals and exact quantiles in value order, without a global sort in one task.

A window without a partition would send every distinct value to one task.  Here the values are
range partitioned in order and written with the number of their partition; each partition is
totalled on its own, the few totals are accumulated, and rows add their partition's offset.
Spark picks the borders from a sample; they decide only how work is spread, so results are exact
for any borders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nimbusgrid.session import stage


def running_totals(df: DataFrame, value: str, totals: Sequence[str], *, by: Sequence[str] = (),
                   descending: bool = False, following: bool = False,
                   partitions: int | None = None) -> DataFrame:
    """Add ``{t}_before`` (sum over all rows earlier in value order) and ``{t}_all``; with
    ``following`` also ``{t}_next``, the total of the next row in order.

    ``df`` holds one row per (by, value).  With ``by`` each group is ordered on its own; a large
    group spans many partitions.  The rows are written to the shared folder when this is called,
    so whatever they were computed from (model scores, say) runs once.
    """
    by, totals = list(by), list(totals)
    order = F.desc if descending else F.asc
    count = partitions or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stage(df.repartitionByRange(count, *by, order(value))
                   .withColumn("_part", F.spark_partition_id()), "ranked")

    group = [F.col(c) for c in by] or [F.lit(0)]
    # At most one row per group and partition from here to the join.
    across = Window.partitionBy(*group).orderBy("_part")
    head = (F.max_by if descending else F.min_by)(F.struct(*totals), value)
    summed = placed.groupBy(*by, "_part").agg(
        *[F.sum(t).alias(t) for t in totals], *([head.alias("_head")] if following else []))
    offsets = summed.select(*by, "_part", *[
        F.coalesce(F.sum(t).over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias(f"_{t}_offset") for t in totals
    ], *[F.sum(t).over(Window.partitionBy(*group)).alias(f"{t}_all") for t in totals],
        *([F.lead("_head").over(across).alias("_next_head")] if following else []))

    inside = Window.partitionBy(*by, "_part").orderBy(order(value))
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(offsets, [*by, "_part"], "left").select(
        *df.columns,
        *[(F.col(f"_{t}_offset") + F.coalesce(F.sum(t).over(earlier), F.lit(0)))
          .alias(f"{t}_before") for t in totals],
        *[f"{t}_all" for t in totals],
        *([F.coalesce(F.lead(t).over(inside), F.col(f"_next_head.{t}")).alias(f"{t}_next")
           for t in totals] if following else []),
    )


def exact_quantiles(df: DataFrame, value: str, probabilities: dict[str, float], *,
                    by: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles as columns, one row per group.

    Equal values are counted together before any shuffle of rows; null values are left out.
    """
    by = list(by)
    counted = (df.filter(F.col(value).isNotNull()).groupBy(*by, value)
               .agg(F.count(F.lit(1)).alias("n")))
    ranked = running_totals(counted, value, ["n"], by=by, partitions=partitions)

    def at(rank: Column) -> Column:
        holds = (F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n"))
        return F.max(F.when(holds, F.col(value)))

    place = {name: (F.col("n_all") - 1) * p for name, p in probabilities.items()}
    ends = ranked.groupBy(*by).agg(
        *[at(F.floor(x)).alias(f"_{n}_low") for n, x in place.items()],
        *[at(F.ceil(x)).alias(f"_{n}_high") for n, x in place.items()],
        *[F.max(x - F.floor(x)).alias(f"_{n}_part") for n, x in place.items()],
    )
    return ends.select(*by, *[
        (F.col(f"_{n}_low") + (F.col(f"_{n}_high") - F.col(f"_{n}_low")) * F.col(f"_{n}_part"))
        .alias(n) for n in probabilities])
