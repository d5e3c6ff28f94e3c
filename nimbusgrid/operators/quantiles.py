"""Exact quantiles by bracketed selection.

A KLL sketch of every group, merged from the tasks' own, brackets each quantile between two values.  The
second pass counts what lies below a bracket, which is one number a task, and moves only the values
inside it; the rank is then selected among those.  A sketch errs with small probability; counting shows
whether the rank lies inside its bracket, and where it does not that bracket is widened, at
last to everything.  So the result is exact whatever the sketch says.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbusgrid.operators.ranking import running_totals
from nimbusgrid.session import stage

#: Size of a sketch, and how far from the rank, as a share of the rows, a bracket's ends are sought.
SKETCH, MARGIN = 1024, 0.006


def sketched(df: DataFrame, value: str, by: Sequence[str], size: int) -> DataFrame:
    """(by, rows, sketch) of every group."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), F.kll_sketch_agg_double(F.col(value), F.lit(size)).alias("_sketch"))


def _ends(probabilities: Mapping[str, float], margin: float) -> tuple[Column, Column]:
    """Lower and upper end of each name's bracket; null where it is open, as for groups smaller than a sketch."""
    low = high = F.lit(None).cast("double")
    for name, p in probabilities.items():
        here = (F.col("_name") == name) & (F.col("_rows") > SKETCH)
        if p - margin > 0:
            low = F.when(here, F.kll_sketch_get_quantile_double("_sketch", F.lit(p - margin))).otherwise(low)
        if p + margin < 1:
            high = F.when(here, F.kll_sketch_get_quantile_double("_sketch", F.lit(p + margin))).otherwise(high)
    return low, high


def bracketed_quantiles(df: DataFrame, value: str, probabilities: Mapping[str, float], *, by: Sequence[str] = (),
                        size: int = SKETCH, margin: float = MARGIN, moved: list[int] | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles as columns, one row per group; null values are left out.

    A null in ``by`` is a group of its own.  ``moved`` collects the number of rows that each pass
    gathered.  The rows of ``df`` are read twice, so it should be stored or cheap.
    """
    by, names = list(by), list(probabilities)
    rows = df.filter(F.col(value).isNotNull()).select(
        *by, F.to_json(F.struct(F.lit(0).alias("_"), *by)).alias("_g"), F.col(value).cast("double").alias("_value"))
    sketches = stage(sketched(rows, "_value", ["_g", *by], size), "sketches")
    wanted = sketches.select("_g", "_rows", "_sketch", F.inline(F.array(*[
        F.struct(F.lit(n).alias("_name"), F.lit(float(p)).alias("_p")) for n, p in probabilities.items()])))
    keys, found = ["_g", "_name"], None
    while True:
        low, high = _ends(probabilities, margin)
        open_ = stage(wanted.select(*keys, "_rows", "_p", low.alias("_low"), high.alias("_high")), "brackets")
        lists = open_.groupBy("_g").agg(F.collect_list(F.struct("_name", "_low", "_high")).alias("_brackets"))
        met = rows.join(lists, "_g").select("_g", "_value", F.inline("_brackets"))
        under = F.coalesce(F.col("_value") < F.col("_low"), F.lit(False))
        inside = ~under & F.coalesce(F.col("_value") <= F.col("_high"), F.lit(True))
        below = stage(met.groupBy(*keys).agg(F.count(F.when(under, 1)).alias("_below")), "below")
        counted = stage(met.filter(inside).groupBy(*keys, "_value").agg(F.count(F.lit(1)).alias("n")), "inside")
        if moved is not None:
            moved.append(counted.agg(F.sum("n")).first()[0] or 0)
        ranked = running_totals(counted, "_value", ["n"], by=keys).join(open_.select(*keys, "_rows", "_p"), keys).join(below, keys)
        place, first = (F.col("_rows") - 1) * F.col("_p"), F.col("_below") + F.col("n_before")

        def at(rank: Column) -> Column:
            return F.max(F.when((first <= rank) & (rank < first + F.col("n")), F.col("_value")))

        got = ranked.groupBy(*keys).agg(at(F.floor(place)).alias("_a"), at(F.ceil(place)).alias("_b"), F.max(place - F.floor(place)).alias("_part"))
        good = stage(got.filter("_a is not null and _b is not null").select(
            *keys, (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part")).alias("_q")), "found")
        found = good if found is None else found.unionByName(good)
        missed = stage(open_.select(*keys).join(good, keys, "left_anti"), "missed")
        if margin >= 1 or not missed.take(1):  # no bracket has an end left, or all ranks were inside
            break
        wanted, margin = wanted.join(missed, keys, "left_semi"), margin * 8
    wide = found.groupBy("_g").agg(*[F.max(F.when(F.col("_name") == n, F.col("_q"))).alias(n) for n in names])
    return sketches.select("_g", *by).join(wide, "_g").select(*by, *names)
