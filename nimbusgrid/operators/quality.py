"""Audit of a filled panel: physical bounds, estimated shares, quality scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbusgrid import SERIES
from nimbusgrid import constants as k
from nimbusgrid.functions.scalars import bounded


def estimate_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.endswith("_est")]


def clip_physical(df: DataFrame, bounds: Mapping[str, tuple] = k.PHYSICAL_BOUNDS) -> DataFrame:
    return df.withColumns({
        c: bounded(F.col(c), low, high) for c, (low, high) in bounds.items() if c in df.columns})


def estimated_share(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Percentage of estimated values per variable, one row each, from a single aggregate."""
    cols = list(cols or estimate_columns(df))
    totals = df.agg(*[(F.avg(c) * 100).alias(c) for c in cols])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(c.removesuffix("_est")).alias("variable"),
                 F.col(c).alias("estimated_pct")) for c in cols])))


def with_quality_score(df: DataFrame, cols: Sequence[str] | None = None,
                       name: str = "_quality_score") -> DataFrame:
    """Share of estimated values in the row."""
    cols = list(cols or estimate_columns(df))
    total = sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
    return df.withColumn(name, total / F.lit(float(len(cols))))


def worst_series(df: DataFrame, n: int = 5, *, by: str = "nombre",
                 score: str = "_quality_score") -> DataFrame:
    """The ``n`` groups with the highest mean score, in percent."""
    return (df.groupBy(by).agg((F.avg(score) * 100).alias("estimated_pct"))
            .orderBy(F.desc("estimated_pct"), by).limit(n))


def dataset_summary(df: DataFrame, *, series: str = SERIES) -> DataFrame:
    return df.agg(F.count_distinct(series).alias("n_series"),
                  F.count(F.lit(1)).alias("n_rows"))
