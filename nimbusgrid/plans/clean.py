"""Raw records to the clean panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid import DATE, SERIES
from nimbusgrid import constants as k
from nimbusgrid.operators import panel as ops
from nimbusgrid.operators.quality import clip_physical, with_quality_score
from nimbusgrid.sources import records, storage


def clean_panel(observed: DataFrame, reanalysis: DataFrame | None = None, *,
                start: str = k.START_DATE, end: str = k.END_DATE,
                min_coverage: float | None = k.MIN_COVERAGE, keep_quality_score: bool = False,
                series: str = SERIES, date: str = DATE) -> DataFrame:
    """Deduplicate, join the second source, densify, fill and clip.

    Three exchanges for any number of series: records by (series, day), the second source by the
    same keys, and the merged sparse rows by series.  Every later window reuses the last one.
    """
    keys = {"series": series, "date": date}
    own = observed.drop(*k.REPLACED_FIELDS)
    # Repeated days: a fixed order that prefers rows with values.
    rest = [F.asc_nulls_last(c) for c in own.columns if c not in (series, date)]
    unique = ops.keep_first(own, [series, date], rest).withColumn("_seen", F.lit(1))
    if reanalysis is None:
        merged = unique.withColumns({c: F.lit(None).cast("double") for c in k.REANALYSIS_FIELDS})
    else:
        merged = unique.join(reanalysis.select(series, date, *k.REANALYSIS_FIELDS),
                             [series, date], "full")
    dense = ops.densify(merged, start, end, static=k.STATIC_FIELDS, min_coverage=min_coverage,
                        observed="_seen", **keys).drop("_seen")
    filled = ops.impute_rain(dense)
    filled = ops.hybrid_impute(filled, **keys)
    filled = ops.impute_direction(filled, **keys)
    clipped = clip_physical(filled)
    return with_quality_score(clipped) if keep_quality_score else clipped


def build_clean_table(spark: SparkSession, raw_path: str, out_path: str,
                      reanalysis: DataFrame | None = None, *, fmt: str = "parquet",
                      **options) -> DataFrame:
    """Scan raw documents, clean them, write the panel sorted by (series, day), read it back."""
    typed = records.require_rows(records.valid_records(
        records.scan_record_files(spark, raw_path), options.get("start", k.START_DATE)))
    clean = clean_panel(typed, reanalysis, **options)
    storage.write_table(clean, out_path, fmt)
    return storage.read_table(spark, out_path, fmt, clean.schema)
