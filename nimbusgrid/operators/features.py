"""Time-series features over a dense panel.

All windows share one specification per frame (series, ordered by day), so Spark plans one
exchange and one sort for the lot.  Lags and rolling means count rows, which on a dense panel
are days.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbusgrid import DATE, SERIES
from nimbusgrid import constants as k
from nimbusgrid.functions.scalars import cyclic, wind_components


def _ordered(series: str, date: str):
    return Window.partitionBy(series).orderBy(date)


def unique_columns(*groups: Sequence[str]) -> list[str]:
    """Union of column lists without repeats, in first-seen order."""
    return list(dict.fromkeys(c for group in groups for c in group))


# --- single features -----------------------------------------------------------------------

def add_lags(df: DataFrame, cols: Sequence[str], lags: Sequence[int] = k.LAGS, *,
             series: str = SERIES, date: str = DATE) -> DataFrame:
    w = _ordered(series, date)
    return df.select("*", *[F.lag(c, n).over(w).alias(f"{c}_lag_{n}")
                            for c in cols if c in df.columns for n in lags])


def rolling_mean(c: str, size: int, *, series: str = SERIES, date: str = DATE) -> Column:
    """Trailing mean, null unless all ``size`` values are present."""
    frame = _ordered(series, date).rowsBetween(1 - size, Window.currentRow)
    return F.when(F.count(c).over(frame) == size, F.avg(c).over(frame))


def add_rolling(df: DataFrame, cols: Sequence[str], windows: Sequence[int] = k.WINDOWS, *,
                series: str = SERIES, date: str = DATE) -> DataFrame:
    return df.select("*", *[
        rolling_mean(c, n, series=series, date=date).alias(f"{c}_roll_{n}")
        for c in cols if c in df.columns for n in windows])


def add_difference(df: DataFrame, c: str, name: str | None = None, *, series: str = SERIES,
                   date: str = DATE) -> DataFrame:
    change = F.col(c) - F.lag(c, 1).over(_ordered(series, date))
    return df.withColumn(name or f"{c}_diff", change)


def add_trends(df: DataFrame, cols: Sequence[str] = k.TREND_COLS) -> DataFrame:
    """``{c}_trend`` = lag 1 minus lag 2, for columns whose lags exist."""
    return df.withColumns({
        f"{c}_trend": F.col(f"{c}_lag_1") - F.col(f"{c}_lag_2")
        for c in cols if f"{c}_lag_1" in df.columns and f"{c}_lag_2" in df.columns})


def add_cyclic(df: DataFrame, *, date: str = DATE) -> DataFrame:
    return df.withColumns(cyclic(F.col(date)))


def add_wind(df: DataFrame, direction: str = "dir", unit_scale: float = 1.0) -> DataFrame:
    if direction not in df.columns:
        return df
    return df.withColumns(wind_components(F.col(direction), unit_scale))


# --- targets and splits --------------------------------------------------------------------

def add_split(df: DataFrame, val_start=k.VAL_START_DATE, test_start=k.TEST_START_DATE, *,
              date: str = DATE) -> DataFrame:
    """``split`` = train / val / test by date."""
    day = F.col(date)
    return df.withColumn("split", F.when(day < F.lit(val_start).cast("date"), "train")
                         .when(day < F.lit(test_start).cast("date"), "val").otherwise("test"))


def next_day_target(c: str, *, series: str = SERIES, date: str = DATE) -> Column:
    """Value of the next row within (series, split); null on the last row of each split."""
    return F.lead(c, 1).over(Window.partitionBy(series, "split").orderBy(date))


def next_day_rain(c: str = "prec", *, series: str = SERIES, date: str = DATE) -> Column:
    """1.0 when the next row of the series is wet; the last row counts as dry."""
    wet = F.lead(c, 1).over(_ordered(series, date)) > k.RAIN_MM
    return F.coalesce(wet, F.lit(False)).cast("double")


def to_valid_time(df: DataFrame, cols: Sequence[str], *, series: str = SERIES,
                  date: str = DATE) -> DataFrame:
    """Move predictions from the day they were issued to the day they are for (one row on)."""
    w = _ordered(series, date)
    return df.withColumns({c: F.lag(c, 1).over(w) for c in cols})


# --- row selection -------------------------------------------------------------------------

def last_row(df: DataFrame, *, ties: Sequence[str] = (), series: str = SERIES,
             date: str = DATE) -> DataFrame:
    """The latest row per series (cut to one row per map task before the shuffle).

    Of rows with the same time, the one that is greatest by ``ties``, by default by all columns
    that have an order.
    """
    ties = ties or [f.name for f in df.schema.fields if f.name not in (series, date)
                    and not isinstance(f.dataType, T.MapType)]
    rank = F.row_number().over(Window.partitionBy(series).orderBy(
        F.desc(date), *[F.desc(c) for c in ties]))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def trailing_history(df: DataFrame, days: int = k.HISTORY_DAYS, *, date: str = DATE) -> DataFrame:
    """Rows within ``days`` of the latest date of the whole frame."""
    latest = df.agg(F.max(date)).scalar()
    return df.filter(F.col(date) >= F.date_sub(latest, days))


def project_features(df: DataFrame, names: Sequence[str], missing: float = 0.0) -> list[Column]:
    """The listed features in order, absent ones as a constant."""
    return [F.col(n) if n in df.columns else F.lit(missing).alias(n) for n in names]


# --- feature sets --------------------------------------------------------------------------

@dataclass(frozen=True)
class FeatureSpec:
    """Which features a model family uses."""

    lag_cols: tuple[str, ...]
    roll_cols: tuple[str, ...]
    trend_cols: tuple[str, ...] = ()
    pressure_change: bool = False
    wind: bool = False
    lags: tuple[int, ...] = k.LAGS
    windows: tuple[int, ...] = k.WINDOWS

    @property
    def reach(self) -> int:
        """Days of history one row needs."""
        return max((*[n + 1 for n in self.lags], *[n - 1 for n in self.windows]))

    def derived(self) -> list[str]:
        """Columns this spec adds, given all its inputs, in order."""
        names = ["month_sin", "month_cos", "day_sin", "day_cos"]
        if self.wind:
            names += ["wind_sin", "wind_cos"]
        if self.pressure_change:
            names += ["presion_diff", "cloud_moisture"]
        names += [f"{c}_lag_{n}" for c in self.lag_cols for n in self.lags]
        names += [f"{c}_roll_{n}" for c in self.roll_cols for n in self.windows]
        return names + [f"{c}_trend" for c in self.trend_cols]


RAIN = FeatureSpec((*k.LAG_COLS, "presion_diff", "cloud_moisture"), ("presion",),
                   pressure_change=True)
TEMPERATURE = FeatureSpec(k.LAG_COLS, ("tmed",), trend_cols=k.TREND_COLS)
ATMOSPHERE = FeatureSpec((*k.LAG_COLS, "wind_sin", "wind_cos"), k.ROLL_COLS, wind=True)
EVERYTHING = FeatureSpec(
    (*k.LAG_COLS, "presion_diff", "cloud_moisture", "wind_sin", "wind_cos"), k.ROLL_COLS,
    trend_cols=k.TREND_COLS, pressure_change=True, wind=True)


def build_features(panel: DataFrame, spec: FeatureSpec = EVERYTHING, *, from_date=None,
                   to_date=None, series: str = SERIES, date: str = DATE) -> DataFrame:
    """Panel plus the features of ``spec``; inputs the panel lacks are skipped.

    With ``from_date``/``to_date`` the scan keeps only that range plus the days the features
    look back, and the exact range is cut after the windows.
    """
    keys = {"series": series, "date": date}
    df = panel
    if from_date is not None:
        begin = F.lit(from_date).cast("date")
        df = df.filter(F.col(date) >= F.date_sub(begin, spec.reach))
    if to_date is not None:
        df = df.filter(F.col(date) <= F.lit(to_date).cast("date"))

    df = add_cyclic(df, date=date)
    if spec.wind:
        df = add_wind(df)
    if spec.pressure_change and "presion" in df.columns:
        df = add_difference(df, "presion", **keys)
    if spec.pressure_change and {"nubes", "hrMedia"} <= set(df.columns):
        df = df.withColumn("cloud_moisture", F.col("nubes") * F.col("hrMedia"))

    w = _ordered(series, date)
    df = df.select(
        "*",
        *[F.lag(c, n).over(w).alias(f"{c}_lag_{n}")
          for c in spec.lag_cols if c in df.columns for n in spec.lags],
        *[rolling_mean(c, n, **keys).alias(f"{c}_roll_{n}")
          for c in spec.roll_cols if c in df.columns for n in spec.windows])
    df = add_trends(df, spec.trend_cols)
    if from_date is not None:
        df = df.filter(F.col(date) >= F.lit(from_date).cast("date"))
    return df
