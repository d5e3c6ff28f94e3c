"""From sparse observations to a dense, gap-filled panel.

Bound on the series windows below: their input holds one row per (series, day) -- ``keep_first``
and ``daily_mean`` reduce hot days before any shuffle by series -- so a window partition is never
longer than the calendar, however many raw records a series has.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nimbusgrid import DATE, SERIES
from nimbusgrid import constants as k

_RUNNING = (Window.unboundedPreceding, Window.currentRow)
_WHOLE = (Window.unboundedPreceding, Window.unboundedFollowing)


def _day(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key, the first by ``order``.

    ``row_number() = 1`` lets Spark cut each key to one row per map task before the shuffle, so
    a key that repeats very often does not pile up in one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def daily_mean(df: DataFrame, values: Mapping[str, Column], *, series: str = SERIES,
               date: str = DATE) -> DataFrame:
    """Mean of each value per (series, day), combined map-side."""
    return df.groupBy(series, date).agg(*[F.avg(c).alias(n) for n, c in values.items()])


# --- coverage ------------------------------------------------------------------------------

def coverage(df: DataFrame, start, end, *, series: str = SERIES, date: str = DATE) -> DataFrame:
    """Distinct observed days per series over ``datediff(end, start)``.

    The divisor is one less than the days in the calendar, so a full series scores above 1.
    """
    span = F.datediff(_day(end), _day(start))
    return df.groupBy(series).agg(
        F.count_distinct(date).alias("days"),
        (F.count_distinct(date) / span).alias("coverage"),
    )


def keep_covered(df: DataFrame, start, end, min_coverage: float = k.MIN_COVERAGE, *,
                 series: str = SERIES, date: str = DATE) -> DataFrame:
    """Rows of the series whose coverage reaches the minimum."""
    good = coverage(df, start, end, series=series, date=date).filter(
        F.col("coverage") >= min_coverage)
    return df.join(good.select(series), series, "left_semi")


# --- calendar ------------------------------------------------------------------------------

def densify(df: DataFrame, start, end, *, static: Iterable[str] = (),
            min_coverage: float | None = None, observed: str | None = None,
            series: str = SERIES, date: str = DATE) -> DataFrame:
    """One row per series and calendar day; days without an observation get nulls.

    ``df`` has unique (series, date).  Each observed row expands in place into itself and the
    empty days up to the next one (the first row also covers the days before it), so only the
    sparse rows are shuffled, once, and the result stays partitioned by series for the windows
    that follow -- no calendar grid and no join.  ``static`` columns are carried forward, then
    backward.  ``min_coverage`` drops low-coverage series in the same pass.  ``observed`` names a
    column that is null on rows from a second source: those count neither towards coverage nor
    as a reason to keep a series.
    """
    static = [c for c in static if c in df.columns]
    ordered = Window.partitionBy(series).orderBy(date)
    running, whole = ordered.rowsBetween(*_RUNNING), ordered.rowsBetween(*_WHOLE)
    first_day, last_day = _day(start), _day(end)

    rows = df.select(
        *[c for c in df.columns if c not in static],
        *[F.coalesce(F.last(c, True).over(running), F.first(c, True).over(whole)).alias(c)
          for c in static],
        F.row_number().over(ordered).alias("_position"),
        F.lead(date).over(ordered).alias("_next"),
        F.count(observed or date).over(whole).alias("_days"),
    )
    if observed is not None:
        rows = rows.filter(F.col("_days") > 0)
    if min_coverage is not None:
        rows = rows.filter(F.col("_days") / F.datediff(last_day, first_day) >= min_coverage)
    begin = F.when(F.col("_position") == 1, first_day).otherwise(F.greatest(date, first_day))
    until = F.least(F.coalesce(F.date_sub("_next", 1), last_day), last_day)
    expanded = rows.withColumn(
        "_day", F.explode(F.when(begin <= until, F.sequence(begin, until))))
    observed = F.col("_day") == F.col(date)
    return expanded.select(*[
        F.col("_day").alias(c) if c == date
        else F.col(c) if c == series or c in static
        else F.when(observed, F.col(c)).alias(c)
        for c in df.columns
    ])


# --- gap filling ---------------------------------------------------------------------------

def missing_flags(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``{c}_est`` = 1 where the value is missing, else 0."""
    return df.withColumns({f"{c}_est": F.col(c).isNull().cast("int") for c in cols})


def interpolate(df: DataFrame, cols: Sequence[str], limit: int = k.INTERPOLATION_LIMIT, *,
                series: str = SERIES, date: str = DATE) -> DataFrame:
    """Linear interpolation over row positions that fills at most ``limit`` rows per gap.

    The slope spans the whole gap, however long; leading gaps stay empty and a trailing gap
    repeats the last value up to the limit.  The next known value comes from a window in
    reverse order, since a frame that ends at ``unbounded following`` is quadratic.
    """
    cols = list(cols)
    ahead = Window.partitionBy(series).orderBy(date)
    before = ahead.rowsBetween(*_RUNNING)
    after = Window.partitionBy(series).orderBy(F.desc(date)).rowsBetween(*_RUNNING)

    placed = df.select("*", F.row_number().over(ahead).alias("_i"))
    # Position and value as two primitive windows: a struct of both is an order slower.
    for side, frame in (("p", before), ("n", after)):
        placed = placed.select(
            "*",
            *[F.expr(f"CASE WHEN `{c}` IS NOT NULL THEN _i END").alias(f"_k_{c}") for c in cols],
        ).select(
            *placed.columns,
            *[F.last(f"_k_{c}", True).over(frame).alias(f"_{side}i_{c}") for c in cols],
            *[F.last(c, True).over(frame).alias(f"_{side}v_{c}") for c in cols])

    def filled(c: str) -> Column:
        return F.expr(f"""
            CASE WHEN `{c}` IS NOT NULL THEN `{c}`
                 WHEN _i - `_pi_{c}` <= {int(limit)} THEN
                   CASE WHEN `_ni_{c}` IS NULL THEN `_pv_{c}`
                        ELSE (`_nv_{c}` - `_pv_{c}`) / (`_ni_{c}` - `_pi_{c}`)
                             * (_i - `_pi_{c}`) + `_pv_{c}` END END""")

    return placed.select(*[filled(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def fill_with_mean(df: DataFrame, cols: Sequence[str], part: Column, *,
                   series: str = SERIES) -> DataFrame:
    """Fill gaps with the series' mean over ``part`` (day of year, month).

    Rows already partitioned by series stay where they are: that distribution also satisfies a
    window over (series, part).
    """
    cols = list(cols)
    group = Window.partitionBy(series, part)
    return df.withColumns({c: F.coalesce(F.col(c), F.avg(c).over(group)) for c in cols})


def fill_adjacent(df: DataFrame, cols: Sequence[str], *, series: str = SERIES,
                  date: str = DATE) -> DataFrame:
    """Forward then backward fill.

    After the forward fill only rows before the first known value are empty, so the backward
    fill is the first known value of the series: one sort serves both.
    """
    ordered = Window.partitionBy(series).orderBy(date)
    running, whole = ordered.rowsBetween(*_RUNNING), ordered.rowsBetween(*_WHOLE)
    return df.withColumns({
        c: F.coalesce(F.last(c, True).over(running), F.first(c, True).over(whole)) for c in cols})


def hybrid_impute(df: DataFrame, cols: Sequence[str] = k.CONTINUOUS_FIELDS, *,
                  limit: int = k.INTERPOLATION_LIMIT,
                  defaults: Mapping[str, float] = k.FILL_DEFAULTS,
                  series: str = SERIES, date: str = DATE) -> DataFrame:
    """Flag, then fill: short-gap line, day-of-year mean, month mean, neighbours, default.

    Each mean is taken over the values as filled so far.
    """
    cols = [c for c in cols if c in df.columns]
    keys = {"series": series, "date": date}
    out = missing_flags(df, cols)
    out = interpolate(out, cols, limit, **keys)
    out = fill_with_mean(out, cols, F.dayofyear(date), series=series)
    out = fill_with_mean(out, cols, F.month(date), series=series)
    out = fill_adjacent(out, cols, **keys)
    return out.fillna({c: float(defaults.get(c, 0.0)) for c in cols})


def impute_rain(df: DataFrame, second_source: str = "om_prec", col: str = "prec") -> DataFrame:
    """Rain: second source first, flagged only where both were missing, then 0."""
    own = F.col(col) if col in df.columns else F.lit(None).cast("double")
    merged = F.coalesce(own, F.col(second_source))
    return df.withColumns({
        f"{col}_est": merged.isNull().cast("int"),
        col: F.coalesce(merged, F.lit(0.0)),
    }).drop(second_source)


def impute_direction(df: DataFrame, col: str = "dir", *, series: str = SERIES,
                     date: str = DATE) -> DataFrame:
    """Wind direction: flag, read as number, neighbours, then 0."""
    if col not in df.columns:
        return df
    out = missing_flags(df, [col]).withColumn(col, F.col(col).try_cast("double"))
    return fill_adjacent(out, [col], series=series, date=date).fillna({col: 0.0})
