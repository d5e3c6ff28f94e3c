"""Frames a reader of the forecast asks for: lookups, next days, cards, alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nimbusgrid import DATE, SERIES
from nimbusgrid.functions import bands
from nimbusgrid.functions.scalars import tenths
from nimbusgrid.operators.joins import with_station
from nimbusgrid.operators.panel import keep_first


def point_lookup(df: DataFrame, key, day, *, series: str = SERIES, date: str = DATE) -> DataFrame:
    """The row of one series on one day; both predicates reach the scan."""
    at = day if isinstance(day, Column) else F.lit(day).cast("date")
    return df.filter((F.col(series) == key) & (F.col(date) == at)).limit(1)


def distinct_values(df: DataFrame, c: str, descending: bool = False) -> DataFrame:
    return df.select(c).distinct().orderBy(F.desc(c) if descending else F.asc(c))


def next_days(df: DataFrame, day, n: int = 7, *, then: Sequence[str] = (),
              series: str = SERIES, date: str = DATE) -> DataFrame:
    """The next ``n`` rows from ``day`` on, for every series; ``then`` orders rows of one day.

    The rank filter becomes a group limit: each task passes on at most ``n`` rows per series.
    """
    rank = F.row_number().over(Window.partitionBy(series).orderBy(date, *then))
    ahead = df.filter(F.col(date) >= F.lit(day).cast("date"))
    return ahead.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def preview(df: DataFrame, n: int = 100, *, order: Sequence[str] = (SERIES, DATE)) -> DataFrame:
    return df.orderBy(*order).limit(n)


def available_dates(df: DataFrame, key, from_year: int, *, series: str = SERIES,
                    date: str = DATE) -> DataFrame:
    """Days of one series from ``from_year`` on, latest first; its whole history if none."""
    own = df.filter(F.col(series) == key).select(date).distinct()
    recent = F.col(date) >= F.lit(f"{from_year}-01-01").cast("date")
    newest = own.agg(F.max(date)).scalar()
    none_recent = newest < F.lit(f"{from_year}-01-01").cast("date")
    return own.filter(recent | none_recent).orderBy(F.desc(date))


def forecast_cards(df: DataFrame) -> DataFrame:
    """Day cards: icon, whole-degree extremes, rain percentage and labels."""
    prob, sun = F.col("prob_rain"), F.col("pred_sol")
    return df.withColumns({
        "icon": bands.weather_icon(prob, sun),
        "tmax_text": F.format_string("%.0f°", F.rint("pred_tmax")),
        "tmin_text": F.format_string("%.0f°", F.rint("pred_tmin")),
        "rain_pct": F.rint(prob * 100).cast("int"),
        "rain_label": bands.rain_label(prob),
        "rainbow_label": bands.rainbow_label(F.col("rainbow_prob")),
        "rainbow_band": bands.rainbow_band(F.col("rainbow_prob")),
        "humidity_band": bands.humidity_band(F.col("pred_hrMedia")),
    })


def forecast_map(df: DataFrame, day, *, series: str = SERIES, date: str = DATE) -> DataFrame:
    """Map markers of one day with station position."""
    today = df.filter(F.col(date) == F.lit(day).cast("date"))
    marker = bands.map_marker(F.col("prob_rain"), F.col("pred_sol"))
    return with_station(today, series=series).select(
        series, "map_name", "lat", "lon", marker.alias("_m"),
        bands.whole_degrees(F.col("pred_tmed")).alias("degrees"), "pred_windchill",
    ).select("*", "_m.icon", "_m.colour").drop("_m")


def weekly_trend(df: DataFrame, day, *, series: str = SERIES, date: str = DATE) -> DataFrame:
    """Next seven days with the rain probability scaled for the temperature axis."""
    return next_days(df, day, series=series, date=date).select(
        series, date, "pred_tmax", "pred_tmin", "pred_tmed",
        (F.col("prob_rain") * 5).alias("rain_scaled"), "pred_windchill")


# Fixed value: the alert text; its gaps are station, day, actual and felt temperature, icon,
# difference and tip.
_ALERT = """
            <b>🌡️ Wind Chill Notification</b>

            📍 <b>Station:</b> %s
            📅 <b>Date:</b> %s
            🕗 <b>Time:</b> 07:00 AM

            🌡️ <b>Actual temperature:</b> %.1f°C
            🎚️ <b>Wind chill:</b> %.1f°C %s
            📊 <b>Difference:</b> %s

            💡 <b>Tip:</b> %s

            <i>Automated notification from the weather system.</i>
        """


def alert_text(station: Column, day: Column, felt: Column, actual: Column) -> Column:
    """The message sent for one subscription."""
    return F.format_string(
        _ALERT, station, F.date_format(day, "dd/MM/yyyy"), tenths(actual), tenths(felt),
        bands.advice_icon(felt), bands.signed_difference(felt, actual), bands.advice(felt))


def alerts(subscriptions: DataFrame, forecast: DataFrame, as_of=None, *, series: str = SERIES,
           date: str = DATE) -> DataFrame:
    """One alert per subscribed id: its latest subscription joined to its station's forecast.

    Without ``as_of`` the station's first forecast row is used, folded map-side.
    """
    mine = keep_first(subscriptions, ["telegram_id"],
                      [F.desc("updated_at"), F.desc("station_code")])
    if as_of is None:
        rows = forecast.groupBy(F.col(series).alias("station_code")).agg(
            F.min_by(F.struct("pred_windchill", "pred_tmed"), date).alias("_f"),
            F.min(date).alias("forecast_date"))
    else:
        rows = forecast.filter(F.col(date) == F.lit(as_of).cast("date")).select(
            F.col(series).alias("station_code"),
            F.struct("pred_windchill", "pred_tmed").alias("_f"),
            F.col(date).alias("forecast_date"))
    felt, actual = F.col("_f.pred_windchill"), F.col("_f.pred_tmed")
    return mine.join(rows, "station_code").select(
        "telegram_id", "station_code", "station_name", "forecast_date",
        felt.alias("pred_windchill"), actual.alias("pred_tmed"),
        bands.advice(felt).alias("advice"),
        bands.signed_difference(felt, actual).alias("difference"),
        alert_text(F.col("station_name"), F.col("forecast_date"), felt, actual).alias("message"))
