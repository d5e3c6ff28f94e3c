"""Heuristic indices derived from predicted variables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from nimbusgrid.functions.scalars import bounded, rint_to


def rainbow_score(prob_rain: Column, sun_hours: Column, humidity: Column) -> Column:
    """Rainbow likelihood in [0, 95], one decimal.

    Missing probability or humidity gives null; missing sun hours counts as no sun (0).
    """
    rain_weight = F.when(prob_rain < 0.25, 0.0).when(prob_rain > 0.85, 0.7).otherwise(1.0)
    sun_weight = (
        F.when(sun_hours < 1.0, 0.0).when(sun_hours < 4.0, 0.6)
        .when(sun_hours < 10.0, 1.0).when(sun_hours >= 10.0, 0.8).otherwise(0.0)
    )
    damp = humidity / 100.0 * F.when(humidity < 40, 0.5).otherwise(1.0)
    return rint_to(bounded(rain_weight * prob_rain * sun_weight * damp * 120, 0, 95))


def apparent_temperature(temperature: Column, humidity: Column, wind_ms: Column) -> Column:
    """Felt temperature by regime: wind chill (<=10 °C), mild (10..26), hot (>=26), one decimal.

    The hot branch is the four-term regression whose values downstream users rely on.
    """
    kmh = wind_ms * 3.6
    drag = F.pow(kmh, F.lit(0.16))
    chill = 13.12 + 0.6215 * temperature - 11.37 * drag + 0.3965 * temperature * drag
    hot = -8.784 + 1.611 * temperature + 2.338 * humidity - 0.146 * (temperature * humidity)
    vapor = humidity / 100.0 * (6.112 * F.exp(17.67 * temperature / (temperature + 243.5)))
    mild = temperature + 0.33 * vapor - 0.70 * wind_ms - 4.00
    felt = (
        F.when((temperature <= 10) & (kmh > 4.8), chill)
        .when(temperature >= 26, hot)
        .when((temperature > 10) & (temperature < 26), mild)
        .otherwise(temperature)
    )
    return rint_to(felt)
