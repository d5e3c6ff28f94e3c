"""Decision, band and label columns shown to readers of a forecast."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from nimbusgrid import constants as k
from nimbusgrid.functions.scalars import tenths


def decision(probability: Column, threshold: float = k.RAIN_THRESHOLD) -> Column:
    """1 when the probability exceeds the threshold, else 0 (missing counts as 0)."""
    return F.coalesce(probability > threshold, F.lit(False)).cast("int")


def rained(millimetres: Column) -> Column:
    """Observed rain label; missing counts as dry."""
    return F.coalesce(millimetres > k.RAIN_MM, F.lit(False)).cast("int")


def weather_icon(prob_rain: Column, sun_hours: Column) -> Column:
    wet = F.when(sun_hours > 2.0, "sun_shower").otherwise("rain")
    return (
        F.when(prob_rain > 0.5, wet).when(sun_hours > 8.0, "sunny")
        .when(sun_hours > 4.0, "partly_cloudy").otherwise("cloudy")
    )


def map_marker(prob_rain: Column, sun_hours: Column) -> Column:
    """Struct of marker icon and colour."""
    def marker(icon: str, colour: str) -> Column:
        return F.struct(F.lit(icon).alias("icon"), F.lit(colour).alias("colour"))

    return (
        F.when(prob_rain > 0.5, marker("cloud-showers-heavy", "blue"))
        .when(sun_hours > 8.0, marker("sun", "orange"))
        .otherwise(marker("cloud", "gray"))
    )


def whole_degrees(temperature: Column) -> Column:
    return F.rint(temperature).cast("int")


def rainbow_band(score: Column) -> Column:
    return F.when(score >= 60, "HIGH").when(score >= 30, "MEDIUM").otherwise("LOW")


def humidity_band(humidity: Column) -> Column:
    return F.when(humidity > 70, "High").when(humidity > 40, "Medium").otherwise("Low")


def rain_label(prob_rain: Column) -> Column:
    return F.when(prob_rain >= 0.5, "YES").otherwise("NO")


def rainbow_label(score: Column) -> Column:
    return F.when(score > 0, "YES").otherwise("NO")


# Upper bound (exclusive) of felt temperature, icon and advice.
ADVICE = (
    (5, "❄️", "Bundle up, it's very cold!"),
    (15, "🌬️", "Wear a jacket, it's chilly."),
    (25, "😊", "Pleasant weather, enjoy it!"),
    (None, "🔥", "It's hot, stay hydrated!"),
)


def _advice_part(felt: Column, part: int) -> Column:
    chain = F
    for row in ADVICE[:-1]:
        chain = chain.when(felt < row[0], row[part])
    return chain.otherwise(ADVICE[-1][part])


def advice(felt: Column) -> Column:
    return _advice_part(felt, 2)


def advice_icon(felt: Column) -> Column:
    return _advice_part(felt, 1)


def signed_difference(felt: Column, actual: Column) -> Column:
    """``+1.5°C`` style text of felt minus actual, or ``same`` when equal."""
    def text(gap: Column) -> Column:
        return F.when(gap == 0, "same").otherwise(F.format_string("%+.1f°C", tenths(gap)))

    # bound once: the text refers to the gap many times, and the gap may be a long formula
    return F.element_at(F.transform(F.array(felt - actual), text), 1)


def code_name_label(code: Column, name: Column, separator: str = " ") -> Column:
    """``code name``; the code alone when the name is unknown."""
    return F.concat_ws(separator, code, name)


def name_code_label(code: Column, name: Column) -> Column:
    """``name (code)``, the code standing in for an unknown name."""
    return F.format_string("%s (%s)", F.coalesce(name, code), code)
