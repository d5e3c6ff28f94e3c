"""Column helpers: parsing, null-safe bounds, rounding, calendar and wind encodings."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from nimbusgrid import constants as k

_SPACE = " \t\n\r\f\v"
_NUMBER_CHARS = "0123456789+-.eE"
_INFINITE = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")


def no_nan(c: Column) -> Column:
    """One missing value only: NaN becomes null."""
    return F.when(~F.isnan(c), c)


def locale_number(text: Column) -> Column:
    """Decimal-comma text to double: ``Ip`` (trace) is 0.05, anything unparsable is null.

    Checking the characters first keeps out forms the JVM parser takes but the contract does not
    (``1d``, hexadecimal), without a regular expression per value.
    """
    clean = F.btrim(F.translate(text, ",", "."), F.lit(_SPACE))
    plain = F.translate(clean, _NUMBER_CHARS, "") == ""
    word = F.lower(clean)
    return (
        F.when(plain, clean.try_cast("double"))
        .when(word == "ip", F.lit(k.TRACE_RAIN_MM))
        .when(word.isin(*_INFINITE), clean.try_cast("double"))
    )


def parse_date(text: Column) -> Column:
    """``yyyy-MM-dd`` text to date, null when unparsable."""
    return F.try_to_date(text, "yyyy-MM-dd")


def bounded(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Clip that keeps null (``greatest``/``least`` alone would turn null into the bound)."""
    value = c
    if low is not None:
        value = F.greatest(value, F.lit(float(low)))
    if high is not None:
        value = F.least(value, F.lit(float(high)))
    return F.when(c.isNotNull(), value)


def rint_to(c: Column, digits: int = 1) -> Column:
    """Half-to-even rounding on the scaled double (``F.round`` is half-up)."""
    scale = float(10 ** digits)
    return F.rint(c * scale) / scale


def tenths(c: Column) -> Column:
    """The double nearest to ``c`` with one decimal, decided on the exact binary value.

    0.35 is a little under its name and gives 0.3; 0.25 is a tie and gives the even 0.2.  Ten times
    the value is eight and two times the value, both exact; what their sum loses is found by
    subtraction and settles whether a half is one.
    """
    big, small = c * 8.0, c * 2.0
    whole = big + small
    part = whole - big
    lost = (big - (whole - part)) + (small - part)
    near = F.rint(whole)
    half = F.abs(whole - near) == 0.5
    return F.when(half & (lost > 0), F.ceil(whole).cast("double")).when(
        half & (lost < 0), F.floor(whole).cast("double")).otherwise(near) / 10.0


def sanitize_name(name: Column) -> Column:
    """Path-safe name: drop punctuation, join words with ``_`` (letters of any script stay)."""
    kept = F.regexp_replace(name, r"(?U)[^\p{L}\p{N}_\s-]", "")
    return F.regexp_replace(kept, r"(?U)\s+", "_")


def cyclic(date: Column) -> dict[str, Column]:
    """Sine/cosine of month (period 12) and of day-of-year (period 365.0)."""
    month = F.month(date) * (2 * math.pi) / 12
    day = F.dayofyear(date) * (2 * math.pi) / 365.0
    return {
        "month_sin": F.sin(month), "month_cos": F.cos(month),
        "day_sin": F.sin(day), "day_cos": F.cos(day),
    }


def wind_components(direction: Column, unit_scale: float = 1.0) -> dict[str, Column]:
    """Sine/cosine of a direction in degrees; missing and the code 99 count as 0.

    ``unit_scale=10`` reads the direction as tens of degrees.
    """
    clean = F.when(direction.isNull() | (direction == 99), 0.0).otherwise(direction)
    angle = F.radians(clean * unit_scale)
    return {"wind_sin": F.sin(angle), "wind_cos": F.cos(angle)}


def stamp(date: Column) -> Column:
    """Compact ``yyyyMMdd`` stamp used in batch names."""
    return F.date_format(date, "yyyyMMdd")


def request_stamp(date: Column) -> Column:
    """ISO time with a ``UTC`` suffix and escaped colons, as request paths carry it."""
    iso = F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'UTC'")
    return F.replace(iso, F.lit(":"), F.lit("%3A"))


def same_day_last_year(date: Column) -> Column:
    return F.add_months(date, -12)


def absolute_error(actual: Column, predicted: Column) -> Column:
    return F.abs(actual - predicted)
