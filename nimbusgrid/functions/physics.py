"""Moist-air formulas over temperature and dew point in °C, pressures in hPa."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from nimbusgrid.functions.scalars import bounded

# Magnus coefficients.
_MAGNUS_SCALE = 6.1094
_MAGNUS_A = 17.625
_MAGNUS_B = 243.04


def saturation_vapor_pressure(temperature: Column) -> Column:
    return _MAGNUS_SCALE * F.exp(_MAGNUS_A * temperature / (_MAGNUS_B + temperature))


def vapor_pressure(dew_point: Column) -> Column:
    return saturation_vapor_pressure(dew_point)


def vapor_pressure_deficit(temperature: Column, dew_point: Column) -> Column:
    return saturation_vapor_pressure(temperature) - vapor_pressure(dew_point)


def relative_humidity(temperature: Column, dew_point: Column) -> Column:
    ratio = vapor_pressure(dew_point) / saturation_vapor_pressure(temperature)
    return bounded(100 * ratio, 0, 100)


def dew_point_depression(temperature: Column, dew_point: Column) -> Column:
    return temperature - dew_point
