"""Solar elevation as column expressions (NOAA low-accuracy series)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemos.functions.temporal import col, hour_fraction

HORIZON_DEG = -0.833
HORIZON_COS = math.sin(math.radians(HORIZON_DEG))
# Fixed values of the published series: (constant, then cos/sin pairs by harmonic).
EQUATION_OF_TIME = (0.000075, (0.001868, -0.032077), (-0.014615, -0.040849))
DECLINATION = (
    0.006918, (-0.399912, 0.070257), (-0.006758, 0.000907), (-0.002697, 0.00148),
)


def _harmonics(series, angle: Column) -> Column:
    total = F.lit(series[0])
    for k, (on_cos, on_sin) in enumerate(series[1:], start=1):
        total = total + on_cos * F.cos(k * angle) + on_sin * F.sin(k * angle)
    return total


def _year_angle(utc_time, hours: Column) -> Column:
    return F.lit(2.0 * math.pi / 365.0) * (
        F.dayofyear(col(utc_time)) - 1 + (hours - 12.0) / 24.0
    )


def _cos_zenith(lat, lon, hours: Column, minutes_shift: Column, declination: Column) -> Column:
    solar_minutes = hours * 60.0 + minutes_shift + 4.0 * col(lon)
    hour_angle = F.radians(solar_minutes / 4.0 - 180.0)
    phi = F.radians(col(lat))
    return F.sin(phi) * F.sin(declination) + F.cos(phi) * F.cos(declination) * F.cos(hour_angle)


def cos_zenith(lat, lon, utc_time) -> Column:
    hours = hour_fraction(utc_time)
    angle = _year_angle(utc_time, hours)
    return _cos_zenith(lat, lon, hours, 229.18 * _harmonics(EQUATION_OF_TIME, angle),
                       _harmonics(DECLINATION, angle))


def with_daylight(df: DataFrame, lat: str, lon: str, utc_time: str, name: str) -> DataFrame:
    """Add a daylight flag in stages.

    The steps share values (the year angle enters ten terms). As columns of
    their own they are computed once per row and the generated code stays small
    enough to be compiled; use this where very many rows are tested.
    """
    hours, angle = F.col("_hours"), F.col("_angle")
    return (
        df.withColumn("_hours", hour_fraction(utc_time))
        .withColumn("_angle", _year_angle(utc_time, hours))
        .withColumns({"_shift": 229.18 * _harmonics(EQUATION_OF_TIME, angle),
                      "_decl": _harmonics(DECLINATION, angle)})
        .withColumn(name, _cos_zenith(lat, lon, hours, F.col("_shift"), F.col("_decl")) > HORIZON_COS)
        .drop("_hours", "_angle", "_shift", "_decl")
    )


def noon_terms(day, lat, lon) -> tuple[Column, Column]:
    """Of the solar day around a place's noon: minutes from the date's start to noon, and the cosine of the hour angle of sunset.

    Declination and equation of time are those of noon. A cosine beyond one means that the sun stays up or down.
    """
    angle = F.lit(2.0 * math.pi / 365.0) * (F.dayofyear(col(day)) - 1 - col(lon) / 360.0)
    declination, phi = _harmonics(DECLINATION, angle), F.radians(col(lat))
    noon = 720.0 - 4.0 * col(lon) - 229.18 * _harmonics(EQUATION_OF_TIME, angle)
    return noon, (F.lit(HORIZON_COS) - F.sin(phi) * F.sin(declination)) / (F.cos(phi) * F.cos(declination))


def solar_elevation(lat, lon, utc_time) -> Column:
    known = col(lat).isNotNull() & col(lon).isNotNull() & col(utc_time).isNotNull()
    clipped = F.least(F.greatest(cos_zenith(lat, lon, utc_time), F.lit(-1.0)), F.lit(1.0))
    return F.when(known, F.lit(90.0) - F.degrees(F.acos(clipped)))


def is_daylight(lat, lon, utc_time) -> Column:
    """Elevation above the horizon, compared as cosines so no arc cosine is needed."""
    return cos_zenith(lat, lon, utc_time) > HORIZON_COS
