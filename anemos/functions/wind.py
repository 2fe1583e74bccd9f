"""Wind expressions: direction, gusts, alignment, profile, geometry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from anemos.functions.temporal import col
from anemos.params import COMPASS_POINTS, KMH_PER_KNOT

# Power-law exponent, km per degree, dial scale.
PROFILE_EXPONENT = 0.143
KM_PER_LAT_DEGREE = 110.574
KM_PER_LON_DEGREE = 111.320
DIAL_KM = 18.0
DIAL_KNOTS = 30.0
ARC_STEP_DEGREES = 6.0


def knots(kmh) -> Column:
    return col(kmh) / F.lit(KMH_PER_KNOT)


def direction_sin(degrees) -> Column:
    return F.sin(F.radians(col(degrees)))


def direction_cos(degrees) -> Column:
    return F.cos(F.radians(col(degrees)))


def gust_excess(gust, speed) -> Column:
    diff = col(gust) - col(speed)
    return F.when(diff < 0, F.lit(0.0)).otherwise(diff)


def gust_factor(gust, speed) -> Column:
    return F.try_divide(col(gust), col(speed))


def shore_alignment(direction, orientation) -> Column:
    return F.cos(F.radians(col(direction) - col(orientation)))


def speed_at_height(speed_10m, metres: float) -> Column:
    return col(speed_10m) * F.pow(F.lit(metres / 10.0), F.lit(PROFILE_EXPONENT))


def compass_point(degrees) -> Column:
    sector = F.floor(F.pmod(col(degrees) + 22.5, F.lit(360.0)) / 45.0).cast("int")
    return F.element_at(F.array(*[F.lit(p) for p in COMPASS_POINTS]), sector + 1)


def wind_status(speed_kn, minimum_kn) -> Column:
    return (
        F.when(col(speed_kn) >= col(minimum_kn), "Rideable")
        .when(col(speed_kn) >= 0.7 * col(minimum_kn), "Almost")
        .otherwise("Too light")
    )


def dial_radius_km(speed_kn) -> Column:
    capped = F.when(col(speed_kn) > DIAL_KNOTS, DIAL_KNOTS).otherwise(col(speed_kn))
    return F.lit(DIAL_KM) * capped / F.lit(DIAL_KNOTS)


def destination(lat, lon, bearing, km) -> Column:
    """Struct (lon, lat) reached along a bearing."""
    turn = F.radians(col(bearing))
    lat_step = col(km) * F.cos(turn) / KM_PER_LAT_DEGREE
    lon_step = col(km) * F.sin(turn) / (KM_PER_LON_DEGREE * F.cos(F.radians(col(lat))))
    return F.struct((col(lon) + lon_step).alias("lon"), (col(lat) + lat_step).alias("lat"))


def arc(lat, lon, km, start, end) -> Column:
    """Array of points on a ground circle between two bearings."""
    span = col(end) - col(start)
    points = F.greatest(F.lit(2), F.floor(F.abs(span) / ARC_STEP_DEGREES).cast("int") + 1)
    return F.transform(
        F.sequence(F.lit(0), points - 1),
        lambda i: destination(lat, lon, col(start) + span * i / (points - 1), km),
    )
