"""Label, band and ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from anemos.functions.temporal import col
from anemos.functions.wind import knots
from anemos.params import QUALITY_NAMES, LabelRules, RankingRules


def rider_minimum(weight_kg, rules: LabelRules = LabelRules()) -> Column:
    return F.when(col(weight_kg) <= rules.light_rider_kg, rules.light_rider_min).otherwise(
        F.lit(rules.other_rider_min)
    )


def quality_label(minimum_kn, rules: LabelRules = LabelRules()) -> Column:
    """0-5 label of a complete row; a row missing an input gets null."""
    wind, gust = knots("wind_speed_10m"), knots("wind_gusts_10m")
    perfect = (
        wind.between(rules.perfect_low, rules.perfect_high)
        & (F.col("gust_factor") <= rules.perfect_gust_factor)
        & (F.col("shore_alignment") >= rules.perfect_alignment)
        & (F.col("wind_steadiness") <= rules.perfect_steadiness)
    )
    incomplete = F.lit(False)
    for name in ("wind_speed_10m", "wind_gusts_10m", "wind_steadiness", "gust_factor",
                 "shore_alignment"):
        incomplete = incomplete | F.col(name).isNull()
    return (
        F.when(incomplete, F.lit(None).cast("bigint"))
        .when((wind > rules.unsafe_wind) | (gust > rules.unsafe_gust), 0)
        .when(perfect, 5)
        .when(wind < col(minimum_kn), 1)
        .when(wind < rules.marginal_below, 2)
        .when(wind < rules.good_below, 3)
        .when(wind <= rules.fun_up_to, 4)
        .otherwise(3)
        .cast("bigint")
    )


def clamp(value: Column, low: float, high: float) -> Column:
    """Limit a value to [low, high]; missing stays missing."""
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def quality_band(value) -> Column:
    """Half-even rounding, limited to 0..5."""
    return clamp(F.bround(col(value), 0), 0.0, 5.0).cast("bigint")


def band_name(band) -> Column:
    pairs = [F.lit(x) for band_no, name in QUALITY_NAMES.items() for x in (band_no, name)]
    return F.element_at(F.create_map(*pairs), col(band).cast("int"))


def ride_drive_ratio(quality, minutes, hours, rules: RankingRules = RankingRules()) -> Column:
    drive = F.greatest(col(minutes) / 60.0, F.lit(rules.min_drive_hours))
    return F.when((col(quality) <= 0) | (col(hours) <= 0), 0.0).otherwise(
        col(quality) * col(hours) / drive
    )
