"""Dusk-to-dawn intervals without an ordered pass over the grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anemos.functions.solar import with_daylight

STEP = "INTERVAL 5 MINUTES"


def night_intervals(spans: DataFrame, lat: str, lon: str, start: str, end: str) -> DataFrame:
    """One row per night of each spot: first dark and first light on a 5-minute grid.

    A grid point knows on its own whether the light changes there, because the
    sun one step earlier is a formula too. Only the changes (about two a day)
    are shuffled to pair a dusk with the next dawn. ``spans`` has one row per
    ``spot_id``.
    """
    hour_end = F.date_trunc("hour", F.col(end)).cast("timestamp_ntz")
    lo = F.date_trunc("hour", F.col(start)).cast("timestamp_ntz") - F.expr("INTERVAL 1 DAY")
    hi = F.when(hour_end < F.col(end), hour_end + F.expr("INTERVAL 1 HOUR")).otherwise(
        hour_end
    ) + F.expr("INTERVAL 1 DAY")
    days = spans.select(
        "spot_id", F.col(lat).alias("_lat"), F.col(lon).alias("_lon"), lo.alias("_lo"), hi.alias("_hi")
    ).withColumn("_day", F.explode(F.expr("sequence(CAST(_lo AS DATE), CAST(_hi AS DATE))")))
    # A day row becomes 288 points: spread the days first, as their bytes are too
    # few for adaptive execution to see the work behind them.
    spread = days.repartition(spans.sparkSession.sparkContext.defaultParallelism, "spot_id", "_day")
    points = (f"sequence(greatest(_lo, CAST(_day AS TIMESTAMP_NTZ)), "
              f"least(_hi, CAST(_day AS TIMESTAMP_NTZ) + INTERVAL '23:55' HOUR TO MINUTE), {STEP})")
    grid = spread.withColumn("at", F.explode(F.expr(points))).drop("_day")
    lit = with_daylight(
        with_daylight(grid.withColumn("_earlier", F.col("at") - F.expr(STEP)),
                      "_lat", "_lon", "_earlier", "_lit_before"),
        "_lat", "_lon", "at", "_lit")
    last, first = F.col("at") == F.col("_hi"), F.col("at") == F.col("_lo")
    # One number per point: 1 dark before, 2 dark, 4 grid end. The marks are
    # exploded, not filtered: a filter would move below and repeat the formula.
    code = (
        F.when(F.col("_lit"), 0).otherwise(2) + F.when(F.col("_lit_before") | first, 0).otherwise(1)
        + F.when(last, 4).otherwise(0)
    )
    coded = lit.withColumn("_code", code)
    mark = F.when(F.col("_code").isin(1, 2, 5, 6, 7), F.array("_code")).otherwise(
        F.array().cast("array<int>"))
    marks = coded.select("spot_id", "at", F.explode(mark).alias("code"))
    w = Window.partitionBy("spot_id").orderBy("at")
    night_end = F.when(F.col("code") == 6, F.col("at")).otherwise(F.lead("at").over(w))
    return (
        marks.withColumn("night_end", night_end).where(F.col("code").isin(2, 6))
        .select("spot_id", F.col("at").alias("night_start"), "night_end")
    )
