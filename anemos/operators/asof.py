"""As-of and point-in-time joins: one union, one ordered pass, no range join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemos.functions.temporal import micros
from anemos.operators.ordered import Series, fill

_T, _SIDE, _ID = "_at", "_side", "_tie"


def _timeline(left: DataFrame, right: DataFrame, keys, left_time: str, right_time: str,
              left_id: str, payload) -> DataFrame:
    """Both sides on one axis; the right row sorts before a left row of the same time."""
    a = left.select(
        *keys, F.col(left_time).alias(_T), F.lit(1).alias(_SIDE), F.col(left_id).alias(_ID),
        F.struct(*[c for c in left.columns if c not in keys]).alias("_left"),
    )
    b = right.select(
        *keys, F.col(right_time).alias(_T), F.lit(0).alias(_SIDE),
        F.lit(None).cast(left.schema[left_id].dataType).alias(_ID),
        F.struct(F.col(right_time).alias("_rt"), *payload).alias("_right"),
    )
    return a.unionByName(b, allowMissingColumns=True)


def one_per_instant(df: DataFrame, keys, time: str, order: str, keep: str = "first") -> DataFrame:
    """First (or last) row per key and instant, by an explicit order column."""
    pick = F.min_by if keep == "first" else F.max_by
    rest = [c for c in df.columns if c not in (*keys, time)]
    return (
        df.groupBy(*keys, time).agg(pick(F.struct(*rest), F.col(order)).alias("_row"))
        .select(*keys, time, "_row.*")
    )


def _neighbours(left, right, keys, left_time, right_time, left_id, payload, after: bool,
                rows_per_segment, series: Series | None = None) -> DataFrame:
    line = _timeline(left, right, keys, left_time, right_time, left_id, payload)
    order = (_T, _SIDE, _ID)
    series = series.ordered_by(*order) if series else Series.measure(line, keys, order, rows_per_segment)
    found = fill(line, series, {"_prev": "_right"}, {"_next": "_right"} if after else None)
    return found.where(F.col("_left").isNotNull())


def _distance(a, b) -> Column:
    return F.abs(micros(a) - micros(b))


def nearest_join(left: DataFrame, right: DataFrame, keys, left_time: str, right_time: str,
                 left_id: str, payload, tie: str = "later", tolerance_s: float | None = None,
                 matched: str = "matched_time", rows_per_segment: int | None = None,
                 series: Series | None = None) -> DataFrame:
    """Each left row with the right row nearest in time, or nulls.

    ``tie`` picks the earlier or later row at equal distance; the tolerance is
    inclusive. The right side holds one row per key and instant (see
    ``one_per_instant``). ``series`` spares the count where the cuts are known.
    """
    n = _neighbours(left, right, keys, left_time, right_time, left_id, payload, True,
                    rows_per_segment, series)
    before, after = _distance(_T, "_prev._rt"), _distance(_T, "_next._rt")
    later_wins = (after <= before) if tie == "later" else (after < before)
    best = F.when(F.col("_prev").isNull() | (F.col("_next").isNotNull() & later_wins),
                  F.col("_next")).otherwise(F.col("_prev"))
    if tolerance_s is not None:
        limit = F.lit(int(tolerance_s * 1_000_000)).cast("bigint")
        best = F.when(_distance(_T, best["_rt"]) <= limit, best)
    return _unpack(n.withColumn("_best", best), left, keys, payload, matched)


def point_in_time_join(left: DataFrame, right: DataFrame, keys, left_time: str, right_time: str,
                       left_id: str, payload, ttl: str | None = None,
                       matched: str = "feature_time",
                       rows_per_segment: int | None = None) -> DataFrame:
    """Each left row with the latest right row at or before it, not older than ``ttl``."""
    n = _neighbours(left, right, keys, left_time, right_time, left_id, payload, False,
                    rows_per_segment)
    best = F.col("_prev")
    if ttl is not None:
        best = F.when(F.col("_prev._rt") >= F.col(_T) - F.expr(f"INTERVAL {ttl}"), F.col("_prev"))
    return _unpack(n.withColumn("_best", best), left, keys, payload, matched)


def _unpack(df: DataFrame, left: DataFrame, keys, payload, matched: str) -> DataFrame:
    return df.select(
        *[F.col(c) if c in keys else F.col("_left")[c].alias(c) for c in left.columns],
        F.col("_best._rt").alias(matched), *[F.col("_best")[c].alias(c) for c in payload],
    )


def regular_grid(df: DataFrame, keys, time: str, step: str, grid: str = "grid_time") -> DataFrame:
    """Evenly spaced times from the first to the last row of each key."""
    span = df.groupBy(*keys).agg(F.min(time).alias("_lo"), F.max(time).alias("_hi"))
    return span.select(
        *keys, F.explode(F.expr(f"sequence(_lo, _hi, INTERVAL {step})")).alias(grid)
    )


def grid_sample(df: DataFrame, grid_source: DataFrame, keys, time: str, step: str, payload,
                rows_per_segment: int | None = None, series: Series | None = None) -> DataFrame:
    """Sample rows on a regular grid; each point takes the nearest row, later on ties."""
    grid = regular_grid(grid_source, keys, time, step)
    return nearest_join(
        grid, df, keys, "grid_time", time, "grid_time", payload, tie="later", matched=time,
        rows_per_segment=rows_per_segment, series=series,
    ).where(F.col(time).isNotNull())


def first_match_join(left: DataFrame, right: DataFrame, keys, left_time: str, right_time: str,
                     order: str, payload) -> DataFrame:
    """Left join on the hour, keeping the first right row of each hour."""
    hour = F.date_trunc("hour", F.col(right_time)).cast("timestamp_ntz")
    first = (
        right.withColumn("hour", hour).groupBy(*keys, "hour")
        .agg(F.min_by(F.struct(*payload), F.struct(right_time, order)).alias("_first"))
        .select(*keys, "hour", *[F.col("_first")[c].alias(c) for c in payload])
    )
    with_hour = left.withColumn("hour", F.date_trunc("hour", F.col(left_time)).cast("timestamp_ntz"))
    return with_hour.join(first, [*keys, "hour"], "left")


def anti_dedup(new: DataFrame, existing: DataFrame, keys) -> DataFrame:
    """Rows whose key is not stored yet; repeats inside the new batch stay."""
    return new.join(existing.select(*keys).distinct(), list(keys), "left_anti")


