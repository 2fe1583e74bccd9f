"""Forecast summaries and the spot ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemos.functions.quality import band_name, clamp, quality_band, ride_drive_ratio
from anemos.functions.temporal import micros
from anemos.operators.ordered import Series, number_rows
from anemos.params import RankingRules
from anemos.session import settle


def forecast_peak(forecast: DataFrame, spots: DataFrame, rules: RankingRules = RankingRules()) -> DataFrame:
    """Peak quality and rideable hours per spot; spots without rows get zeros."""
    peaks = forecast.groupBy("spot_id").agg(
        F.max("quality_index").alias("peak_quality"),
        F.count_if(F.col("quality_index") >= rules.rideable_from).alias("session_hours"),
    )
    return spots.join(peaks, "spot_id", "left").withColumns({
        "peak_quality": F.coalesce(F.col("peak_quality").cast("double"), F.lit(0.0)),
        "session_hours": F.coalesce(F.col("session_hours").cast("double"), F.lit(0.0)),
    })


def forecast_frame(forecast: DataFrame, daylight: Column, rules: RankingRules = RankingRules()) -> DataFrame:
    """Display columns of each forecast row; an unknown place counts as daylight."""
    return forecast.withColumns({
        "quality_name": band_name(quality_band("quality_index")),
        "rideable": F.col("quality_index") >= rules.rideable_from,
        "daylight": F.coalesce(daylight, F.lit(True)),
        "display_time": F.date_format("time", "EEE dd MMM HH:mm"),
    })


def forecast_summary(frame: DataFrame, spots: DataFrame) -> DataFrame:
    """Strongest hour per spot (first on ties) and hours rideable by day."""
    best = F.max_by(F.struct("quality_index", "quality_name", "time", "display_time"),
                    F.struct("quality_index", -micros("time")))
    found = frame.groupBy("spot_id").agg(
        best.alias("_best"),
        F.count_if(F.col("rideable") & F.col("daylight")).alias("rideable_hours"),
        F.count("*").alias("forecast_rows"),
    )
    zero_name = band_name(F.lit(0))
    return spots.select("spot_id").join(found, "spot_id", "left").select(
        "spot_id",
        F.coalesce(F.col("_best.quality_index").cast("double"), F.lit(0.0)).alias("peak_quality"),
        F.coalesce(F.col("_best.quality_name"), zero_name).alias("peak_label"),
        F.col("_best.time").alias("peak_time"),
        F.coalesce(F.col("_best.display_time"), F.lit("No forecast rows")).alias("peak_time_label"),
        F.coalesce("rideable_hours", F.lit(0)).alias("rideable_hours"),
        F.coalesce("forecast_rows", F.lit(0)).alias("forecast_rows"),
    )


def mean_quality(forecast: DataFrame) -> DataFrame:
    return forecast.groupBy("spot_id").agg(
        clamp(F.avg("quality_index"), 0.0, 5.0).alias("mean_quality"))


def minmax(df: DataFrame, columns) -> dict[str, Column]:
    """Min-max scaled columns; equal values scale to 1 if positive, else 0.

    The bounds are one aggregated row, read ahead of the plan that uses them.
    ``df`` should be stored, as it is read again by that plan.
    """
    bounds = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()
    out = {}
    for c in columns:
        lo, hi = bounds[f"lo_{c}"], bounds[f"hi_{c}"]
        if lo is None or lo == hi:
            out[c] = F.lit(1.0 if hi is not None and hi > 0 else 0.0)
        else:
            out[c] = (F.col(c) - lo) / (hi - lo)
    return out


def rank_spots(peaks: DataFrame, rules: RankingRules = RankingRules()) -> DataFrame:
    """Composite score from scaled quality, ride/drive ratio and hours.

    The cards (one row per spot) are settled first: both the bounds and the
    scores read them, and the scoring below must not run twice.
    """
    cards = settle(peaks.withColumn(
        "ride_drive_ratio", ride_drive_ratio("peak_quality", "drive_minutes", "session_hours", rules)), "cards")
    scaled = minmax(cards, ("peak_quality", "ride_drive_ratio", "session_hours"))
    return cards.withColumn("score", (
        rules.quality_weight * scaled["peak_quality"]
        + rules.ratio_weight * scaled["ride_drive_ratio"]
        + rules.hours_weight * scaled["session_hours"]))


def ranking_table(ranked: DataFrame, ordinal: str) -> DataFrame:
    """Position by score (ties in configured order) with rounded display columns.

    One row per spot, and still cut when there are very many spots.
    """
    one = ranked.withColumns({"_all": F.lit(0), "_down": -F.col("score")})
    series = Series.measure(one, ("_all",), ("_down", ordinal), probe=ranked)
    return number_rows(one, series, "position").select(
        "position", "spot_id", band_name(quality_band("peak_quality")).alias("signal"),
        F.bround("peak_quality", 2).alias("peak_quality"),
        F.bround("drive_minutes", 1).alias("drive_minutes"),
        F.bround("session_hours", 1).alias("session_hours"),
        F.bround("ride_drive_ratio", 2).alias("ride_drive_ratio"),
        F.bround("score", 3).alias("score"),
    )


def topk_with_rest(df: DataFrame, name: str, value: str, k: int = 8) -> DataFrame:
    """The k largest rows plus one row for the rest (count and sum).

    The k-th row is found by a top-k sort and compared as a scalar, so the full
    table is neither sorted nor gathered.
    """
    top = df.orderBy(F.desc(value), F.asc(name)).limit(k)
    edge = top.agg(F.max_by(F.struct(F.col(value).alias("v"), F.col(name).alias("n")),
                            F.struct(-F.col(value), F.col(name)))).scalar()
    is_top = (F.col(value) > edge["v"]) | ((F.col(value) == edge["v"]) & (F.col(name) <= edge["n"]))
    label = F.when(is_top, F.col(name)).otherwise("(rest)")
    return df.groupBy(label.alias(name)).agg(
        F.count("*").alias("entries"), F.sum(value).alias(value))


def snapshot_subset(snapshot: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested spots of a snapshot, or nothing unless it covers them all."""
    ids = requested.select("spot_id").distinct()
    uncovered = ids.join(snapshot.select("spot_id").distinct(), "spot_id", "left_anti")
    missing = uncovered.agg(F.count("*")).scalar()
    return snapshot.join(ids, "spot_id", "left_semi").where(missing == 0)


def latest_per_key(df: DataFrame, keys, order) -> DataFrame:
    """Newest row per key by an explicit order that ends in a unique column."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*keys, "_row.*")


def top_n(df: DataFrame, by: str, name: str, n: int = 8) -> DataFrame:
    return df.where(F.col(by) > 0).orderBy(F.desc(by), F.asc(name)).limit(n)



def fresh_snapshot(snapshot: DataFrame, stamp: str, now: Column, max_age_s: int) -> DataFrame:
    """Snapshot rows young enough to serve; rows without a stamp are stale."""
    return snapshot.where(F.col(stamp) >= now - F.expr(f"INTERVAL {max_age_s} SECONDS")).drop(stamp)
