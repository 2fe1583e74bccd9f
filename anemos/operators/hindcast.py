"""Past predictions against observed outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemos.functions.quality import quality_band
from anemos.functions.temporal import round_to_hour

PAIR_KEY = ("spot_id", "forecast_hour")


def observation_window(eligible: DataFrame, spots: DataFrame) -> DataFrame:
    """Date span to observe per known spot."""
    return (
        eligible.join(spots.select("spot_id").distinct(), "spot_id", "left_semi")
        .groupBy("spot_id")
        .agg(F.to_date(F.min("forecast_time")).alias("start_date"),
             F.to_date(F.max("forecast_time")).alias("end_date"))
    )


def hindcast_pairs(predictions: DataFrame, observed: DataFrame) -> DataFrame:
    """Prediction/observation pairs per spot and rounded hour, with their number.

    Both sides are counted per distinct value before the join, so an hour that
    holds very many rows joins a handful of counted rows instead of all pairs.
    """
    p = predictions.groupBy(
        "spot_id", round_to_hour("forecast_time").alias("forecast_hour"), "quality_index"
    ).agg(F.count("*").alias("_p"))
    o = observed.groupBy(
        "spot_id", round_to_hour("time").alias("forecast_hour"), "actual_quality_index"
    ).agg(F.count("*").alias("_o"))
    return p.join(o, list(PAIR_KEY)).select(
        *PAIR_KEY, "quality_index", "actual_quality_index", (F.col("_p") * F.col("_o")).alias("pairs"))


def hindcast_metrics(pairs: DataFrame) -> DataFrame:
    """Pair count, class accuracy and MAE; the rates are null without pairs."""
    hit = F.bround("quality_index", 0) == F.bround("actual_quality_index", 0)
    gap = F.abs(F.col("quality_index") - F.col("actual_quality_index"))
    n = F.sum("pairs")
    return pairs.agg(
        F.coalesce(n, F.lit(0)).alias("validated_count"),
        F.try_divide(F.sum(F.when(hit, F.col("pairs")).otherwise(0)), n).alias("accuracy"),
        F.try_divide(F.sum(gap * F.col("pairs")), n).alias("mae"),
    )


def hindcast_class_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(
        F.bround("actual_quality_index", 0).cast("bigint").alias("quality_class")
    ).agg(F.sum("pairs").alias("pairs"))


def regression_metrics(df: DataFrame, actual: str, predicted: str, by=()) -> DataFrame:
    """MAE, RMSE and R2; a constant target gives R2 of 1 when exact, else 0."""
    y, gap = F.col(actual).cast("double"), F.col(predicted) - F.col(actual)
    sums = df.groupBy(*by).agg(
        F.count("*").alias("rows"), F.avg(F.abs(gap)).alias("mae"), F.avg(gap * gap).alias("_mse"),
        F.var_pop(y).alias("_var"), F.min(y).alias("_lo"), F.max(y).alias("_hi"),
    )
    constant = F.col("_lo") == F.col("_hi")
    r2 = F.when(constant, F.when(F.col("_mse") == 0, 1.0).otherwise(0.0)).otherwise(
        1.0 - F.try_divide(F.col("_mse"), F.col("_var")))
    return sums.select(*by, "rows", "mae", F.sqrt("_mse").alias("rmse"), r2.alias("r2"))


def class_accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Share of hits after rounding, per true class and overall."""
    hit = (quality_band(predicted) == F.col(actual)).cast("bigint")
    per_class = df.groupBy(F.col(actual).cast("bigint").alias("label")).agg(
        F.sum(hit).alias("hits"), F.count("*").alias("rows"))
    overall = per_class.agg(F.lit(None).cast("bigint").alias("label"),
                            F.sum("hits").alias("hits"), F.sum("rows").alias("rows"))
    name = F.coalesce(F.concat(F.lit("class_accuracy_"), F.col("label")), F.lit("overall_class_accuracy"))
    return per_class.unionByName(overall).select(
        name.alias("metric"), F.try_divide("hits", "rows").alias("value"), "rows")


def shadow_divergence(df: DataFrame, champion: str, candidate: str, by=()) -> DataFrame:
    gap = F.abs(F.col(candidate) - F.col(champion))
    return df.groupBy(*by).agg(
        F.avg(gap).alias("mean_abs_divergence"), F.max(gap).alias("max_abs_divergence"),
        F.count(gap).alias("compared_rows"))


def shadow_from_log(events: DataFrame, champion: str, candidate: str) -> DataFrame:
    """Compare two model versions of one event log; no rows when they are the same.

    Repeats of one spot and time are averaged first: a log has no row order that
    would pair them up, and all pairs would multiply.
    """
    both = (
        events.where(F.col("model_version").isin(champion, candidate) & F.lit(champion != candidate))
        .groupBy("spot_id", "forecast_time")
        .agg(F.avg(F.when(F.col("model_version") == champion, F.col("quality_index"))).alias("_a"),
             F.avg(F.when(F.col("model_version") == candidate, F.col("quality_index"))).alias("_b"))
        .where("_a IS NOT NULL AND _b IS NOT NULL")
    )
    return (
        shadow_divergence(both, "_a", "_b").where("compared_rows > 0")
        .select(F.lit(champion).alias("champion_version"), F.lit(candidate).alias("candidate_version"), "*")
    )
