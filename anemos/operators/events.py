"""The prediction event log: flattening, retention, gauges, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anemos.functions.temporal import seconds
from anemos.functions.text import normalize_id_list, normalize_label
from anemos.operators.ordered import Series, number_rows
from anemos.params import SALTS, RetentionRules



def flatten_predictions(payloads: DataFrame, endpoint: Column, logged_at: Column,
                        requested: Column) -> DataFrame:
    """Nested payloads to one event per forecast hour; spots without hours give none."""
    spots = payloads.select(
        endpoint.alias("endpoint"), logged_at.alias("prediction_timestamp"),
        requested.alias("requested_spot_ids"),
        normalize_label("model_version").alias("model_version"), F.inline("predictions"),
    )
    return spots.select(
        "prediction_timestamp", "endpoint", "model_version", "spot_id", "spot_name",
        "requested_spot_ids", F.inline("forecast"),
    ).withColumnRenamed("time", "forecast_time")


def normalize_events(df: DataFrame) -> DataFrame:
    """Typed event rows: unreadable times become null, id lists become arrays."""
    out = df.withColumns({
        c: F.try_to_timestamp(F.col(c)).cast("timestamp_ntz")
        for c in ("prediction_timestamp", "forecast_time") if c in df.columns
    })
    if "requested_spot_ids" in df.columns:
        out = out.withColumn("requested_spot_ids", normalize_id_list("requested_spot_ids"))
    return out


def _cutoff(df: DataFrame, time: str, days: int) -> Column:
    return df.agg(F.max(time)).scalar() - F.expr(f"INTERVAL {days} DAYS")


def _newest(df: DataFrame, order, rows: int) -> DataFrame:
    """Newest rows per model in two steps.

    Every map task sends up to ``rows`` rows of a model, which for one huge
    model adds up. Salted parts of a model are limited first, each in its own
    task; their survivors are few.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64("seq"), F.lit(SALTS)))
    for keys in (("model_version", "_salt"), ("model_version",)):
        w = Window.partitionBy(*keys).orderBy(*order)
        salted = salted.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= rows).drop("_rn")
    return salted.drop("_salt")


def retain_by_time(df: DataFrame, rules: RetentionRules, model: str | None = None) -> DataFrame:
    """Warehouse form: inside the time limit, newest rows per model by time."""
    kept = df.where(F.col("prediction_timestamp") >= _cutoff(df, "prediction_timestamp", rules.days))
    if model:
        kept = kept.where(F.col("model_version") == model)
    order = (F.desc("prediction_timestamp"), F.desc("forecast_time"), F.desc("seq"))
    return _newest(kept, order, rules.max_rows).orderBy("prediction_timestamp", "forecast_time")


def retain_by_sequence(df: DataFrame, rules: RetentionRules, model: str | None = None) -> DataFrame:
    """File form: time limit only if any time is valid, then last rows per model as appended."""
    named = df.withColumn("model_version", normalize_label("model_version"))
    cutoff = _cutoff(df, "prediction_timestamp", rules.days)
    kept = named.where(cutoff.isNull() | (F.col("prediction_timestamp") >= cutoff))
    if model is not None:
        kept = kept.where(F.col("model_version") == normalize_label(F.lit(model)))
    return _newest(kept, (F.desc("seq"),), rules.max_rows).orderBy("seq")


def eligible(df: DataFrame, now: Column, buffer_hours: int) -> DataFrame:
    return df.where(F.col("forecast_time") < now - F.expr(f"INTERVAL {buffer_hours} HOURS"))


def log_gauges(df: DataFrame) -> DataFrame:
    """Rows and latest times per model, plus the totals row (model ``*``)."""
    named = df.withColumn("model_version", normalize_label("model_version"))
    per_model = named.groupBy("model_version").agg(
        F.count("*").alias("row_count"),
        seconds(F.max("prediction_timestamp")).alias("latest_prediction_s"),
        seconds(F.max("forecast_time")).alias("latest_forecast_s"),
    ).withColumn("models", F.lit(1).cast("bigint"))
    # One row per model reaches this second step.
    total = per_model.agg(
        F.lit("*").alias("model_version"), F.sum("row_count").alias("row_count"),
        F.max("latest_prediction_s").alias("latest_prediction_s"),
        F.max("latest_forecast_s").alias("latest_forecast_s"), F.count("*").alias("models"),
    )
    return per_model.unionByName(total)


def time_split(df: DataFrame, days: int, time: str = "prediction_timestamp", order: str = "seq") -> DataFrame:
    """Add ``side``: reference before the last ``days``, current after.

    Rows without a time go. Where one side would be empty the log is halved in
    its appended order instead.
    """
    edge = df.agg(
        F.max(time).alias("hi"),
        (F.min(time) < F.max(time) - F.expr(f"INTERVAL {days} DAYS")).alias("both"),
    ).first()
    if edge["both"]:
        cutoff = F.lit(edge["hi"]).cast("timestamp_ntz") - F.expr(f"INTERVAL {days} DAYS")
        return df.where(F.col(time).isNotNull()).withColumn(
            "side", F.when(F.col(time) < cutoff, "reference").otherwise("current"))
    return midpoint_split(df, (), (order,))


def midpoint_split(df: DataFrame, keys, order, rows_per_segment: int | None = None,
                   series: Series | None = None) -> DataFrame:
    """Add ``side``: the first half of each key is reference; keys under two rows go."""
    one = df if keys else df.withColumn("_all", F.lit(0))
    by = tuple(keys) or ("_all",)
    series = series or Series.measure(one, by, order, rows_per_segment)
    numbered = number_rows(one, series, "_position", "_count")
    half = F.floor(F.col("_count") / 2)
    return (
        numbered.where(F.col("_count") >= 2)
        .withColumn("side", F.when(F.col("_position") <= half, "reference").otherwise("current"))
        .drop("_position", "_count", "_all")
    )


def quality_timeline(past: DataFrame, observed: DataFrame, forecast: DataFrame, now: Column) -> DataFrame:
    """Past predictions, labelled observations and the forecast as one ordered series."""
    def part(df: DataFrame, time: str, name: str) -> DataFrame:
        return df.select("spot_id", F.col(time).alias("time"),
                         F.col("quality_index").cast("double").alias("quality_index"),
                         F.lit(name).alias("series"))

    before = past.where(F.col("forecast_time") < now)
    return (
        part(before, "forecast_time", "Predicted (past)")
        .unionByName(part(observed, "time", "Observed"))
        .unionByName(part(forecast, "time", "Forecast"))
        .orderBy("time", "spot_id")
    )
