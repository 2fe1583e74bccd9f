"""Run summaries: roll-ups, states, hand-off, long metrics, selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemos.operators.ranking import latest_per_key
from anemos.params import FEATURE_STAGES, RETRAIN_ALIASES


def run_rollup(spot_runs: DataFrame, keys=("run_id",)) -> DataFrame:
    """Counts of spots per run by what happened to them."""
    status = F.col("status")
    return spot_runs.groupBy(*keys).agg(
        F.count("*").alias("expected_spots"),
        F.count_if(F.col("ingest_rows") > 0).alias("fetched_spots"),
        F.count_if("validation_passed").alias("validated_spots"),
        F.count_if(status == "stored").alias("stored_spots"),
        F.count_if(status == "skipped").alias("skipped_spots"),
        F.count_if(status == "failed").alias("failed_spots"))


def stage_state(failures: Column, duration: Column) -> Column:
    return F.when(F.coalesce(failures, F.lit(0)) > 0, "failed").when(
        duration.isNotNull(), "succeeded").otherwise("not_run")


def stage_states(runs: DataFrame, keys=("run_id",), stages=FEATURE_STAGES) -> DataFrame:
    """State of each known stage per run, as text and as -1/0/1; a stored state wins."""
    failures, durations = F.col("stage_failure_counts"), F.col("stage_durations_seconds")
    state = stage_state(F.element_at(failures, F.col("stage")), F.element_at(durations, F.col("stage")))
    if "stage_states" in runs.columns:
        state = F.coalesce(F.element_at("stage_states", F.col("stage")), state)
    number = F.when(F.col("state") == "failed", -1).when(F.col("state") == "succeeded", 1).otherwise(0)
    return (
        runs.withColumn("stage", F.explode(F.array(*[F.lit(s) for s in stages])))
        .withColumn("state", state)
        .select(*keys, "stage", "state", number.cast("bigint").alias("state_value"),
                F.element_at(durations, F.col("stage")).alias("duration_seconds"),
                F.coalesce(F.element_at(failures, F.col("stage")), F.lit(0)).alias("failure_count"))
    )


def handoff_rule(mode: Column, stored: Column, drifted: Column) -> Column:
    """State of a hand-off from its mode, whether anything was stored, and whether anything drifted."""
    return (
        F.when(mode == "off", "disabled").when(~stored, "not_ready").when(mode == "always", "ready")
        .when((mode == "drift") & drifted, "ready").when(mode == "drift", "waiting_for_drift")
        .otherwise("unknown")
    )


def handoff_state(runs: DataFrame) -> DataFrame:
    """How a feature run hands over to training."""
    mode = F.lower(F.trim(F.coalesce("retraining_mode", F.lit("off"))))
    stored = (F.col("run_status") == "succeeded") & (F.size("stored_spots") > 0)
    drifted = F.size("drifted_spots") > 0
    state = handoff_rule(mode, stored, drifted)
    return runs.select(
        "run_id", mode.alias("handoff_mode"), stored.alias("feature_persistence_ready"),
        drifted.alias("dataset_drift_detected"), state.alias("handoff_state"),
        (state == "ready").alias("handoff_ready"))


def retrain_gate(runs: DataFrame) -> DataFrame:
    """Whether each run leads to training, by normalised mode."""
    pairs = [F.lit(x) for pair in RETRAIN_ALIASES.items() for x in pair]
    raw = F.lower(F.trim(F.coalesce("retraining_mode", F.lit("always"))))
    mode = F.coalesce(F.element_at(F.create_map(*pairs), raw), F.lit("unsupported"))
    has_stored = F.size(F.filter("stored_spots", lambda s: F.trim(s) != "")) > 0
    gate = F.when(mode == "always", has_stored).when(mode == "drift", F.size("drifted_spots") > 0).otherwise(False)
    return runs.select("run_id", mode.alias("mode"), gate.alias("retrain"))


def summary_metrics_long(runs: DataFrame) -> DataFrame:
    """Run documents to (run, metric name, value) rows."""
    def metric(name: Column, value: Column) -> Column:
        return F.struct(name.alias("metric"), value.cast("double").alias("value"))

    def per_stage(name: str, suffix: str) -> Column:
        return F.transform(F.map_entries(name), lambda e: metric(
            F.concat(F.lit("feature_"), e["key"], F.lit(suffix)), e["value"]))

    counts = F.array(
        metric(F.lit("feature_expected_spot_count"), F.size("spots")),
        metric(F.lit("feature_stored_spot_count"), F.size("stored_spots")),
        metric(F.lit("feature_drifted_spot_count"), F.size("drifted_spots")),
        metric(F.lit("feature_dataset_drift_detected"), (F.size("drifted_spots") > 0).cast("int")),
        metric(F.lit("feature_failed_spot_count"),
               F.size(F.filter("spots", lambda s: s["status"] == "failed"))),
    )
    spots = F.flatten(F.transform("spots", lambda s: F.array(*[
        metric(F.concat(F.lit("feature_"), s["spot_id"], F.lit(f"_{name}")), value)
        for name, value in (
            ("ingest_rows", s["ingest_rows"]), ("stored_rows", s["stored_rows"]),
            ("validation_passed", s["validation_passed"].cast("int")),
            ("range_violation_count", s["range_violation_count"]),
            ("max_numeric_abs_delta", s["max_numeric_abs_delta"]))])))
    every = F.concat(counts, per_stage("stage_durations_seconds", "_duration_seconds"),
                     per_stage("stage_failure_counts", "_failure_count"), spots)
    return runs.select("run_id", F.inline(every)).where(F.col("value").isNotNull())


def training_metrics_long(runs: DataFrame) -> DataFrame:
    """Training run documents to (run, metric name, value) rows; absent values give none."""
    fields = {
        "training_row_count": "training_row_count", "training_feature_count": "training_feature_count",
        "train_row_count": "training_train_row_count", "test_row_count": "training_test_row_count",
    }
    version = F.col("registered_model_version")
    cells = [F.struct(F.lit(name).alias("metric"), F.col(c).cast("double").alias("value"))
             for c, name in fields.items()]
    cells.append(F.struct(F.lit("training_model_registered").alias("metric"),
                          (F.coalesce(version, F.lit("")) != "").cast("int").cast("double").alias("value")))
    cells.append(F.struct(F.lit("training_registered_model_version").alias("metric"),
                          F.when(version.rlike("^[0-9]+$"), version.cast("double")).alias("value")))
    extra = F.transform(F.map_entries("run_metrics"), lambda e: F.struct(
        F.concat(F.lit("training_metric_"), e["key"]).alias("metric"), e["value"].alias("value")))
    every = F.concat(F.array(*cells), extra)
    return runs.select("run_id", F.inline(every)).where(F.col("value").isNotNull())


def stage_overview(runs: DataFrame) -> DataFrame:
    """One row per spot of each run document."""
    return runs.select("run_id", "dataset", F.inline("spots"))


def latest_with_patch(history: DataFrame, patches: DataFrame, key: str, order, field: str) -> DataFrame:
    """Latest document per key with one field patched from a side table."""
    newest = latest_per_key(patches, (key,), ("patched_at", "patch_id")).select(key, F.col(field).alias("_new"))
    return latest_per_key(history, (key,), order).join(newest, key, "left").withColumn(
        field, F.coalesce("_new", field) if field in history.columns else F.col("_new")).drop("_new")


def group_runs(history: DataFrame, key: str, order) -> DataFrame:
    """Runs per pipeline, newest first, as counts and the newest run."""
    return history.groupBy(key).agg(
        F.count("*").alias("runs"), F.max_by(F.struct("run_id", "run_status"), F.struct(*order)).alias("_r")
    ).select(key, "runs", F.col("_r.run_id").alias("latest_run_id"), F.col("_r.run_status").alias("latest_status"))


def select_run_summary(history: DataFrame, wanted: DataFrame, key: str, order) -> DataFrame:
    """Latest summary if its run id fits (or none is asked or stored), else the newest with that id.

    ``wanted`` holds (key, wanted_run_id) requests. The history is reduced to
    one row per key and per (key, run id) before the requests join it.
    """
    fields = [c for c in history.columns if c != key]
    asked = wanted.distinct()
    latest = latest_per_key(history, (key,), order).select(key, F.struct(*fields).alias("_latest"))
    exact = latest_per_key(history.where(F.col("run_id").isNotNull()), (key, "run_id"), order).select(
        key, F.col("run_id").alias("wanted_run_id"), F.struct(*fields).alias("_exact"))
    both = asked.join(latest, key).join(exact, [key, "wanted_run_id"], "left")
    fits = F.col("wanted_run_id").isNull() | F.col("_latest.run_id").isNull() | (
        F.col("_latest.run_id") == F.col("wanted_run_id"))
    row = F.when(fits, F.col("_latest")).otherwise(F.col("_exact"))
    return both.withColumn("_row", row).where(F.col("_row").isNotNull()).select(key, "wanted_run_id", "_row.*")
