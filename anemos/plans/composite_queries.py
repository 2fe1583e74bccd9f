"""The user-facing jobs that chain several operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemos.operators import asof
from anemos.operators import drift as d
from anemos.operators import features as fx
from anemos.operators import quality as q
from anemos.operators.events import log_gauges
from anemos.operators.hindcast import hindcast_metrics, shadow_from_log
from anemos.operators.metrics import aggregate_samples, select_samples
from anemos.operators.runs import handoff_rule, summary_metrics_long
from anemos.params import MODEL_FEATURES, VALUE_RANGES, StoreLayout
from anemos.plans.bindings import Tables, with_sql
from anemos.plans.event_queries import GAUGE_PART, PAIRS_SQL, SPOT_PART, _melt_sql, hindcast_pairs, ks_sql, spot_gauges
from anemos.plans.join_queries import _CHECKED, _NULLS, GRID_SQL, _violation_sql
from anemos.plans.metric_queries import _SUMMARY
from anemos.plans.registry import query, rounded
from anemos.plans.source_queries import land_deliveries
from anemos.session import fresh_path, settle
from anemos.sources import readers, writers
from anemos.sources.slicestore import SliceStore
from anemos.sources.writers import shape_for_store

# Ranges widened to the given values, so that some slices pass and some fail.
CURATE_RANGES = {**VALUE_RANGES, "wind_speed_10m": (0.0, 330.0), "wind_speed_80m": (0.0, None), "wind_speed_120m": (0.0, None),
                 "wind_gusts_10m": (-5.0, 520.0), "relative_humidity_2m": (0.0, 110.0)}


def curate_slices(rows: DataFrame, store: SliceStore, dataset: str, policy: str, ranges=VALUE_RANGES, columns=_CHECKED,
                  drift_columns=MODEL_FEATURES) -> DataFrame:
    """Validate engineered rows, test drift against the stored slices, replace them, report per spot.

    ``rows`` is a settled table: every step below reads it. The stored slices
    are read for drift before they are replaced; of the drift columns those count that both sides have.
    """
    verdict = settle(q.validate_slices(rows, columns, columns=columns, ranges=ranges), "verdict")
    accepted = q.apply_policy(rows, verdict, policy)
    report = None
    previous = store.read(dataset)
    if previous is not None:
        drift_columns = d.shared_columns(previous, accepted, drift_columns)
        sides = previous.select("spot_id", *drift_columns, F.lit("reference").alias("side")).unionByName(
            accepted.select("spot_id", *drift_columns, F.lit("current").alias("side")))
        both = sides.join(accepted.select("spot_id").distinct(), "spot_id", "left_semi")
        tests = d.drift_verdict(d.drift_ks(both, drift_columns, ("spot_id",)))
        report = settle(d.drift_report(tests, ("spot_id",)), "drift")
    store.replace(shape_for_store(accepted, dataset))
    written = store.read(dataset).groupBy("spot_id").agg(F.count("*").alias("stored_rows"))
    out = verdict.join(written, "spot_id", "left")
    if report is not None:
        out = out.join(report.select("spot_id", "drifted_column_count", "dataset_drift"), "spot_id", "left")
    else:
        out = out.withColumns({"drifted_column_count": F.lit(0), "dataset_drift": F.lit(False)})
    return out.select(
        "spot_id", "rows", "is_valid", "range_violations", F.coalesce("stored_rows", F.lit(0)).alias("stored_rows"),
        F.coalesce("drifted_column_count", F.lit(0)).cast("bigint").alias("drifted_columns"),
        F.coalesce("dataset_drift", F.lit(False)).alias("drifted"))


def handoff(report: DataFrame, mode: str) -> DataFrame:
    """Run-level hand-off from the per-spot report."""
    totals = report.agg(F.count_if(F.col("stored_rows") > 0).alias("stored"), F.count_if("drifted").alias("drifted"))
    return totals.select(handoff_rule(F.lit(mode), F.col("stored") > 0, F.col("drifted") > 0).alias("handoff_state"))


# A delivery is lost where its file is broken, and refused where its gust speeds come in another unit.
_BROKEN, _FOREIGN_UNIT = "user_id % 13 = 5", "user_id % 11 = 7"
_CURATE_SQL = f""", sent AS (SELECT spot_id, CASE WHEN {_BROKEN} THEN 'foreign' WHEN {_FOREIGN_UNIT} THEN 'rejected unit' ELSE 'delivered' END AS delivery FROM spots),
    viol AS (SELECT spot_id, count(*) AS n FROM ({_violation_sql('features', 'spot_id', CURATE_RANGES)}) GROUP BY spot_id),
    agg AS (SELECT spot_id, count(*) AS rows, greatest({_NULLS}) AS max_null FROM features GROUP BY spot_id),
    ver AS (SELECT spot_id, rows, coalesce(n,0) AS range_violations, max_null <= 0.1e0 AND coalesce(n,0) = 0 AS is_valid
      FROM agg LEFT JOIN viol USING (spot_id) JOIN sent USING (spot_id) WHERE delivery = 'delivered'),
    both_sides AS (SELECT f.*, 'reference' AS side FROM features f WHERE event_id % 2 = 0 UNION ALL SELECT f.*, 'current' FROM features f),
    sides AS (SELECT b.* FROM both_sides b JOIN ver USING (spot_id) WHERE is_valid),
    melted AS ({_melt_sql('sides', MODEL_FEATURES, 'spot_id')}),
    {ks_sql('melted', 'spot_id')}, dr AS (SELECT spot_id, CAST(sum(CASE WHEN score <= 0.05e0 THEN 1 ELSE 0 END) AS BIGINT) AS dc, count(*) AS cc FROM ks GROUP BY spot_id),
    old AS (SELECT spot_id, count(*) AS n FROM features WHERE event_id % 2 = 0 GROUP BY 1),
    rep AS (SELECT sent.spot_id, delivery, rows, is_valid, range_violations, CASE WHEN rows IS NULL THEN 0 WHEN is_valid THEN rows ELSE coalesce(old.n,0) END AS stored_rows,
      coalesce(dc,0) AS drifted_columns, coalesce(dc*1e0/cc >= 0.15e0, false) AS drifted
      FROM sent LEFT JOIN ver USING (spot_id) LEFT JOIN dr USING (spot_id) LEFT JOIN old USING (spot_id))
    SELECT *, CASE WHEN (SELECT count(*) FROM rep WHERE stored_rows>0)=0 THEN 'not_ready' WHEN (SELECT count(*) FROM rep WHERE drifted)>0 THEN 'ready' ELSE 'waiting_for_drift' END AS handoff_state FROM rep"""


def landed_units(t: Tables) -> DataFrame:
    """One landed document per spot that tells its units."""
    one = F.array(F.lit(1.0))
    units = F.create_map(F.lit("wind_speed_10m"), F.lit("km/h"), F.lit("wind_gusts_10m"),
                         F.when(F.expr(_FOREIGN_UNIT), "mph").when(F.expr("user_id % 3 = 0"), "undefined").otherwise("km/h"))
    hourly = F.struct(F.array(F.lit("2024-01-01T00:00")).alias("time"), one.alias("wind_speed_10m"), one.alias("wind_gusts_10m"))
    return t.spots.select(F.to_json(F.struct("spot_id", hourly.alias("hourly"), units.alias("hourly_units"))).alias("value"))


def ingest(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Readings from landed files of many spots, where their units are known, and what became of every spot's delivery."""
    path, documents = fresh_path(t.spark, "entity"), fresh_path(t.spark, "documents")
    manifest = land_deliveries(t.readings, _BROKEN, path)
    landed_units(t).write.text(documents)
    rows, report = readers.read_isolated(t.spark, path, t.readings.schema, manifest)
    units = q.unit_contract(readers.hourly_units(readers.read_hourly_payloads(t.spark, documents, one_per_file=False)), ("spot_id",))
    refused = settle(units.where("status = 'rejected'").select("spot_id").distinct().withColumn("refused", F.lit(True)), "refused")
    status = readers.entity_status(t.spots.select("spot_id"), report).join(refused, "spot_id", "left")
    delivery = F.when((F.col("status") == "delivered") & F.col("refused"), "rejected unit").otherwise(F.col("status"))
    return rows.join(refused, "spot_id", "left_anti"), settle(status.select("spot_id", delivery.alias("delivery")), "deliveries")


@query("curate", with_sql("features", _CURATE_SQL))
def curate(t: Tables):
    """From landed files to stored slices: scan, unit check, features, then two refreshes of the store.

    The first takes half the readings, the second all of them with invalid slices skipped.
    """
    raw, deliveries = ingest(t)
    series = t.spot_series
    rows = settle(fx.engineer_features(fx.fill_wind_profile(fx.enrich(raw, t.spots.drop("user_id"))), series), "stage")
    store = SliceStore(t.spark, fresh_path(t.spark, "store"))
    curate_slices(rows.where("event_id % 2 = 0"), store, "train", "warn", CURATE_RANGES)
    report = settle(curate_slices(rows, store, "train", "skip", CURATE_RANGES), "report")
    return deliveries.join(report, "spot_id", "left").withColumns({
        "stored_rows": F.coalesce("stored_rows", F.lit(0)), "drifted_columns": F.coalesce("drifted_columns", F.lit(0)),
        "drifted": F.coalesce("drifted", F.lit(False)), "handoff_state": handoff(report, "drift").scalar()})


@query("backfill_events", with_sql("features labelled", GRID_SQL + """, viol AS (SELECT spot_id, count(*) AS n FROM (""" + _violation_sql('features', 'spot_id', CURATE_RANGES) + f""") GROUP BY spot_id),
    agg AS (SELECT spot_id, greatest({_NULLS}) AS max_null FROM features GROUP BY spot_id)
    SELECT spot_id, grid_time AS prediction_timestamp, time AS forecast_time, quality_index, 'backfill' AS endpoint, max_null > 0.1e0 OR n IS NOT NULL AS warned
    FROM sampled s JOIN agg USING (spot_id) LEFT JOIN viol USING (spot_id)
    WHERE NOT EXISTS (SELECT 1 FROM labelled l WHERE l.event_id % 4 = 0 AND l.spot_id = s.spot_id AND l.time = s.time)"""))
def backfill_events(t: Tables):
    """Synthetic events every six hours from an archive of days, without those already stored.

    The archive is checked first; slices that fail are used all the same and marked.
    """
    path = fresh_path(t.spark, "archive")
    writers.write_by_day(t.readings, path, StoreLayout("time", ("spot_id",), 730))
    archive = t.spark.read.parquet(path).drop("day")
    series = t.spot_series
    features = settle(fx.engineer_features(fx.fill_wind_profile(fx.enrich(archive, t.spots.drop("user_id"))), series), "history")
    verdict = q.validate_slices(features, _CHECKED, columns=_CHECKED, ranges=CURATE_RANGES)
    usable = q.apply_policy(features, verdict, "warn")
    labelled = settle(fx.label_rows(usable, F.lit(12.0)).select("spot_id", "time", "event_id", "quality_index"), "labels")
    sampled = asof.grid_sample(labelled.drop("event_id"), features.select("spot_id", "time"), ("spot_id",), "time", "6 HOURS",
                               ("quality_index",), series=series)
    events = sampled.select("spot_id", F.col("grid_time").alias("prediction_timestamp"), F.col("time").alias("forecast_time"),
                            "quality_index", F.lit("backfill").alias("endpoint"))
    stored = labelled.where("event_id % 4 = 0").select("spot_id", F.col("time").alias("forecast_time"))
    fresh = asof.anti_dedup(events, stored, ("spot_id", "forecast_time"))
    return fresh.join(verdict.select("spot_id", (~F.col("is_valid")).alias("warned")), "spot_id")


_ROLLUP_SQL = PAIRS_SQL + SPOT_PART + GAUGE_PART + _SUMMARY + """, lg AS (SELECT model_version, count(*) AS n, epoch_us(max(forecast_time))/1e6 AS f FROM prediction_events GROUP BY 1),
    sh AS (SELECT spot_id, seq // 8 AS hour, avg(CASE WHEN model_version='1' THEN quality_index END) AS a, avg(CASE WHEN model_version='2' THEN quality_index END) AS c
      FROM prediction_events WHERE model_version IN ('1','2') GROUP BY 1,2),
    long AS (SELECT 'prediction_log_rows' AS name, model_version AS label, CAST(n AS DOUBLE) AS value FROM lg UNION ALL SELECT 'prediction_log_latest_forecast', model_version, f FROM lg
      UNION ALL SELECT 'prediction_log_rows', '*', sum(n) FROM lg UNION ALL SELECT 'prediction_log_latest_forecast', '*', max(f) FROM lg
      UNION ALL SELECT 'hindcast_accuracy', '', avg(CASE WHEN round_even(quality_index,0) = actual_quality_index THEN 1e0 ELSE 0e0 END) FROM pairs
      UNION ALL SELECT 'hindcast_mae', '', avg(abs(quality_index-actual_quality_index)) FROM pairs
      UNION ALL SELECT 'shadow_mean_abs_divergence', '', avg(abs(c-a)) FROM sh WHERE a IS NOT NULL AND c IS NOT NULL HAVING count(*) > 0
      UNION ALL SELECT 'drift_' || metric, dataset, value FROM gauges WHERE "column" = 'dataset'
      UNION ALL SELECT 'drift_column_' || metric, dataset || '.' || "column", value FROM gauges WHERE "column" <> 'dataset'
      UNION ALL SELECT metric, run_id, value FROM mt)
    SELECT name, label, round(value,4)+0e0 AS value FROM long UNION ALL SELECT 'max by drift_share', '', round(max(value),4) FROM long WHERE name = 'drift_share_of_drifted_columns'"""


@query("metrics_rollup", with_sql("prediction_events observed_labels features runs run_spots", _ROLLUP_SQL))
def metrics_rollup(t: Tables):
    """Log, hindcast, shadow, drift and run-summary values as one sample table, and a selection over it."""
    def sample(df: DataFrame, name: str, label, value) -> DataFrame:
        return df.select(F.lit(name).alias("name"), label.alias("label"), value.cast("double").alias("value"))

    log = settle(log_gauges(t.predictions), "gauges")
    hind = settle(hindcast_metrics(hindcast_pairs(t)), "hindcast")
    shadow = shadow_from_log(t.predictions.withColumn("forecast_time", F.floor(F.col("seq") / 8)), "1", "2")
    gauges = spot_gauges(t)
    whole = F.col("column") == "dataset"
    none = F.lit("")
    table = (
        sample(log, "prediction_log_rows", F.col("model_version"), F.col("row_count"))
        .unionByName(sample(log, "prediction_log_latest_forecast", F.col("model_version"), F.col("latest_forecast_s")))
        .unionByName(sample(hind, "hindcast_accuracy", none, F.col("accuracy")))
        .unionByName(sample(hind, "hindcast_mae", none, F.col("mae")))
        .unionByName(sample(shadow, "shadow_mean_abs_divergence", none, F.col("mean_abs_divergence")))
        .unionByName(gauges.select(
            F.concat(F.when(whole, "drift_").otherwise("drift_column_"), F.col("metric")).alias("name"),
            F.when(whole, F.col("dataset")).otherwise(F.concat_ws(".", "dataset", "column")).alias("label"), "value"))
        .unionByName(summary_metrics_long(t.runs).select(F.col("metric").alias("name"), F.col("run_id").alias("label"), "value"))
    )
    # The label map repeats the label: only the selection reads it, so it is not stored.
    stored = settle(table, "samples")
    labelled = stored.withColumn("labels", F.create_map(F.lit("key"), F.col("label")))
    worst = aggregate_samples(select_samples(labelled, "drift_share_of_drifted_columns"), "max")
    return stored.unionByName(
        worst.select(F.lit("max by drift_share").alias("name"), none.alias("label"), "value")).withColumn(
        "value", F.round("value", 4) + F.lit(0.0))
