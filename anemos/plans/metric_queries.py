"""Queries over metric samples and alerts, and over run documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from anemos.operators import metrics as m
from anemos.operators import runs as rn
from anemos.params import LATENCY_BOUNDS, TRAINING_STAGES
from anemos.plans.bindings import Tables, with_sql
from anemos.plans.registry import query, r6, rounded


@query("metric_select", with_sql("samples", """SELECT event_id, endpoint, result, value FROM samples WHERE regexp_full_match(endpoint,'view|cl.*')
    AND result <> '1' AND NOT regexp_full_match(result,'[3-9]')"""))
def metric_select(t: Tables):
    found = m.select_samples(t.labelled_samples, "requests_total", ("endpoint", "=~", "view|cl.*"), ("result", "!=", "1"),
                             ("result", "!~", "[3-9]"), ("absent", "=", ""))
    return found.select("event_id", m.label("endpoint").alias("endpoint"), m.label("result").alias("result"), "value")


@query("metric_aggregate", with_sql("samples", """SELECT 'max' AS how, round(max(value),4) AS value FROM samples UNION ALL SELECT 'min', round(min(value),4) FROM samples
    UNION ALL SELECT 'avg', round(avg(value),4) FROM samples UNION ALL SELECT 'sum', round(sum(value),4) FROM samples
    UNION ALL SELECT 'clamped', round(sum(least(value,100e0)),4) FROM samples"""))
def metric_aggregate(t: Tables):
    s = t.labelled_samples
    # The four aggregates share one scan; the capped values feed a fifth.
    plain = s.agg(F.max("value").alias("max"), F.min("value").alias("min"), F.avg("value").alias("avg"), F.sum("value").alias("sum"))
    long = plain.unpivot([], ["max", "min", "avg", "sum"], "how", "value").unionByName(
        m.aggregate_samples(m.clamp_max(s, 100.0), "sum").withColumn("how", F.lit("clamped")))
    return long.withColumn("value", F.round("value", 4))


@query("metric_sum_by", with_sql("samples", """SELECT endpoint, result, round(sum(value),4) AS value FROM samples GROUP BY 1,2"""))
def metric_sum_by(t: Tables):
    return m.aggregate_samples(t.labelled_samples, "sum", ("endpoint", "result")).withColumn("value", F.round("value", 4))


@query("metric_vector_arith", with_sql("samples", """, r AS (SELECT endpoint, result, arg_max(value, event_id) AS r FROM samples WHERE result <> '2' GROUP BY 1,2)
    SELECT event_id, endpoint, result, round(s.value - r.r, 6)+0e0 AS value FROM samples s JOIN r USING (endpoint, result)"""))
def metric_vector_arith(t: Tables):
    s = t.labelled_samples
    right = m.select_samples(s, "requests_total", ("result", "!=", "2")).withColumn("name", F.lit("other"))
    found = m.vector_arith(s, right, "-", "event_id")
    return rounded(found.select("event_id", m.label("endpoint").alias("endpoint"), m.label("result").alias("result"), "value"), "value")


@query("metric_scalar_arith", with_sql("samples", """SELECT event_id, round((SELECT max(value) FROM samples) - value, 6)+0e0 AS below_max,
    round(1706572800e0 - epoch_us(ts)/1e6, 3) AS age_s FROM samples"""))
def metric_scalar_arith(t: Tables):
    s = t.samples
    top = m.aggregate_samples(s, "max").scalar()
    below = m.scalar_arith(s, top, "-", scalar_first=True)
    stamped = below.withColumnRenamed("value", "below_max").withColumn("value", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    now = F.lit(1706572800.0)
    return m.scalar_arith(stamped, now, "-", scalar_first=True).select(
        "event_id", r6("below_max").alias("below_max"), F.round("value", 3).alias("age_s"))


@query("run_counters", with_sql("samples", "SELECT endpoint, result, count(*) AS runs, epoch_us(max(ts))/1e6 AS last_seen_s FROM samples GROUP BY 1,2"))
def run_counters(t: Tables):
    return m.run_counters(t.samples)


_BOUNDS = LATENCY_BOUNDS
_HIST_SQL = ", q AS (SELECT endpoint, result, value/50 AS latency FROM samples), hist AS (" + " UNION ALL ".join(
    f"SELECT endpoint, result, {b}e0 AS le, CAST(sum(CASE WHEN latency <= {b}e0 THEN 1 ELSE 0 END) AS BIGINT) AS cumulative FROM q GROUP BY 1,2" for b in _BOUNDS
) + " UNION ALL SELECT endpoint, result, 1e308, count(*) FROM q GROUP BY 1,2) "


def _histogram(t: Tables):
    return m.latency_histogram(t.samples.withColumn("latency", F.col("value") / 50), ("endpoint", "result"), "latency")


@query("latency_histogram", with_sql("samples", _HIST_SQL + "SELECT endpoint, result, CASE WHEN le > 100 THEN -1e0 ELSE le END AS le, cumulative FROM hist"))
def latency_histogram(t: Tables):
    # The infinite bound is shown as -1, so that every reader prints it alike.
    return _histogram(t).withColumn("le", F.when(F.col("le") > 100, -1.0).otherwise(F.col("le")))


@query("histogram_quantile", with_sql("samples", _HIST_SQL + """, r AS (SELECT *, max(cumulative) OVER (PARTITION BY endpoint, result) AS n,
    lag(le,1,0e0) OVER w AS lo, lag(cumulative,1,0) OVER w AS under FROM hist WINDOW w AS (PARTITION BY endpoint, result ORDER BY le)),
    f AS (SELECT *, row_number() OVER (PARTITION BY endpoint, result ORDER BY le) AS rn FROM r WHERE cumulative >= 0.95e0*n)
    SELECT endpoint, result, round(CASE WHEN le > 100 THEN lo ELSE lo+(le-lo)*(0.95e0*n-under)/(cumulative-under) END,6) AS quantile, n AS observations,
    CASE WHEN le > 100 THEN lo ELSE lo+(le-lo)*(0.95e0*n-under)/(cumulative-under) END > 2 AS firing FROM f WHERE rn = 1"""))
def histogram_quantile(t: Tables):
    found = m.histogram_quantile(_histogram(t), ("endpoint", "result"), 0.95)
    return rounded(found.withColumn("firing", F.col("quantile") > 2.0), "quantile")


_INC_SQL = with_sql("samples", """, s AS (SELECT endpoint, result, ts, value, lag(value) OVER (PARTITION BY endpoint, result ORDER BY ts, event_id) AS p FROM samples),
    d AS (SELECT endpoint, result, time_bucket(INTERVAL 15 MINUTE, ts) AS window_start, CASE WHEN value < p THEN value ELSE value - p END AS step FROM s)
    SELECT endpoint, result, window_start::TIMESTAMP AS window_start, round(sum(step),6)+0e0 AS increase, round(sum(step)/900,6)+0e0 AS rate, sum(step)/900 > 0.1e0 AS firing FROM d
    GROUP BY 1,2,3 HAVING sum(step) IS NOT NULL""")


@query("counter_increase", _INC_SQL)
def counter_increase(t: Tables):
    found = m.counter_increase(t.samples, ("endpoint", "result"), ("ts", "event_id"), "value", "15 minutes")
    return rounded(found.withColumn("firing", F.col("rate") > 0.1), "increase", "rate")


@query("threshold_alerts", with_sql("samples", """, l AS (SELECT endpoint, result, arg_max(value, (ts, event_id)) AS value FROM samples GROUP BY 1,2)
    SELECT endpoint, max(value) AS value FROM l GROUP BY 1 HAVING max(value) > 50"""))
def threshold_alerts(t: Tables):
    latest = m.latest_samples(t.samples, ("endpoint", "result"), ("ts", "event_id"))
    return m.threshold_alerts(latest, ("endpoint",), 50.0)


@query("alert_hold", with_sql("samples", """, b AS (SELECT endpoint, result, ts, event_id, value > 20 AS br FROM samples),
    g AS (SELECT *, row_number() OVER (PARTITION BY endpoint, result ORDER BY ts, event_id) - row_number() OVER (PARTITION BY endpoint, result, br ORDER BY ts, event_id) AS k FROM b),
    i AS (SELECT endpoint, result, min(ts) AS breach_start, max(ts) AS breach_end, count(*) AS samples FROM g WHERE br GROUP BY endpoint, result, k)
    SELECT endpoint, result, breach_start, breach_end, breach_start + INTERVAL 15 MINUTE AS firing_from, samples FROM i WHERE breach_end >= breach_start + INTERVAL 15 MINUTE"""))
def alert_hold(t: Tables):
    return m.alert_hold(t.samples, ("endpoint", "result"), ("ts", "event_id"), F.col("value") > 20, 15)


# Run documents ---------------------------------------------------------------

@query("run_rollup", with_sql("run_spots", """SELECT CAST(run_no AS VARCHAR) AS run_id, count(*) AS expected_spots, CAST(sum(CASE WHEN ingest_rows>0 THEN 1 ELSE 0 END) AS BIGINT) AS fetched_spots,
    CAST(sum(CASE WHEN validation_passed THEN 1 ELSE 0 END) AS BIGINT) AS validated_spots, CAST(sum(CASE WHEN status='stored' THEN 1 ELSE 0 END) AS BIGINT) AS stored_spots,
    CAST(sum(CASE WHEN status='skipped' THEN 1 ELSE 0 END) AS BIGINT) AS skipped_spots, CAST(sum(CASE WHEN status='failed' THEN 1 ELSE 0 END) AS BIGINT) AS failed_spots FROM run_spots GROUP BY 1"""))
def run_rollup(t: Tables):
    return rn.run_rollup(t.run_spots.withColumn("run_id", F.col("run_no").cast("string")))


_DOC = """, run_sums AS (SELECT run_no, count(*) AS n, sum(CASE WHEN status='stored' THEN 1 ELSE 0 END) AS stored, sum(CASE WHEN status='failed' THEN 1 ELSE 0 END) AS failed,
    sum(CASE WHEN status='stored' AND max_numeric_abs_delta >= 0.08 THEN 1 ELSE 0 END) AS drifted FROM run_spots GROUP BY 1),
    doc AS (SELECT * FROM runs JOIN run_sums USING (run_no)) """
_STAGES = ", st AS (" + " UNION ALL ".join(
    f"SELECT run_id, '{stage}' AS stage, CASE WHEN owner % {i + 3} <> 0 THEN total/{i + 1}e0 END AS duration, {fail} AS failures FROM doc"
    for i, (stage, fail) in enumerate((("fetch", "0"), ("engineer", "0"), ("validate", "failed"), ("store", "CASE WHEN run_status='failed' THEN 1 ELSE 0 END")))
) + ") "


@query("stage_state", with_sql("runs run_spots", _DOC + _STAGES + """SELECT run_id, stage, CASE WHEN failures>0 THEN 'failed' WHEN duration IS NOT NULL THEN 'succeeded' ELSE 'not_run' END AS state,
    CAST(CASE WHEN failures>0 THEN -1 WHEN duration IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS state_value, duration AS duration_seconds, CAST(failures AS BIGINT) AS failure_count FROM st"""))
def stage_state(t: Tables):
    return rn.stage_states(t.runs)


_MODE = "coalesce(lower(retraining_mode),'{}')"


@query("handoff_state", with_sql("runs run_spots", _DOC + f""", h AS (SELECT run_id, {_MODE.format('off')} AS handoff_mode, run_status='succeeded' AND stored>0 AS ready, drifted>0 AS dr FROM doc),
    s AS (SELECT *, CASE WHEN handoff_mode='off' THEN 'disabled' WHEN NOT ready THEN 'not_ready' WHEN handoff_mode='always' THEN 'ready' WHEN handoff_mode='drift' AND dr THEN 'ready'
      WHEN handoff_mode='drift' THEN 'waiting_for_drift' ELSE 'unknown' END AS handoff_state FROM h)
    SELECT run_id, handoff_mode, ready AS feature_persistence_ready, dr AS dataset_drift_detected, handoff_state, handoff_state='ready' AS handoff_ready FROM s"""))
def handoff_state(t: Tables):
    return rn.handoff_state(t.runs)


@query("retrain_gate", with_sql("runs run_spots", _DOC + f""", h AS (SELECT run_id, CASE {_MODE.format('always')} WHEN 'off' THEN 'off' WHEN 'drift' THEN 'drift' WHEN 'drift-only' THEN 'drift' ELSE 'always' END AS mode,
    stored, drifted FROM doc) SELECT run_id, mode, CASE mode WHEN 'always' THEN stored>0 WHEN 'drift' THEN drifted>0 ELSE false END AS retrain FROM h"""))
def retrain_gate(t: Tables):
    return rn.retrain_gate(t.runs)


_SUMMARY = _DOC + _STAGES + """, mt AS (
    SELECT run_id, 'feature_expected_spot_count' AS metric, CAST(n AS DOUBLE) AS value FROM doc UNION ALL SELECT run_id, 'feature_stored_spot_count', stored FROM doc
    UNION ALL SELECT run_id, 'feature_drifted_spot_count', drifted FROM doc UNION ALL SELECT run_id, 'feature_dataset_drift_detected', CASE WHEN drifted>0 THEN 1 ELSE 0 END FROM doc
    UNION ALL SELECT run_id, 'feature_failed_spot_count', failed FROM doc
    UNION ALL SELECT run_id, 'feature_' || stage || '_duration_seconds', duration FROM st WHERE duration IS NOT NULL
    UNION ALL SELECT run_id, 'feature_' || stage || '_failure_count', failures FROM st WHERE stage IN ('validate','store')
    UNION ALL SELECT run_id, 'feature_' || spot_id || '_' || k, v FROM (SELECT d.run_id, spot_id, unnest(['ingest_rows','stored_rows','validation_passed','range_violation_count','max_numeric_abs_delta']) AS k,
      unnest([CAST(ingest_rows AS DOUBLE), CAST(stored_rows AS DOUBLE), CASE WHEN validation_passed THEN 1e0 ELSE 0e0 END, CAST(range_violation_count AS DOUBLE), max_numeric_abs_delta]) AS v
      FROM run_spots s JOIN doc d ON d.run_no = s.run_no) WHERE v IS NOT NULL) """


@query("summary_metrics_long", with_sql("runs run_spots", _SUMMARY + "SELECT run_id, metric, value FROM mt"))
def summary_metrics_long(t: Tables):
    return rn.summary_metrics_long(t.runs)


@query("stage_overview", with_sql("runs run_spots", """SELECT run_id, dataset, spot_id, status, ingest_rows, stored_rows, validation_passed, range_violation_count, max_numeric_abs_delta
    FROM runs JOIN run_spots USING (run_no)"""))
def stage_overview(t: Tables):
    return rn.stage_overview(t.runs)


@query("training_metrics_long", """WITH r AS (SELECT CAST(c_custkey AS VARCHAR) AS run_id, CAST(c_nationkey AS DOUBLE) AS rows, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS VARCHAR)
    WHEN c_custkey % 3 = 1 THEN 'v1' END AS version, c_acctbal AS mae FROM customer)
    SELECT run_id, 'training_row_count' AS metric, rows AS value FROM r UNION ALL SELECT run_id, 'training_model_registered', CASE WHEN version IS NULL THEN 0e0 ELSE 1e0 END FROM r
    UNION ALL SELECT run_id, 'training_registered_model_version', CAST(version AS DOUBLE) FROM r WHERE regexp_full_match(version,'[0-9]+') UNION ALL SELECT run_id, 'training_metric_mae', mae FROM r""")
def training_metrics_long(t: Tables):
    c = t.table("customer")
    none = F.lit(None).cast("long")
    docs = c.select(
        F.col("c_custkey").cast("string").alias("run_id"), F.col("c_nationkey").alias("training_row_count"),
        none.alias("training_feature_count"), none.alias("train_row_count"), none.alias("test_row_count"),
        F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey").cast("string")).when(F.col("c_custkey") % 3 == 1, "v1").alias("registered_model_version"),
        F.create_map(F.lit("mae"), F.col("c_acctbal")).alias("run_metrics"))
    return rn.training_metrics_long(docs)


_TRAINING = """WITH r AS (SELECT CAST(c_custkey AS VARCHAR) AS run_id, c_custkey AS k, c_acctbal AS d FROM customer),
    st AS (SELECT run_id, 'train' AS stage, d AS duration, 0 AS failures FROM r
      UNION ALL SELECT run_id, 'evaluate', CASE WHEN k % 4 <> 0 THEN d / 2 END, 0 FROM r
      UNION ALL SELECT run_id, 'register', CASE WHEN k % 3 = 0 THEN d / 4 END, CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END FROM r)
    SELECT run_id, stage, CASE WHEN failures>0 THEN 'failed' WHEN duration IS NOT NULL THEN 'succeeded' ELSE 'not_run' END AS state,
    CAST(CASE WHEN failures>0 THEN -1 WHEN duration IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS state_value, duration AS duration_seconds,
    CAST(failures AS BIGINT) AS failure_count FROM st"""


@query("training_stage_overview", _TRAINING)
def training_stage_overview(t: Tables):
    """State of each training stage per training run."""
    key, seconds = F.col("c_custkey"), F.col("c_acctbal")
    durations = F.map_filter(F.create_map(
        F.lit("train"), seconds, F.lit("evaluate"), F.when(key % 4 != 0, seconds / 2),
        F.lit("register"), F.when(key % 3 == 0, seconds / 4)), lambda _, v: v.isNotNull())
    failures = F.create_map(F.lit("register"), F.when(key % 5 == 0, 1).otherwise(0).cast("bigint"))
    docs = t.table("customer").select(key.cast("string").alias("run_id"), durations.alias("stage_durations_seconds"),
                                      failures.alias("stage_failure_counts"))
    return rn.stage_states(docs, stages=TRAINING_STAGES)


@query("select_run_summary", with_sql("runs", """, l AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY generated_at DESC, run_no DESC) AS rn FROM runs),
    w AS (SELECT dataset, CAST(NULL AS VARCHAR) AS wanted FROM runs GROUP BY 1 UNION ALL SELECT dataset, run_id FROM runs WHERE owner % 50 = 0),
    c AS (SELECT w.dataset, w.wanted, CASE WHEN wanted IS NULL THEN l.run_id ELSE wanted END AS run_id FROM w JOIN l ON l.dataset = w.dataset AND l.rn = 1)
    SELECT c.dataset, coalesce(wanted,'-') AS wanted_run_id, c.run_id, r.run_status FROM c JOIN runs r USING (run_id)"""))
def select_run_summary(t: Tables):
    history = t.run_headers.select("dataset", "run_id", "run_status", "generated_at", "run_no")
    latest = t.run_headers.select("dataset", F.lit(None).cast("string").alias("wanted_run_id")).distinct()
    named = t.run_headers.where("owner % 50 = 0").select("dataset", F.col("run_id").alias("wanted_run_id"))
    found = rn.select_run_summary(history, latest.unionByName(named), "dataset", ("generated_at", "run_no"))
    return found.select("dataset", F.coalesce("wanted_run_id", F.lit("-")).alias("wanted_run_id"), "run_id", "run_status")
