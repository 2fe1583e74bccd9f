"""Queries for the event log, hindcast and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from anemos.functions import wind
from anemos.operators import drift as d
from anemos.operators import events as ev
from anemos.operators import hindcast as h
from anemos.operators import ranking
from anemos.operators.features import label_rows, wind_steadiness
from anemos.params import MODEL_FEATURES, RetentionRules
from anemos.plans.bindings import Tables, with_sql
from anemos.plans.registry import query, r6, rounded
from anemos.session import settle

RULES = RetentionRules.explicit(50, 10)
NOW_COL = "TIMESTAMP_NTZ '2024-01-30 00:00:00'"
NOW_SQL = "TIMESTAMP '2024-01-30 00:00:00'"


@query("event_retention", with_sql("prediction_events", """, b AS (SELECT * FROM prediction_events WHERE prediction_timestamp >=
    (SELECT max(prediction_timestamp) FROM prediction_events) - INTERVAL 10 DAY), r AS (SELECT *, row_number() OVER (PARTITION BY model_version
    ORDER BY prediction_timestamp DESC, forecast_time DESC, seq DESC) AS rn FROM b)
    SELECT seq, model_version, prediction_timestamp, forecast_time FROM r WHERE rn <= 50"""))
def event_retention(t: Tables):
    return ev.retain_by_time(t.predictions, RULES).select("seq", "model_version", "prediction_timestamp", "forecast_time")


@query("event_retention_sequence", with_sql("prediction_events", """, b AS (SELECT *, coalesce(nullif(trim(model_version),''),'unknown') AS m
    FROM prediction_events WHERE prediction_timestamp >= (SELECT max(prediction_timestamp) FROM prediction_events) - INTERVAL 10 DAY),
    r AS (SELECT *, row_number() OVER (PARTITION BY m ORDER BY seq DESC) AS rn FROM b) SELECT seq, m AS model_version FROM r WHERE rn <= 50"""))
def event_retention_sequence(t: Tables):
    return ev.retain_by_sequence(t.predictions, RULES).select("seq", "model_version")


@query("eligible_predictions", with_sql("prediction_events", f"""SELECT seq, spot_id, forecast_time FROM prediction_events
    WHERE forecast_time < {NOW_SQL} - INTERVAL 120 HOUR"""))
def eligible_predictions(t: Tables):
    return ev.eligible(t.predictions, F.expr(NOW_COL), 120).select("seq", "spot_id", "forecast_time")


@query("log_gauges", with_sql("prediction_events", """, g AS (SELECT model_version, count(*) AS row_count, epoch_us(max(prediction_timestamp))/1e6 AS latest_prediction_s,
    epoch_us(max(forecast_time))/1e6 AS latest_forecast_s FROM prediction_events GROUP BY 1)
    SELECT *, CAST(1 AS BIGINT) AS models FROM g UNION ALL SELECT '*', CAST(sum(row_count) AS BIGINT), max(latest_prediction_s), max(latest_forecast_s), count(*) FROM g"""))
def log_gauges(t: Tables):
    return ev.log_gauges(t.predictions)


@query("drift_time_split", with_sql("prediction_events", """SELECT seq, CASE WHEN prediction_timestamp < (SELECT max(prediction_timestamp) FROM prediction_events) - INTERVAL 10 DAY
    THEN 'reference' ELSE 'current' END AS side FROM prediction_events WHERE prediction_timestamp IS NOT NULL"""))
def drift_time_split(t: Tables):
    return ev.time_split(t.predictions, 10).select("seq", "side")


@query("midpoint_split", with_sql("readings", """, n AS (SELECT spot_id, event_id, row_number() OVER (PARTITION BY spot_id ORDER BY time, event_id) AS p,
    count(*) OVER (PARTITION BY spot_id) AS c FROM readings)
    SELECT spot_id, event_id, CASE WHEN p <= c // 2 THEN 'reference' ELSE 'current' END AS side FROM n WHERE c >= 2"""))
def midpoint_split(t: Tables):
    return ev.midpoint_split(t.readings.select("spot_id", "time", "event_id"), ("spot_id",), ("time", "event_id")).drop("time")


def observed_labels(t: Tables):
    """Observed rows with features and their rule label."""
    rows = wind_steadiness(t.observed, t.observed_series).withColumns({
        "gust_factor": wind.gust_factor("wind_gusts_10m", "wind_speed_10m"),
        "shore_alignment": wind.shore_alignment("wind_direction_10m", "shore_orientation_deg")})
    return label_rows(rows, F.lit(12.0)).select(
        "spot_id", "event_id", "time", F.col("quality_index").alias("actual_quality_index"))


_ELIGIBLE = f"SELECT * FROM prediction_events WHERE forecast_time < {NOW_SQL} - INTERVAL 120 HOUR"


def _rounded_hour(c: str) -> str:
    return f"make_timestamp(CAST(round_even(epoch_us({c})/3.6e9, 0) AS BIGINT) * 3600000000)"


PAIRS_SQL = f""", el AS ({_ELIGIBLE}), pairs AS (SELECT p.spot_id, {_rounded_hour('p.forecast_time')} AS forecast_hour, quality_index, actual_quality_index
    FROM el p JOIN observed_labels o ON p.spot_id = o.spot_id AND {_rounded_hour('p.forecast_time')} = {_rounded_hour('o.time')}) """


def hindcast_pairs(t: Tables):
    return h.hindcast_pairs(ev.eligible(t.predictions, F.expr(NOW_COL), 120), observed_labels(t))


@query("hindcast_join", with_sql("prediction_events observed_labels", PAIRS_SQL + """SELECT spot_id, forecast_hour, quality_index, actual_quality_index, count(*) AS pairs
    FROM pairs GROUP BY ALL"""))
def hindcast_join(t: Tables):
    return hindcast_pairs(t)


_HINDCAST_SQL = with_sql("prediction_events observed_labels", PAIRS_SQL + """SELECT count(*) AS validated_count,
    round(avg(CASE WHEN round_even(quality_index,0) = actual_quality_index THEN 1e0 ELSE 0e0 END),6) AS accuracy, round(avg(abs(quality_index-actual_quality_index)),6) AS mae FROM pairs""")


@query("hindcast_metrics", _HINDCAST_SQL)
def hindcast_metrics(t: Tables):
    return rounded(h.hindcast_metrics(hindcast_pairs(t)), "accuracy", "mae")


@query("hindcast_class_counts", with_sql("prediction_events observed_labels", PAIRS_SQL + """SELECT actual_quality_index AS quality_class, count(*) AS pairs FROM pairs GROUP BY 1"""))
def hindcast_class_counts(t: Tables):
    return h.hindcast_class_counts(hindcast_pairs(t))


_WINDOW = f""", el AS ({_ELIGIBLE}), win AS (SELECT spot_id, CAST(min(forecast_time) AS DATE) AS lo, CAST(max(forecast_time) AS DATE) AS hi FROM el
    WHERE spot_id <> 's5' GROUP BY spot_id) """


@query("observation_window", with_sql("prediction_events", _WINDOW + "SELECT spot_id, lo::TIMESTAMP AS start_date, hi::TIMESTAMP AS end_date FROM win"))
def observation_window(t: Tables):
    known = t.observed.where("spot_id <> 's5'")
    found = h.observation_window(ev.eligible(t.predictions, F.expr(NOW_COL), 120), known)
    return found.select("spot_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("start_date", "end_date")])


@query("hindcast", with_sql("prediction_events observed_labels", _WINDOW + f""", obs AS (SELECT o.* FROM observed_labels o JOIN win w
    ON o.spot_id = w.spot_id AND CAST(o.time AS DATE) BETWEEN lo AND hi), pairs AS (SELECT quality_index, actual_quality_index FROM el p JOIN obs o ON p.spot_id = o.spot_id
    AND {_rounded_hour('p.forecast_time')} = {_rounded_hour('o.time')}), c AS (SELECT actual_quality_index AS k, count(*) AS n FROM pairs GROUP BY 1)
    SELECT count(*) AS validated_count, round(avg(CASE WHEN round_even(quality_index,0) = actual_quality_index THEN 1e0 ELSE 0e0 END),6) AS accuracy,
    round(avg(abs(quality_index-actual_quality_index)),6) AS mae, (SELECT string_agg(k || ':' || n, ',' ORDER BY k) FROM c) AS class_counts FROM pairs"""))
def hindcast(t: Tables):
    """Eligible predictions against observations inside each spot's date window, with class counts."""
    el = ev.eligible(t.predictions, F.expr(NOW_COL), 120)
    spans = h.observation_window(el, t.observed.where("spot_id <> 's5'"))
    day = F.to_date("time")
    observed = observed_labels(t).join(spans, "spot_id").where(day.between(F.col("start_date"), F.col("end_date")))
    pairs = h.hindcast_pairs(el, observed)
    # Six classes at most reach the last step.
    by_class = pairs.groupBy(F.bround("actual_quality_index", 0).cast("bigint").alias("k")).agg(
        F.sum("pairs").alias("n"),
        F.sum(F.when(F.bround("quality_index", 0) == F.bround("actual_quality_index", 0), F.col("pairs")).otherwise(0)).alias("hits"),
        F.sum(F.abs(F.col("quality_index") - F.col("actual_quality_index")) * F.col("pairs")).alias("gap"))
    listed = F.array_sort(F.collect_list(F.struct("k", "n")))
    text = F.array_join(F.transform(listed, lambda x: F.concat_ws(":", x["k"].cast("string"), x["n"].cast("string"))), ",")
    return by_class.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("validated_count"), r6(F.try_divide(F.sum("hits"), F.sum("n"))).alias("accuracy"),
        r6(F.try_divide(F.sum("gap"), F.sum("n"))).alias("mae"), text.alias("class_counts"))


@query("shadow_divergence", with_sql("prediction_events", """, e AS (SELECT seq // 8 AS hour, spot_id, model_version, quality_index FROM prediction_events WHERE model_version IN ('1','2')),
    b AS (SELECT spot_id, hour, avg(CASE WHEN model_version='1' THEN quality_index END) AS a, avg(CASE WHEN model_version='2' THEN quality_index END) AS c FROM e GROUP BY 1,2)
    SELECT '1' AS champion_version, '2' AS candidate_version, round(avg(abs(c-a)),6) AS mean_abs_divergence, round(max(abs(c-a)),6) AS max_abs_divergence, count(*) AS compared_rows
    FROM b WHERE a IS NOT NULL AND c IS NOT NULL HAVING count(*) > 0"""))
def shadow_divergence(t: Tables):
    shared = t.predictions.withColumn("forecast_time", F.floor(F.col("seq") / 8))
    return rounded(h.shadow_from_log(shared, "1", "2"), "mean_abs_divergence", "max_abs_divergence")


@query("quality_timeline", with_sql("prediction_events observed_labels", f"""SELECT spot_id, forecast_time AS time, quality_index, 'Predicted (past)' AS series FROM prediction_events
    WHERE forecast_time < {NOW_SQL} - INTERVAL 3 DAY UNION ALL SELECT spot_id, time, CAST(actual_quality_index AS DOUBLE), 'Observed' FROM observed_labels
    UNION ALL SELECT spot_id, forecast_time, quality_index, 'Forecast' FROM prediction_events WHERE forecast_time >= {NOW_SQL} - INTERVAL 3 DAY"""))
def quality_timeline(t: Tables):
    now = F.expr(NOW_COL + " - INTERVAL 3 DAYS")
    seen = observed_labels(t).withColumnRenamed("actual_quality_index", "quality_index")
    ahead = t.predictions.where(F.col("forecast_time") >= now).withColumnRenamed("forecast_time", "time")
    return ev.quality_timeline(t.predictions, seen, ahead, now)


# Drift -----------------------------------------------------------------------

_KS_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _p_sql(stat: str, n: str, m: str) -> str:
    lam = f"({stat}*sqrt(CAST({n} AS DOUBLE)*{m}/({n}+{m})))"
    series = f"2*list_sum(list_transform(range(1,101), lambda k: CASE WHEN k%2=1 THEN 1e0 ELSE -1e0 END*exp(-2e0*k*k*{lam}*{lam})))"
    return f"CASE WHEN {lam} < 0.2e0 THEN 1e0 ELSE least(greatest({series},0e0),1e0) END"


def ks_sql(melted: str, by: str = "") -> str:
    """KS per column over a relation with columns (by, side, column, value)."""
    group = f"{by}, " if by else ""
    part = f'PARTITION BY {group}"column"'
    return f"""
    cnt AS (SELECT {group}"column", value, sum(CASE WHEN side='reference' THEN 1 ELSE 0 END) AS a, sum(CASE WHEN side='current' THEN 1 ELSE 0 END) AS b
      FROM {melted} WHERE value IS NOT NULL GROUP BY ALL),
    cum AS (SELECT *, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER ({part}) AS ta, sum(b) OVER ({part}) AS tb FROM cnt
      WINDOW w AS ({part} ORDER BY value)),
    ks0 AS (SELECT {group}"column", max(abs(CASE WHEN ta>0 AND tb>0 THEN ca/CAST(ta AS DOUBLE) - cb/CAST(tb AS DOUBLE) END)) AS statistic, CAST(max(ta) AS BIGINT) AS reference_rows,
      CAST(max(tb) AS BIGINT) AS current_rows FROM cum GROUP BY ALL),
    cases AS (SELECT DISTINCT CAST(round(statistic * reference_rows * current_rows) AS BIGINT) AS gap, reference_rows, current_rows FROM ks0
      WHERE statistic IS NOT NULL AND reference_rows * current_rows <= {d.EXACT_PATHS}),
    paths AS (SELECT *, 0::BIGINT AS t, list_transform(range(reference_rows + 1), lambda i: CASE WHEN i = 0 THEN 1e0 ELSE 0e0 END) AS p FROM cases
      UNION ALL SELECT gap, reference_rows, current_rows, t + 1, list_transform(range(reference_rows + 1), lambda i:
        CASE WHEN t + 1 - i < 0 OR t + 1 - i > current_rows OR abs(i * current_rows - (t + 1 - i) * reference_rows) >= gap THEN 0e0
        ELSE i / CAST(t + 1 AS DOUBLE) * coalesce(p[i], 0e0) + (t + 1 - i) / CAST(t + 1 AS DOUBLE) * p[i + 1] END)
      FROM paths WHERE t < reference_rows + current_rows),
    ends AS (SELECT gap, reference_rows, current_rows, CASE WHEN gap <= 0 THEN 1e0 ELSE least(greatest(1e0 - p[reference_rows + 1], 0e0), 1e0) END AS exact
      FROM paths WHERE t = reference_rows + current_rows),
    ks AS (SELECT ks0.*, coalesce(exact, {_p_sql('statistic', 'ks0.reference_rows', 'ks0.current_rows')}) AS score FROM ks0 LEFT JOIN ends
      ON ends.reference_rows = ks0.reference_rows AND ends.current_rows = ks0.current_rows AND gap = CAST(round(statistic * ks0.reference_rows * ks0.current_rows) AS BIGINT))"""


def _melt_sql(source: str, columns, by: str = "") -> str:
    group = f"{by}, " if by else ""
    return " UNION ALL ".join(f"SELECT {group}side, '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM {source}" for c in columns)


_LINE_SIDES = "SELECT *, CASE WHEN l_shipdate < (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 400 DAY THEN 'reference' ELSE 'current' END AS side FROM lineitem"


def _line_sides(t: Tables):
    line = t.table("lineitem")
    drifting = line.withColumn("l_quantity", F.when(F.year("l_shipdate") >= 2001, F.col("l_quantity") + 2).otherwise(F.col("l_quantity")))
    return ev.time_split(drifting, 400, "l_shipdate", "l_orderkey")


_LINE_SQL = ("WITH RECURSIVE ls AS (" + _LINE_SIDES.replace("*,", "* REPLACE (CASE WHEN year(l_shipdate) >= 2001 THEN l_quantity + 2 ELSE l_quantity END AS l_quantity),")
             + f"), melted AS ({_melt_sql('ls', _KS_COLUMNS)}), {ks_sql('melted')}")


@query("drift_ks", _LINE_SQL + """ SELECT "column", round(statistic,6) AS statistic, reference_rows, current_rows, round(score,6)+0e0 AS score FROM ks""")
def drift_ks(t: Tables):
    return rounded(d.drift_ks(_line_sides(t), _KS_COLUMNS), "statistic", "score").drop("method")


_CAT_SQL = """WITH s AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, CASE WHEN o_orderdate < (SELECT max(o_orderdate) FROM orders) - INTERVAL 400 DAY THEN 'reference'
    ELSE 'current' END AS side FROM orders), m AS (SELECT side, 'o_orderstatus' AS "column", CASE WHEN side='current' AND o_orderkey % 4 = 0 THEN 'F' ELSE o_orderstatus END AS value FROM s
    UNION ALL SELECT side, 'o_orderpriority', o_orderpriority FROM s),
    c AS (SELECT "column", value, CAST(sum(CASE WHEN side='reference' THEN 1 ELSE 0 END) AS DOUBLE) AS a, CAST(sum(CASE WHEN side='current' THEN 1 ELSE 0 END) AS DOUBLE) AS b FROM m GROUP BY 1,2),
    x AS (SELECT *, sum(a) OVER (PARTITION BY "column") AS ta, sum(b) OVER (PARTITION BY "column") AS tb FROM c),
    cat AS (SELECT "column", sum(pow(a*sqrt(tb/ta)-b*sqrt(ta/tb),2)/(a+b)) AS statistic, CAST(max(ta) AS BIGINT) AS reference_rows, CAST(max(tb) AS BIGINT) AS current_rows,
      count(*)-1 AS degrees_of_freedom, 0.5e0*sum(abs(a/ta-b/tb)) AS score, sqrt(greatest(sum((CASE WHEN a=0 THEN 0e0 ELSE a/ta*ln(a/ta/((a/ta+b/tb)/2)) END)
      + (CASE WHEN b=0 THEN 0e0 ELSE b/tb*ln(b/tb/((a/ta+b/tb)/2)) END))/2, 0e0)) AS jensen_shannon FROM x GROUP BY 1),
    tail AS (SELECT *, CASE WHEN degrees_of_freedom < 1 OR statistic <= 0 THEN 1e0 ELSE least(greatest(1e0 - list_sum(list_transform(range(2000), lambda k:
      exp((degrees_of_freedom/2e0+k)*ln(statistic/2)-statistic/2-lgamma(degrees_of_freedom/2e0+k+1)))), 0e0), 1e0) END AS p_value FROM cat)"""
_CATEGORIES = """ SELECT "column", round(statistic,6) AS statistic, reference_rows, current_rows, degrees_of_freedom, round(jensen_shannon,6)+0e0 AS jensen_shannon,
    round(p_value,6)+0e0 AS p_value, round(score,6) AS score, score >= 0.1e0 AS drifted FROM tail"""


def _order_sides(t: Tables):
    sides = ev.time_split(t.table("orders"), 400, "o_orderdate", "o_orderkey")
    return sides.withColumn("o_orderstatus", F.when((F.col("side") == "current") & (F.col("o_orderkey") % 4 == 0), "F").otherwise(F.col("o_orderstatus")))


@query("drift_categorical", _CAT_SQL + _CATEGORIES)
def drift_categorical(t: Tables):
    found = d.drift_verdict(d.drift_categorical(_order_sides(t), ("o_orderstatus", "o_orderpriority")))
    return rounded(found, "statistic", "score", "p_value", "jensen_shannon").drop("method", "threshold")


# Suppliers in three groups, so that small and large samples stand side by side.
_CLASS = "CASE WHEN l_suppkey % 100 = 0 THEN 'few' WHEN l_suppkey % 100 < 5 THEN 'some' ELSE 'many' END"
_SIZED_SQL = f"""WITH RECURSIVE ls0 AS ({_LINE_SIDES}), ls AS (SELECT * EXCLUDE (l_quantity), {_CLASS} AS class,
    CASE WHEN year(l_shipdate) >= 2001 THEN l_quantity + 2 ELSE l_quantity END AS l_quantity FROM ls0),
    melted AS ({_melt_sql('ls', _KS_COLUMNS, 'class')}), {ks_sql('melted', 'class')},
    spread AS (SELECT class, "column", stddev_pop(value) AS spread FROM melted WHERE side='reference' GROUP BY ALL),
    steps AS (SELECT class, "column", abs(ca/CAST(ta AS DOUBLE) - cb/CAST(tb AS DOUBLE)) * (lead(value) OVER (PARTITION BY class, "column" ORDER BY value) - value) AS area
      FROM cum WHERE ta > 0 AND tb > 0),
    areas AS (SELECT class, "column", coalesce(sum(area), 0e0) AS area FROM steps GROUP BY ALL),
    sized AS (SELECT class, "column", statistic, reference_rows, current_rows, area / greatest(spread, 0.001e0) AS distance,
      CASE WHEN reference_rows > 1000 THEN area / greatest(spread, 0.001e0) ELSE score END AS score,
      CASE WHEN reference_rows > 1000 THEN 'wasserstein distance' ELSE 'ks p_value' END AS method
      FROM ks LEFT JOIN areas USING (class, "column") LEFT JOIN spread USING (class, "column"))"""
_SIZED = """ SELECT class, "column", round(statistic,6) AS statistic, reference_rows, current_rows, round(distance,6)+0e0 AS distance, round(score,6)+0e0 AS score,
    method, coalesce(CASE WHEN reference_rows > 1000 THEN score >= 0.1e0 ELSE score <= 0.05e0 END, false) AS drifted FROM sized"""


def _sized(t: Tables):
    sides = settle(_line_sides(t).select(F.expr(_CLASS).alias("class"), "side", *_KS_COLUMNS), "sides")
    return d.drift_verdict(d.drift_numeric(sides, _KS_COLUMNS, ("class",)))


@query("drift_numeric", _SIZED_SQL + _SIZED)
def drift_numeric(t: Tables):
    """Large samples by distance, small ones by significance."""
    return rounded(_sized(t), "statistic", "distance", "score").drop("threshold")


@query("drift_categories", _CAT_SQL + """ SELECT "column", reference_rows > 1000 AS large, round(CASE WHEN reference_rows > 1000 THEN jensen_shannon ELSE p_value END,6)+0e0 AS score,
    CASE WHEN reference_rows > 1000 THEN jensen_shannon >= 0.1e0 ELSE p_value <= 0.05e0 END AS drifted FROM tail""")
def drift_categories(t: Tables):
    found = d.drift_verdict(d.drift_categories(_order_sides(t), ("o_orderstatus", "o_orderpriority")))
    return rounded(found, "score").select("column", (F.col("reference_rows") > d.LARGE_SAMPLE).alias("large"), "score", "drifted")


@query("drift_report_sized", _SIZED_SQL + f""", verdict AS ({_SIZED}) SELECT class, {{header}} FROM verdict GROUP BY class""".replace("{header}", """max(reference_rows) AS reference_rows,
    max(current_rows) AS current_rows, count(*) AS column_count, CAST(sum(CASE WHEN drifted THEN 1 ELSE 0 END) AS BIGINT) AS drifted_column_count,
    round(avg(CASE WHEN drifted THEN 1e0 ELSE 0e0 END),6) AS share_of_drifted_columns, avg(CASE WHEN drifted THEN 1e0 ELSE 0e0 END) >= 0.15e0 AS dataset_drift"""))
def drift_report_sized(t: Tables):
    return rounded(d.drift_report(_sized(t), ("class",)), "share_of_drifted_columns")


REPORT_SQL = """ , verdict AS (SELECT *, coalesce(score <= 0.05e0, false) AS drifted FROM ks)"""
_HEADER = """max(reference_rows) AS reference_rows, max(current_rows) AS current_rows, count(*) AS column_count, CAST(sum(CASE WHEN drifted THEN 1 ELSE 0 END) AS BIGINT) AS drifted_column_count,
    round(avg(CASE WHEN drifted THEN 1e0 ELSE 0e0 END),6) AS share_of_drifted_columns, avg(CASE WHEN drifted THEN 1e0 ELSE 0e0 END) >= 0.15e0 AS dataset_drift"""


def _line_verdict(t: Tables):
    return d.drift_verdict(d.drift_ks(_line_sides(t), _KS_COLUMNS))


@query("drift_report", _LINE_SQL + REPORT_SQL + f" SELECT {_HEADER} FROM verdict")
def drift_report(t: Tables):
    return rounded(d.drift_report(_line_verdict(t)), "share_of_drifted_columns")


_DRIFT_COLUMNS = MODEL_FEATURES
SPOT_PART = f""", n AS (SELECT *, row_number() OVER (PARTITION BY spot_id ORDER BY time, event_id) AS p, count(*) OVER (PARTITION BY spot_id) AS c FROM features),
    sd AS (SELECT *, CASE WHEN p <= c // 2 THEN 'reference' ELSE 'current' END AS side FROM n WHERE c >= 2),
    melted AS ({_melt_sql('sd', _DRIFT_COLUMNS, 'spot_id')}), {ks_sql('melted', 'spot_id')}"""
_SPOT_SQL = with_sql("features", SPOT_PART)


def spot_verdict(t: Tables):
    """Each spot's first half against its second, over all model features."""
    sides = ev.midpoint_split(t.features, ("spot_id",), ("time", "event_id"), series=t.spot_series)
    sides = settle(sides.select("spot_id", "side", *_DRIFT_COLUMNS), "sides")
    return d.drift_verdict(d.drift_ks(sides, _DRIFT_COLUMNS, ("spot_id",)))


@query("drift_per_spot", _SPOT_SQL + REPORT_SQL + f" SELECT spot_id, {_HEADER} FROM verdict GROUP BY spot_id")
def drift_per_spot(t: Tables):
    return rounded(d.drift_report(spot_verdict(t), ("spot_id",)), "share_of_drifted_columns")


@query("drift_dataset", with_sql("features", f""", n AS (SELECT *, row_number() OVER (PARTITION BY spot_id ORDER BY time, event_id) AS p, count(*) OVER (PARTITION BY spot_id) AS c FROM features),
    sd AS (SELECT *, CASE WHEN p <= c // 2 THEN 'reference' ELSE 'current' END AS side FROM n WHERE c >= 2),
    melted AS ({_melt_sql('sd', MODEL_FEATURES)}), {ks_sql('melted')}""")
    + REPORT_SQL + """ SELECT "column", round(statistic,6) AS statistic, round(score,6)+0e0 AS score, drifted FROM verdict""")
def drift_dataset(t: Tables):
    """Whole dataset over the model features both halves share."""
    sides = ev.midpoint_split(t.features, ("spot_id",), ("time", "event_id"), series=t.spot_series)
    wanted = d.shared_columns(sides, t.features, MODEL_FEATURES)
    # The test looks at the rows twice (size, then counts): settle the few columns it needs.
    compared = settle(sides.select("side", *wanted), "sides")
    found = d.drift_verdict(d.drift_ks(compared, wanted))
    return rounded(found, "statistic", "score").select("column", "statistic", "score", "drifted")


@query("drift_predictions", with_sql("prediction_events", f""", sd AS (SELECT *, CASE WHEN prediction_timestamp < (SELECT max(prediction_timestamp) FROM prediction_events) - INTERVAL 10 DAY
    THEN 'reference' ELSE 'current' END AS side FROM prediction_events WHERE prediction_timestamp IS NOT NULL),
    melted AS ({_melt_sql('sd', ('quality_index',))}), {ks_sql('melted')}""") + REPORT_SQL
    + """ SELECT "column", round(statistic,6) AS statistic, reference_rows, current_rows, round(score,6)+0e0 AS score, drifted FROM verdict""")
def drift_predictions(t: Tables):
    log = t.predictions
    found = d.drift_verdict(d.drift_ks(ev.time_split(log, 10), d.prediction_columns(log.drop("seq"))))
    return rounded(found, "statistic", "score").drop("method", "threshold")


@query("drift_candidates", with_sql("samples", f""", edge AS (SELECT max(ts) - INTERVAL 10 DAY AS edge_at FROM samples),
    sd AS (SELECT CASE WHEN ts < edge_at THEN 'reference' ELSE 'current' END AS side, value AS latency, result, value > 60e0 AND event_id % 3 = 0 AS failed FROM samples, edge),
    melted AS (SELECT side, 'latency' AS "column", CAST(latency AS DOUBLE) AS value FROM sd), {ks_sql('melted')},
    spread AS (SELECT stddev_pop(value) AS spread FROM melted WHERE side='reference'),
    area AS (SELECT sum(area) AS area FROM (SELECT abs(ca/CAST(ta AS DOUBLE) - cb/CAST(tb AS DOUBLE)) * (lead(value) OVER (ORDER BY value) - value) AS area FROM cum)),
    cats AS (SELECT side, 'result' AS "column", result AS value FROM sd UNION ALL SELECT side, 'failed', CAST(failed AS VARCHAR) FROM sd),
    kc AS (SELECT "column", value, CAST(sum(CASE WHEN side='reference' THEN 1 ELSE 0 END) AS DOUBLE) AS a, CAST(sum(CASE WHEN side='current' THEN 1 ELSE 0 END) AS DOUBLE) AS b FROM cats GROUP BY 1,2),
    kx AS (SELECT *, sum(a) OVER (PARTITION BY "column") AS ta, sum(b) OVER (PARTITION BY "column") AS tb FROM kc),
    kt AS (SELECT "column", max(ta) AS ta, count(*)-1 AS k, sum(pow(a*sqrt(tb/ta)-b*sqrt(ta/tb),2)/(a+b)) AS x, sqrt(greatest(sum((CASE WHEN a=0 THEN 0e0 ELSE a/ta*ln(a/ta/((a/ta+b/tb)/2)) END)
      + (CASE WHEN b=0 THEN 0e0 ELSE b/tb*ln(b/tb/((a/ta+b/tb)/2)) END))/2, 0e0)) AS js FROM kx GROUP BY 1),
    every AS (SELECT "column", reference_rows > 1000 AS large, CASE WHEN reference_rows > 1000 THEN area / greatest(spread, 0.001e0) ELSE score END AS score FROM ks, area, spread
      UNION ALL SELECT "column", ta > 1000, CASE WHEN ta > 1000 THEN js WHEN k < 1 OR x <= 0 THEN 1e0 ELSE least(greatest(1e0 - list_sum(list_transform(range(2000), lambda n:
        exp((k/2e0+n)*ln(x/2)-x/2-lgamma(k/2e0+n+1)))), 0e0), 1e0) END FROM kt)
    SELECT "column", large, round(score,6)+0e0 AS score, CASE WHEN large THEN score >= 0.1e0 ELSE score <= 0.05e0 END AS drifted FROM every"""))
def drift_candidates(t: Tables):
    """A log without a column named like a prediction: every number, text or truth value that is no key or time is tested by its kind."""
    log = t.samples.select(F.col("ts").alias("timestamp"), F.col("event_id").alias("request_id"), F.col("value").alias("latency"), "result",
                           ((F.col("value") > 60.0) & (F.col("event_id") % 3 == 0)).alias("failed"))
    sides = settle(ev.time_split(log, 10, "timestamp", "request_id"), "sides")
    found = rounded(d.drift_verdict(d.drift_predictions(sides)), "score")
    return found.select("column", (F.col("reference_rows") > d.LARGE_SAMPLE).alias("large"), "score", "drifted")


GAUGE_PART = REPORT_SQL + f""", hd AS (SELECT spot_id, {_HEADER} FROM verdict GROUP BY spot_id),
    gauges AS (SELECT spot_id AS dataset, 'dataset' AS "column", 'threshold' AS metric, 0.15e0 AS value FROM hd
      UNION ALL SELECT spot_id, 'dataset', 'drifted_column_count', drifted_column_count FROM hd
      UNION ALL SELECT spot_id, 'dataset', 'share_of_drifted_columns', share_of_drifted_columns FROM hd
      UNION ALL SELECT spot_id, 'dataset', 'dataset_drift', CASE WHEN dataset_drift THEN 1 ELSE 0 END FROM hd
      UNION ALL SELECT spot_id, "column", 'drift_detected', CASE WHEN drifted THEN 1 ELSE 0 END FROM verdict
      UNION ALL SELECT spot_id, "column", 'drift_score', score FROM verdict WHERE score IS NOT NULL
      UNION ALL SELECT spot_id, "column", 'threshold', 0.05e0 FROM verdict) """
GAUGE_SQL = _SPOT_SQL + GAUGE_PART


def spot_gauges(t: Tables):
    verdict = settle(spot_verdict(t), "verdict")
    return d.drift_gauges(d.drift_report(verdict, ("spot_id",)), verdict, "spot_id")


@query("drift_gauges", GAUGE_SQL + """SELECT dataset, "column", metric, round(value,6)+0e0 AS value FROM gauges""")
def drift_gauges(t: Tables):
    return rounded(spot_gauges(t), "value")


_BREAK_SQL = """, br AS (SELECT 'dataset' AS kind, dataset AS name, avg(value) AS value FROM gauges WHERE metric='share_of_drifted_columns' GROUP BY 2
    UNION ALL SELECT 'column', "column", sum(value) FROM gauges WHERE metric='drift_detected' GROUP BY 2) """


@query("drift_breakdown", GAUGE_SQL + _BREAK_SQL + "SELECT kind, name, round(value,6)+0e0 AS value FROM br")
def drift_breakdown(t: Tables):
    return rounded(d.drift_breakdown(spot_gauges(t)), "value")


@query("top_drifted", GAUGE_SQL + _BREAK_SQL + "SELECT name, CAST(value AS BIGINT) AS drifted FROM br WHERE kind='column' AND value > 0 ORDER BY value DESC, name LIMIT 8")
def top_drifted(t: Tables):
    columns = d.drift_breakdown(spot_gauges(t)).where("kind = 'column'").select("name", F.col("value").cast("bigint").alias("drifted"))
    return ranking.top_n(columns, "drifted", "name", 8)


@query("metric_lines", GAUGE_SQL + """SELECT 'drift_metrics.' || regexp_replace(dataset,'[^A-Za-z0-9]+','_','g') || '.v1.' || "column" || '.' || metric || ':' ||
    CAST(CAST(round(value*1000) AS BIGINT) AS VARCHAR) || '|g' AS line FROM gauges""")
def metric_lines(t: Tables):
    scaled = spot_gauges(t).withColumn("value", F.round(F.col("value") * 1000).cast("bigint").cast("string"))
    return d.metric_lines(scaled, "drift_metrics", "v1")
