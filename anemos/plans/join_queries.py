"""Queries for enrichment, as-of joins, quality checks and ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from anemos.functions.quality import quality_band
from anemos.functions.temporal import local_time
from anemos.functions.wind import compass_point
from anemos.operators import asof, ranking
from anemos.operators import features as fx
from anemos.operators import quality as q
from anemos.params import ENGINEERED_COLUMNS, VALUE_RANGES
from anemos.plans.bindings import Tables, with_sql
from anemos.plans.feature_queries import _FORECAST_SQL, forecast
from anemos.plans.registry import query, r6, rounded
from anemos.plans.source_queries import landed_payloads
from anemos.session import settle
from anemos.sources import readers


@query("enrich_spots", with_sql("readings spots", """SELECT event_id, lat, lon, shore_orientation_deg FROM readings JOIN spots USING (spot_id)"""))
def enrich_spots(t: Tables):
    return fx.enrich(t.readings.drop("user_id"), t.spots).select("event_id", "lat", "lon", "shore_orientation_deg")


@query("unknown_spots", with_sql("spots", """SELECT DISTINCT 's' || CAST(c_custkey AS VARCHAR) AS spot_id FROM customer
    WHERE 's' || CAST(c_custkey AS VARCHAR) NOT IN (SELECT spot_id FROM spots)"""))
def unknown_spots(t: Tables):
    asked = t.table("customer").select(F.concat(F.lit("s"), F.col("c_custkey")).alias("spot_id"))
    return fx.unknown_spots(asked, t.spots)


_HOUR = "date_trunc('hour', {})::TIMESTAMP"


@query("first_match_join", with_sql("prediction_events observed", f""", o AS (SELECT spot_id, {_HOUR.format('time')} AS hour, wind_direction_10m,
    event_id AS seen, row_number() OVER (PARTITION BY spot_id, date_trunc('hour', time) ORDER BY time, event_id) AS rn FROM observed)
    SELECT seq, p.spot_id, wind_direction_10m, coalesce(seen, -1) AS seen FROM prediction_events p LEFT JOIN (SELECT * FROM o WHERE rn = 1) o
    ON p.spot_id = o.spot_id AND {_HOUR.format('forecast_time')} = o.hour"""))
def first_match_join(t: Tables):
    seen = t.observed.withColumn("seen", F.col("event_id"))
    found = asof.first_match_join(t.predictions, seen, ("spot_id",), "forecast_time", "time", "event_id",
                                  ("wind_direction_10m", "seen"))
    return found.select("seq", "spot_id", "wind_direction_10m", F.coalesce("seen", F.lit(-1)).alias("seen"))


def _nearest_sql(tie: str, tolerance: str) -> str:
    pick = "dn <= dp" if tie == "later" else "dn < dp"
    return with_sql("prediction_events observed observed_repeats observed_once", f""", b AS (SELECT p.seq, p.spot_id, p.forecast_time, o.time AS pt, o.event_id AS pe FROM prediction_events p
      ASOF LEFT JOIN observed_once o ON p.spot_id = o.spot_id AND p.forecast_time >= o.time),
    a AS (SELECT p.seq, o.time AS nt, o.event_id AS ne FROM prediction_events p
      ASOF LEFT JOIN observed_once o ON p.spot_id = o.spot_id AND p.forecast_time <= o.time),
    c AS (SELECT b.*, nt, ne, abs(epoch_us(forecast_time)-epoch_us(pt)) AS dp, abs(epoch_us(nt)-epoch_us(forecast_time)) AS dn FROM b JOIN a USING (seq)),
    d AS (SELECT seq, spot_id, CASE WHEN pt IS NULL OR (nt IS NOT NULL AND {pick}) THEN ne ELSE pe END AS e,
      CASE WHEN pt IS NULL OR (nt IS NOT NULL AND {pick}) THEN dn ELSE dp END AS dist FROM c)
    SELECT seq, spot_id, coalesce(CASE WHEN {tolerance} THEN e END, -1) AS nearest FROM d""")


def _nearest(t: Tables, tie: str, tolerance: float | None):
    right = asof.one_per_instant(t.observed_repeats, ("spot_id",), "time", "event_id")
    found = asof.nearest_join(t.predictions.select("spot_id", "forecast_time", "seq"), right, ("spot_id",), "forecast_time",
                              "time", "seq", ("event_id",), tie=tie, tolerance_s=tolerance)
    return found.select("seq", "spot_id", F.coalesce("event_id", F.lit(-1)).alias("nearest"))


@query("asof_nearest_tolerance", _nearest_sql("later", "dist <= 5400000000"))
def asof_nearest_tolerance(t: Tables):
    return _nearest(t, "later", 5400)


@query("asof_nearest", _nearest_sql("earlier", "true"))
def asof_nearest(t: Tables):
    return _nearest(t, "earlier", None)


@query("point_in_time_join", with_sql("prediction_events observed observed_repeats observed_once", """SELECT seq, spot_id, coalesce(CASE WHEN o.time >= forecast_time - INTERVAL 8 DAY
    THEN o.event_id END, -1) AS feature_row FROM (SELECT p.seq, p.spot_id, p.forecast_time, o.time, o.event_id FROM prediction_events p
    ASOF LEFT JOIN observed_once o ON p.spot_id = o.spot_id AND p.forecast_time >= o.time) o"""))
def point_in_time_join(t: Tables):
    right = asof.one_per_instant(t.observed_repeats, ("spot_id",), "time", "event_id")
    found = asof.point_in_time_join(t.predictions.select("spot_id", "forecast_time", "seq"), right, ("spot_id",), "forecast_time",
                                    "time", "seq", ("event_id",), ttl="8 DAYS")
    return found.select("seq", "spot_id", F.coalesce("event_id", F.lit(-1)).alias("feature_row"))


GRID_SQL = """, span AS (SELECT spot_id, min(time) AS lo, max(time) AS hi FROM features GROUP BY spot_id),
    grid AS (SELECT spot_id, unnest(generate_series(lo, hi, INTERVAL 6 HOUR)) AS grid_time FROM span),
    gb AS (SELECT g.spot_id, g.grid_time, l.time AS pt, l.quality_index AS pq FROM grid g ASOF LEFT JOIN labelled l
      ON g.spot_id = l.spot_id AND g.grid_time >= l.time),
    ga AS (SELECT g.spot_id, g.grid_time, l.time AS nt, l.quality_index AS nq FROM grid g ASOF LEFT JOIN labelled l
      ON g.spot_id = l.spot_id AND g.grid_time <= l.time),
    sampled AS (SELECT spot_id, grid_time, CASE WHEN pt IS NULL OR (nt IS NOT NULL AND nt - grid_time <= grid_time - pt) THEN nt ELSE pt END AS time,
      CASE WHEN pt IS NULL OR (nt IS NOT NULL AND nt - grid_time <= grid_time - pt) THEN nq ELSE pq END AS quality_index
      FROM gb JOIN ga USING (spot_id, grid_time) WHERE pt IS NOT NULL OR nt IS NOT NULL) """


def grid_sampled(t: Tables):
    labelled = fx.label_rows(t.features, F.lit(12.0)).select("spot_id", "time", "quality_index")
    return asof.grid_sample(labelled, t.readings.select("spot_id", "time"), ("spot_id",), "time", "6 HOURS", ("quality_index",),
                            series=t.spot_series)


@query("grid_sample_nearest", with_sql("features labelled", GRID_SQL + "SELECT spot_id, grid_time, time, quality_index FROM sampled"))
def grid_sample_nearest(t: Tables):
    return grid_sampled(t)


@query("anti_dedup", with_sql("prediction_events observed", """SELECT seq, spot_id, forecast_time FROM (SELECT seq, spot_id, forecast_time FROM prediction_events
    UNION ALL SELECT seq, spot_id, forecast_time FROM prediction_events WHERE seq % 10 = 1) n WHERE NOT EXISTS
    (SELECT 1 FROM prediction_events e WHERE e.seq % 3 = 0 AND e.spot_id = n.spot_id AND e.forecast_time = n.forecast_time)"""))
def anti_dedup(t: Tables):
    p = t.predictions.select("seq", "spot_id", "forecast_time")
    # The new batch repeats some of its own rows; those repeats stay.
    return asof.anti_dedup(p.unionAll(p.where("seq % 10 = 1")), p.where("seq % 3 = 0"), ("spot_id", "forecast_time"))


@query("snapshot_subset", with_sql("prediction_events", """SELECT seq, spot_id FROM prediction_events
    WHERE spot_id IN ('s1', 's4')"""))
def snapshot_subset(t: Tables):
    asked = t.predictions.where("spot_id IN ('s1', 's4')").select("spot_id")
    return ranking.snapshot_subset(t.predictions.select("seq", "spot_id"), asked)


_SHARED = ("spot_id", "user_id", "event_id", "time", "wind_speed_10m", "wind_gusts_10m", "wind_direction_10m", "temperature_2m",
           "relative_humidity_2m")
_NEW = ("wind_speed_80m", "wind_speed_120m", "wind_direction_80m", "cape", "lifted_index", *ENGINEERED_COLUMNS, "shore_orientation_deg",
        "lat", "lon", "drive_minutes")


@query("null_fractions", with_sql("features", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END),6) AS null_fraction FROM features"""
    for c in (*_SHARED, *_NEW))))
def null_fractions(t: Tables):
    return rounded(q.null_fractions(t.features, t.features.columns), "null_fraction")


def _violation_sql(source: str, ids: str, ranges=VALUE_RANGES) -> str:
    parts = []
    for c, (lo, hi) in ranges.items():
        test = " OR ".join(x for x in (f"{c} < {lo}e0" if lo is not None else "", f"{c} > {hi}e0" if hi is not None else "") if x)
        low = "NULL" if lo is None else f"{lo}e0"
        high = "NULL" if hi is None else f"{hi}e0"
        parts.append(f"SELECT {ids}, '{c}' AS \"column\", {c} AS value, CAST({low} AS DOUBLE) AS \"min\", CAST({high} AS DOUBLE) AS \"max\" FROM {source} WHERE {test}")
    return " UNION ALL ".join(parts)


@query("range_violations", with_sql("features", f"""SELECT event_id, "column", round(value,6)+0e0 AS value, "min", "max" FROM ({_violation_sql('features', 'event_id')})"""))
def range_violations(t: Tables):
    return rounded(q.range_violations(t.features, ("event_id",)), "value")


# Every column of a slice but its key.
_CHECKED = tuple(c for c in (*_SHARED, *_NEW) if c != "spot_id")
_NULLS = ", ".join(f"avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END)" for c in _CHECKED)
VERDICT_SQL = f""", viol AS (SELECT spot_id, count(*) AS n FROM ({_violation_sql('features', 'spot_id')}) GROUP BY spot_id),
    agg AS (SELECT spot_id, count(*) AS rows, greatest({_NULLS}) AS max_null FROM features GROUP BY spot_id),
    verdict AS (SELECT spot_id, rows, 'precipitation' AS missing_columns, false AS schema_valid, max_null <= 0.1e0 AS completeness_valid,
      coalesce(n,0) = 0 AS range_valid, round(max_null,6) AS max_null_fraction, coalesce(n,0) AS range_violations, false AS is_valid
      FROM agg LEFT JOIN viol USING (spot_id)) """


@query("validate_slices", with_sql("features", VERDICT_SQL + "SELECT * FROM verdict"))
def validate_slices(t: Tables):
    checked = q.validate_slices(t.features, (*_CHECKED, "precipitation"))
    return rounded(checked, "max_null_fraction")


@query("roundtrip_delta", with_sql("readings", """SELECT spot_id, count(*) AS written_rows, CAST(sum(CASE WHEN user_id % 10 <> 0 OR event_id % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS stored_rows,
    CAST(sum(CASE WHEN user_id % 10 <> 0 OR event_id % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS matched_rows, round(CASE WHEN sum(CASE WHEN user_id % 10 <> 0 OR event_id % 2 = 0 THEN 0 ELSE 1 END) = 0
    THEN max(CASE WHEN event_id % 31 = 0 THEN 0.5e0 WHEN event_id % 3 = 0 THEN 0.25e0 ELSE 0e0 END) END, 4) AS max_abs_delta FROM readings GROUP BY 1"""))
def roundtrip_delta(t: Tables):
    """Written against stored slices over every numeric column that both have."""
    stored = t.readings.where("user_id % 10 <> 0 OR event_id % 2 = 0").withColumns({
        "wind_gusts_10m": F.when(F.col("event_id") % 3 == 0, F.col("wind_gusts_10m") + 0.25).otherwise(F.col("wind_gusts_10m")),
        "temperature_2m": F.when(F.col("event_id") % 31 == 0, F.col("temperature_2m") + 0.5).otherwise(F.col("temperature_2m"))})
    keys = ("spot_id", "event_id")
    found = q.round_trip(t.readings, stored, keys, q.numeric_columns(t.readings, keys), by=("spot_id",))
    return found.withColumn("max_abs_delta", F.round("max_abs_delta", 4))


@query("column_diff", with_sql("features", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{status}' AS status, count({c}) AS filled_rows FROM features"""
    for status, names in (("shared", _SHARED), ("new", _NEW)) for c in names)))
def column_diff(t: Tables):
    """Columns before and after feature engineering, with their filled rows."""
    filled = t.features.agg(*[F.count(c).alias(c) for c in t.features.columns])
    long = filled.unpivot([], filled.columns, "column", "filled_rows")
    return q.column_diff(t.readings, t.features).join(long, "column")


@query("field_parity", """WITH a AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cust, o_orderstatus AS status, o_totalprice AS total FROM orders WHERE o_orderkey % 11 <> 0),
    b AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cust, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS status,
      o_totalprice + CASE WHEN o_orderkey % 5 = 0 THEN 0.5 ELSE 0 END AS total FROM orders WHERE o_orderkey % 13 <> 0),
    f AS (SELECT unnest(['cust','status','total']) AS field),
    j AS (SELECT coalesce(a.o_orderkey,b.o_orderkey) AS o_orderkey, a.o_orderkey IS NOT NULL AS present_left, b.o_orderkey IS NOT NULL AS present_right,
      a.cust = b.cust AS mc, a.status = b.status AS ms, abs(a.total-b.total) < 1e-12 AS mt FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey)
    SELECT o_orderkey, field, present_left, present_right, coalesce(CASE field WHEN 'cust' THEN mc WHEN 'status' THEN ms ELSE mt END, false) AS matches
    FROM j, f""")
def field_parity(t: Tables):
    orders = t.table("orders").select("o_orderkey", F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("status"),
                                      F.col("o_totalprice").alias("total"))
    left = orders.where("o_orderkey % 11 <> 0")
    right = orders.where("o_orderkey % 13 <> 0").withColumns({
        "status": F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("status")),
        "total": F.col("total") + F.when(F.col("o_orderkey") % 5 == 0, 0.5).otherwise(0.0)})
    found = q.field_parity(left, right, ("o_orderkey",), ("cust", "status", "total"), tolerant=("total",))
    return found.select("o_orderkey", "field", "present_left", "present_right", "matches")


_PEAK_SQL = _FORECAST_SQL + """, peaks AS (SELECT s.spot_id, s.user_id, s.drive_minutes, coalesce(CAST(max(quality_index) AS DOUBLE),0e0) AS peak_quality,
    coalesce(CAST(sum(CASE WHEN quality_index >= 2 THEN 1 ELSE 0 END) AS DOUBLE),0e0) AS session_hours FROM spots s LEFT JOIN fc ON s.spot_id = fc.spot_id
    GROUP BY ALL) """


@query("forecast_peak", _PEAK_SQL + "SELECT spot_id, peak_quality, session_hours FROM peaks")
def forecast_peak(t: Tables):
    return ranking.forecast_peak(forecast(t), t.spots).select("spot_id", "peak_quality", "session_hours")


@query("mean_quality", _FORECAST_SQL + "SELECT spot_id, round(least(greatest(avg(quality_index),0e0),5e0),6) AS mean_quality FROM fc GROUP BY spot_id")
def mean_quality(t: Tables):
    return rounded(ranking.mean_quality(forecast(t)), "mean_quality")


@query("minmax_normalize", with_sql("spots", """SELECT spot_id, round((drive_minutes - (SELECT min(drive_minutes) FROM spots)) /
    ((SELECT max(drive_minutes) FROM spots) - (SELECT min(drive_minutes) FROM spots)),6) AS scaled, 1e0 AS constant FROM spots"""))
def minmax_normalize(t: Tables):
    spots = t.spots.withColumn("constant", F.lit(3.0))
    scaled = ranking.minmax(spots, ("drive_minutes", "constant"))
    return spots.select("spot_id", r6(scaled["drive_minutes"]).alias("scaled"), scaled["constant"].alias("constant"))


RANK_SQL = _PEAK_SQL + """, cards AS (SELECT *, CASE WHEN peak_quality<=0 OR session_hours<=0 THEN 0e0 ELSE peak_quality*session_hours/greatest(drive_minutes/60,0.25e0) END
    AS ratio FROM peaks), b AS (SELECT min(peak_quality) AS q0, max(peak_quality) AS q1, min(ratio) AS r0, max(ratio) AS r1, min(session_hours) AS h0,
    max(session_hours) AS h1 FROM cards),
    ranked AS (SELECT spot_id, user_id, drive_minutes, peak_quality, session_hours, ratio,
      0.6e0*CASE WHEN q0=q1 THEN CASE WHEN q1>0 THEN 1e0 ELSE 0e0 END ELSE (peak_quality-q0)/(q1-q0) END
      +0.3e0*CASE WHEN r0=r1 THEN CASE WHEN r1>0 THEN 1e0 ELSE 0e0 END ELSE (ratio-r0)/(r1-r0) END
      +0.1e0*CASE WHEN h0=h1 THEN CASE WHEN h1>0 THEN 1e0 ELSE 0e0 END ELSE (session_hours-h0)/(h1-h0) END AS score FROM cards, b) """


def ranked(t: Tables, hours=None):
    return ranking.rank_spots(ranking.forecast_peak(forecast(t) if hours is None else hours, t.spots))


@query("rank_spots", RANK_SQL + """SELECT spot_id, peak_quality, session_hours, drive_minutes, round(ratio,6)+0e0 AS ride_drive_ratio, round(score,6)+0e0 AS score
    FROM ranked""")
def rank_spots(t: Tables):
    return rounded(ranked(t), "ride_drive_ratio", "score").select(
        "spot_id", "peak_quality", "session_hours", "drive_minutes", "ride_drive_ratio", "score").orderBy(F.desc("score"))


TABLE_SQL = RANK_SQL + """, signal AS (SELECT *, CASE CAST(round_even(peak_quality,0) AS INTEGER) WHEN 0 THEN 'Unsafe' WHEN 1 THEN 'Too Light' WHEN 2 THEN 'Marginal'
    WHEN 3 THEN 'Good Enough' WHEN 4 THEN 'Fun Day' ELSE 'Perfect Storm' END AS signal FROM ranked)
    SELECT row_number() OVER (ORDER BY score DESC, user_id) AS position, spot_id, signal, round_even(peak_quality,2) AS peak_quality,
    round_even(drive_minutes,1) AS drive_minutes, round_even(session_hours,1) AS session_hours, round_even(ratio,2)+0e0 AS ride_drive_ratio,
    round_even(score,3)+0e0 AS score FROM signal"""


@query("ranking_table", TABLE_SQL)
def ranking_table(t: Tables):
    return ranking.ranking_table(ranked(t), "user_id")


@query("topk_with_rest", """WITH c AS (SELECT CAST(user_id AS VARCHAR) AS model_version, count(*) AS predictions FROM events GROUP BY 1),
    r AS (SELECT *, row_number() OVER (ORDER BY predictions DESC, model_version) AS rn FROM c)
    SELECT CASE WHEN rn <= 8 THEN model_version ELSE '(rest)' END AS model_version, count(*) AS entries, CAST(sum(predictions) AS BIGINT) AS predictions
    FROM r GROUP BY 1""")
def topk_with_rest(t: Tables):
    counts = t.table("events").groupBy(F.col("user_id").cast("string").alias("model_version")).agg(F.count("*").alias("predictions"))
    return ranking.topk_with_rest(counts, "model_version", "predictions", 8)


@query("union_by_name", """SELECT 'r' AS origin, event_id AS id, value, NULL AS note FROM events
    UNION ALL SELECT 'o', o_orderkey, NULL, o_orderpriority FROM orders""")
def union_by_name(t: Tables):
    a = t.table("events").select(F.lit("r").alias("origin"), F.col("event_id").alias("id"), "value")
    b = t.table("orders").select(F.lit("o").alias("origin"), F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("note"))
    return a.unionByName(b, allowMissingColumns=True)


@query("wind_pivot", with_sql("readings", """, h AS (SELECT spot_id, date_trunc('hour', time)::TIMESTAMP AS hour, wind_speed_10m, wind_gusts_10m FROM readings)
    SELECT spot_id, hour, round(avg(wind_speed_10m),6)+0e0 AS "10m", round(avg(wind_gusts_10m),6)+0e0 AS gusts FROM h GROUP BY ALL"""))
def wind_pivot(t: Tables):
    return rounded(pivoted_wind(t), "10m", "gusts")


def pivoted_wind(t: Tables):
    """Mean wind and gusts per spot and hour, from the long form."""
    long = fx.elevation_long(t.readings.select("spot_id", "time", "wind_speed_10m", "wind_gusts_10m"), ("spot_id", "time"))
    hour = F.date_trunc("hour", "time").cast("timestamp_ntz")
    return long.groupBy("spot_id", hour.alias("hour")).pivot("elevation", ["10m", "gusts"]).agg(F.avg("wind_speed"))


@query("online_latest", with_sql("observed", """SELECT spot_id, event_id, time, round(wind_gusts_10m,6) AS wind_gusts_10m FROM (SELECT *, row_number() OVER
    (PARTITION BY spot_id ORDER BY time DESC, event_id DESC) AS rn FROM observed) WHERE rn = 1
    AND time >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 8 DAY"""))
def online_latest(t: Tables):
    latest = ranking.latest_per_key(t.observed, ("spot_id",), ("time", "event_id"))
    fresh = latest.where(F.col("time") >= F.expr("TIMESTAMP_NTZ '2024-01-30 00:00:00' - INTERVAL 8 DAYS"))
    return rounded(fresh.select("spot_id", "event_id", "time", "wind_gusts_10m"), "wind_gusts_10m")


_STAGE_SQL = VERDICT_SQL + """, units AS (SELECT spot_id, CASE WHEN bool_or(event_id // 24 % 7 <> 0 AND event_id // 24 % 11 = 0) THEN 'rejected'
      WHEN bool_or(event_id // 24 % 7 = 0) THEN 'assumed' ELSE 'expected' END AS unit_status FROM readings GROUP BY 1), raw AS (SELECT spot_id, count(*) AS ingest_rows, min(time) AS time_start, max(time) AS time_end FROM readings GROUP BY 1),
    st AS (SELECT spot_id, count(*) AS stored_rows, max(coalesce(abs(round(gust_factor,3)-gust_factor),0e0)) AS delta FROM features WHERE user_id % 10 <> 0 GROUP BY 1)
    SELECT raw.spot_id, ingest_rows, time_start, time_end, verdict.rows AS engineered_rows, 19 AS engineered_columns, max_null_fraction,
    range_violations, coalesce(stored_rows,0) AS stored_rows, round(CASE WHEN stored_rows = ingest_rows THEN delta END,6)+0e0 AS max_abs_delta,
    stored_rows IS NOT NULL AS projection_ready, 'cape' AS missing_after, 'stored_by' AS extra_after, unit_status FROM raw JOIN verdict USING (spot_id) JOIN units USING (spot_id) LEFT JOIN st USING (spot_id)"""


@query("spot_stage_summary", with_sql("features", _STAGE_SQL))
def spot_stage_summary(t: Tables):
    """Per spot: raw rows, units of its landed documents, verdict, and the stored slice compared over every number and column name."""
    features = settle(t.features, "stage-features")
    stored = features.where("user_id % 10 <> 0").withColumns({
        "gust_factor": F.round("gust_factor", 3), "stored_by": F.lit("job")}).drop("cape")
    raw = t.readings.groupBy("spot_id").agg(F.count("*").alias("ingest_rows"), F.min("time").alias("time_start"), F.max("time").alias("time_end"))
    verdict = q.validate_slices(features, _CHECKED)
    units = q.worst_unit(q.unit_contract(readers.hourly_units(readers.parse_hourly_payloads(landed_payloads(t))), ("spot_id",)), ("spot_id",))
    keys = ("spot_id", "event_id")
    trip = q.round_trip(features, stored, keys, q.numeric_columns(features, keys), by=("spot_id",)).drop("matched_rows", "written_rows")
    new = len(set(features.columns) - set(t.readings.columns))
    names = lambda a, b: F.lit(",".join(sorted(set(a.columns) - set(b.columns))))
    return rounded(
        raw.join(verdict, "spot_id").join(units, "spot_id").join(trip, "spot_id", "left").select(
            "spot_id", "ingest_rows", "time_start", "time_end", F.col("rows").alias("engineered_rows"),
            F.lit(new).alias("engineered_columns"), "max_null_fraction", "range_violations", "stored_rows", "max_abs_delta",
            (F.col("stored_rows") > 0).alias("projection_ready"), names(features, stored).alias("missing_after"),
            names(stored, features).alias("extra_after"), "unit_status"), "max_null_fraction", "max_abs_delta")


# Quality grid: one cell per spot and forecast row.
GRID_CELLS_SQL = RANK_SQL + """, w AS (SELECT spot_id, date_trunc('hour', time)::TIMESTAMP AS hour, avg(wind_speed_10m) AS wind, avg(wind_gusts_10m) AS gust FROM readings GROUP BY 1,2),
    d AS (SELECT spot_id, date_trunc('hour', time)::TIMESTAMP AS hour, wind_direction_10m AS direction, row_number() OVER (PARTITION BY spot_id, date_trunc('hour', time)
      ORDER BY time, event_id) AS rn FROM readings)
    SELECT fc.spot_id, fc.event_id, fc.time, fc.time + INTERVAL 1 HOUR AS time_end, greatest(quality_index,1) AS quality,
      fc.spot_id || ' - ' || strftime(fc.time + INTERVAL 1 HOUR,'%a %H:00') AS header, round(w.wind,6)+0e0 AS wind, round(w.gust,6)+0e0 AS gust,
      ['N','NE','E','SE','S','SW','W','NW'][CAST(floor(((direction+22.5e0) % 360)/45) AS INTEGER)+1] || ' (' || CAST(CAST(direction AS INTEGER) AS VARCHAR) || '°)' AS direction,
      round(r.score,6)+0e0 AS score, r.drive_minutes, r.session_hours
    FROM fc LEFT JOIN w ON w.spot_id=fc.spot_id AND w.hour=date_trunc('hour',fc.time)
    LEFT JOIN (SELECT * FROM d WHERE rn=1) d ON d.spot_id=fc.spot_id AND d.hour=date_trunc('hour',fc.time) LEFT JOIN ranked r ON r.spot_id=fc.spot_id"""


@query("quality_grid", GRID_CELLS_SQL)
def quality_grid(t: Tables):
    # A few hours per spot, read by the cells and by the ranking.
    hours = settle(forecast(t).select("spot_id", "event_id", "time", "quality_index"), "hours")
    cells = hours.select(
        "spot_id", "event_id", "time", F.greatest(quality_band("quality_index"), F.lit(1)).alias("quality"),
        F.date_trunc("hour", "time").cast("timestamp_ntz").alias("hour"))
    # Only the hours of the cells are read on: the mean wind, and the direction of the hour's first reading.
    hour = F.date_trunc("hour", "time").cast("timestamp_ntz")
    seen = t.readings.withColumn("hour", hour).join(cells.select("spot_id", "hour").distinct(), ["spot_id", "hour"], "left_semi")
    wind = seen.groupBy("spot_id", "hour").agg(
        F.avg("wind_speed_10m").alias("wind"), F.avg("wind_gusts_10m").alias("gust"),
        F.min_by("wind_direction_10m", F.struct("time", "event_id")).alias("deg"))
    with_direction = cells.join(wind, ["spot_id", "hour"], "left")
    cards = ranked(t, hours).select("spot_id", "score", "drive_minutes", "session_hours")
    text = F.concat(compass_point("deg"), F.lit(" ("), F.format_string("%.0f", "deg"), F.lit("°)"))
    grid = with_direction.join(cards, "spot_id", "left").select(
        "spot_id", "event_id", "time", (F.col("time") + F.expr("INTERVAL 1 HOUR")).alias("time_end"), "quality",
        F.concat(F.col("spot_id"), F.lit(" - "), F.date_format(local_time("time", "Europe/Zurich"), "EEE HH:00")).alias("header"),
        "wind", "gust", F.coalesce(text, F.lit("")).alias("direction"), "score", "drive_minutes", "session_hours")
    return rounded(grid, "wind", "gust", "score")


@query("score_and_rank", TABLE_SQL)
def score_and_rank(t: Tables):
    """Score the horizon of every spot and rank the spots (the rule label is the scorer)."""
    peaks = ranking.forecast_peak(forecast(t), t.spots)
    return ranking.ranking_table(ranking.rank_spots(peaks), "user_id")
