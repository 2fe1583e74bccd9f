"""Queries for row features, labels, windows and solar geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from anemos.functions import quality, solar, temporal, text, wind
from anemos.operators import features as fx
from anemos.operators import ranking
from anemos.operators.nights import night_intervals
from anemos.params import ENGINEERED_COLUMNS, MODEL_FEATURES
from anemos.plans.bindings import _TURN, _YEAR, START, Tables, label_sql, with_sql
from anemos.plans.registry import query, r6, rounded

_LOCAL = "(SELECT *, time + INTERVAL 1 HOUR AS lt FROM readings)"


@query("cyclic_hour", with_sql("readings", f"""SELECT event_id, round(sin({_TURN}),6)+0e0 AS hour_sin,
    round(cos({_TURN}),6)+0e0 AS hour_cos FROM {_LOCAL}"""))
def cyclic_hour(t: Tables):
    local = temporal.local_time("time", "Europe/Zurich")
    return t.readings.select("event_id", r6(temporal.hour_of_day_sin(local)).alias("hour_sin"),
                             r6(temporal.hour_of_day_cos(local)).alias("hour_cos"))


@query("cyclic_day", with_sql("readings", f"""SELECT event_id, round(sin({_YEAR}),6)+0e0 AS day_sin,
    round(cos({_YEAR}),6)+0e0 AS day_cos FROM {_LOCAL}"""))
def cyclic_day(t: Tables):
    local = temporal.local_time("time", "Europe/Zurich")
    return t.readings.select("event_id", r6(temporal.day_of_year_sin(local)).alias("day_sin"),
                             r6(temporal.day_of_year_cos(local)).alias("day_cos"))


@query("direction_encoding", with_sql("readings", """SELECT event_id,
    round(sin(radians(wind_direction_10m)),6)+0e0 AS dir_sin,
    round(cos(radians(wind_direction_10m)),6)+0e0 AS dir_cos FROM readings"""))
def direction_encoding(t: Tables):
    return t.readings.select("event_id", r6(wind.direction_sin("wind_direction_10m")).alias("dir_sin"),
                             r6(wind.direction_cos("wind_direction_10m")).alias("dir_cos"))


@query("gust_excess", with_sql("readings", """SELECT event_id,
    round(CASE WHEN wind_gusts_10m-wind_speed_10m<0 THEN 0e0 ELSE wind_gusts_10m-wind_speed_10m END,6)+0e0
    AS gust_excess FROM readings"""))
def gust_excess(t: Tables):
    return t.readings.select("event_id", r6(wind.gust_excess("wind_gusts_10m", "wind_speed_10m")).alias("gust_excess"))


@query("gust_factor", with_sql("readings", """SELECT event_id,
    round(CASE WHEN wind_speed_10m<>0 THEN wind_gusts_10m/wind_speed_10m END,6)+0e0 AS gust_factor FROM readings"""))
def gust_factor(t: Tables):
    return t.readings.select("event_id", r6(wind.gust_factor("wind_gusts_10m", "wind_speed_10m")).alias("gust_factor"))


@query("shore_alignment", with_sql("readings spots", """SELECT event_id,
    round(cos(radians(wind_direction_10m-shore_orientation_deg)),6)+0e0 AS shore_alignment
    FROM readings JOIN spots USING (spot_id)"""))
def shore_alignment(t: Tables):
    return fx.enrich(t.readings.drop("user_id"), t.spots).select(
        "event_id", r6(wind.shore_alignment("wind_direction_10m", "shore_orientation_deg")).alias("shore_alignment"))


@query("wind_profile_fill", with_sql("readings", """SELECT event_id, round(wind_speed_10m*pow(8e0,0.143e0),6) AS wind_speed_80m,
    round(wind_speed_10m*pow(12e0,0.143e0),6) AS wind_speed_120m, wind_direction_10m AS wind_direction_80m,
    0e0 AS cape, 0e0 AS lifted_index FROM readings"""))
def wind_profile_fill(t: Tables):
    filled = fx.fill_wind_profile(t.readings)
    return rounded(filled, "wind_speed_80m", "wind_speed_120m").select(
        "event_id", "wind_speed_80m", "wind_speed_120m", "wind_direction_80m", "cape", "lifted_index")


@query("wind_steadiness", with_sql("features", """SELECT event_id, round(wind_steadiness,6)+0e0 AS wind_steadiness
    FROM features"""))
def wind_steadiness(t: Tables):
    return fx.wind_steadiness(t.readings, t.spot_series).select("event_id", r6("wind_steadiness").alias("wind_steadiness"))


_ENGINEERED_SQL = ", ".join(f"round({c},6)+0e0 AS {c}" for c in ENGINEERED_COLUMNS)


@query("engineer_features", with_sql("features", f"""SELECT spot_id, event_id, time, wind_speed_10m,
    {_ENGINEERED_SQL} FROM features"""))
def engineer_features(t: Tables):
    return rounded(t.features, *ENGINEERED_COLUMNS).select(
        "spot_id", "event_id", "time", "wind_speed_10m", *ENGINEERED_COLUMNS)


@query("rider_minimum", """WITH riders AS (SELECT DISTINCT user_id, CAST(50 + user_id % 50 AS DOUBLE) AS weight_kg FROM events)
    SELECT user_id, weight_kg, CASE WHEN weight_kg <= 75 THEN 12e0 ELSE 15e0 END AS minimum_kn FROM riders""")
def rider_minimum(t: Tables):
    riders = t.spots.select("user_id", (50 + F.col("user_id") % 50).cast("double").alias("weight_kg"))
    return riders.withColumn("minimum_kn", quality.rider_minimum("weight_kg"))


@query("quality_label", with_sql("features", f""", r AS (SELECT *, CASE WHEN 50 + user_id % 50 <= 75 THEN 12e0 ELSE 15e0 END AS minimum_kn
    FROM features) SELECT event_id, CAST({label_sql('minimum_kn')} AS DOUBLE) AS quality_index FROM r"""))
def quality_label(t: Tables):
    weight = (50 + F.col("user_id") % 50).cast("double")
    return t.features.select("event_id", quality.quality_label(quality.rider_minimum(weight)).cast("double").alias("quality_index"))


@query("label_dataset", with_sql("features labelled", "SELECT spot_id, event_id, quality_index FROM labelled"))
def label_dataset(t: Tables):
    return fx.label_rows(t.features, F.lit(12.0)).select("spot_id", "event_id", "quality_index")


_RAW_SCORE = "value / 60.0e0 - 0.5e0 + (event_id % 2) * 0.5e0"


@query("quality_band", f"""SELECT event_id, CAST(least(greatest(round_even({_RAW_SCORE},0),0),5) AS BIGINT) AS band,
    CAST(least(greatest(round_even((event_id % 16)/2.0e0 - 1.5e0,0),0),5) AS BIGINT) AS half_band FROM events""")
def quality_band(t: Tables):
    return t.table("events").select(
        "event_id", quality.quality_band(F.expr(_RAW_SCORE)).alias("band"),
        quality.quality_band(F.expr("(event_id % 16)/2.0e0 - 1.5e0")).alias("half_band"))


@query("band_label", """SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'Unsafe' WHEN 1 THEN 'Too Light' WHEN 2 THEN 'Marginal'
    WHEN 3 THEN 'Good Enough' WHEN 4 THEN 'Fun Day' ELSE 'Perfect Storm' END AS label FROM events""")
def band_label(t: Tables):
    return t.table("events").select("event_id", quality.band_name(F.col("event_id") % 6).alias("label"))


@query("compass_point", with_sql("readings", """SELECT event_id,
    ['N','NE','E','SE','S','SW','W','NW'][CAST(floor(((wind_direction_10m+22.5e0) % 360)/45) AS INTEGER)+1] AS point
    FROM readings"""))
def compass_point(t: Tables):
    return t.readings.select("event_id", wind.compass_point("wind_direction_10m").alias("point"))


@query("wind_status", with_sql("readings", """SELECT event_id, CASE WHEN wind_speed_10m/1.852e0>=12 THEN 'Rideable'
    WHEN wind_speed_10m/1.852e0>=0.7e0*12e0 THEN 'Almost' ELSE 'Too light' END AS status FROM readings"""))
def wind_status(t: Tables):
    return t.readings.select("event_id", wind.wind_status(wind.knots("wind_speed_10m"), F.lit(12.0)).alias("status"))


_RADIUS = "18e0*least(wind_speed_10m/1.852e0,30e0)/30e0"


@query("geo_offset", with_sql("readings spots", f"""SELECT event_id, CASE WHEN wind_speed_10m IS NULL THEN NULL ELSE
    round(lon + {_RADIUS}*sin(radians(wind_direction_10m))/(111.320e0*cos(radians(lat))),6) END AS to_lon,
    CASE WHEN wind_speed_10m IS NULL THEN NULL ELSE round(lat + {_RADIUS}*cos(radians(wind_direction_10m))/110.574e0,6) END AS to_lat
    FROM readings JOIN spots USING (spot_id)"""))
def geo_offset(t: Tables):
    there = wind.destination("lat", "lon", "wind_direction_10m", wind.dial_radius_km(wind.knots("wind_speed_10m")))
    return fx.enrich(t.readings.drop("user_id"), t.spots).select(
        "event_id", r6(there["lon"]).alias("to_lon"), r6(there["lat"]).alias("to_lat"))


@query("geo_arc", with_sql("spots", """, n AS (SELECT *, 30e0 + user_id % 90 AS span FROM spots),
    m AS (SELECT *, greatest(2, CAST(floor(span/6) AS INTEGER)+1) AS points FROM n),
    p AS (SELECT *, unnest(range(points)) AS i FROM m)
    SELECT spot_id, i AS point, round(lon+18e0*sin(radians(shore_orientation_deg+span*i/(points-1)))/(111.320e0*cos(radians(lat))),6) AS lon,
    round(lat+18e0*cos(radians(shore_orientation_deg+span*i/(points-1)))/110.574e0,6) AS lat FROM p"""))
def geo_arc(t: Tables):
    end = F.col("shore_orientation_deg") + 30.0 + F.col("user_id") % 90
    points = wind.arc("lat", "lon", F.lit(18.0), "shore_orientation_deg", end)
    flat = t.spots.select("spot_id", F.posexplode(points).alias("point", "_p"))
    return flat.select("spot_id", F.col("point").cast("bigint").alias("point"),
                       r6("_p.lon").alias("lon"), r6("_p.lat").alias("lat"))


def _solar_sql(lat: str, lon: str, at: str) -> str:
    h = f"(hour({at})+minute({at})/60e0+floor(second({at}))/3600e0)"
    g = f"(2*pi()/365e0*(dayofyear({at})-1+({h}-12)/24e0))"
    eq = (f"(229.18e0*(0.000075e0+0.001868e0*cos({g})-0.032077e0*sin({g})-0.014615e0*cos(2*{g})-0.040849e0*sin(2*{g})))")
    d = (f"(0.006918e0-0.399912e0*cos({g})+0.070257e0*sin({g})-0.006758e0*cos(2*{g})+0.000907e0*sin(2*{g})"
         f"-0.002697e0*cos(3*{g})+0.00148e0*sin(3*{g}))")
    ha = f"radians(({h}*60+{eq}+4*{lon})/4e0-180)"
    cz = f"(sin(radians({lat}))*sin({d})+cos(radians({lat}))*cos({d})*cos({ha}))"
    return f"(90e0-degrees(acos(least(greatest({cz},-1e0),1e0))))"


@query("solar_elevation", with_sql("readings spots", f"""SELECT event_id, round({_solar_sql('lat','lon','time')},4)+0e0 AS elevation
    FROM readings JOIN spots USING (spot_id)"""))
def solar_elevation(t: Tables):
    return fx.enrich(t.readings.drop("user_id"), t.spots).select(
        "event_id", (F.round(solar.solar_elevation("lat", "lon", "time"), 4) + F.lit(0.0)).alias("elevation"))


@query("daylight", with_sql("readings spots", f"""SELECT spot_id, count(*) AS readings,
    CAST(sum(CASE WHEN {_solar_sql('lat','lon','time')} > -0.833e0 THEN 1 ELSE 0 END) AS BIGINT) AS daylight_rows
    FROM readings JOIN spots USING (spot_id) GROUP BY spot_id"""))
def daylight(t: Tables):
    return fx.enrich(t.readings.drop("user_id"), t.spots).groupBy("spot_id").agg(
        F.count("*").alias("readings"), F.count_if(solar.is_daylight("lat", "lon", "time")).alias("daylight_rows"))


@query("night_intervals", with_sql("readings spots", f""", span AS (SELECT spot_id, any_value(lat) AS lat, any_value(lon) AS lon,
      date_trunc('hour',min(time)) - INTERVAL 1 DAY AS lo,
      CASE WHEN date_trunc('hour',max(time))<max(time) THEN date_trunc('hour',max(time))+INTERVAL 1 HOUR
           ELSE max(time) END + INTERVAL 1 DAY AS hi
      FROM readings JOIN spots USING (spot_id) GROUP BY spot_id),
    grid AS (SELECT spot_id, lat, lon, unnest(generate_series(lo, hi, INTERVAL 5 MINUTES)) AS g FROM span),
    lit AS (SELECT spot_id, g, {_solar_sql('lat','lon','g')} <= -0.833e0 AS dark FROM grid),
    chg AS (SELECT *, CASE WHEN dark AND NOT coalesce(lag(dark) OVER w,false) THEN 1 ELSE 0 END AS st,
       lead(g) OVER w AS nxt FROM lit WINDOW w AS (PARTITION BY spot_id ORDER BY g)),
    isl AS (SELECT *, sum(st) OVER (PARTITION BY spot_id ORDER BY g) AS k FROM chg)
    SELECT spot_id, min(g) AS night_start, max(coalesce(nxt,g)) AS night_end FROM isl WHERE dark GROUP BY spot_id, k"""))
def night_intervals_query(t: Tables):
    span = t.readings.groupBy("spot_id").agg(F.min("time").alias("start"), F.max("time").alias("end"))
    return night_intervals(span.join(t.spots, "spot_id"), "lat", "lon", "start", "end")


_FF = "last_value({c} IGNORE NULLS) OVER (PARTITION BY spot_id ORDER BY time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_BF = "first_value({c} IGNORE NULLS) OVER (PARTITION BY spot_id ORDER BY time, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
_IMPUTE_SQL = ", ".join(f"round(coalesce({_FF.format(c=c)},{_BF.format(c=c)},0e0),6)+0e0 AS {c}" for c in MODEL_FEATURES)


@query("impute_per_spot", with_sql("features", f"SELECT spot_id, event_id, {_IMPUTE_SQL} FROM features"))
def impute_per_spot(t: Tables):
    filled = fx.impute(t.features.select("spot_id", "time", "event_id", *MODEL_FEATURES), t.spot_series, MODEL_FEATURES)
    return rounded(filled, *MODEL_FEATURES).drop("time")


_CARRY = ("wind_speed_10m", "calm_speed")
_CARRY_SQL = ", ".join(
    f"""coalesce(last_value({c} IGNORE NULLS) OVER (ORDER BY user_id, time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value({c} IGNORE NULLS) OVER (ORDER BY user_id, time, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),0e0) AS {c}"""
    for c in _CARRY)


@query("impute_carry", with_sql("readings", f""", r AS (SELECT *, CASE WHEN user_id % 3 = 1 AND event_id % 3 = 0 THEN wind_speed_10m END AS calm_speed
    FROM readings) SELECT spot_id, event_id, {_CARRY_SQL} FROM r"""))
def impute_carry(t: Tables):
    sparse = F.when((F.col("user_id") % 3 == 1) & (F.col("event_id") % 3 == 0), F.col("wind_speed_10m"))
    rows = t.readings.withColumn("calm_speed", sparse).select("spot_id", "user_id", "time", "event_id", *_CARRY)
    return fx.impute(rows, t.spot_series, _CARRY, across="user_id").drop("user_id", "time")


@query("horizon_limit", with_sql("readings", f"""SELECT spot_id, event_id, horizon_row FROM (SELECT *, row_number() OVER
    (PARTITION BY spot_id ORDER BY time, event_id) AS horizon_row FROM readings WHERE time >= date_trunc('hour', {START})) WHERE horizon_row <= 14"""))
def horizon_limit(t: Tables):
    return fx.horizon(t.readings, ("spot_id",), ("time", "event_id"), 14, F.expr(START)).select(
        "spot_id", "event_id", F.col("horizon_row").cast("bigint").alias("horizon_row"))


@query("elevation_unpivot", with_sql("features", """SELECT event_id, e AS elevation, round(v,6)+0e0 AS wind_speed FROM (
    SELECT event_id, '10m' AS e, wind_speed_10m AS v FROM features UNION ALL SELECT event_id, '80m', wind_speed_80m FROM features
    UNION ALL SELECT event_id, '120m', wind_speed_120m FROM features UNION ALL SELECT event_id, 'gusts', wind_gusts_10m FROM features)"""))
def elevation_unpivot(t: Tables):
    return rounded(fx.elevation_long(fx.fill_wind_profile(t.readings), ("event_id",)), "wind_speed")


@query("feature_select", with_sql("features", "SELECT spot_id, round(gust_factor,6)+0e0 AS gust_factor, wind_speed_10m FROM features"))
def feature_select(t: Tables):
    views = {"spot_features": [*ENGINEERED_COLUMNS], "raw": ["wind_speed_10m"]}
    return rounded(fx.select_features(t.features, ["gust_factor", " ", "raw:wind_speed_10m"], "spot_features", views),
                   "gust_factor")


@query("flat_window", with_sql("features labelled", """SELECT spot_id, max(quality_index) <= 1 AS flat FROM labelled
    GROUP BY spot_id"""))
def flat_window(t: Tables):
    labelled = fx.label_rows(t.features, F.lit(12.0))
    return labelled.groupBy("spot_id").agg((F.max("quality_index") <= 1).alias("flat"))


_FORECAST_SQL = with_sql("ahead", f""", f AS (SELECT spot_id, event_id, time, lat, lon, CAST({label_sql('12')} AS BIGINT) AS quality_index FROM ahead_ready),
    fc AS (SELECT *, CASE quality_index WHEN 0 THEN 'Unsafe' WHEN 1 THEN 'Too Light' WHEN 2 THEN 'Marginal' WHEN 3 THEN 'Good Enough'
      WHEN 4 THEN 'Fun Day' ELSE 'Perfect Storm' END AS quality_name, quality_index >= 2 AS rideable,
      CASE WHEN spot_id LIKE '%7' THEN true ELSE {_solar_sql('lat','lon','time')} > -0.833e0 END AS daylight,
      strftime(time,'%a %d %b %H:%M') AS display_time FROM f) """)


def forecast(t: Tables):
    """Scored hours per spot: the rule label stands in for the model."""
    return fx.label_rows(t.ahead, F.lit(12.0))


def framed(t: Tables):
    # Spots ending in 7 stand for unknown places.
    lat = F.when(~F.col("spot_id").endswith("7"), F.col("lat"))
    return ranking.forecast_frame(forecast(t), solar.is_daylight(lat, "lon", "time"))


@query("forecast_frame", _FORECAST_SQL + "SELECT spot_id, event_id, quality_name, rideable, daylight, display_time FROM fc")
def forecast_frame(t: Tables):
    return framed(t).select("spot_id", "event_id", "quality_name", "rideable", "daylight", "display_time")


@query("forecast_summary", _FORECAST_SQL + """, best AS (SELECT *, row_number() OVER (PARTITION BY spot_id
    ORDER BY quality_index DESC, time) AS b FROM fc), agg AS (SELECT spot_id, CAST(sum(CASE WHEN rideable AND daylight THEN 1 ELSE 0 END) AS BIGINT)
    AS rideable_hours, count(*) AS forecast_rows FROM fc GROUP BY spot_id),
    cust AS (SELECT spot_id FROM spots UNION SELECT 's' || CAST(c_custkey AS VARCHAR) FROM customer)
    SELECT c.spot_id, coalesce(CAST(b.quality_index AS DOUBLE),0e0) AS peak_quality, coalesce(b.quality_name,'Unsafe') AS peak_label,
    b.time AS peak_time, coalesce(b.display_time,'No forecast rows') AS peak_time_label, coalesce(rideable_hours,0) AS rideable_hours,
    coalesce(forecast_rows,0) AS forecast_rows FROM cust c LEFT JOIN (SELECT * FROM best WHERE b=1) b USING (spot_id) LEFT JOIN agg USING (spot_id)""")
def forecast_summary(t: Tables):
    asked = t.table("customer").select(F.concat(F.lit("s"), F.col("c_custkey").cast("string")).alias("spot_id"))
    return ranking.forecast_summary(framed(t), t.spots.select("spot_id").union(asked).distinct())


@query("normalize_id_list", """WITH x AS (SELECT event_id, CASE event_id % 5
      WHEN 0 THEN '["a' || event_id || '", " b ", ""]' WHEN 1 THEN ' x' || event_id || ' , y,, z ' WHEN 2 THEN ''
      WHEN 3 THEN NULL ELSE props END AS ids FROM events)
    SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'a' || event_id || '|b' WHEN 1 THEN 'x' || event_id || '|y|z' WHEN 4 THEN trim(ids)
      ELSE '' END AS ids, CAST(CASE event_id % 5 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 4 THEN 1 ELSE 0 END AS BIGINT) AS n FROM x""")
def normalize_id_list(t: Tables):
    raw = F.expr("""CASE event_id % 5 WHEN 0 THEN concat('["a', event_id, '", " b ", ""]')
        WHEN 1 THEN concat(' x', event_id, ' , y,, z ') WHEN 2 THEN '' WHEN 3 THEN NULL ELSE props END""")
    ids = text.normalize_id_list(raw)
    return t.table("events").select("event_id", F.array_join(ids, "|").alias("ids"), F.size(ids).cast("bigint").alias("n"))


@query("normalize_label", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN 'unknown' WHEN 2 THEN 'unknown'
    ELSE event_type END AS label FROM events""")
def normalize_label(t: Tables):
    raw = F.expr("CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN '  ' WHEN 2 THEN NULL ELSE concat(' ', event_type, ' ') END")
    return t.table("events").select("event_id", text.normalize_label(raw).alias("label"))


@query("numeric_version", """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS DOUBLE) END AS version FROM events""")
def numeric_version(t: Tables):
    raw = F.expr("CASE event_id % 3 WHEN 0 THEN concat(' ', event_id, ' ') WHEN 1 THEN concat('v', event_id) ELSE NULL END")
    return t.table("events").select("event_id", text.numeric_version(raw).alias("version"))


_STAMP = ("CASE event_id % 4 WHEN 0 THEN concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), 'Z') WHEN 1 THEN "
          "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") WHEN 2 THEN concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), '+02:00') "
          "ELSE 'not a time' END")


@query("epoch_seconds", """SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL WHEN 2 THEN CAST(epoch(date_trunc('second',ts)) AS DOUBLE)-7200
    ELSE CAST(epoch(date_trunc('second',ts)) AS DOUBLE) END AS epoch_s FROM events""")
def epoch_seconds(t: Tables):
    return t.table("events").select("event_id", temporal.epoch_seconds(F.expr(_STAMP)).alias("epoch_s"))


@query("feature_age", """SELECT event_id, greatest(0e0, 1706572800e0 - CASE WHEN event_id % 4 = 2 THEN epoch(date_trunc('second',ts))-7200
    ELSE epoch(date_trunc('second',ts)) END) AS age_s FROM events WHERE event_id % 4 <> 3""")
def feature_age(t: Tables):
    age = temporal.age_seconds(F.expr(_STAMP), F.expr("TIMESTAMP_NTZ '2024-01-30 00:00:00'"))
    return t.table("events").select("event_id", age.alias("age_s")).where("age_s IS NOT NULL")


@query("normalize_route", """SELECT event_id, CASE event_type WHEN 'view' THEN '/spots' WHEN 'click' THEN '/predict'
    WHEN 'purchase' THEN '/rank' ELSE 'other' END AS route FROM events""")
def normalize_route(t: Tables):
    path = F.expr("CASE event_type WHEN 'view' THEN '/spots' WHEN 'click' THEN '/predict' WHEN 'purchase' THEN '/rank' "
                  "ELSE concat('/users/', user_id) END")
    return t.table("events").select("event_id", text.normalize_route(path).alias("route"))


@query("sanitize_name", """SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'unknown' ELSE event_type || '_' || user_id || '_x' END AS metric,
    CASE WHEN event_id % 10 = 0 THEN 'manual' ELSE event_type || '-' || user_id || '.x' END AS run_key FROM events""")
def sanitize_name(t: Tables):
    raw = F.expr("CASE WHEN event_id % 10 = 0 THEN ' ./- ' ELSE concat('  ', event_type, ' // ', user_id, '.x- ') END")
    return t.table("events").select("event_id", text.sanitize_name(raw).alias("metric"),
                                    text.sanitize_run_key(raw).alias("run_key"))


@query("ride_drive_ratio", """WITH x AS (SELECT event_id, value/100 - 0.2e0 AS q, CAST(event_id % 240 AS DOUBLE) AS m,
    CAST(event_id % 9 AS DOUBLE) AS h FROM events) SELECT event_id, CASE WHEN q<=0 OR h<=0 THEN 0e0 ELSE
    round(q*h/greatest(m/60,0.25e0),6) END AS ratio FROM x""")
def ride_drive_ratio(t: Tables):
    rows = t.table("events").selectExpr("event_id", "value/100 - 0.2e0 AS q", "CAST(event_id % 240 AS DOUBLE) AS m",
                                        "CAST(event_id % 9 AS DOUBLE) AS h")
    return rows.select("event_id", r6(quality.ride_drive_ratio("q", "m", "h")).alias("ratio"))
