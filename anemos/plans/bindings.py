"""The given tables read as readings, spots, events, samples and run documents.

Each binding is a list of expressions that Spark and the checking SQL share.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anemos.operators.features import engineer_features, enrich, fill_wind_profile, horizon, impute, missing_to_null
from anemos.operators.ordered import Series
from anemos.params import LABEL_INPUTS, MODEL_FEATURES

NOW = "TIMESTAMP '2024-01-30 00:00:00'"

READINGS = [
    "'s' || CAST(user_id AS VARCHAR(20)) AS spot_id", "user_id", "event_id", "ts AS time",
    "CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 0.0e0 ELSE value END AS wind_speed_10m",
    "value * (1.0e0 + (event_id % 50) / 100.0e0) - (CASE WHEN event_id % 31 = 0 THEN 5.0e0 ELSE 0.0e0 END) AS wind_gusts_10m",
    "CAST((event_id * 37) % 360 AS DOUBLE) AS wind_direction_10m",
    "CAST((event_id * 7) % 45 - 10 AS DOUBLE) AS temperature_2m",
    "CAST((event_id * 13) % 104 AS DOUBLE) AS relative_humidity_2m",
]
SPOTS = [
    "'s' || CAST(user_id AS VARCHAR(20)) AS spot_id", "user_id",
    "CAST((user_id * 45) % 360 AS DOUBLE) AS shore_orientation_deg",
    "45.8e0 + (user_id % 20) / 10.0e0 AS lat", "5.9e0 + (user_id % 46) / 10.0e0 AS lon",
    "10.0e0 + (user_id * 7) % 240 AS drive_minutes",
]
PREDICTIONS = [
    "event_id AS seq", "CASE WHEN event_id % 101 = 0 THEN NULL ELSE ts END AS prediction_timestamp",
    "ts AS forecast_time", "CAST((event_id * 17) % 51 AS DOUBLE) / 10.0e0 AS quality_index",
    "event_type AS endpoint", "CAST(user_id % 5 AS VARCHAR(20)) AS model_version",
    "'s' || CAST(user_id % 6 AS VARCHAR(20)) AS spot_id",
]
OBSERVED = [
    "'s' || CAST(user_id % 6 AS VARCHAR(20)) AS spot_id", "ts + INTERVAL 20 MINUTE AS time", "event_id",
    "value AS wind_speed_10m", "value * (1.0e0 + (event_id % 50) / 100.0e0) AS wind_gusts_10m",
    "CAST((event_id * 37) % 360 AS DOUBLE) AS wind_direction_10m",
    "CAST((user_id % 6) * 45 AS DOUBLE) AS shore_orientation_deg",
]
SAMPLES = [
    "'requests_total' AS name", "event_type AS endpoint", "CAST(user_id % 3 AS VARCHAR(20)) AS result",
    "ts", "value", "event_id",
]
# Run documents: twelve consecutive events are a run, each event a spot of it. A
# document has twelve spots at most, whatever the distribution of the table. Its
# header tells the first event's user and type, the last time and the largest value.
RUN_NO = "CAST(floor(event_id / 12) AS BIGINT)"
RUN_BASE = ["min_by(user_id, event_id) AS user_id", "min_by(event_type, event_id) AS event_type", "max(ts) AS ts",
            "max(value) AS value"]
RUN_HEADER = [
    "CAST(run_no AS VARCHAR(20)) AS run_id", "run_no",
    "'set-' || CAST(user_id % 5 AS VARCHAR(20)) AS dataset",
    "CASE WHEN event_type = 'error' THEN 'failed' ELSE 'succeeded' END AS run_status", "ts AS generated_at",
    "CASE user_id % 7 WHEN 0 THEN 'off' WHEN 1 THEN 'always' WHEN 2 THEN 'drift' "
    "WHEN 3 THEN 'new-data' WHEN 4 THEN 'Drift-Only' WHEN 5 THEN NULL ELSE 'always' END AS retraining_mode",
    "value AS total", "user_id AS owner",
]
RUN_SPOT = [
    f"{RUN_NO} AS run_no", "'s' || CAST(user_id AS VARCHAR(20)) || '-' || CAST(event_id AS VARCHAR(20)) AS spot_id",
    "CASE WHEN event_type IN ('view', 'click') THEN 'stored' WHEN event_type = 'purchase' THEN 'skipped' ELSE 'failed' END AS status",
    "CAST(floor(value) AS BIGINT) AS ingest_rows",
    "CASE WHEN event_type IN ('view', 'click') THEN CAST(floor(value) AS BIGINT) ELSE 0 END AS stored_rows",
    "event_type <> 'error' AS validation_passed",
    "CASE WHEN event_type = 'error' THEN event_id % 7 ELSE 0 END AS range_violation_count",
    "CASE WHEN event_type IN ('view', 'click') THEN CAST(event_id % 11 AS DOUBLE) / 100.0e0 END AS max_numeric_abs_delta",
]


def select_list(expressions, source: str, where: str = "", distinct: bool = False) -> str:
    head = "SELECT DISTINCT" if distinct else "SELECT"
    return f"{head} {', '.join(expressions)} FROM {source}{' WHERE ' + where if where else ''}"


# The features in the words of the checking SQL. Local time is UTC+1 or UTC+2.
_TURN = "2*pi()*(hour(lt)+minute(lt)/60.0e0+floor(second(lt))/3600.0e0)/24.0e0"
_YEAR = ("2*pi()*(dayofyear(lt)-1)/(CASE WHEN year(lt)%4=0 AND (year(lt)%100<>0 OR year(lt)%400=0) "
         "THEN 366.0e0 ELSE 365.0e0 END)")
FEATURE_SQL = f"""
joined AS (SELECT r.*, s.shore_orientation_deg, s.lat, s.lon, s.drive_minutes,
    r.time + INTERVAL 1 HOUR AS lt FROM readings r JOIN spots s USING (spot_id)),
features AS (SELECT spot_id, user_id, event_id, time, shore_orientation_deg, lat, lon, drive_minutes,
    wind_speed_10m, wind_gusts_10m, wind_direction_10m, temperature_2m, relative_humidity_2m,
    wind_speed_10m*pow(8.0e0,0.143e0) AS wind_speed_80m,
    wind_speed_10m*pow(12.0e0,0.143e0) AS wind_speed_120m,
    wind_direction_10m AS wind_direction_80m, 0.0e0 AS cape, 0.0e0 AS lifted_index,
    sin({_TURN}) AS hour_of_day_sin, cos({_TURN}) AS hour_of_day_cos,
    sin({_YEAR}) AS day_of_year_sin, cos({_YEAR}) AS day_of_year_cos,
    sin(radians(wind_direction_10m)) AS wind_direction_10m_sin,
    cos(radians(wind_direction_10m)) AS wind_direction_10m_cos,
    CASE WHEN wind_gusts_10m-wind_speed_10m < 0 THEN 0.0e0 ELSE wind_gusts_10m-wind_speed_10m END AS gust_excess_10m,
    CASE WHEN wind_speed_10m <> 0 THEN wind_gusts_10m/wind_speed_10m END AS gust_factor,
    cos(radians(wind_direction_10m-shore_orientation_deg)) AS shore_alignment,
    CASE WHEN avg(wind_speed_10m) OVER w <> 0
         THEN stddev_pop(wind_speed_10m) OVER w / avg(wind_speed_10m) OVER w END AS wind_steadiness
    FROM joined WINDOW w AS (PARTITION BY spot_id ORDER BY time, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
"""


def label_sql(minimum: str) -> str:
    """The label rule over columns wind_speed_10m .. shore_alignment."""
    return f"""CASE WHEN wind_speed_10m IS NULL OR wind_gusts_10m IS NULL OR wind_steadiness IS NULL
      OR gust_factor IS NULL OR shore_alignment IS NULL THEN NULL
    WHEN wind_speed_10m/1.852e0 > 40 OR wind_gusts_10m/1.852e0 > 50 THEN 0
    WHEN wind_speed_10m/1.852e0 BETWEEN 15 AND 25 AND gust_factor <= 1.25e0 AND shore_alignment >= 0.7e0
      AND wind_steadiness <= 0.2e0 THEN 5
    WHEN wind_speed_10m/1.852e0 < {minimum} THEN 1 WHEN wind_speed_10m/1.852e0 < 17 THEN 2
    WHEN wind_speed_10m/1.852e0 < 22 THEN 3 WHEN wind_speed_10m/1.852e0 <= 30 THEN 4 ELSE 3 END"""


START = "TIMESTAMP '2024-01-20 06:30:00'"
# The hours ahead of each spot, cut to the horizon first, then engineered and imputed like any other rows.
_LAST = "last_value({c} IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_NEXT = "first_value({c} IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
AHEAD_FILLED = tuple(dict.fromkeys((*MODEL_FEATURES, *LABEL_INPUTS)))
AHEAD_SQL = (
    f"""ahead AS (SELECT * EXCLUDE (horizon_row) FROM (SELECT *, row_number() OVER (PARTITION BY spot_id ORDER BY time, event_id) AS horizon_row
    FROM readings WHERE time >= date_trunc('hour', {START})) WHERE horizon_row <= 14),"""
    + FEATURE_SQL.replace("joined", "ahead_joined").replace("readings r", "ahead r").replace("features AS", "ahead_features AS")
    + ", ahead_ready AS (SELECT spot_id, user_id, event_id, time, lat, lon, shore_orientation_deg, "
    + ", ".join(f"coalesce({_LAST.format(c=c)}, {_NEXT.format(c=c)}, 0e0) AS {c}" for c in AHEAD_FILLED)
    + " FROM ahead_features WINDOW w AS (PARTITION BY spot_id ORDER BY time, event_id))")

OBSERVED_SQL = f"""
observed_features AS (SELECT spot_id, event_id, time, wind_speed_10m, wind_gusts_10m,
    CASE WHEN wind_speed_10m <> 0 THEN wind_gusts_10m/wind_speed_10m END AS gust_factor,
    cos(radians(wind_direction_10m-shore_orientation_deg)) AS shore_alignment,
    CASE WHEN avg(wind_speed_10m) OVER w <> 0
         THEN stddev_pop(wind_speed_10m) OVER w / avg(wind_speed_10m) OVER w END AS wind_steadiness
    FROM observed WINDOW w AS (PARTITION BY spot_id ORDER BY time, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
observed_labels AS (SELECT * FROM (SELECT *, CAST({label_sql('12')} AS BIGINT) AS actual_quality_index
    FROM observed_features) WHERE actual_quality_index IS NOT NULL)
"""

_BASE = {
    "readings": select_list(READINGS, "events"),
    "spots": select_list(SPOTS, "events", distinct=True),
    "prediction_events": select_list(PREDICTIONS, "events"),
    "observed": select_list(OBSERVED, "events"),
    "observed_repeats": "SELECT spot_id, time, event_id FROM observed UNION ALL "
                        "SELECT spot_id, time, event_id + 1000000000 FROM observed WHERE event_id % 5 = 0",
    "observed_once": "SELECT spot_id, time, min(event_id) AS event_id FROM observed_repeats GROUP BY 1, 2",
    "samples": select_list(SAMPLES, "events"),
    "runs": select_list(RUN_HEADER, f"({select_list([f'{RUN_NO} AS run_no', *RUN_BASE], 'events')} GROUP BY 1)"),
    "run_spots": select_list(RUN_SPOT, "events"),
}


def with_sql(names: str, body: str) -> str:
    """Prefix a checking query with the bindings it uses."""
    parts = []
    for name in names.split():
        if name == "features":
            parts += [f"readings AS ({_BASE['readings']})", f"spots AS ({_BASE['spots']})", FEATURE_SQL]
        elif name == "ahead":
            parts += [f"readings AS ({_BASE['readings']})", f"spots AS ({_BASE['spots']})", AHEAD_SQL]
        elif name == "labelled":
            parts.append("labelled AS (SELECT * FROM (SELECT *, CAST(" + label_sql("12")
                         + " AS BIGINT) AS quality_index FROM features) WHERE quality_index IS NOT NULL)")
        elif name == "observed_labels":
            parts += [f"observed AS ({_BASE['observed']})", OBSERVED_SQL]
        else:
            parts.append(f"{name} AS ({_BASE[name]})")
    return f"WITH RECURSIVE {', '.join(dict.fromkeys(parts))} {body}"


class Tables:
    """The bindings of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return self._read[name]

    def _bind(self, table: str, expressions) -> DataFrame:
        return self.table(table).selectExpr(*expressions)

    @cached_property
    def readings(self) -> DataFrame:
        return missing_to_null(self._bind("events", READINGS))

    @cached_property
    def spots(self) -> DataFrame:
        return self._bind("events", SPOTS).distinct()

    @cached_property
    def predictions(self) -> DataFrame:
        return self._bind("events", PREDICTIONS)

    @cached_property
    def observed(self) -> DataFrame:
        return self._bind("events", OBSERVED)

    @cached_property
    def observed_repeats(self) -> DataFrame:
        """Instants of observations, every fifth reported again under a later number."""
        once = self.observed.select("spot_id", "time", "event_id")
        return once.unionAll(once.where("event_id % 5 = 0").withColumn("event_id", F.col("event_id") + 1_000_000_000))

    @cached_property
    def samples(self) -> DataFrame:
        return self._bind("events", SAMPLES)

    @cached_property
    def labelled_samples(self) -> DataFrame:
        """Samples with their labels as a map."""
        return self.samples.select(
            "name", F.create_map(F.lit("endpoint"), F.col("endpoint"), F.lit("result"), F.col("result"))
            .alias("labels"), "value", "ts", "event_id")

    @cached_property
    def spot_series(self) -> Series:
        return Series.measure(self.readings, ("spot_id",), ("time", "event_id"))

    @cached_property
    def observed_series(self) -> Series:
        return Series.measure(self.observed, ("spot_id",), ("time", "event_id"))

    @cached_property
    def features(self) -> DataFrame:
        """Readings with their spot, the upper-air profile and all engineered features."""
        return engineer_features(fill_wind_profile(enrich(self.readings, self.spots.drop("user_id"))),
                                 self.spot_series)

    @cached_property
    def ahead(self) -> DataFrame:
        """The next hours of every spot from START on: cut first, then engineered, then imputed (no row is dropped)."""
        order = ("time", "event_id")
        hours = horizon(self.readings, ("spot_id",), order, 14, F.expr(START)).drop("horizon_row")
        series = Series(("spot_id",), order)  # a few rows per spot: nothing to cut
        rows = engineer_features(fill_wind_profile(enrich(hours, self.spots.drop("user_id"))), series)
        return impute(rows, series, AHEAD_FILLED)

    @cached_property
    def run_spots(self) -> DataFrame:
        return self._bind("events", RUN_SPOT)

    @cached_property
    def run_headers(self) -> DataFrame:
        first = self.table("events").groupBy(F.expr(RUN_NO).alias("run_no")).agg(*[F.expr(e) for e in RUN_BASE])
        return first.selectExpr(*RUN_HEADER)

    @cached_property
    def runs(self) -> DataFrame:
        """Run documents: header, stage maps and the array of spot structs (twelve at most)."""
        fields = [c.split(" AS ")[-1] for c in RUN_SPOT[1:]]
        spots = self.run_spots.groupBy("run_no").agg(
            F.array_sort(F.collect_list(F.struct(*fields))).alias("spots"))
        named = lambda s: F.transform(F.filter("spots", s), lambda x: x["spot_id"])
        durations = F.map_filter(
            F.create_map(*[x for i, stage in enumerate(("fetch", "engineer", "validate", "store"))
                           for x in (F.lit(stage), F.when(F.col("owner") % (i + 3) != 0,
                                                          F.col("total") / F.lit(float(i + 1))))]),
            lambda _, v: v.isNotNull())
        failures = F.create_map(
            F.lit("validate"), F.size(F.filter("spots", lambda x: x["status"] == "failed")).cast("bigint"),
            F.lit("store"), F.when(F.col("run_status") == "failed", 1).otherwise(0).cast("bigint"))
        return self.run_headers.join(spots, "run_no").select(
            "run_id", "dataset", "run_status", "generated_at", "retraining_mode",
            named(lambda x: x["status"] == "stored").alias("stored_spots"),
            named(lambda x: (x["status"] == "stored") & (x["max_numeric_abs_delta"] >= 0.08)).alias("drifted_spots"),
            durations.alias("stage_durations_seconds"), failures.alias("stage_failure_counts"), "spots")
