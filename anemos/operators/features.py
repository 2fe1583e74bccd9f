"""Per-entity time-series features, imputation, horizon and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anemos.functions import temporal, wind
from anemos.functions.quality import quality_label
from anemos.operators.ordered import Series, drop_lookback, fill, with_lookback
from anemos.params import LABEL_INPUTS, LOCAL_ZONE, SALTS, LabelRules
from anemos.schemas import require_columns


def missing_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes null, so SQL null logic means 'missing' from here on."""
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in floats})


def enrich(df: DataFrame, spots: DataFrame) -> DataFrame:
    """Attach the spot columns; rows of unknown spots fall away (see ``unknown_spots``)."""
    return df.join(spots, "spot_id")


def unknown_spots(ids: DataFrame, spots: DataFrame) -> DataFrame:
    return ids.select("spot_id").distinct().join(spots, "spot_id", "left_anti").orderBy("spot_id")


def row_features(time: str = "time", zone: str = LOCAL_ZONE) -> dict[str, Column]:
    """Features that need one row only; cyclic ones use local wall-clock time."""
    local = temporal.local_time(time, zone)
    return {
        "hour_of_day_sin": temporal.hour_of_day_sin(local),
        "hour_of_day_cos": temporal.hour_of_day_cos(local),
        "day_of_year_sin": temporal.day_of_year_sin(local),
        "day_of_year_cos": temporal.day_of_year_cos(local),
        "wind_direction_10m_sin": wind.direction_sin("wind_direction_10m"),
        "wind_direction_10m_cos": wind.direction_cos("wind_direction_10m"),
        "gust_excess_10m": wind.gust_excess("wind_gusts_10m", "wind_speed_10m"),
        "gust_factor": wind.gust_factor("wind_gusts_10m", "wind_speed_10m"),
        "shore_alignment": wind.shore_alignment("wind_direction_10m", "shore_orientation_deg"),
    }


def wind_steadiness(df: DataFrame, series: Series, rows: int = 3) -> DataFrame:
    """Population std over mean of the last ``rows`` rows; zero mean gives null."""
    look = with_lookback(df, series, rows - 1)
    w = series.window().rowsBetween(-(rows - 1), 0)
    ratio = F.try_divide(F.stddev_pop("wind_speed_10m").over(w), F.avg("wind_speed_10m").over(w))
    return drop_lookback(look.withColumn("wind_steadiness", ratio))


def engineer_features(df: DataFrame, series: Series, zone: str = LOCAL_ZONE) -> DataFrame:
    require_columns(
        df, ("spot_id", "time", "wind_speed_10m", "wind_gusts_10m", "wind_direction_10m",
             "shore_orientation_deg"), "feature engineering",
    )
    return wind_steadiness(df, series).withColumns(row_features(series.order[0], zone))


def fill_wind_profile(df: DataFrame) -> DataFrame:
    """Approximate upper-air columns, each only where the column is absent."""
    candidates = {
        "wind_speed_80m": wind.speed_at_height("wind_speed_10m", 80.0),
        "wind_speed_120m": wind.speed_at_height("wind_speed_10m", 120.0),
        "wind_direction_80m": F.col("wind_direction_10m"),
        "cape": F.lit(0.0),
        "lifted_index": F.lit(0.0),
    }
    return df.withColumns({c: e for c, e in candidates.items() if c not in df.columns})


def impute(df: DataFrame, series: Series, columns, across: str | None = None) -> DataFrame:
    """Forward fill, then back fill, then zero, per key.

    ``across`` names the key-order column: values then also carry over from one
    key to the next in that order, as when all keys are laid end to end.
    """
    out = fill(
        df, series, {f"_fw_{c}": c for c in columns}, {f"_bw_{c}": c for c in columns}
    )
    chain = {c: [F.col(f"_fw_{c}"), F.col(f"_bw_{c}")] for c in columns}
    if across:
        at = F.struct(*series.order)
        ends = df.groupBy(*series.keys, across).agg(
            *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_l_{c}") for c in columns],
            *[F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_e_{c}") for c in columns],
        ).withColumn("_all", F.lit(0))
        # One row per key: ordered over all keys, cut like any other series.
        keys = Series.measure(ends, ("_all",), (across, *series.keys),
                              probe=df.select(*series.keys).distinct())
        moved = drop_lookback(with_lookback(ends, keys, 1).withColumns(
            {f"_q_{c}": F.lag(f"_l_{c}").over(keys.window()) for c in columns}))
        carry = fill(moved, keys, {f"_pk_{c}": f"_q_{c}" for c in columns},
                     {f"_nk_{c}": f"_e_{c}" for c in columns})
        out = out.join(carry.select(*series.keys, *[f"_pk_{c}" for c in columns],
                                    *[f"_nk_{c}" for c in columns]), list(series.keys))
        chain = {c: [F.col(f"_fw_{c}"), F.col(f"_pk_{c}"), F.col(f"_bw_{c}"), F.col(f"_nk_{c}")]
                 for c in columns}
    return out.withColumns({c: F.coalesce(*chain[c], F.lit(0.0)) for c in columns}).select(df.columns)


def horizon(df: DataFrame, keys, order, rows: int, start=None) -> DataFrame:
    """First ``rows`` rows per key, from the hour of ``start`` on.

    Spark limits groups before the shuffle, but of a huge key every map task would still
    send ``rows`` rows to one place: salted parts of a key are limited first.
    """
    ahead = df if start is None else df.where(F.col(order[0]) >= F.date_trunc("hour", start))
    ahead = ahead.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(SALTS)))
    for by in ((*keys, "_salt"), tuple(keys)):
        w = Window.partitionBy(*by).orderBy(*order)
        ahead = ahead.withColumn("horizon_row", F.row_number().over(w)).where(F.col("horizon_row") <= rows)
    return ahead.drop("_salt")


def label_rows(df: DataFrame, minimum_kn, rules: LabelRules = LabelRules()) -> DataFrame:
    """Keep complete rows and add their 0-5 label."""
    require_columns(df, LABEL_INPUTS, "labelling")
    return df.dropna(subset=list(LABEL_INPUTS)).withColumn(
        "quality_index", quality_label(minimum_kn, rules)
    )


def elevation_long(df: DataFrame, ids) -> DataFrame:
    """Wind columns to long form: 10m, 80m, 120m and gusts, where present."""
    wanted = [c for c in ("wind_speed_10m", "wind_speed_80m", "wind_speed_120m", "wind_gusts_10m")
              if c in df.columns]
    name = F.regexp_replace(F.regexp_replace("elevation", "wind_gusts_10m", "gusts"), "wind_speed_", "")
    return df.unpivot(list(ids), wanted, "elevation", "wind_speed").withColumn("elevation", name)


def select_features(df: DataFrame, names, default_view: str, views: dict[str, list[str]]) -> DataFrame:
    """Select by feature name or ``view:feature``; blank names are skipped."""
    wanted = []
    for name in names:
        cleaned = name.strip()
        if not cleaned:
            continue
        view, _, feature = cleaned.rpartition(":")
        if feature not in views.get(view or default_view, []):
            raise ValueError(f"unknown feature {cleaned}")
        wanted.append(feature)
    if not wanted:
        raise ValueError("at least one feature name is needed")
    return df.select("spot_id", *wanted)
