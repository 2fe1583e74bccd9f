import math
import random
import statistics
from datetime import timedelta

import pytest
from conftest import START, at, rows
from pyspark.sql import functions as F

from anemos.operators import features as fx
from anemos.operators.nights import night_intervals
from anemos.operators.ordered import Series

SCHEMA = "spot_id string, time timestamp_ntz, event_id long, wind_speed_10m double, wind_gusts_10m double, wind_direction_10m double, shore_orientation_deg double"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def random_rows(spark):
    rng = random.Random(3)
    data = [("hot" if i % 4 else "cold", at(i / 3), i, rng.choice([None, 0.0, 10.0, 12.5, 20.0]), 20.0, 90.0, 45.0) for i in range(240)]
    return data, frame(spark, data)


def test_published_steadiness_example(spark):
    df = frame(spark, [("a", at(h), h, v, g, d, 180.0) for h, (v, g, d) in enumerate(
        zip((10.0, 12.0, 14.0, 11.0, 13.0), (15.0, 18.0, 20.0, 14.0, 19.0), (180.0, 190.0, 200.0, 185.0, 195.0)))])
    out = fx.engineer_features(df, Series(("spot_id",), ("time", "event_id"))).orderBy("time").collect()
    assert out[0].wind_steadiness == 0.0 and out[0].shore_alignment == pytest.approx(1.0)
    assert out[2].wind_steadiness == pytest.approx(statistics.pstdev((10, 12, 14)) / 12)
    assert [r.gust_excess_10m for r in out] == [5.0, 6.0, 6.0, 3.0, 6.0] and out[0].gust_factor == 1.5


@pytest.mark.parametrize("limit", [None, 25])
def test_steadiness_against_brute_force(random_rows, limit):
    data, df = random_rows
    series = Series.measure(df, ("spot_id",), ("time", "event_id"), limit)
    got = {r.event_id: r.wind_steadiness for r in fx.wind_steadiness(df, series).collect()}
    for key in ("hot", "cold"):
        mine = [r for r in data if r[0] == key]
        for n, row in enumerate(mine):
            seen = [r[3] for r in mine[max(0, n - 2):n + 1] if r[3] is not None]
            mean = statistics.fmean(seen) if seen else 0
            want = statistics.pstdev(seen) / mean if seen and mean else None
            assert got[row[2]] == (None if want is None else pytest.approx(want, abs=1e-12))


@pytest.mark.parametrize("limit", [None, 25])
def test_impute_per_spot(random_rows, limit):
    data, df = random_rows
    series = Series.measure(df, ("spot_id",), ("time", "event_id"), limit)
    got = {r.event_id: r.wind_speed_10m for r in fx.impute(df, series, ("wind_speed_10m",)).collect()}
    for key in ("hot", "cold"):
        mine = [r for r in data if r[0] == key]
        for n, row in enumerate(mine):
            before = [r[3] for r in mine[:n + 1] if r[3] is not None]
            after = [r[3] for r in mine[n:] if r[3] is not None]
            assert got[row[2]] == (before[-1] if before else after[0] if after else 0.0)


def test_impute_carries_across_spots_in_order(spark):
    data = [("c", 3, at(0), 5, None), ("a", 1, at(0), 1, None), ("a", 1, at(1), 2, 7.0), ("b", 2, at(0), 3, None), ("b", 2, at(1), 4, None),
            ("d", 4, at(0), 6, None), ("d", 4, at(1), 7, 9.0)]
    df = spark.createDataFrame(data, "spot_id string, ordinal int, time timestamp_ntz, event_id long, v double")
    series = Series(("spot_id",), ("time", "event_id"))
    carried = fx.impute(df, series, ("v",), across="ordinal")
    assert rows(carried, "event_id", "v") == [(1, 7.0), (2, 7.0), (3, 7.0), (4, 7.0), (5, 7.0), (6, 7.0), (7, 9.0)]
    alone = fx.impute(df, series, ("v",))
    assert rows(alone, "event_id", "v") == [(1, 7.0), (2, 7.0), (3, 0.0), (4, 0.0), (5, 0.0), (6, 9.0), (7, 9.0)]


def test_nan_is_missing(spark):
    df = fx.missing_to_null(spark.createDataFrame([(math.nan,), (1.0,), (None,)], "v double"))
    assert df.where(F.col("v").isNull()).count() == 2


def test_labels_need_their_columns_and_drop_incomplete_rows(spark, random_rows):
    with pytest.raises(ValueError, match="gust_factor"):
        fx.label_rows(random_rows[1], F.lit(12.0))
    full = fx.engineer_features(random_rows[1], Series(("spot_id",), ("time", "event_id")))
    labelled = fx.label_rows(full, F.lit(12.0))
    assert labelled.where("wind_speed_10m IS NULL OR wind_speed_10m = 0").count() == 0
    assert labelled.where("quality_index IS NULL").count() == 0


def test_profile_fills_only_absent_columns(spark, random_rows):
    df = random_rows[1].withColumn("wind_speed_80m", F.lit(1.0))
    out = fx.fill_wind_profile(df)
    assert out.where("wind_speed_80m <> 1.0").count() == 0
    assert out.where("abs(wind_speed_120m - wind_speed_10m * pow(12, 0.143)) > 1e-9").count() == 0


def test_feature_selection_by_name(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0)], "spot_id string, x double, y double")
    assert fx.select_features(df, ["x", " ", "v:y"], "u", {"u": ["x"], "v": ["y"]}).columns == ["spot_id", "x", "y"]
    with pytest.raises(ValueError):
        fx.select_features(df, [" "], "u", {"u": ["x"]})
    with pytest.raises(ValueError):
        fx.select_features(df, ["u:y"], "u", {"u": ["x"]})


def test_horizon_starts_at_the_current_hour(spark):
    df = spark.createDataFrame([("a", at(h), h) for h in range(30)], "spot_id string, time timestamp_ntz, event_id long")
    got = fx.horizon(df, ("spot_id",), ("time", "event_id"), 14, F.lit(at(5.5)).cast("timestamp_ntz"))
    assert sorted(r.event_id for r in got.collect()) == list(range(5, 19))


def test_nights_of_a_winter_week(spark):
    spans = spark.createDataFrame([("a", 47.37, 8.54, at(0.5), at(24 * 6 + 0.5)), ("pole", 89.0, 0.0, at(0), at(24))],
                                  "spot_id string, lat double, lon double, start timestamp_ntz, end timestamp_ntz")
    out = night_intervals(spans, "lat", "lon", "start", "end").orderBy("spot_id", "night_start").collect()
    nights = [r for r in out if r.spot_id == "a"]
    assert nights[0].night_start == at(-24) and nights[-1].night_end == at(24 * 7 + 1)
    assert all(14 < (r.night_end - r.night_start).total_seconds() / 3600 < 17 for r in nights[1:-1])
    # Polar night: one interval over the whole grid.
    pole = [r for r in out if r.spot_id == "pole"]
    assert [(r.night_start, r.night_end) for r in pole] == [(at(-24), at(48))]


def test_nights_equal_a_walk_over_the_whole_grid(spark):
    from anemos.functions.solar import is_daylight

    places = [(float(lat), float(lon)) for lat in (-80, -66.5, -60, -34, 0, 23.4, 46, 59.9, 65.9, 66.2, 70) for lon in (-179.9, -75, 0, 8.5, 100, 179.9)]
    data = [(f"p{i}", la, lo, START + timedelta(days=26 * (i % 14)), START + timedelta(days=26 * (i % 14) + 9, hours=5, minutes=7))
            for i, (la, lo) in enumerate(places)]
    spans = spark.createDataFrame(data, "spot_id string, lat double, lon double, start timestamp_ntz, end timestamp_ntz")
    got = sorted(tuple(r) for r in night_intervals(spans, "lat", "lon", "start", "end").collect())
    grid = []
    for name, la, lo, a, b in data:
        at, stop = a.replace(minute=0) - timedelta(days=1), b.replace(minute=0) + timedelta(hours=1, days=1)
        while at <= stop:
            grid.append((name, la, lo, at))
            at += timedelta(minutes=5)
    lit = spark.createDataFrame(grid, "spot_id string, lat double, lon double, at timestamp_ntz").select(
        "spot_id", "at", is_daylight("lat", "lon", "at").alias("lit")).collect()
    want, open_at, last = [], None, None
    for r in sorted(lit, key=lambda r: (r.spot_id, r.at)):
        if last is not None and last.spot_id != r.spot_id:
            if open_at:
                want.append((last.spot_id, open_at, last.at))
            open_at = None
        if not r.lit and open_at is None:
            open_at = r.at
        elif r.lit and open_at is not None:
            want.append((r.spot_id, open_at, r.at))
            open_at = None
        last = r
    if open_at:
        want.append((last.spot_id, open_at, last.at))
    assert got == sorted(want) and len(got) > 500
