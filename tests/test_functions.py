import math

import pytest
from conftest import at
from pyspark.sql import functions as F

from anemos.functions import quality, solar, temporal, text, wind


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def ntz(text_value):
    return F.lit(text_value).cast("timestamp_ntz")


def test_cyclic_features(spark):
    s, c = one(spark, temporal.hour_of_day_sin(ntz("2024-01-01 06:00:00")), temporal.hour_of_day_cos(ntz("2024-01-01 12:30:00")))
    assert s == pytest.approx(1.0) and c == pytest.approx(math.cos(2 * math.pi * 12.5 / 24))
    leap, plain = one(spark, temporal.day_of_year_sin(ntz("2024-12-31 00:00:00")), temporal.day_of_year_sin(ntz("2023-12-31 00:00:00")))
    assert leap == pytest.approx(math.sin(2 * math.pi * 365 / 366)) and plain == pytest.approx(math.sin(2 * math.pi * 364 / 365))


def test_cyclic_features_take_the_order_of_the_reference(spark):
    """Times whose cosines are equal but for rounding: which is the larger one must not depend on the engine."""
    for hour, minute, second in ((8, 24, 28), (15, 35, 32)):
        part = hour + minute / 60.0 + second / 3600.0
        at_time = ntz(f"2024-01-01 {hour:02}:{minute:02}:{second:02}")
        assert one(spark, temporal.hour_of_day_sin(at_time), temporal.hour_of_day_cos(at_time)) == (
            math.sin(2 * math.pi * part / 24.0), math.cos(2 * math.pi * part / 24.0))


def test_local_time_crosses_summer_time(spark):
    winter, summer = one(spark, temporal.local_time(ntz("2024-03-31 00:30:00"), "Europe/Zurich"),
                         temporal.local_time(ntz("2024-03-31 01:30:00"), "Europe/Zurich"))
    assert (winter.hour, summer.hour) == (1, 3)


def test_missing_stays_missing(spark):
    none = F.lit(None).cast("double")
    assert one(spark, wind.gust_excess(none, F.lit(3.0)), wind.gust_excess(F.lit(1.0), F.lit(3.0)), wind.gust_excess(F.lit(5.0), F.lit(3.0))) == (None, 0.0, 2.0)
    assert one(spark, quality.clamp(none, 0.0, 5.0), quality.clamp(F.lit(9.0), 0.0, 5.0)) == (None, 5.0)


def test_division_by_zero_is_missing(spark):
    assert one(spark, wind.gust_factor(F.lit(4.0), F.lit(0.0)), wind.gust_factor(F.lit(0.0), F.lit(0.0)), wind.gust_factor(F.lit(6.0), F.lit(4.0))) == (None, None, 1.5)


@pytest.mark.parametrize("value,band", [(0.5, 0), (1.5, 2), (2.5, 2), (-1.0, 0), (9.0, 5), (3.4, 3)])
def test_band_rounds_half_even_and_clamps(spark, value, band):
    assert one(spark, quality.quality_band(F.lit(value))) == (band,)


@pytest.mark.parametrize("minutes,hour", [(30, 0), (90, 2), (29, 0), (150, 2), (151, 3)])
def test_hour_rounding_is_half_even(spark, minutes, hour):
    assert one(spark, temporal.round_to_hour(F.lit(at(minutes / 60)).cast("timestamp_ntz")))[0] == at(hour)


def test_labels_one_per_band(spark):
    kn = 1.852
    data = [(45, 45, .1, 1.0, 1.0, 0), (10, 11, .1, 1.1, 1.0, 1), (16, 24, .1, 1.5, 0.0, 2), (20, 30, .1, 1.5, 0.0, 3),
            (26, 33, .1, 1.3, 0.0, 4), (20, 22, .1, 1.1, 0.9, 5), (35, 40, .1, 1.2, 0.0, 3), (20, 51, .1, 2.5, 0.9, 0)]
    df = spark.createDataFrame([(w * kn, g * kn, s, f, a, q) for w, g, s, f, a, q in data],
                               "wind_speed_10m double, wind_gusts_10m double, wind_steadiness double, gust_factor double, shore_alignment double, want int")
    got = df.select("want", quality.quality_label(F.lit(12.0)).alias("q")).collect()
    assert [r.want for r in got] == [r.q for r in got]


def test_rider_weight_moves_the_minimum(spark):
    assert one(spark, quality.rider_minimum(F.lit(75.0)), quality.rider_minimum(F.lit(80.0))) == (12.0, 15.0)


def test_ratio_has_a_floor_and_zero_cases(spark):
    assert one(spark, quality.ride_drive_ratio(F.lit(4.0), F.lit(1.0), F.lit(2.0)), quality.ride_drive_ratio(F.lit(4.0), F.lit(60.0), F.lit(0.0))) == (32.0, 0.0)


def test_compass_and_geometry(spark):
    assert one(spark, *[wind.compass_point(F.lit(float(d))) for d in (0, 22.4, 22.5, 337.5, 359.9)]) == ("N", "N", "NE", "N", "N")
    there = one(spark, wind.destination(F.lit(0.0), F.lit(0.0), F.lit(90.0), F.lit(111.32)))[0]
    assert there.lon == pytest.approx(1.0) and there.lat == pytest.approx(0.0, abs=1e-9)
    assert len(one(spark, wind.arc(F.lit(46.0), F.lit(8.0), F.lit(18.0), F.lit(0.0), F.lit(1.0)))[0]) == 2
    assert len(one(spark, wind.arc(F.lit(46.0), F.lit(8.0), F.lit(18.0), F.lit(0.0), F.lit(90.0)))[0]) == 16


def test_solar_elevation_of_a_summer_noon_and_a_winter_day(spark):
    noon, unknown = one(spark, solar.solar_elevation(F.lit(47.37), F.lit(8.54), ntz("2024-07-01 11:30:00")),
                        solar.solar_elevation(F.lit(None).cast("double"), F.lit(8.5), ntz("2024-07-01 11:30:00")))
    assert noon > 55 and unknown is None
    day = spark.range(288).select((F.lit("2024-12-21").cast("timestamp_ntz") + F.make_interval(mins=(F.col("id") * 5).cast("int"))).alias("t"))
    light = day.where(solar.is_daylight(F.lit(47.37), F.lit(8.54), "t")).count() * 5 / 60
    assert 7.5 < light < 9.5


def test_text_normalisation(spark):
    df = spark.createDataFrame([('["a"," b ",""]',), (" x, y ,,",), ("",), (None,), ('{"k": 1}',), ("[1, 2]",)], "v string")
    got = [r[0] for r in df.select(text.normalize_id_list("v")).collect()]
    assert got == [["a", "b"], ["x", "y"], [], [], ['{"k": 1}'], ["1", "2"]]
    assert one(spark, text.normalize_label(F.lit("  ")), text.normalize_label(F.lit(None).cast("string")), text.normalize_label(F.lit(" a "))) == ("unknown", "unknown", "a")
    assert one(spark, text.numeric_version(F.lit(" 12 ")), text.numeric_version(F.lit("v1"))) == (12.0, None)
    assert one(spark, text.sanitize_name(F.lit("--")), text.sanitize_name(F.lit("a.b  c")), text.sanitize_run_key(F.lit(" run 1:2 ")), text.sanitize_run_key(F.lit(""))) == ("unknown", "a_b_c", "run-1-2", "manual")


def test_epoch_seconds(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("2024-01-01T00:00:00",), ("2024-01-01T02:00:00+02:00",), ("soon",), (None,)], "v string")
    got = [r[0] for r in df.select(temporal.epoch_seconds("v")).collect()]
    assert got == [1704067200.0] * 3 + [None, None]
