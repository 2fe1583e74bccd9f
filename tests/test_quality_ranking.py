import math

import pytest
from conftest import at, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from anemos.operators import quality as q
from anemos.operators import ranking, runs
from anemos.params import RetentionRules

READ = "spot_id string, wind_speed_10m double, wind_steadiness double"


def test_null_fractions_count_nan_and_empty_is_zero(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", math.nan, 1.0), ("a", 3.0, 1.0), ("a", 4.0, None)], READ)
    assert rows(q.null_fractions(df, ("wind_speed_10m", "wind_steadiness")), "column", "null_fraction") == [("wind_speed_10m", 0.5), ("wind_steadiness", 0.25)]
    assert {r.null_fraction for r in q.null_fractions(df.where("false"), ("wind_speed_10m",)).collect()} == {0.0}


def test_range_bounds_are_inclusive_and_may_be_open(spark):
    df = spark.createDataFrame([("a", 80.0, 0.0), ("b", 80.1, 1e9), ("c", -0.1, -0.1), ("d", None, None)], READ)
    got = rows(q.range_violations(df, ("spot_id",)), "spot_id", "column", "value")
    assert got == [("b", "wind_speed_10m", 80.1), ("c", "wind_speed_10m", -0.1), ("c", "wind_steadiness", -0.1)]


@pytest.fixture(scope="module")
def slices(spark):
    return spark.createDataFrame([("good", 5.0, .1)] * 9 + [("good", None, .1)] + [("null", None, .1)] * 2 + [("range", 99.0, .1)], READ)


def test_verdict_per_slice(slices):
    got = {r.spot_id: r for r in q.validate_slices(slices, ("wind_speed_10m",)).collect()}
    assert got["good"].is_valid and got["good"].max_null_fraction == pytest.approx(0.1)
    assert not got["null"].completeness_valid and got["null"].range_valid
    assert got["range"].range_violations == 1 and not got["range"].is_valid
    missing = q.validate_slices(slices, ("wind_speed_10m", "cape")).first()
    assert missing.missing_columns == "cape" and not missing.is_valid


def test_three_policies(slices):
    verdict = q.validate_slices(slices, ("wind_speed_10m",))
    assert q.apply_policy(slices, verdict, "warn").count() == 13
    assert {r.spot_id for r in q.apply_policy(slices, verdict, "skip").collect()} == {"good"}
    with pytest.raises(PySparkException, match="validation failed"):
        q.apply_policy(slices, verdict, "fail").collect()


def test_unit_contract(spark):
    units = spark.createDataFrame([(1, "wind_speed_10m", "km/h"), (2, "wind_speed_80m", "undefined"), (3, "wind_gusts_10m", "mph"),
                                   (4, "temperature_2m", "F"), (5, "wind_speed_120m", None)], "id int, field string, unit string")
    checked = q.unit_contract(units, ("id",))
    assert rows(checked, "id", "status", "resolved_unit") == [(1, "expected", "km/h"), (2, "assumed", "km/h"), (3, "rejected", "mph"), (5, "rejected", None)]
    with pytest.raises(PySparkException, match="unexpected unit"):
        q.require_units(checked).collect()


def test_round_trip_is_null_unless_rows_match(spark):
    a = spark.createDataFrame([("x", 1, 1.0), ("x", 2, 2.0), ("y", 1, 1.0)], "spot_id string, t int, v double")
    b = spark.createDataFrame([("x", 1, 1.5), ("x", 2, 2.0)], "spot_id string, t int, v double")
    assert rows(q.round_trip(a, b, ("spot_id", "t"), ("v",), by=("spot_id",)), "spot_id", "max_abs_delta") == [("x", 0.5), ("y", None)]


def test_field_parity_tolerance_and_presence(spark):
    a = spark.createDataFrame([(1, "s", 1.0, 5)], "k int, name string, delta double, only_left int")
    b = spark.createDataFrame([(1, "s", 1.0 + 1e-13, 7)], "k int, name string, delta double, only_right int")
    got = q.field_parity(a, b, ("k",), ("name", "delta", "only_left", "only_right"), tolerant=("delta",))
    assert rows(got, "field", "present_left", "present_right", "matches") == [
        ("delta", True, True, True), ("name", True, True, True), ("only_left", True, False, False), ("only_right", False, True, False)]


def test_column_diff(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(1, 2)], "y int, z int")
    assert rows(q.column_diff(a, b), "column", "status") == [("x", "missing"), ("y", "shared"), ("z", "new")]


FORECAST = [("a", at(h), v) for h, v in enumerate((1.0, 4.0, 4.0, 3.0))] + [("b", at(0), 2.0), ("b", at(1), 1.0)] + [("c", at(0), 5.0)]


@pytest.fixture(scope="module")
def forecast(spark):
    return spark.createDataFrame(FORECAST, "spot_id string, time timestamp_ntz, quality_index double")


@pytest.fixture(scope="module")
def spots(spark):
    return spark.createDataFrame([("a", 0, 30.0), ("b", 1, 180.0), ("c", 2, 20.0), ("empty", 3, 10.0)], "spot_id string, ordinal int, drive_minutes double")


def test_peak_and_hours_keep_empty_spots(forecast, spots):
    assert rows(ranking.forecast_peak(forecast, spots), "spot_id", "peak_quality", "session_hours") == [
        ("a", 4.0, 3.0), ("b", 2.0, 1.0), ("c", 5.0, 1.0), ("empty", 0.0, 0.0)]


def test_ranking_by_hand(forecast, spots):
    ranked = ranking.ranking_table(ranking.rank_spots(ranking.forecast_peak(forecast, spots)), "ordinal")
    # a: ratio 4*3/0.5 = 24; c: 5*1/(1/3) = 15; b: 2*1/3.
    want = {"a": .6 * .8 + .3 + .1, "c": .6 + .3 * 15 / 24 + .1 / 3, "b": .6 * .4 + .3 * (2 / 3) / 24 + .1 / 3, "empty": 0.0}
    got = ranked.orderBy("position").collect()
    assert [r.spot_id for r in got] == ["a", "c", "b", "empty"]
    assert all(r.score == pytest.approx(want[r.spot_id], abs=6e-4) for r in got)


def test_equal_values_scale_to_one_or_zero(spark):
    df = spark.createDataFrame([(3.0, 0.0), (3.0, 0.0)], "x double, z double")
    scaled = ranking.minmax(df, ("x", "z"))
    assert rows(df.select(scaled["x"].alias("x"), scaled["z"].alias("z")), "x", "z") == [(1.0, 0.0)] * 2


def test_summary_takes_the_first_peak_and_has_defaults(forecast, spots):
    frame = ranking.forecast_frame(forecast, F.when(F.col("spot_id") != "b", F.col("time") != F.lit(at(2)).cast("timestamp_ntz")))
    got = {r.spot_id: r for r in ranking.forecast_summary(frame, spots).collect()}
    assert got["a"].peak_time == at(1) and got["a"].rideable_hours == 2 and got["a"].peak_label == "Fun Day"
    assert got["b"].rideable_hours == 1
    assert (got["empty"].peak_label, got["empty"].peak_time_label, got["empty"].forecast_rows) == ("Unsafe", "No forecast rows", 0)


def test_top_k_with_rest(spark):
    df = spark.createDataFrame([(n, v) for n, v in zip("abcdef", (5, 5, 9, 1, 5, 2))], "m string, n long")
    assert rows(ranking.topk_with_rest(df, "m", "n", 2), "m", "entries", "n") == [("(rest)", 4, 13), ("a", 1, 5), ("c", 1, 9)]
    assert rows(ranking.topk_with_rest(df.limit(2), "m", "n", 8), "m", "entries", "n") == [("a", 1, 5), ("b", 1, 5)]


def test_snapshot_must_cover_the_request(forecast, spark):
    ask = lambda *ids: spark.createDataFrame([(i,) for i in ids], "spot_id string")
    assert ranking.snapshot_subset(forecast, ask("a", "c")).count() == 5
    assert ranking.snapshot_subset(forecast, ask("a", "nowhere")).count() == 0


def test_snapshot_age(spark):
    df = spark.createDataFrame([(1, at(0)), (2, at(3)), (3, None)], "k int, written_at timestamp_ntz")
    assert rows(ranking.fresh_snapshot(df, "written_at", F.lit(at(7)).cast("timestamp_ntz"), 25200), "k") == [(1,), (2,)]


def test_run_selection(spark):
    history = spark.createDataFrame([("p", "r1", 1), ("p", "r2", 2), ("p", "r1", 3), ("p", "r3", 4), ("q", None, 1)], "dataset string, run_id string, n int")
    wanted = spark.createDataFrame([("p", None), ("p", "r1"), ("p", "r3"), ("p", "gone"), ("q", "any")], "dataset string, wanted_run_id string")
    got = runs.select_run_summary(history, wanted, "dataset", ("n",))
    assert rows(got, "dataset", "wanted_run_id", "n") == sorted([("p", "r1", 3), ("p", "r3", 4), ("p", None, 4), ("q", "any", 1)], key=lambda t: tuple((x is None, x) for x in t))


def test_retention_limits():
    assert RetentionRules.explicit(1, 0) == RetentionRules(2, 1)
    assert RetentionRules.from_config(2048, 10, 30).days == 60
