import math
import random

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from anemos.operators import drift as d
from anemos.operators import events as ev
from anemos.operators import hindcast as h
from anemos.params import RetentionRules

LOG = "seq long, model_version string, prediction_timestamp timestamp_ntz, forecast_time timestamp_ntz, quality_index double"


def log(spark, entries):
    return spark.createDataFrame([(i, m, t, t or at(0), 1.0) for i, (m, t) in enumerate(entries)], LOG)


def test_newest_rows_per_model_and_stale_rows_go(spark):
    df = log(spark, [("7", at(0)), ("7", at(24 * 45)), ("8", at(24 * 46)), ("7", at(24 * 46)), ("7", at(24 * 44)), ("7", None)])
    kept = ev.retain_by_time(df, RetentionRules(2, 30))
    assert rows(kept, "seq") == [(1,), (2,), (3,)]
    assert rows(ev.retain_by_time(df, RetentionRules(2, 30), "8"), "seq") == [(2,)]


def test_file_order_decides_in_the_sequence_form(spark):
    df = log(spark, [("7", at(9)), ("7", at(1)), (" ", at(2)), (None, at(3)), ("7", at(5)), ("7", None)])
    assert rows(ev.retain_by_sequence(df, RetentionRules(2, 1)), "seq") == [(1,), (2,), (3,), (4,)]
    # The model filter comes after the cutoff, and blank names are "unknown".
    assert rows(ev.retain_by_sequence(df, RetentionRules(2, 1), ""), "seq") == [(2,), (3,)]
    # Without any valid time nothing is cut by age.
    timeless = df.withColumn("prediction_timestamp", F.lit(None).cast("timestamp_ntz"))
    assert rows(ev.retain_by_sequence(timeless, RetentionRules(3, 1)), "seq") == [(1,), (2,), (3,), (4,), (5,)]


def test_row_limit_is_applied_before_the_shuffle(spark):
    df = log(spark, [("7", at(1))])
    plan = ev.retain_by_sequence(df, RetentionRules(2, 1))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_eligibility_is_strict(spark):
    df = log(spark, [("7", at(0)), ("7", at(1))])
    assert rows(ev.eligible(df, F.lit(at(121)).cast("timestamp_ntz"), 120), "seq") == [(0,)]


def test_time_split_and_fallback(spark):
    df = log(spark, [("7", at(24 * x)) for x in (0, 1, 2, 20)] + [("7", None)])
    assert rows(ev.time_split(df, 10), "seq", "side") == [(0, "reference"), (1, "reference"), (2, "reference"), (3, "current")]
    assert rows(ev.time_split(df, 40), "seq", "side") == [(0, "reference"), (1, "reference"), (2, "current"), (3, "current"), (4, "current")]


@pytest.mark.parametrize("limit", [None, 3])
def test_midpoint_split_per_key(spark, limit):
    df = spark.createDataFrame([("a", i, i) for i in range(7)] + [("b", 0, 9)], "k string, t long, id long")
    got = ev.midpoint_split(df, ("k",), ("t", "id"), limit)
    assert rows(got, "id", "side") == [(i, "reference" if i < 3 else "current") for i in range(7)]


def test_flatten_skips_spots_without_hours(spark):
    df = spark.sql("""SELECT '' AS model_version, array(named_struct('spot_id','a','spot_name','A','forecast',
        array(named_struct('time','t1','quality_index',1.0D), named_struct('time','t2','quality_index',2.0D))),
        named_struct('spot_id','b','spot_name','B','forecast', array())) AS predictions""")
    got = ev.flatten_predictions(df, F.lit("rank"), F.lit("now"), F.array(F.lit("a")))
    assert rows(got, "model_version", "spot_id", "forecast_time", "quality_index") == [("unknown", "a", "t1", 1.0), ("unknown", "a", "t2", 2.0)]


def test_gauges_include_a_total(spark):
    df = log(spark, [("7", at(0)), ("7", at(1)), (" ", None)])
    assert rows(ev.log_gauges(df), "model_version", "row_count", "models") == [("*", 3, 2), ("7", 2, 1), ("unknown", 1, 1)]


def test_hindcast_counts_every_pair(spark):
    p = spark.createDataFrame([("a", at(0.5), 2.5), ("a", at(0.25), 2.5), ("a", at(1.5), 1.0), ("b", at(0), 1.0)], "spot_id string, forecast_time timestamp_ntz, quality_index double")
    o = spark.createDataFrame([("a", at(0), 2), ("a", at(0.5), 3), ("a", at(2), 3)], "spot_id string, time timestamp_ntz, actual_quality_index long")
    pairs = h.hindcast_pairs(p, o)
    assert rows(pairs, "forecast_hour", "quality_index", "actual_quality_index", "pairs") == [(at(0), 2.5, 2, 2), (at(0), 2.5, 3, 2), (at(2), 1.0, 3, 1)]
    m = h.hindcast_metrics(pairs).first()
    assert (m.validated_count, m.accuracy, m.mae) == (5, pytest.approx(0.4), pytest.approx((4 * .5 + 2) / 5))
    empty = h.hindcast_metrics(pairs.where("false")).first()
    assert (empty.validated_count, empty.accuracy, empty.mae) == (0, None, None)


def test_published_evaluation_example_and_constant_target(spark):
    df = spark.createDataFrame([(1, 1.2), (3, 2.8), (4, 3.6)], "y long, p double")
    m = h.regression_metrics(df, "y", "p").first()
    assert m.mae == pytest.approx(0.8 / 3) and m.rmse == pytest.approx(math.sqrt(.24 / 3)) and m.r2 == pytest.approx(1 - .24 / (14 / 3))
    assert rows(h.class_accuracy(df, "y", "p"), "metric", "value") == [("class_accuracy_1", 1.0), ("class_accuracy_3", 1.0), ("class_accuracy_4", 1.0), ("overall_class_accuracy", 1.0)]
    constant = spark.createDataFrame([(2, 2.0), (2, 2.0)], "y long, p double")
    assert h.regression_metrics(constant, "y", "p").first().r2 == 1.0
    assert h.regression_metrics(constant.withColumn("p", F.lit(2.5)), "y", "p").first().r2 == 0.0


def test_shadow_needs_two_models(spark):
    e = spark.createDataFrame([("7", "a", at(0), 1.0), ("8", "a", at(0), 1.5), ("8", "a", at(1), 3.0)], "model_version string, spot_id string, forecast_time timestamp_ntz, quality_index double")
    got = h.shadow_from_log(e, "7", "8").first()
    assert (got.mean_abs_divergence, got.compared_rows) == (0.5, 1)
    assert h.shadow_from_log(e, "7", "7").count() == 0


def ks_by_hand(a, b):
    gap = max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in set(a) | set(b))
    lam = gap * math.sqrt(len(a) * len(b) / (len(a) + len(b)))
    p = 1.0 if lam < .2 else min(max(2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101)), 0), 1)
    return gap, p


@pytest.mark.parametrize("limit", [None, 20])
def test_ks_against_brute_force(spark, limit):
    rng = random.Random(1)
    data = [("reference", rng.gauss(0, 1), rng.choice([0.0, 1.0, 1e6])) for _ in range(150)] + [("current", rng.gauss(.4, 1), rng.choice([0.0, 1.0])) for _ in range(120)]
    df = spark.createDataFrame(data + [("current", None, None)], "side string, x double, y double")
    got = {r["column"]: r for r in d.drift_ks(df, ("x", "y"), rows_per_segment=limit).collect()}
    for i, name in ((1, "x"), (2, "y")):
        gap, p = ks_by_hand([r[i] for r in data if r[0] == "reference"], [r[i] for r in data if r[0] == "current"])
        assert got[name].statistic == pytest.approx(gap) and got[name].score == pytest.approx(p, abs=1e-9)


def test_verdicts_by_method_and_report(spark):
    tests = spark.createDataFrame([("p1", 0.05, "ks p_value"), ("p2", 0.06, "ks p_value"), ("d1", 0.1, "total_variation"), ("d2", 0.09, "total_variation"), ("none", None, "ks p_value")],
                                  "column string, score double, method string").withColumns({"reference_rows": F.lit(5), "current_rows": F.lit(6)})
    v = d.drift_verdict(tests)
    assert rows(v, "column", "drifted") == [("d1", True), ("d2", False), ("none", False), ("p1", True), ("p2", False)]
    r = d.drift_report(v).first()
    assert (r.column_count, r.drifted_column_count, r.share_of_drifted_columns, r.dataset_drift) == (5, 2, 0.4, True)


def test_categorical_distance(spark):
    df = spark.createDataFrame([("reference", "a")] * 6 + [("reference", "b")] * 2 + [("current", "a")] * 2 + [("current", "b")] * 2, "side string, c string")
    r = d.drift_categorical(df, ("c",)).first()
    assert r.score == pytest.approx(.25) and r.degrees_of_freedom == 1 and r.statistic == pytest.approx(0.75)


def test_comparable_columns(spark):
    df = spark.createDataFrame([(1, "m", 1.0, "x")], "user_id int, model_version string, quality_index double, note string")
    assert d.prediction_columns(df) == ["quality_index"]
    assert d.prediction_columns(df.drop("quality_index")) == ["note"]
    with pytest.raises(ValueError):
        d.prediction_columns(df.select("user_id"))
    with pytest.raises(ValueError):
        d.shared_columns(df.select("note"), df.select("user_id"))
