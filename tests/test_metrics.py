import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from anemos.operators import metrics as m
from anemos.operators import runs as rn

TEXT = """# HELP metric_a text
metric_a{spot="a",dataset="train"} 3
metric_a{spot="b",dataset="train"} 5.5 1700000000
metric_b{dataset="train"} 2
metric_ts 100

not a metric line
broken{x="1" 3
twice{k="1",k="2"} NaN
"""


@pytest.fixture(scope="module")
def samples(spark):
    lines = spark.createDataFrame([(i, x) for i, x in enumerate(TEXT.split("\n"))], "n int, value string")
    return m.parse_samples(lines)


def test_parse(samples):
    got = {(r["name"], tuple(sorted(r["labels"].items())), r["value"]) for r in samples.where("name <> 'twice' AND name <> 'not'").collect()}
    assert got == {("metric_a", (("dataset", "train"), ("spot", "a")), 3.0), ("metric_a", (("dataset", "train"), ("spot", "b")), 5.5),
                   ("metric_b", (("dataset", "train"),), 2.0), ("metric_ts", (), 100.0)}
    assert samples.where("name = 'twice'").first()["labels"] == {"k": "2"}


def test_labels_of_the_exposition_format(spark):
    lines = ['m{a="x}y"} 1', 'm{a="q\\"r",b="c\\\\d\\ne",} 2 1700000000000', "m +Inf", "m{} NaN -5", "m { a = \"1\" , b=\"2\" } 3", 'm{a="open} 1',
             "m{a=1} 1", "m word", "m", "9m 1", "m 1 2 3", " m{a=\"\"} 4 "]
    got = m.parse_samples(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [(r["labels"], str(r["value"])) for r in got] == [
        ({"a": "x}y"}, "1.0"), ({"a": 'q"r', "b": "c\\d\ne"}, "2.0"), ({}, "inf"), ({}, "nan"), ({"a": "1", "b": "2"}, "3.0"), ({"a": ""}, "4.0")]


def test_selectors_match_the_whole_value_and_absent_labels(samples):
    count = lambda *ms: m.select_samples(samples, "metric_a", *ms).count()
    assert count(("spot", "=", "a")) == 1 and count(("spot", "!=", "a")) == 1 and count(("spot", "=~", "a|b")) == 2
    assert count(("dataset", "=~", "trai")) == 0 and count(("dataset", "!~", "tra.*")) == 0 and count(("none", "=", "")) == 2


def test_aggregates(samples):
    a = m.select_samples(samples, "metric_a")
    assert [m.aggregate_samples(a, f).first().value for f in ("max", "min", "avg", "sum")] == [5.5, 3.0, 4.25, 8.5]
    assert rows(m.aggregate_samples(a, "sum", ("spot", "none")), "spot", "none", "value") == [("a", "", 3.0), ("b", "", 5.5)]
    assert m.aggregate_samples(a.where("false"), "sum").count() == 0
    assert rows(m.clamp_max(a, 4.0), "value") == [(3.0,), (4.0,)]


def test_arithmetic(samples, spark):
    schema = "name string, labels map<string,string>, value double, o int"
    left = spark.createDataFrame([("x", {"k": "1"}, 10.0, 0), ("x", {"k": "2"}, 1.0, 0)], schema)
    right = spark.createDataFrame([("y", {"k": "1"}, 1.0, 1), ("y", {"k": "1"}, 4.0, 2)], schema)
    assert rows(m.vector_arith(left, right, "-", "o"), "value") == [(6.0,)]
    assert rows(m.scalar_arith(left, F.lit(100.0), "-", scalar_first=True), "value") == [(90.0,), (99.0,)]


def test_histogram_and_quantile(spark):
    df = spark.createDataFrame([("a", x) for x in (0.005, 0.02, 0.2, 0.2)] + [("b", 99.0)], "e string, latency double")
    hist = m.latency_histogram(df, ("e",), "latency")
    assert [r.cumulative for r in hist.where("e = 'a'").orderBy("le").collect()] == [1, 2, 2, 2, 4, 4, 4, 4, 4, 4, 4]
    got = {r.e: r.quantile for r in m.histogram_quantile(hist, ("e",), 0.95).collect()}
    assert got["a"] == pytest.approx(0.1 + 0.15 * (3.8 - 2) / 2) and got["b"] == 10.0


@pytest.mark.parametrize("limit", [None, 2])
def test_increase_with_reset(spark, limit):
    df = spark.createDataFrame([("a", at(x / 60), i, v) for i, (x, v) in enumerate([(0, 5.0), (5, 8.0), (10, 2.0), (16, 4.0), (17, 4.0)])],
                               "e string, ts timestamp_ntz, id long, v double")
    got = m.counter_increase(df, ("e",), ("ts", "id"), "v", "15 minutes", limit)
    assert rows(got, "window_start", "increase") == [(at(0), 5.0), (at(.25), 2.0)]


def hold(spark, values, limit=None):
    df = spark.createDataFrame([("train", at(i / 60), i, float(v)) for i, v in enumerate(values)], "dataset string, ts timestamp_ntz, id long, v double")
    return m.alert_hold(df, ("dataset",), ("ts", "id"), F.col("v") > 28800, 15, limit)


@pytest.mark.parametrize("limit", [None, 4])
def test_published_alert_cases(spark, limit):
    fires = hold(spark, [3600, 3600] + [32400] * 19, limit).collect()
    assert len(fires) == 1 and fires[0].firing_from == at(17 / 60)
    assert hold(spark, [3600] * 21, limit).count() == 0
    assert hold(spark, [32400] * 10 + [3600] + [32400] * 10, limit).count() == 0


def test_threshold_on_latest_sample(spark):
    df = spark.createDataFrame([("a", "x", at(0), 9.0), ("a", "x", at(1), 1.0), ("b", "x", at(0), 0.0)], "job string, i string, ts timestamp_ntz, value double")
    latest = m.latest_samples(df, ("job", "i"), ("ts",))
    assert rows(m.threshold_alerts(latest, ("job",), 0.0), "job") == [("a",)]
    assert rows(m.threshold_alerts(latest, ("job",), 0.0, "=="), "job") == [("b",)]


@pytest.fixture(scope="module")
def run_docs(spark):
    spot = "named_struct('spot_id','a','status','stored','ingest_rows',3L,'stored_rows',3L,'validation_passed',true,'range_violation_count',0L,'max_numeric_abs_delta',CAST(NULL AS DOUBLE))"
    return spark.sql(f"""SELECT 'r1' AS run_id, 'train' AS dataset, 'succeeded' AS run_status, 'drift' AS retraining_mode, array('a') AS stored_spots, array() AS drifted_spots,
        map('fetch', 1.5D, 'store', 2.0D) AS stage_durations_seconds, map('store', 1L) AS stage_failure_counts, array({spot}) AS spots""")


def test_stage_states(run_docs):
    assert rows(rn.stage_states(run_docs), "stage", "state", "state_value") == [("engineer", "not_run", 0), ("fetch", "succeeded", 1), ("store", "failed", -1), ("validate", "not_run", 0)]
    stored = run_docs.withColumn("stage_states", F.create_map(F.lit("engineer"), F.lit("succeeded")))
    assert ("engineer", "succeeded", 1) in rows(rn.stage_states(stored), "stage", "state", "state_value")


@pytest.mark.parametrize("mode,drifted,status,state,gate", [
    ("off", 0, "succeeded", "disabled", False), ("always", 0, "succeeded", "ready", True), ("drift", 0, "succeeded", "waiting_for_drift", False),
    ("drift", 1, "succeeded", "ready", True), ("always", 0, "failed", "not_ready", True), ("odd", 0, "succeeded", "unknown", False)])
def test_handoff_and_gate(run_docs, mode, drifted, status, state, gate):
    doc = run_docs.withColumns({"retraining_mode": F.lit(mode), "run_status": F.lit(status), "drifted_spots": F.array(*[F.lit("a")] * drifted).cast("array<string>")})
    assert rn.handoff_state(doc).first().handoff_state == state
    assert rn.retrain_gate(doc).first().retrain is gate


def test_long_metrics(run_docs):
    got = dict(rows(rn.summary_metrics_long(run_docs), "metric", "value"))
    assert got["feature_fetch_duration_seconds"] == 1.5 and got["feature_store_failure_count"] == 1.0 and got["feature_a_validation_passed"] == 1.0
    assert "feature_a_max_numeric_abs_delta" not in got
