"""Cut series must give what a plain window gives."""

import pytest
from conftest import at, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from anemos.operators import ordered as o


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 0 holds most rows; its times pile up in a burst, with a long tail."""
    hot = spark.range(600).select(
        F.lit(0).alias("k"), F.col("id"),
        F.when(F.col("id") < 500, F.col("id") * 0.001).otherwise((F.col("id") - 499.0) * 1000).alias("t"))
    cold = spark.range(600, 700).select((F.col("id") % 5 + 1).cast("int").alias("k"), F.col("id"), F.col("id").cast("double").alias("t"))
    df = hot.union(cold)
    return df.withColumns({"v": F.when(F.col("id") % 7 == 0, F.col("id").cast("double")), "n": F.lit(1).cast("bigint"),
                           "flag": (F.floor(F.col("id") / 9) % 2 == 0)})


@pytest.fixture(scope="module", params=[40, 150])
def series(spark, skewed, request):
    return o.Series.measure(skewed, ("k",), ("t", "id"), request.param)


def table(df, *names):
    return {r["id"]: tuple(r[n] for n in names) for r in df.collect()}


def plain():
    return Window.partitionBy("k").orderBy("t", "id")


def test_the_burst_is_cut_again(series):
    assert len(series.cuts) >= 2


def test_segments_stay_near_the_limit(spark, skewed):
    cut = o.Series.measure(skewed, ("k",), ("t", "id"), 40).cut(skewed)
    assert cut.groupBy("k", o.SEG).count().agg(F.max("count")).first()[0] <= 40


def test_fill(skewed, series):
    got = table(o.fill(skewed, series, {"f": "v"}, {"b": "v"}), "f", "b")
    want = table(skewed.withColumns({
        "f": F.last("v", True).over(plain().rowsBetween(Window.unboundedPreceding, 0)),
        "b": F.first("v", True).over(plain().rowsBetween(0, Window.unboundedFollowing))}), "f", "b")
    assert got == want


def test_running_totals_and_positions(skewed, series):
    got = table(o.running_totals(skewed, series, {"s": "v"}, {"all": "v"}), "s", "all")
    want = table(skewed.withColumns({
        "s": F.sum("v").over(plain().rowsBetween(Window.unboundedPreceding, 0)), "all": F.sum("v").over(Window.partitionBy("k"))}), "s", "all")
    assert got == want
    numbered = table(o.number_rows(skewed, series, "p", "c"), "p", "c")
    usual = table(skewed.withColumns({"p": F.row_number().over(plain()), "c": F.count("*").over(Window.partitionBy("k"))}), "p", "c")
    assert numbered == usual


@pytest.mark.parametrize("back", [1, 2, 5])
def test_lookback(skewed, series, back):
    look = o.with_lookback(skewed, series, back)
    got = table(o.drop_lookback(look.withColumn("m", F.sum("id").over(series.window().rowsBetween(-back, 0)))), "m")
    assert got == table(skewed.withColumn("m", F.sum("id").over(plain().rowsBetween(-back, 0))), "m")


def test_islands(skewed, series):
    cut = table(o.islands(skewed, series, "flag"), "island")
    assert cut == table(o.islands(skewed, o.Series(("k",), ("t", "id")), "flag"), "island")


def test_small_keys_need_no_cut_and_no_extra_shuffle(skewed):
    series = o.Series.measure(skewed, ("k",), ("t", "id"))
    assert not series.is_cut
    plan = o.fill(skewed, series, {"f": "v"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_probe_spares_the_count(spark):
    boom = spark.range(3).select(F.lit(0).alias("k"), F.raise_error(F.lit("read")).cast("double").alias("t"))
    assert not o.Series.measure(boom, ("k",), ("t",), probe=spark.range(3)).is_cut


def test_frames_grow_only(skewed, series):
    """No shrinking frame: Spark would recompute it for every row."""
    plan = o.fill(skewed, series, {"f": "v"}, {"b": "v"})._jdf.queryExecution().optimizedPlan().toString()
    assert "unboundedfollowing" not in plan.lower()


def test_many_hot_keys_get_larger_segments(spark, monkeypatch):
    df = spark.range(400).select((F.col("id") % 4).alias("k"), "id", F.col("id").cast("double").alias("t"))
    monkeypatch.setattr(o, "HOT_LIMIT", 2)
    series = o.Series.measure(df, ("k",), ("t", "id"), 5)
    assert all(c.count() <= 2 for c in series.cuts)
    assert {r.c for r in o.number_rows(df, series, "p", "c").collect()} == {100}


def test_time_order_columns_are_cut_too(spark):
    df = spark.createDataFrame([("a", at(h), h) for h in range(100)], "k string, t timestamp_ntz, id long")
    series = o.Series.measure(df, ("k",), ("t", "id"), 10)
    assert series.is_cut
    assert [r.p for r in o.number_rows(df, series, "p").orderBy("id").collect()] == list(range(1, 101))


def test_cuts_fit_a_wider_table_and_nulls_come_first(spark):
    """Cuts measured on a part still order rows outside its span, and null order values."""
    df = spark.range(-50, 150).select(F.lit("k").alias("k"), "id", F.when(F.col("id") >= -40, F.col("id").cast("double")).alias("t"))
    series = o.Series.measure(df.where("id >= 0 AND id < 100"), ("k",), ("t", "id"), 10)
    assert series.is_cut
    assert [r.p for r in o.number_rows(df, series, "p").orderBy("id").collect()] == list(range(1, 201))


def test_a_null_key_is_cut_like_any_other(spark):
    rows_ = [(None, at(i), i, float(i % 7)) for i in range(200)] + [("b", at(i), 1000 + i, 1.0) for i in range(10)]
    df = spark.createDataFrame(rows_, "spot_id string, time timestamp_ntz, event_id long, v double")
    series = o.Series.measure(df, ("spot_id",), ("time", "event_id"), 20)
    cut = series.cut(df)
    assert cut.groupBy("spot_id", o.SEG).count().agg(F.max("count")).first()[0] <= 20
    plain = o.Series(("spot_id",), ("time", "event_id"))
    gaps = df.withColumn("v", F.when(F.col("event_id") % 50 == 0, F.col("v")))
    assert rows(o.fill(gaps, series, {"x": "v"}), "event_id", "x") == rows(o.fill(gaps, plain, {"x": "v"}), "event_id", "x")


def test_a_key_of_millions_of_rows_is_cut(spark):
    """The rows of a segment, some 300 bytes each in an as-of join, must fit a task."""
    assert o.Series.measure(spark.range(3_000_000).withColumn("k", F.lit(0)), ("k",), ("id",)).is_cut
