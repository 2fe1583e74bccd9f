import random

import pandas as pd
import pytest
from conftest import at
from pyspark.sql import functions as F

from anemos.operators import asof

RIGHT = "k string, t timestamp_ntz, v long"


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(5)
    left = [("h" if i % 3 else "c", at(rng.randrange(4000) / 20), i) for i in range(300)]
    moments = {k: sorted(rng.sample(range(4000), 60)) for k in "hc"}
    right = [(k, at(m / 20), m) for k in "hc" for m in moments[k]]
    return left, right, spark.createDataFrame(left, "k string, t timestamp_ntz, id long"), spark.createDataFrame(right, RIGHT)


def brute(left, right, pick):
    out = {}
    for k, t, i in left:
        out[i] = pick(t, [(rt, v) for rk, rt, v in right if rk == k])
    return out


def nearest(tie, tolerance=None):
    def pick(t, cands):
        sign = -1 if tie == "later" else 1
        best = min(cands, key=lambda c: (abs((c[0] - t).total_seconds()), sign * (c[0] - t).total_seconds()))
        return best[1] if tolerance is None or abs((best[0] - t).total_seconds()) <= tolerance else None
    return pick


@pytest.mark.parametrize("limit", [None, 30])
@pytest.mark.parametrize("tie,tolerance", [("later", 5400), ("earlier", None), ("later", 180)])
def test_nearest_join(sides, limit, tie, tolerance):
    left, right, l, r = sides
    got = asof.nearest_join(l, r, ("k",), "t", "t", "id", ("v",), tie=tie, tolerance_s=tolerance, rows_per_segment=limit)
    assert {x.id: x.v for x in got.collect()} == brute(left, right, nearest(tie, tolerance))


@pytest.mark.parametrize("limit", [None, 30])
def test_point_in_time_join_matches_pandas(sides, limit):
    left, right, l, r = sides
    got = {x.id: x.v for x in asof.point_in_time_join(l, r, ("k",), "t", "t", "id", ("v",), ttl="3 HOURS", rows_per_segment=limit).collect()}
    a = pd.DataFrame(left, columns=["k", "t", "id"]).sort_values("t")
    b = pd.DataFrame(right, columns=["k", "t", "v"]).sort_values("t")
    want = pd.merge_asof(a, b, on="t", by="k", tolerance=pd.Timedelta("3h"))
    assert got == {i: None if pd.isna(v) else int(v) for i, v in zip(want.id, want.v)}


def test_ties_and_tolerance_edge(spark):
    l = spark.createDataFrame([("a", at(1), 1), ("b", at(1), 2)], "k string, t timestamp_ntz, id long")
    r = spark.createDataFrame([("a", at(0), 10), ("a", at(2), 11), ("b", at(2.5), 12)], RIGHT)
    pick = lambda **kw: {x.id: x.v for x in asof.nearest_join(l, r, ("k",), "t", "t", "id", ("v",), **kw).collect()}
    assert pick(tie="later") == {1: 11, 2: 12} and pick(tie="earlier") == {1: 10, 2: 12}
    assert pick(tie="later", tolerance_s=5400) == {1: 11, 2: 12}
    assert pick(tie="later", tolerance_s=5399) == {1: 11, 2: None}


def test_no_nested_loop_join(sides):
    _, _, l, r = sides
    plan = asof.nearest_join(l, r, ("k",), "t", "t", "id", ("v",))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Join" not in plan


def test_grid_sample(spark):
    df = spark.createDataFrame([("a", at(0), 1), ("a", at(7), 2), ("a", at(12), 3)], RIGHT)
    got = asof.grid_sample(df, df, ("k",), "t", "6 HOURS", ("v",)).orderBy("grid_time").collect()
    assert [(x.grid_time, x.v) for x in got] == [(at(0), 1), (at(6), 2), (at(12), 3)]


def test_one_per_instant(spark):
    df = spark.createDataFrame([("a", at(0), 5), ("a", at(0), 4), ("b", at(0), 1)], RIGHT).withColumn("o", F.col("v"))
    first = {x.k: x.v for x in asof.one_per_instant(df, ("k",), "t", "o").collect()}
    assert first == {"a": 4, "b": 1}


def test_anti_dedup_keeps_repeats_in_the_batch(spark):
    new = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, t int")
    old = spark.createDataFrame([("b", 2), ("b", 2)], "k string, t int")
    assert asof.anti_dedup(new, old, ("k", "t")).count() == 2
