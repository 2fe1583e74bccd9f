"""Tails, lattice paths and distances against plain computations."""

import math
from decimal import Decimal, getcontext
from itertools import combinations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from anemos.functions import probability as prob
from anemos.operators import drift as d


def plain_chi_square_p(x: float, k: int) -> float:
    """Closed forms: a finite sum for even, the error function and a finite sum for odd degrees; with 60 digits."""
    getcontext().prec = 60
    half = Decimal(repr(x)) / 2
    if k % 2 == 0:
        term = total = Decimal(1)
        for i in range(1, k // 2):
            term *= half / i
            total += term
        return float((-half).exp() * total)
    total, term = Decimal(0), None
    for i in range(1, (k - 1) // 2 + 1):
        # half^(i - 1/2) / gamma(i + 1/2)
        term = half.sqrt() / (Decimal(math.pi).sqrt() / 2) if i == 1 else term * half / (Decimal(i) - Decimal("0.5"))
        total += term
    return math.erfc(math.sqrt(x / 2)) + float((-half).exp() * total)


def test_chi_square_tail(spark):
    cases = [(x * k, k) for k in (1, 2, 3, 4, 5, 10, 31, 100, 101, 333, 500, 999, 1000) for x in (0.01, 0.5, 0.9, 1.0, 1.1, 1.6, 3.0)]
    df = spark.createDataFrame(cases, "x double, k long").withColumn("p", prob.chi_square_p(F.col("x"), F.col("k")))
    for r in df.collect():
        assert abs(r.p - plain_chi_square_p(r.x, r.k)) < 1e-9
    # Printed in every table: the 5 % points.
    points = spark.createDataFrame([(3.841458821, 1), (18.307038053, 10), (124.342113404, 100), (0.0, 4), (7.0, 0)], "x double, k long")
    got = [r.p for r in points.select(prob.chi_square_p(F.col("x"), F.col("k")).alias("p")).collect()]
    assert all(abs(p - w) < 1e-9 for p, w in zip(got, (0.05, 0.05, 0.05, 1.0, 1.0)))


def test_log_gamma(spark):
    df = spark.createDataFrame([(a,) for a in (0.5, 1.0, 1.5, 2.0, 7.3, 100.0, 500.0)], "a double")
    for r in df.withColumn("g", prob.log_gamma(F.col("a"))).collect():
        assert abs(r.g - math.lgamma(r.a)) < 1e-11 * max(1, abs(r.g))


def enumerated(gap: int, n: int, m: int) -> float:
    outside = total = 0
    for right in combinations(range(n + m), n):
        i = j = 0
        worst = 0
        for t in range(n + m):
            i, j = (i + 1, j) if t in right else (i, j + 1)
            worst = max(worst, abs(i * m - j * n))
        total += 1
        outside += worst >= gap
    return outside / total


def test_exact_p_value_equals_enumeration(spark):
    cases = [(g, n, m) for n, m in ((1, 1), (2, 3), (4, 4), (5, 3), (6, 5)) for g in range(0, n * m + 2)]
    df = spark.createDataFrame(cases, "g long, n long, m long").withColumn("p", prob.band_exit_p(F.col("g"), F.col("n"), F.col("m")))
    for r in df.collect():
        assert abs(r.p - enumerated(r.g, r.n, r.m)) < 1e-12


def sides(spark, reference, current, kind="double"):
    return spark.createDataFrame([("reference", v) for v in reference] + [("current", v) for v in current], f"side string, v {kind}")


def test_small_samples_are_exact_and_large_ones_asymptotic(spark):
    small = d.drift_ks(sides(spark, [1.0, 2.0, 3.0, 4.0], [3.5, 4.5, 5.5, 6.5]), ["v"]).first()
    assert small.statistic == 0.75 and abs(small.score - enumerated(12, 4, 4)) < 1e-12
    large = d.drift_ks(sides(spark, [float(i) for i in range(300)], [i + 30.0 for i in range(300)]), ["v"]).first()
    lam = 0.1 * math.sqrt(150)
    assert abs(large.score - 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 50))) < 1e-9
    grouped = sides(spark, [1.0, 2.0, 3.0, 4.0], [3.5, 4.5, 5.5, 6.5]).withColumn("g", F.lit("x"))
    assert abs(d.drift_ks(grouped, ["v"], ("g",)).first().score - small.score) < 1e-12


def plain_wasserstein(a, b):
    values = sorted({*a, *b})
    area = sum(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) * (w - v) for v, w in zip(values, values[1:]))
    mean = sum(a) / len(a)
    return area / max(math.sqrt(sum((x - mean) ** 2 for x in a) / len(a)), 0.001)


@pytest.mark.parametrize("cut", [None, 7])
def test_wasserstein_distance_crosses_cuts(spark, cut):
    a, b = [float(i * i % 97) for i in range(60)], [float(i * 7 % 113) + 5 for i in range(40)]
    df = sides(spark, a, b)
    got = d.drift_numeric(df, ["v"], large=10, rows_per_segment=cut).first()
    assert got.method == "wasserstein distance" and abs(got.score - plain_wasserstein(a, b)) < 1e-9 and got.score == got.distance
    few = d.drift_numeric(df, ["v"], large=100, rows_per_segment=cut).first()
    assert few.method == "ks p_value" and few.score < 1


def test_constant_and_one_sided_columns(spark):
    same = d.drift_verdict(d.drift_numeric(sides(spark, [5.0] * 20, [5.0] * 20), ["v"], large=10)).first()
    assert (same.score, same.drifted) == (0.0, False)
    moved = d.drift_verdict(d.drift_numeric(sides(spark, [5.0] * 20, [6.0] * 20), ["v"], large=10)).first()
    assert moved.score == 1000.0 and moved.drifted
    alone = d.drift_verdict(d.drift_numeric(sides(spark, [5.0, 6.0], [None]), ["v"], large=1)).first()
    assert alone.score is None and not alone.drifted


def test_categories_by_size(spark):
    df = sides(spark, ["a"] * 60 + ["b"] * 40, ["a"] * 30 + ["c"] * 70, "string")
    p, q = (0.6, 0.4, 0.0), (0.3, 0.0, 0.7)
    js = math.sqrt(sum(x * math.log(x / ((x + y) / 2)) + (y * math.log(y / ((x + y) / 2)) if y else 0) if x else
                       y * math.log(y / ((x + y) / 2)) for x, y in zip(p, q)) / 2)
    large = d.drift_verdict(d.drift_categories(df, ["v"], large=50)).first()
    assert abs(large.score - js) < 1e-12 and large.drifted and large.threshold == 0.1
    small = d.drift_verdict(d.drift_categories(df, ["v"])).first()
    assert abs(small.score - plain_chi_square_p(small.statistic, 2)) < 1e-12 and small.drifted and small.threshold == 0.05
    assert rows(d.drift_categories(df.where("v = 'a'"), ["v"]), "score") == [(1.0,)]


def test_small_groups_are_dealt_out_by_rows(spark, monkeypatch):
    """A task has as many rows whatever the table's size, and one shuffle serves counting and ordering."""
    df = spark.range(400).select((F.col("id") % 40).alias("g"), F.when(F.col("id") < 200, "reference").otherwise("current").alias("side"),
                                 (F.col("id") * 7 % 13).cast("double").alias("x"), (F.col("id") * 5 % 11).cast("double").alias("y"))
    names = ("g", "column", "statistic", "reference_rows", "current_rows", "score")
    whole = rows(d.drift_ks(df, ("x", "y"), ("g",), rows_per_segment=5), *names)  # cut groups go the other way
    monkeypatch.setattr(d, "ROWS_PER_TASK", 20)
    walked = d._walked(df, ("x", "y"), ("g",), None)[0]
    assert walked.rdd.getNumPartitions() == 20
    assert walked._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1
    assert rows(d.drift_ks(df, ("x", "y"), ("g",)), *names) == whole


def test_exact_cases_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(d, "CASES_PER_TASK", 3)
    tested = spark.createDataFrame([(f"g{i}", i / 20, 20, 30 + i) for i in range(1, 19)], "g string, statistic double, reference_rows long, current_rows long")
    found = d._ks_score(tested, ("g",))
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().toString()
    for r in found.collect():
        assert abs(r.score - plain_band_exit(round(r.statistic * r.reference_rows * r.current_rows), r.reference_rows, r.current_rows)) < 1e-12


def plain_band_exit(gap: int, n: int, m: int) -> float:
    """All cells of the lattice, one diagonal after the other."""
    inside = {(0, 0): 1.0}
    for t in range(1, n + m + 1):
        for i in range(max(0, t - m), min(n, t) + 1):
            j = t - i
            inside[i, j] = 0.0 if abs(i * m - j * n) >= gap else i / t * inside.get((i - 1, j), 0.0) + j / t * inside.get((i, j - 1), 0.0)
    return min(max(1 - inside[n, m], 0.0), 1.0)


def test_narrow_and_wide_bands(spark):
    cases = [(gap, n, m) for n, m in ((1, 1), (1, 9), (9, 1), (7, 13), (40, 3), (30, 31), (100, 100)) for gap in (1, 2, n, m, n * m // 3 + 1, n * m, n * m + 1)]
    df = spark.createDataFrame(cases, "g long, n long, m long")
    for r in df.withColumn("p", prob.band_exit_p(F.col("g"), F.col("n"), F.col("m"))).collect():
        assert r.p == plain_band_exit(r.g, r.n, r.m)


def test_small_groups_are_walked_without_counting_values(spark):
    """Ties, nulls, infinities, both zeros and one-sided groups give the gaps of counted values, from one sort of the dealt rows."""
    odd = F.element_at(F.array(*[F.lit(v) for v in (0.0, -0.0, float("inf"), float("-inf"), 1.5, 2.5)]), (F.xxhash64("id") % 3 + 4).cast("int"))
    df = spark.range(300).select(
        (F.col("id") % 7).cast("string").alias("g"), F.when((F.col("id") % 7 == 3) | (F.col("id") % 2 == 0), "reference").otherwise("current").alias("side"),
        odd.alias("x"), F.when(F.col("id") % 5 > 0, F.floor(F.col("id") / 20)).alias("y"), F.lit(None).cast("double").alias("z"))
    names = ("g", "column", "statistic", "reference_rows", "current_rows")
    small = d._small_gaps(df.repartition(3, "g"), ("x", "y", "z"), ("g",))
    counted = d._walked(df, ("x", "y", "z"), ("g",), None)[0].groupBy("g", "column").agg(*d._largest_gap())
    found = rows(small, *names)
    assert found == rows(counted, *names) and len(found) == 14
    plan = small._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Exchange") <= 1 and plan.count("Window ") == 1 and "value" not in plan[plan.index("HashAggregate"):plan.index("]", plan.index("HashAggregate"))]
