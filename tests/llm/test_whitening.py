"""Whitening against a dense eigenvalue solver, and its odd inputs."""

import math

import numpy as np
import pytest
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from anemos.llm import whitening
from anemos.llm.queries import QUERIES
from conftest import SMALL

SCHEMA = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType()))])


def plain(vectors, most=8):
    """n, per row (deviation, whitened up to sign), explained; from the covariance itself."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    total = [sum(column) for column in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, total)) for v in x]
    y = np.array([[(n * a - s) / n for a, s in zip(v, total)] for v in x])
    value, vector = np.linalg.eigh(y.T @ y / n)
    value, vector = value[::-1][:most], vector[:, ::-1][:, :most]
    return n, deviation, y @ vector / np.sqrt(value), value / np.trace(y.T @ y / n), d


def compare(spark, vectors, result):
    n, deviation, whitened, explained, d = plain(vectors)
    found = {}
    for r in result.collect():
        found[r.vec_id, r.component] = r
    assert len(found) == n * min(8, d)
    for k in range(min(8, d)):
        column = np.array([found[i, k + 1].whitened for i in range(n)])
        sign = np.sign(column @ whitened[:, k])
        assert np.abs(column * sign - whitened[:, k]).max() < 1e-8
        for i in range(n):
            r = found[i, k + 1]
            assert (r.n, r.deviation) == (n, deviation[i])
            assert abs(r.explained / explained[k] - 1) < 1e-10
            assert 0 <= r.identity_error < 1e-9


def test_all_vectors_of_the_table_against_a_dense_solver(spark):
    vectors = [r.embedding for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()]
    compare(spark, vectors, QUERIES["op12_whitening"](spark, SMALL))


@pytest.mark.parametrize("d", [1, 2, 3, 11])
def test_few_dimensions_over_many_parts(spark, d, monkeypatch):
    monkeypatch.setattr(whitening, "TOGETHER", 2)
    monkeypatch.setattr(whitening, "BLOCK", 7)
    rng = np.random.default_rng(d)
    vectors = (rng.standard_normal((90, d)) * rng.uniform(0.1, 4, d)).tolist()
    compare(spark, vectors, whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), SCHEMA).repartition(9)))


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(5)
    good = rng.standard_normal((20, 3)).tolist()
    rows = [*enumerate(good), (90, None), (91, [1.0, None, 2.0]), (92, [nan, 0.0, 0.0]), (93, [0.0, -inf, 0.0]), (94, []),
            (95, [1.0, 2.0])]
    compare(spark, good, whitening.whiten(spark.createDataFrame(rows, SCHEMA)))


def test_repeated_null_and_zero_rows_count(spark):
    vectors = [[0.0, 0.0], [1.0, 0.5], [1.0, 0.5], [0.0, 0.0], [-0.5, 2.0]]
    table = spark.createDataFrame(list(zip([None, 1, 1, 2, 3], vectors)), SCHEMA)
    out = whitening.whiten(table).collect()
    assert len(out) == 10 and {r.n for r in out} == {5}
    assert sum(r.vec_id is None for r in out) == 2
    n, deviation, *_ = plain(vectors)
    assert sorted(r.deviation for r in out) == sorted(deviation * 2)


def test_no_variance_empty_table_and_other_columns(spark):
    wide = StructType([*SCHEMA.fields, StructField("component", StringType()), StructField("x", StringType())])
    out = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.5], "a", "b"), (2, [0.5, 0.5], "c", "d")], wide)).collect()
    assert {(r.whitened, r.explained, r.deviation, r.identity_error) for r in out} == {(0.0, 0.0, 0, 1.0)}
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25])], SCHEMA)).collect()
    assert {(r.n, r.whitened) for r in one} == {(1, 0.0)}
    empty = whitening.whiten(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert empty.count() == 0


def test_entries_that_no_long_can_hold(spark):
    rows = [(k, [1e300 * (-1) ** k, float(k)]) for k in range(4)]
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 8 and all(r.identity_error < 1e-6 for r in out)
    x = np.array([[10 ** 6 * k for k in range(3)]] * 2)
    assert whitening.deviations(x, 10 ** 9, np.array([0, 0, 0], dtype=object)).to_pylist() == [None, None]


def triangle_of(y):
    return whitening.triangle(np.asarray(y, dtype=float))


def test_solver_on_hard_spectra():
    rng = np.random.default_rng(2)
    square = np.linalg.qr(rng.standard_normal((200, 40)))[0]
    for y in (square, square * np.logspace(0, -10, 40), np.hstack((square[:, :5] * 7, square[:, 5:])), np.diag(np.arange(1.0, 30)),
              rng.standard_normal((400, 40)), np.hstack((square[:, :3], square[:, :1] + 1e-7 * square[:, 3:4], square[:, 9:]))):
        n, d = y.shape
        by = whitening.directions(triangle_of(y), n, np.zeros(d, dtype=object), 8)
        v = y.T @ y / n
        value = np.linalg.eigvalsh(v)[::-1][:8]
        assert np.abs(by.variance / value - 1).max() < 1e-10
        assert np.abs(v @ by.rows.T - by.rows.T * by.variance).max() < 1e-12 * value[0]
        assert np.abs(by.rows @ by.rows.T - np.eye(8)).max() < 1e-8


def test_dqds_keeps_small_values_exact():
    # The product of the diagonal is that of the singular values; a dense solver loses the smallest ones.
    a, b = np.logspace(0, -9, 10), np.full(9, 0.1)
    values = np.sqrt(whitening.dqds(a * a, b * b))
    assert abs(np.log(values).sum() - np.log(a).sum()) < 1e-12
