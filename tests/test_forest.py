"""Forests of large tables: the same trees as Spark ML's where nothing is drawn, all trees and rows where rows are drawn."""

import os

import duckdb
import numpy as np
import pytest
from conftest import SMALL
from pyspark.ml import Pipeline
from pyspark.sql import functions as F
from test_queries import ORACLES, QUERIES, content

from anemos.ml import forest, growing, store
from anemos.ml import training as ml

SPACE = ["f0", "f1", "f2"]


@pytest.fixture(scope="module")
def data(spark):
    """Grades that follow two columns, with noise, and a column of one value."""
    df = spark.range(0, 700, 1, 3).withColumns({"f0": F.round(F.rand(1) * 50), "f1": F.rand(2), "f2": F.lit(1.0)})
    noise = (F.rand(3) * 1.3).cast("long")
    return store.settle(df.withColumn("quality_index", (F.col("f0") / 13).cast("long") + F.when(F.col("f1") > .6, 1).otherwise(0) + noise), "graded")


def grown(data, root, **changes):
    whole = ml.build_model(columns=SPACE, **{"trees": 7, "depth": 30, **changes})
    return store.fit_forest(data, lambda n: [whole, whole], whole, str(root))


def predictions(model, rows):
    return {r.id: r.prediction for r in ml.score(model, rows).collect()}


def spark_tree(data, **changes):
    return ml.build_model(columns=SPACE, trees=1, bootstrap=False, **changes).fit(data)


@pytest.mark.parametrize("depth", [1, 3, 30])
def test_a_tree_of_all_rows_is_that_of_spark(data, tmp_path, depth):
    """Noise would make deep nodes of few rows, where equal gains are common and Spark ML takes the one its rounding favours."""
    if depth == 30:
        data = store.settle(data.withColumn("quality_index", (F.col("f0") / 13).cast("long") + F.when(F.col("f1") > .6, 1).otherwise(0)), "plain")
    model = grown(data, tmp_path, trees=1, bootstrap=False, depth=depth)
    theirs = spark_tree(data, depth=depth)
    assert isinstance(model, forest.GrownForest)
    assert len(model.trees.first()["column"]) == theirs.stages[-1].trees[0].numNodes
    want = predictions(theirs, data)
    assert {k: pytest.approx(v) for k, v in want.items()} == predictions(model, data)
    assert model.importances() == pytest.approx(list(theirs.stages[-1].featureImportances.toArray()), abs=.02)


def test_a_forest_is_the_mean_of_its_trees(data, tmp_path):
    model = grown(data, tmp_path)
    scored = ml.score(model, data)
    assert scored.columns == [*data.columns, "prediction"] and scored.count() == data.count()
    assert sorted(r["tree"] for r in model.trees.collect()) == list(range(7))
    rows = data.toPandas()
    limits = forest.limits_of(data, SPACE, len(rows), 42)
    bins = np.array([np.searchsorted(x, rows[c]) for c, x in zip(SPACE, limits)]).astype(np.uint8)
    trees = [growing.Tree(*(np.frombuffer(r[c], k) for c, k in (("column", np.int8), ("last", np.uint8), ("value", float))), None)
             for r in model.trees.collect()]
    assert len({t.value.tobytes() for t in trees}) == 7  # each has drawn its own rows
    mean = sum(t.predict(bins) for t in trees) / 7
    assert predictions(model, data) == {int(i): pytest.approx(p) for i, p in zip(rows["id"], mean)}
    ranked = {r.feature: r.importance for r in ml.feature_importance(model, data, SPACE).collect()}
    assert ranked["f2"] == 0 and sum(ranked.values()) == pytest.approx(1) and ranked["f0"] > ranked["f1"]


def test_a_forest_is_grown_once(spark, data, tmp_path):
    first = grown(data, tmp_path)
    assert grown(data.repartition(5), tmp_path) == first and store.index(spark, str(tmp_path)).count() == 1
    assert grown(data, tmp_path, seed=1) != first and grown(data.where("id > 0"), tmp_path) != first


def test_blocks_may_come_in_any_order(spark, data, monkeypatch):
    """What a tree draws hangs on its number and the block's, not on when or where a block arrives."""
    monkeypatch.setattr(forest, "BLOCK", 50)
    limits = forest.limits_of(data, SPACE, 700, 42)
    packed = store.settle(forest.pack(data, SPACE, limits, "quality_index", "grades"), "packed")
    assert packed.count() >= 14 and packed.agg(F.sum(F.octet_length("grades"))).first()[0] == 700
    one, two = ([tuple(r) for r in forest.grown(p, 3, 42, 5, 30, True).orderBy("tree").collect()]
                for p in (packed, packed.orderBy(F.desc("block")).repartition(4)))
    assert one == two and len(one) == 5


def test_a_large_forest_needs_no_fit_of_spark(spark, monkeypatch):
    """The queries grow the forest where it would take several fits of Spark ML, and equal what SQL can say of them."""
    monkeypatch.setattr(ml, "FIT_ROWS", 100 * 200)
    monkeypatch.setattr(Pipeline, "fit", lambda *a, **b: pytest.fail("a fit of Spark ML"))
    con = duckdb.connect()
    for name in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{name}'")
    for key in ("score_batch_rows", "train_evaluate_counts"):
        assert content(QUERIES[key](spark, SMALL).toPandas()) == content(con.execute(ORACLES[key]).df())


def test_small_tables_keep_the_fit_of_spark(data, tmp_path):
    whole = ml.build_model(columns=SPACE, trees=3)
    model = store.fit_forest(data, lambda n: ml.forest_parts(n, trees=3, columns=SPACE), whole, str(tmp_path))
    assert isinstance(model, store.PartedForest) and len(model.paths) == 1


@pytest.mark.parametrize("column,value", [("f0", "null"), ("f1", "double('NaN')"), ("quality_index", "null"), ("quality_index", "16"), ("quality_index", "-1")])
def test_rows_that_cannot_be_packed_are_an_error(data, tmp_path, column, value):
    kind = dict(data.dtypes)[column]
    spoilt = data.withColumn(column, F.when(F.col("id") == 7, F.expr(f"cast({value} as {kind})")).otherwise(F.col(column)))
    with pytest.raises(Exception, match=column):
        grown(store.settle(spoilt, "spoilt"), tmp_path)


def test_tables_beyond_exact_sums_are_fitted_in_parts(data, tmp_path, monkeypatch):
    monkeypatch.setattr(growing, "MOST_ROWS", 699)
    whole = ml.build_model(columns=SPACE, trees=2, depth=2)
    model = store.fit_forest(data, lambda n: [ml.build_model(columns=SPACE, trees=1, depth=2, seed=s) for s in (1, 2)], whole, str(tmp_path))
    assert isinstance(model, store.PartedForest) and len(model.paths) == 2


def test_no_rows_to_score(data, tmp_path):
    assert ml.score(grown(data, tmp_path), data.where("false")).count() == 0


def test_limits_halve_the_way_between_values():
    assert list(growing.thresholds(np.array([3.0, 1.0, 1.0, 2.0]))) == [1.5, 2.5]
    assert list(growing.thresholds(np.array([1.0, 1.0]))) == [] and list(growing.thresholds(np.array([]))) == []
    many = growing.thresholds(np.arange(3200.0))
    assert len(many) == 31 and set(np.diff(many)) == {100.0} and many[0] == 99.5


def test_splits_equal_a_plain_search():
    rng = np.random.default_rng(5)
    bins, grades, weights = rng.integers(0, 6, (3, 60)).astype(np.uint8), rng.integers(0, 6, 60).astype(np.uint8), rng.integers(0, 3, 60).astype(np.uint8)
    sums = np.zeros((3, 1, growing.BINS))
    for f in range(3):
        np.add.at(sums[f, 0], bins[f], weights * growing.HIGH + weights.astype(float) * grades)
    w = weights.astype(float)

    def fall(f, b):
        spread = lambda m: (w[m] * (grades[m] - np.average(grades[m], weights=w[m])) ** 2).sum() if w[m].sum() else 0.0
        return spread(w >= 0) - spread(bins[f] <= b) - spread(bins[f] > b)

    plain = {(f, b): fall(f, b) for f in range(3) for b in range(5)}
    (column,), (last,), (gain,) = growing.best_splits(sums)
    assert gain == pytest.approx(max(plain.values())) and plain[column, last] == pytest.approx(gain)


def test_equal_means_are_no_split():
    bins = np.array([[0, 0, 1, 1], [0, 1, 0, 1]], np.uint8)
    tree = growing.grow(bins, np.array([0, 1, 1, 0], np.uint8), np.ones(4, np.uint8))
    assert list(tree.column) == [-1] and tree.value[0] == .5


def test_sums_of_the_largest_tree_are_exact():
    most = growing.MOST_ROWS * 1.001  # what is drawn may be a little more
    assert most * growing.MOST_GRADE < growing.HIGH and most * growing.HIGH < 2**53 and most * most * growing.MOST_GRADE < 2**53


def test_many_rows_and_nodes_are_cut_into_pieces(monkeypatch):
    rng = np.random.default_rng(6)
    bins, grades, weights = rng.integers(0, 32, (4, 5000)).astype(np.uint8), rng.integers(0, 6, 5000).astype(np.uint8), rng.poisson(1, 5000).astype(np.uint8)
    whole = growing.grow(bins, grades, weights)
    monkeypatch.setattr(growing, "ROWS_AT_ONCE", 64)
    monkeypatch.setattr(growing, "NODES_AT_ONCE", 3)
    for kept in (growing.KEPT, 20, 0):  # histograms taken from the parents' at all levels, at the upper ones, nowhere
        monkeypatch.setattr(growing, "KEPT", kept)
        cut = growing.grow(bins, grades, weights)
        assert all(np.array_equal(getattr(whole, c), getattr(cut, c)) for c in ("column", "last", "value"))
        assert whole.importance == pytest.approx(cut.importance)
    # Rows that nothing tells apart share a leaf: their weighted mean is its value.
    told, seen = whole.predict(bins), weights > 0
    for key in {tuple(c) for c in bins[:, seen].T[:200]}:
        same = (bins.T == key).all(axis=1) & seen
        assert told[same] == pytest.approx(np.average(grades[same], weights=weights[same]))
