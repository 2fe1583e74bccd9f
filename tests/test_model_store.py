"""Stored models: found again by rows and parameters, lost by any change, never half written."""

import pytest
from pyspark.sql import functions as F

from anemos.ml import store
from anemos.ml import training as ml

SPACE = ["f0", "f1"]


@pytest.fixture(scope="module")
def data(spark):
    df = spark.range(60).withColumns({"f0": (F.col("id") % 2).cast("double"), "f1": F.lit(1.0)})
    return df.withColumn("quality_index", F.when(F.col("id") % 2 == 0, 1).otherwise(4) + F.when(F.col("id") % 3 == 0, 1).otherwise(0))


def one_tree(**changes):
    return ml.build_model("random_forest", SPACE, **{"trees": 1, "depth": 1, "bootstrap": False, **changes})


def test_one_tree_has_the_known_answer(spark, data, tmp_path):
    model, _ = store.fit_once(data, one_tree(), str(tmp_path))
    got = {r.f0: r.p for r in ml.score(model, data).groupBy("f0").agg(F.avg("prediction").alias("p")).collect()}
    assert got == {0.0: pytest.approx(1 + 1 / 3), 1.0: pytest.approx(4 + 1 / 3)}


def test_a_model_is_fitted_once(spark, data, tmp_path):
    calls = []

    def fit(rows):
        calls.append(rows.count())
        return one_tree().fit(rows)

    root = str(tmp_path)
    first, key = store.fit_once(data, one_tree(), root, fit)
    again, same = store.fit_once(data.repartition(5), one_tree(), root, fit)
    assert calls == [60] and key == same
    assert ml.score(again, data).select("prediction").collect() == ml.score(first, data).select("prediction").collect()
    assert [r.algorithm for r in store.index(spark, root).collect()] == ["RandomForestRegressor"]


def test_rows_and_parameters_change_the_key(spark, data):
    key = lambda rows, pipeline: store.model_key(rows, pipeline)[0]
    keys = [key(data, one_tree()), key(data, one_tree(depth=2)), key(data, one_tree(seed=1)), key(data.where("id > 0"), one_tree()),
            key(data.withColumn("f1", F.when(F.col("id") == 7, 2.0).otherwise(F.col("f1"))), one_tree()),
            key(data.unionAll(data.limit(1)), one_tree()), key(data, ml.build_model("gradient_boosting", SPACE, rounds=1))]
    assert len(set(keys)) == len(keys) and key(data, one_tree()) == keys[0]


def test_unfinished_and_lost_folders_are_fitted_again(spark, data, tmp_path):
    root = str(tmp_path)
    model, key = store.fit_once(data, one_tree(), root)
    model.write().save(f"{root}/unfinished")  # a writer that died before its line
    assert store.index(spark, root).count() == 1
    lost = str(tmp_path / "other")
    store._log(spark, f"{lost}/index", store.INDEX, key=key, path=f"{lost}/gone", created="2024", rows=1, algorithm="x", parameters="")
    assert store.load(spark, lost, key) is None
    store.fit_once(data, one_tree(), lost)
    assert store.load(spark, lost, key) is not None


def test_aliases(spark, data, tmp_path):
    root = str(tmp_path)
    with pytest.raises(KeyError):
        store.load_alias(spark, root, "champion")
    _, one = store.fit_once(data, one_tree(), root)
    _, two = store.fit_once(data, one_tree(depth=2), root)
    store.set_alias(spark, root, "champion", one)
    store.set_alias(spark, root, "candidate", two)
    store.set_alias(spark, root, "champion", two)
    assert store.key_of_alias(spark, root, "champion") == two
    assert ml.score(store.load_alias(spark, root, "candidate"), data).count() == 60
    with pytest.raises(KeyError):
        store.set_alias(spark, root, "champion", "unknown")


def test_a_forest_in_parts_is_the_mean_of_its_trees(spark, data, tmp_path, monkeypatch):
    monkeypatch.setattr(ml, "FIT_ROWS", 120)
    plan = lambda rows: ml.forest_parts(rows, trees=5, columns=SPACE, depth=3)
    root = str(tmp_path)
    forest = store.fit_parts(data, plan, root)
    parts = [store.PipelineModel.load(p).stages[-1] for p in forest.paths]
    assert [p.getNumTrees for p in parts] == [2, 2, 1]
    scored = ml.score(forest, data)
    assert scored.columns == [*data.columns, "prediction"]
    got = {r.id: r.prediction for r in scored.collect()}
    vector = store.PipelineModel.load(forest.paths[0]).stages[0].transform(data).collect()
    assert got == {r.id: pytest.approx(sum(t.predict(r.features_vector) for p in parts for t in p.trees) / 5) for r in vector}
    ranked = {r.feature: r.importance for r in ml.feature_importance(forest, data, SPACE).collect()}
    assert ranked == {"f0": pytest.approx(1.0), "f1": 0.0}
    assert store.fit_parts(data.repartition(3), plan, root) == forest and store.index(spark, root).count() == 3


def test_the_parts_of_a_forest_hold_all_its_trees():
    few, many = ml.forest_parts(8_000), ml.forest_parts(470_000)
    trees = lambda parts: [p.getStages()[-1].getNumTrees() for p in parts]
    assert trees(few) == [200] and sum(trees(many)) == 200
    assert max(trees(many)) * 470_000 <= ml.FIT_ROWS and trees(ml.forest_parts(10**9)) == [1] * 200
    assert len({p.getStages()[-1].getSeed() for p in many}) == len(many) and few[0].getStages()[-1].getSeed() == 42
