import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from anemos.ml import training as ml

SPACE = [f"f{i}" for i in range(3)]


@pytest.fixture(scope="module")
def data(spark):
    df = spark.range(400).withColumns({"f0": (F.col("id") % 5).cast("double"), "f1": F.rand(1), "f2": F.lit(1.0)})
    return df.withColumn("quality_index", F.col("f0").cast("long"))


@pytest.mark.parametrize("n", [1, 7, 100, 400])
def test_holdout_has_exact_size_and_ignores_partitioning(data, n):
    part = data.where(F.col("id") < n)
    test = rows(ml.holdout_split(part, ("id",)).where("split = 'test'"), "id")
    assert len(test) == math.ceil(.2 * n)
    assert test == rows(ml.holdout_split(part.repartition(5), ("id",)).where("split = 'test'"), "id")


def test_another_seed_moves_the_split(data):
    one, two = (rows(ml.holdout_split(data, ("id",), seed).where("split = 'test'"), "id") for seed in (1, 2))
    assert one != two


def test_empty_input_has_no_test_rows(data):
    assert ml.holdout_split(data.where("false"), ("id",)).count() == 0


def test_split_needs_no_shuffle(data):
    assert "Exchange" not in ml.holdout_split(data, ("id",))._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("algorithm", ["random_forest", "gradient_boosting"])
def test_models_learn_and_rank_features(data, algorithm):
    model = ml.build_model(algorithm, SPACE, trees=10, depth=5).fit(data)
    assert ml.score(model, data).agg(F.avg(F.abs(F.col("prediction") - F.col("quality_index")))).first()[0] < .2
    assert ml.feature_importance(model, data, SPACE).collect()[-1].feature == "f0"


def test_unknown_algorithm():
    with pytest.raises(ValueError):
        ml.build_model("other")


def test_counts(data):
    r = ml.training_counts(ml.holdout_split(data, ("id",)), SPACE).first()
    assert tuple(r) == (400, 3, 320, 80)


def test_boosting_rows_are_dealt_out_evenly(spark):
    """A table of one large and several small parts: every core gets about the same number of rows, none gets lost."""
    uneven = spark.range(0, 40_000, 1, 1).unionAll(spark.range(40_000, 41_000, 1, 4))
    parts = [n for n in ml.dealt(uneven, ("id",), 41_000).rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()]
    assert len(parts) == spark.sparkContext.defaultParallelism and sum(parts) == 41_000
    assert max(parts) < 1.1 * 41_000 / len(parts)
    assert ml.dealt(uneven, ("id",), 100).rdd.getNumPartitions() == 1
