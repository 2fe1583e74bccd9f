"""Queries for training, scoring and run comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from anemos.ml import store
from anemos.ml import training as ml
from anemos.operators import features as fx
from anemos.operators import hindcast as h
from anemos.params import MODEL_FEATURES
from anemos.plans.bindings import Tables, with_sql
from anemos.plans.feature_queries import _BF, _FF
from anemos.plans.registry import query, r6, rounded
from anemos.session import settle


def training_rows(t: Tables):
    return ml.training_set(t.features, t.spot_series, F.lit(12.0))


_FILL = ", ".join(f"coalesce({_FF.format(c=c)},{_BF.format(c=c)},0e0) AS {c}" for c in MODEL_FEATURES)
_TRAIN_SQL = f", ts AS (SELECT spot_id, event_id, {_FILL}, quality_index FROM labelled) "
_SPLIT_SQL = """, dg AS (SELECT spot_id, event_id, md5('42|' || spot_id || '|' || event_id) AS d FROM labelled), rk AS (SELECT *, row_number() OVER (ORDER BY d) AS r,
    count(*) OVER () AS n FROM dg), sp AS (SELECT spot_id, event_id, CASE WHEN r <= ceil(0.2e0*n) THEN 'test' ELSE 'train' END AS split FROM rk) """


@query("training_set", with_sql("features labelled", _TRAIN_SQL + "SELECT spot_id, event_id, quality_index, "
       + ", ".join(f"round({c},6)+0e0 AS {c}" for c in MODEL_FEATURES) + " FROM ts"))
def training_set(t: Tables):
    return rounded(training_rows(t), *MODEL_FEATURES).drop("time")


@query("holdout_split", with_sql("features labelled", _SPLIT_SQL + "SELECT spot_id, event_id, split FROM sp"))
def holdout_split(t: Tables):
    rows = settle(fx.label_rows(t.features, F.lit(12.0)).select("spot_id", "event_id"), "labelled")
    return ml.holdout_split(rows, ("spot_id", "event_id"))


@query("training_counts", with_sql("features labelled", _SPLIT_SQL + """SELECT count(*) AS training_rows, 14 AS training_features,
    CAST(sum(CASE WHEN split='train' THEN 1 ELSE 0 END) AS BIGINT) AS train_rows, CAST(sum(CASE WHEN split='test' THEN 1 ELSE 0 END) AS BIGINT) AS test_rows FROM sp"""))
def training_counts(t: Tables):
    rows = settle(fx.label_rows(t.features, F.lit(12.0)).select("spot_id", "event_id"), "labelled")
    return ml.training_counts(ml.holdout_split(rows, ("spot_id", "event_id")))


def fitted(t: Tables, algorithm: str = "random_forest"):
    """Settled, split training set and the model of its training part: fitted once, then loaded from the model store."""
    rows = settle(training_rows(t), "training")
    keys = ("spot_id", "event_id")
    split = ml.holdout_split(rows, keys)
    train = split.where("split = 'train'").drop("split")
    if algorithm == "random_forest":
        return split, store.fit_forest(train, ml.forest_parts, ml.build_model(algorithm))
    pipeline = ml.build_model(algorithm)
    model, _ = store.fit_once(train, pipeline, fit=lambda found: pipeline.fit(ml.dealt(found, keys, rows.count())))
    return split, model


@query("train_forest")
def train_forest(t: Tables):
    split, model = fitted(t)
    return ml.score(model, split.where("split = 'test'")).select("spot_id", "event_id", "quality_index", r6("prediction").alias("prediction"))


@query("train_boosting")
def train_boosting(t: Tables):
    """The same training with boosting as its algorithm."""
    split, model = fitted(t, "gradient_boosting")
    return ml.score(model, split.where("split = 'test'")).select("spot_id", "event_id", "quality_index", r6("prediction").alias("prediction"))


@query("train_boosting_rows", with_sql("features labelled", _SPLIT_SQL + """SELECT spot_id, event_id, quality_index, true AS near
    FROM labelled JOIN sp USING (spot_id, event_id) WHERE split = 'test'"""))
def train_boosting_rows(t: Tables):
    """What SQL can say of boosting: the rows of the test part and their grades, and that no prediction is far off the scale."""
    return train_boosting(t).select("spot_id", "event_id", "quality_index", F.col("prediction").between(-1, 6).alias("near"))


@query("train_one_tree", with_sql("features labelled", """SELECT algorithm, spot_id, event_id, round(avg(quality_index) OVER (PARTITION BY algorithm, wind_speed_10m >= 40e0), 6)+0e0 AS prediction
    FROM labelled, (SELECT unnest(['gradient_boosting', 'random_forest']) AS algorithm)"""))
def train_one_tree(t: Tables):
    """Models of a single split over a column of two values, whose predictions are the means of both parts."""
    rows = settle(fx.label_rows(t.features, F.lit(12.0)).select(
        "spot_id", "event_id", (F.col("wind_speed_10m") >= 40.0).cast("double").alias("strong"), ml.TARGET), "training")
    out = None
    for algorithm in ("gradient_boosting", "random_forest"):
        model, _ = store.fit_once(rows, ml.build_model(algorithm, ("strong",), trees=1, depth=1, rounds=1, bootstrap=False))
        part = ml.score(model, rows).select(F.lit(algorithm).alias("algorithm"), "spot_id", "event_id", r6("prediction").alias("prediction"))
        out = part if out is None else out.unionByName(part)
    return out


# A model of one split has predictions that SQL can state: the means of the training rows on both sides.
_SPLIT_COLUMNS = ("strong", "constant")


def one_split(rows):
    """Rows with a column of two values and one of a single value, and the forest of one tree with one split over them."""
    marked = rows.select(*[c for c in rows.columns if c not in MODEL_FEATURES],
                         (F.col("wind_speed_10m") >= 40.0).cast("double").alias("strong"), F.lit(1.0).alias("constant"))
    return marked, ml.build_model(columns=_SPLIT_COLUMNS, trees=1, depth=1, bootstrap=False)


def fitted_once_split(t: Tables):
    rows = settle(training_rows(t), "training")
    marked, pipeline = one_split(ml.holdout_split(rows, ("spot_id", "event_id")))
    model, _ = store.fit_once(settle(marked.where("split = 'train'").drop("split"), "marked"), pipeline)
    return marked, model


_MEANS = _TRAIN_SQL + _SPLIT_SQL.lstrip() + """, marked AS (SELECT ts.*, split, wind_speed_10m >= 40e0 AS strong FROM ts JOIN sp USING (spot_id, event_id)),
    means AS (SELECT strong, avg(quality_index) AS prediction FROM marked WHERE split = 'train' GROUP BY 1) """


@query("score_one_split", with_sql("features labelled ahead", _MEANS + """SELECT spot_id, event_id, time, round(prediction, 6)+0e0 AS quality_index
    FROM ahead_ready a JOIN means ON means.strong = (a.wind_speed_10m >= 40e0)"""))
def score_one_split(t: Tables):
    """Batch scoring of the hours ahead by the one-split model, so that its values can be checked."""
    _, model = fitted_once_split(t)
    ready, _ = one_split(t.ahead.select("spot_id", "time", "event_id", *MODEL_FEATURES))
    return ml.score(model, ready).select("spot_id", "event_id", "time", r6("prediction").alias("quality_index"))


@query("evaluate_one_split", with_sql("features labelled", _MEANS + """, tested AS (SELECT quality_index AS a, prediction AS p FROM marked JOIN means USING (strong) WHERE split = 'test'),
    c AS (SELECT a, CASE WHEN least(greatest(round_even(p,0),0),5) = a THEN 1e0 ELSE 0e0 END AS hit FROM tested),
    m AS (SELECT 'mae' AS metric, avg(abs(p-a)) AS value FROM tested UNION ALL SELECT 'rmse', sqrt(avg(pow(p-a,2))) FROM tested
      UNION ALL SELECT 'r2', 1-avg(pow(p-a,2))/var_pop(a) FROM tested UNION ALL SELECT 'class_accuracy_' || a, avg(hit) FROM c GROUP BY a
      UNION ALL SELECT 'overall_class_accuracy', avg(hit) FROM c UNION ALL SELECT 'importance_strong', 1e0 UNION ALL SELECT 'importance_constant', 0e0)
    SELECT metric, round(value, 6)+0e0 AS value FROM m"""))
def evaluate_one_split(t: Tables):
    """Metrics on the test part and importances of the one-split model."""
    marked, model = fitted_once_split(t)
    tested = settle(ml.score(model, marked.where("split = 'test'")).select("quality_index", "prediction"), "tested")
    importance = ml.feature_importance(model, marked, _SPLIT_COLUMNS)
    return rounded(h.regression_metrics(tested, "quality_index", "prediction").unpivot([], ["mae", "rmse", "r2"], "metric", "value").unionByName(
        h.class_accuracy(tested, "quality_index", "prediction").select("metric", "value")).unionByName(
        importance.select(F.concat(F.lit("importance_"), "feature").alias("metric"), F.col("importance").alias("value"))), "value")


@query("feature_importance")
def feature_importance(t: Tables):
    split, model = fitted(t)
    return ml.feature_importance(model, split)


@query("score_batch")
def score_batch(t: Tables):
    """Limit to the horizon, engineer, impute per spot, predict."""
    _, model = fitted(t)
    ready = t.ahead.select("spot_id", "time", "event_id", *MODEL_FEATURES)
    return ml.score(model, ready).select("spot_id", "event_id", "time", r6("prediction").alias("quality_index"))


@query("score_batch_rows", with_sql("ahead", "SELECT spot_id, event_id, time, true AS in_range FROM ahead_ready"))
def score_batch_rows(t: Tables):
    """What SQL can say of the scores: their rows, and that a forest stays within the grades it has seen."""
    return score_batch(t).select("spot_id", "event_id", "time", F.col("quality_index").between(0, 5).alias("in_range"))


@query("train_evaluate_counts", with_sql("features labelled", _SPLIT_SQL + """, c AS (SELECT count(*) AS n, CAST(sum(CASE WHEN split='train' THEN 1 ELSE 0 END) AS BIGINT) AS tr,
    CAST(sum(CASE WHEN split='test' THEN 1 ELSE 0 END) AS BIGINT) AS te FROM sp), cls AS (SELECT DISTINCT quality_index AS k FROM labelled JOIN sp USING (spot_id, event_id) WHERE split='test')
    SELECT 'training_rows' AS metric, CAST(n AS DOUBLE) AS exact, true AS in_bounds FROM c UNION ALL SELECT 'training_features', 14e0, true UNION ALL SELECT 'train_rows', tr, true FROM c
    UNION ALL SELECT 'test_rows', te, true FROM c UNION ALL SELECT 'class_accuracy_' || k, NULL, true FROM cls
    UNION ALL SELECT unnest(['overall_class_accuracy','mae','rmse','r2']), NULL, true"""))
def train_evaluate_counts(t: Tables):
    """What SQL can say of an evaluation: its metrics by name, exact counts, and bounds on the rest."""
    counts = ("training_rows", "training_features", "train_rows", "test_rows")
    value, name = F.col("value"), F.col("metric")
    bounds = F.when(name == "mae", value < 0.5).when(name == "rmse", value < 1).when(name == "r2", value.between(0.5, 1)).when(
        name == "overall_class_accuracy", value.between(0.7, 1)).when(name.isin(*counts), True).otherwise(value.between(0, 1))
    return train_evaluate(t).select("metric", F.when(name.isin(*counts), value).alias("exact"), bounds.alias("in_bounds"))


@query("train_evaluate")
def train_evaluate(t: Tables):
    """Train on the split, score the test part, and report metrics and counts in long form."""
    split, model = fitted(t)
    tested = settle(ml.score(model, split.where("split = 'test'")).select("quality_index", "prediction"), "tested")
    regression = h.regression_metrics(tested, "quality_index", "prediction").unpivot([], ["mae", "rmse", "r2"], "metric", "value")
    classes = h.class_accuracy(tested, "quality_index", "prediction").select("metric", "value")
    counts = ml.training_counts(split).select(
        *[F.col(c).cast("double").alias(c) for c in ("training_rows", "training_features", "train_rows", "test_rows")])
    return regression.unionByName(classes).unionByName(
        counts.unpivot([], counts.columns, "metric", "value")).withColumn("value", F.round("value", 6))


@query("compare_runs", """SELECT CAST(l_orderkey AS VARCHAR) AS run_id, max(l_discount) AS mae, max(l_tax) AS rmse, max(l_quantity) AS r2 FROM lineitem GROUP BY 1""")
def compare_runs(t: Tables):
    wide = t.table("lineitem").select(F.col("l_orderkey").cast("string").alias("run_id"), F.col("l_discount").alias("mae"),
                                      F.col("l_tax").alias("rmse"), F.col("l_quantity").alias("r2"))
    return ml.compare_runs(wide.unpivot(["run_id"], ["mae", "rmse", "r2"], "metric", "value"), ("mae", "rmse", "r2"))
