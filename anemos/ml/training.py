"""Training set, hold-out, tree models, batch scoring, run comparison."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anemos.operators.features import impute, label_rows
from anemos.operators.ordered import Series
from anemos.params import MODEL_FEATURES
from anemos.schemas import require_columns

TARGET = "quality_index"
BUCKET_DIGITS = 5  # 16^5 = 1 048 576 digest buckets
#: Trees times rows that one fit holds. Deep trees have nodes in proportion to their rows, and a fit keeps all its trees in the driver.
FIT_ROWS = 8_000_000
#: Megabytes of split statistics that a task of a fit holds; more nodes than fit into them take another pass.
FIT_MB = 128
#: Rows that a task passes over in a pass of boosting, at most and (where the table is small) at least.
MOST_PASSED, LEAST_PASSED = 1_000_000, 10_000
#: Distance of the parts' seeds. Spark draws a partition's rows with seed + partition, so it is wider than any number of partitions.
SEED_STEP = 1_000_003


def training_set(features: DataFrame, series: Series, minimum_kn, columns=MODEL_FEATURES,
                 across: str | None = None) -> DataFrame:
    """Labelled rows with imputed model features and the target."""
    require_columns(features, columns, "training set")
    labelled = label_rows(features, minimum_kn)
    keep = [*series.keys, *series.order, *([across] if across else []), *columns, TARGET]
    return impute(labelled.select(*dict.fromkeys(keep)), series, columns, across)


def _digest(keys, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def holdout_edge(df: DataFrame, keys, seed: int, share: float) -> str | None:
    """Largest digest of the test part: the ceil(share * n)-th smallest of all rows.

    Found by counting digest buckets, then looking inside the one bucket that
    holds the edge; the data is neither sorted nor gathered.
    """
    digests = df.select(_digest(keys, seed).alias("d"))
    bucket = F.substring("d", 1, BUCKET_DIGITS)
    counts = digests.groupBy(bucket.alias("b")).agg(F.count("*").alias("n"))
    # At most 16^BUCKET_DIGITS rows reach the running sum.
    running = counts.withColumn("c", F.sum("n").over(Window.orderBy("b")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    if total == 0:
        return None
    want = math.ceil(share * total)
    found = running.where(F.col("c") >= want).orderBy("b").select("b", (F.lit(want) - F.col("c") + F.col("n")).alias("k")).first()
    inside = digests.where(bucket == found["b"])
    ranked = inside.withColumn("r", F.row_number().over(Window.partitionBy(bucket).orderBy("d")))
    return ranked.where(F.col("r") == found["k"]).first()["d"]


def holdout_split(df: DataFrame, keys, seed: int = 42, share: float = 0.2) -> DataFrame:
    """Add ``split``: exactly ceil(share * n) rows are test, the same on every engine."""
    edge = holdout_edge(df, keys, seed, share)
    test = F.lit(False) if edge is None else _digest(keys, seed) <= F.lit(edge)
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def training_counts(split: DataFrame, features=MODEL_FEATURES) -> DataFrame:
    return split.agg(
        F.count("*").alias("training_rows"), F.lit(len(features)).alias("training_features"),
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "test").alias("test_rows"))


def build_model(algorithm: str = "random_forest", columns=MODEL_FEATURES, seed: int = 42,
                trees: int = 200, depth: int = 30, rounds: int = 100, bootstrap: bool = True) -> Pipeline:
    """Seeded forest of ``trees`` trees as deep as Spark grows them, or ``rounds`` of gradient boosting; other names are refused."""
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features_vector")
    shared = dict(featuresCol="features_vector", labelCol=TARGET, predictionCol="prediction", seed=seed)
    if algorithm == "random_forest":
        tree = RandomForestRegressor(numTrees=trees, maxDepth=depth, featureSubsetStrategy="all", bootstrap=bootstrap,
                                     cacheNodeIds=True, maxMemoryInMB=FIT_MB, **shared)
    elif algorithm == "gradient_boosting":
        tree = GBTRegressor(maxIter=rounds, maxDepth=min(depth, 3), **shared)
    else:
        raise ValueError(f"unknown algorithm {algorithm}")
    return Pipeline(stages=[assembler, tree])


def forest_parts(rows: int, trees: int = 200, seed: int = 42, **parameters) -> list[Pipeline]:
    """A forest as fits of as many trees as go with this many rows; a small table has one."""
    share = max(1, min(trees, FIT_ROWS // max(rows, 1)))
    return [build_model(seed=seed + SEED_STEP * i, trees=min(share, trees - first), **parameters)
            for i, first in enumerate(range(0, trees, share))]


def dealt(rows: DataFrame, keys, count: int) -> DataFrame:
    """About ``count`` rows in equal parts, as many for every core.

    Boosting passes over its rows three times a round, and each pass waits for its largest part. Parts of a stored table are as its
    files are: uneven, and one more than there are cores takes twice the time.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = min(cores * max(1, math.ceil(count / (cores * MOST_PASSED))), max(1, count // LEAST_PASSED))
    return rows.repartition(parts, *keys)


def score(model, df: DataFrame) -> DataFrame:
    """Predictions of all spots in one pass."""
    return model.transform(df).drop("features_vector")


def feature_importance(model, df: DataFrame, columns=MODEL_FEATURES) -> DataFrame:
    """Importance per feature, ascending: one row per model input."""
    values = model.importances() if hasattr(model, "importances") else model.stages[-1].featureImportances.toArray()
    rows = [(c, float(v)) for c, v in zip(columns, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy("importance", "feature")


def compare_runs(long: DataFrame, metrics) -> DataFrame:
    """One row per run, one column per metric."""
    return long.groupBy("run_id").pivot("metric", list(metrics)).agg(F.max("value"))
