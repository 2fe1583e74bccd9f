"""Fitted models as stored artifacts, named by what they were fitted on.

A key is a digest of the training rows and of every parameter of the pipeline, so the same rows and parameters
find the model that is there, and a changed row or parameter finds none. Models are written by Spark ML's
own writer into a new folder; only then a line in the index names them. A job that dies while writing leaves
a folder that nothing names, and two jobs that fit the same model leave two lines of equal worth. Aliases ("the model in
use") are lines of a log, of which the last one counts.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from anemos.ml import forest, growing
from anemos.session import fresh_path, settle, shared_dir
from anemos.sources.writers import stored_table, table_fingerprint

INDEX = "key string, path string, created string, rows long, algorithm string, parameters string"
ALIASES = "alias string, key string, created string"


def default_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/models"


def parameters(pipeline: Pipeline) -> dict[str, str]:
    """Every parameter of every stage but the stages' random names."""
    return {f"{i}.{type(stage).__name__}.{param.name}": str(value)
            for i, stage in enumerate(pipeline.getStages()) for param, value in stage.extractParamMap().items()}


def model_key(rows: DataFrame, pipeline: Pipeline) -> tuple[str, int]:
    """Key and number of training rows; the rows' order and partitions don't matter."""
    found = table_fingerprint(rows, rows.columns).first()
    return _key(rows, found["digest"], pipeline), found["rows"]


def _key(rows: DataFrame, digest: str, pipeline: Pipeline, *how: str) -> str:
    text = json.dumps([rows.columns, digest, parameters(pipeline), rows.sparkSession.version, *how], sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()


def _log(spark: SparkSession, path: str, schema: str, /, **line) -> None:
    spark.createDataFrame([tuple(line.values())], schema).coalesce(1).write.mode("append").json(path)


def index(spark: SparkSession, root: str) -> DataFrame:
    """All models of a store, the latest last."""
    path = f"{root}/index"
    known = stored_table(spark, path, "json", INDEX)
    return spark.createDataFrame([], INDEX) if known is None else known.orderBy("created", "path")


def load(spark: SparkSession, root: str, key: str) -> PipelineModel | None:
    """The stored model of a key; None where there is none, or where its folder has gone."""
    path = _path(spark, root, key)
    return None if path is None else PipelineModel.load(path)


def _path(spark: SparkSession, root: str, key: str) -> str | None:
    for line in reversed(index(spark, root).where(F.col("key") == key).collect()):
        if stored_table(spark, f"{line['path']}/metadata", "text") is not None:
            return line["path"]
    return None


def save(spark: SparkSession, root: str, key: str, model: PipelineModel, rows: int, pipeline: Pipeline) -> None:
    path = _new_path(root, key)
    model.write().save(path)
    _named(spark, root, key, path, rows, pipeline)


def _new_path(root: str, key: str) -> str:
    return f"{root}/{key[:16]}-{uuid.uuid4().hex}"


def _named(spark: SparkSession, root: str, key: str, path: str, rows: int, pipeline: Pipeline) -> None:
    _log(spark, f"{root}/index", INDEX, key=key, path=path, created=datetime.now(UTC).isoformat(), rows=rows,
         algorithm=type(pipeline.getStages()[-1]).__name__, parameters=json.dumps(parameters(pipeline), sort_keys=True))


def fit_once(rows: DataFrame, pipeline: Pipeline, root: str | None = None,
             fit: Callable[[DataFrame], PipelineModel] | None = None) -> tuple[PipelineModel, str]:
    """The model of these rows and parameters and its key: loaded if stored, else fitted, stored and loaded.

    ``rows`` is read more than once and should be a stored table.
    """
    spark = rows.sparkSession
    root = root or default_root(spark)
    key, count = model_key(rows, pipeline)
    model = load(spark, root, key)
    if model is None:
        save(spark, root, key, (fit or pipeline.fit)(rows), count, pipeline)
        model = load(spark, root, key)
    return model, key


@dataclass(frozen=True)
class PartedForest:
    """A forest stored in parts, each a forest of some of its trees: its prediction is the mean over all trees.

    One part at a time is in memory. Trees grow with their rows, so a whole forest may not fit into the driver.
    """

    spark: SparkSession
    paths: tuple[str, ...]

    def _parts(self) -> Iterator[PipelineModel]:
        for path in self.paths:
            yield PipelineModel.load(path)

    def transform(self, df: DataFrame) -> DataFrame:
        """Rows with their ``prediction``; they are stored once, and each part adds one number per row."""
        if len(self.paths) == 1:
            return PipelineModel.load(self.paths[0]).transform(df)
        rows = settle(df.withColumn("_row", F.monotonically_increasing_id()), "unscored")
        out = fresh_path(self.spark, "parts")
        for i, part in enumerate(self._parts()):
            trees = part.stages[-1].getNumTrees
            part.transform(rows).select("_row", F.lit(i).alias("_part"), F.lit(trees).alias("_trees"), "prediction").write.mode(
                "append").parquet(out)
        # Added in the order of the parts, so that a sum does not depend on the order of files.
        listed = F.array_sort(F.collect_list(F.struct("_part", (F.col("prediction") * F.col("_trees")).alias("_sum"))))
        mean = F.aggregate(listed, F.lit(0.0), lambda a, x: a + x["_sum"]) / F.sum("_trees")
        sums = self.spark.read.parquet(out).groupBy("_row").agg(mean.alias("prediction"))
        return rows.join(sums, "_row").drop("_row")

    def importances(self) -> list[float]:
        """Importance per input: the mean over the trees that split, as Spark ML has it for one forest."""
        total: list[float] = []
        for part in self._parts():
            forest = part.stages[-1]
            split = sum(tree.numNodes > 1 for tree in forest.trees)
            values = [float(v) * split for v in forest.featureImportances.toArray()]
            total = [a + b for a, b in zip(total, values)] if total else values
        whole = sum(total)
        return [v / whole for v in total] if whole else total


def fit_parts(rows: DataFrame, plan: Callable[[int], Sequence[Pipeline]], root: str | None = None) -> PartedForest:
    """The forest whose parts ``plan`` gives for the number of rows; parts that are stored are not fitted again.

    ``rows`` is read more than once and should be a stored table.
    """
    found = table_fingerprint(rows, rows.columns).first()
    return _fit_parts(rows, found, plan(found["rows"]), root or default_root(rows.sparkSession))


def _fit_parts(rows: DataFrame, found: Row, pipelines: Sequence[Pipeline], root: str) -> PartedForest:
    spark, paths = rows.sparkSession, []
    for pipeline in pipelines:
        key = _key(rows, found["digest"], pipeline)
        if _path(spark, root, key) is None:
            save(spark, root, key, pipeline.fit(rows), found["rows"], pipeline)
        paths.append(_path(spark, root, key))
    return PartedForest(spark, tuple(paths))


def fit_forest(rows: DataFrame, plan: Callable[[int], Sequence[Pipeline]], whole: Pipeline, root: str | None = None) -> PartedForest | forest.GrownForest:
    """The forest of these rows: Spark ML's fit where ``plan`` has one part, else ``whole`` grown from packed rows; loaded if stored.

    ``rows`` is read more than once and should be a stored table.
    """
    spark = rows.sparkSession
    root = root or default_root(spark)
    found = table_fingerprint(rows, rows.columns).first()
    parts = plan(found["rows"])
    if len(parts) == 1 or found["rows"] > growing.MOST_ROWS:
        return _fit_parts(rows, found, parts, root)
    key = _key(rows, found["digest"], whole, "grown")
    if _path(spark, root, key) is None:
        path = _new_path(root, key)
        forest.write(rows, whole, found["rows"], path)
        _named(spark, root, key, path, found["rows"], whole)
    return forest.GrownForest(spark, _path(spark, root, key))


def set_alias(spark: SparkSession, root: str, alias: str, key: str) -> None:
    """Let an alias name a stored model from now on."""
    if index(spark, root).where(F.col("key") == key).isEmpty():
        raise KeyError(f"no model is stored under {key}")
    _log(spark, f"{root}/aliases", ALIASES, alias=alias, key=key, created=datetime.now(UTC).isoformat())


def key_of_alias(spark: SparkSession, root: str, alias: str) -> str:
    named = stored_table(spark, f"{root}/aliases", "json", ALIASES)
    found = None if named is None else named.where(F.col("alias") == alias).agg(F.max_by("key", "created")).first()[0]
    if found is None:
        raise KeyError(f"no model is named {alias}")
    return found


def load_alias(spark: SparkSession, root: str, alias: str) -> PipelineModel:
    """The model that an alias names; an alias whose model has gone is an error."""
    model = load(spark, root, key_of_alias(spark, root, alias))
    if model is None:
        raise FileNotFoundError(f"the model named {alias} is not there any more")
    return model
