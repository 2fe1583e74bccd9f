"""Random forests of tables that are too large for Spark ML's fit.

Spark ML adds up the statistics of every node of every tree across the cluster, and deep trees have nodes in proportion to their rows. Here
the table is binned and packed once (a byte a value), goes to as many tasks as there are cores, and each grows its share of the trees on arrays.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anemos.ml import growing
from anemos.session import settle

# Workers get this code with the task: Spark ML's fits, too, need no package there.
for _module in (growing, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)

#: Rows of a packed block.
BLOCK = 1 << 16
#: Rows that limits of bins are taken from, as in Spark ML.
SAMPLED = 10_000
TREES = "tree int, column binary, last binary, value binary, importance array<double>"


def _binned(batch: pa.RecordBatch, columns, limits) -> np.ndarray:
    out = np.empty((len(columns), batch.num_rows), np.uint8)
    for f, (name, edges) in enumerate(zip(columns, limits)):
        values = batch.column(name).to_numpy(zero_copy_only=False).astype(float)  # a null becomes NaN
        if np.isnan(values).any():
            raise ValueError(f"{name} has missing values")
        out[f] = np.searchsorted(edges, values)
    return out


def _grades(batch: pa.RecordBatch, name: str) -> np.ndarray:
    values = batch.column(name).to_numpy(zero_copy_only=False).astype(float)
    if not ((values >= 0) & (values <= growing.MOST_GRADE) & (values == np.floor(values))).all():
        raise ValueError(f"{name} is not a whole number from 0 to {growing.MOST_GRADE} in every row")
    return values.astype(np.uint8)


def pack(rows: DataFrame, columns, limits, extra: str, kind: str) -> DataFrame:
    """Rows as numbered blocks: the bin of every value column by column, and beside it ``extra``: grades or row numbers."""
    columns, limits = list(columns), [np.asarray(x) for x in limits]

    def blocks(held: list, number: int):
        bins, others = np.concatenate([x[0] for x in held], axis=1), np.concatenate([x[1] for x in held])
        return pa.RecordBatch.from_pydict({
            "block": pa.array([number], pa.int64()), "bins": pa.array([bins.tobytes()], pa.binary()), kind: pa.array([others.tobytes()], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                others = _grades(part, extra) if kind == "grades" else part.column(extra).to_numpy(zero_copy_only=False).astype(np.int64)
                if size + part.num_rows > BLOCK:
                    yield blocks(held, number)
                    held, size, number = [], 0, number + 1
                held.append((_binned(part, columns, limits), others))
                size += part.num_rows
        if held:
            yield blocks(held, number)

    return rows.select(*columns, extra).mapInArrow(run, f"block long, bins binary, {kind} binary")


def _array(cell, kind) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), kind)


def _tasks(spark: SparkSession, trees: int) -> int:
    return min(trees, 2 * spark.sparkContext.defaultParallelism)


def limits_of(rows: DataFrame, columns, count: int, seed: int) -> list[np.ndarray]:
    share = SAMPLED / max(count, 1)
    sample = rows.select(*[F.col(c).cast("double") for c in columns])
    found = (sample if share >= 1 else sample.sample(share, seed)).toPandas()
    return [growing.thresholds(found[c].dropna().to_numpy(), count) for c in columns]


def grown(packed: DataFrame, columns: int, seed: int, trees: int, depth: int, bootstrap: bool) -> DataFrame:
    """One row per tree. A task has all blocks and the trees of its number; a tree draws its rows from its own number and the block's."""
    tasks = _tasks(packed.sparkSession, trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(n, _array(x, np.uint8).reshape(columns, -1), _array(y, np.uint8))
                for batch in batches for n, x, y in zip(batch.column("block").to_pylist(), batch.column("bins"), batch.column("grades"))]
        if not held:
            return
        sizes = [(n, len(y)) for n, _, y in held]
        bins, grades = np.concatenate([x for _, x, _ in held], axis=1), np.concatenate([y for _, _, y in held])
        del held
        for number in range(TaskContext.get().partitionId(), trees, tasks):
            weights = np.concatenate([np.random.default_rng([seed, number, n]).poisson(1.0, size).astype(np.uint8) if bootstrap
                                      else np.ones(size, np.uint8) for n, size in sizes])
            tree = growing.grow(bins, grades, weights, depth)
            yield pa.RecordBatch.from_pydict({
                "tree": pa.array([number], pa.int32()), "column": pa.array([tree.column.tobytes()], pa.binary()),
                "last": pa.array([tree.last.tobytes()], pa.binary()), "value": pa.array([tree.value.tobytes()], pa.binary()),
                "importance": pa.array([tree.importance], pa.list_(pa.float64()))})

    dealt = packed.withColumn("bundle", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    return dealt.repartitionById(tasks, "bundle").drop("bundle").mapInArrow(run, TREES)


def write(rows: DataFrame, pipeline: Pipeline, count: int, path: str) -> None:
    """Grow the forest that a pipeline of assembler and forest describes, and store it; what names the limits of its bins comes last."""
    assembler, forest = pipeline.getStages()
    columns, seed = assembler.getInputCols(), forest.getSeed()
    limits = limits_of(rows, columns, count, seed)
    packed = settle(pack(rows, columns, limits, forest.getLabelCol(), "grades"), "packed")
    grown(packed, len(columns), seed, forest.getNumTrees(), forest.getMaxDepth(), forest.getBootstrap()).write.parquet(f"{path}/trees")
    about = json.dumps({"columns": columns, "limits": [list(x) for x in limits], "trees": forest.getNumTrees()})
    rows.sparkSession.createDataFrame([(about,)], "value string").coalesce(1).write.text(f"{path}/metadata")


@dataclass(frozen=True)
class GrownForest:
    """A stored forest: its prediction is the mean over its trees."""

    spark: SparkSession
    path: str

    @property
    def trees(self) -> DataFrame:
        return self.spark.read.schema(TREES).parquet(f"{self.path}/trees")

    def transform(self, df: DataFrame) -> DataFrame:
        """Rows with their ``prediction``; they are stored once, and their blocks meet every tree: a task holds its share of the trees."""
        about = json.loads(self.spark.read.text(f"{self.path}/metadata").first()[0])
        columns, trees = about["columns"], about["trees"]
        tasks = _tasks(self.spark, trees)

        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = []
            for batch in batches:
                for cells in batch.to_struct_array():
                    if not cells["turn"].as_py():
                        held.append(growing.Tree(*(_array(cells[c], kind) for c, kind in (("column", np.int8), ("last", np.uint8), ("value", float))), None))
                        continue
                    bins = _array(cells["bins"], np.uint8).reshape(len(columns), -1)
                    sums = np.zeros(bins.shape[1])
                    for tree in held:
                        sums += tree.predict(bins)
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array([cells["block"].as_py()], pa.int64()), "bundle": pa.array([cells["bundle"].as_py()], pa.int32()),
                        "rows": pa.array([cells["rows"].as_py()], pa.binary()), "sums": pa.array([sums.tobytes()], pa.binary())})

        def mean(table: pa.Table) -> pa.Table:
            table = table.sort_by("bundle")
            total = sum(_array(x, float) for x in table.column("sums"))
            return pa.table({"_row": _array(table.column("rows")[0], np.int64), "prediction": total / trees})

        rows = settle(df.withColumn("_row", F.monotonically_increasing_id()), "unscored")
        blocks = settle(pack(rows, columns, about["limits"], "_row", "rows"), "packed").withColumn(
            "bundle", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
        asked = blocks.withColumns({"turn": F.lit(1), "rows": F.when(F.col("bundle") == 0, F.col("rows"))})
        held = self.trees.drop("importance").withColumns({"turn": F.lit(0), "bundle": F.col("tree") % tasks})
        both = held.unionByName(asked, allowMissingColumns=True).repartitionById(tasks, "bundle").sortWithinPartitions("turn", "tree", "block")
        sums = settle(both.mapInArrow(walk, "block long, bundle int, rows binary, sums binary"), "walked")
        return rows.join(sums.groupBy("block").applyInArrow(mean, "_row long, prediction double"), "_row").drop("_row")

    def importances(self) -> list[float]:
        """Importance per input: the mean over the trees that split, as Spark ML has it."""
        found = np.array([r["importance"] for r in self.trees.select("tree", "importance").orderBy("tree").collect()])
        total = found.sum(axis=0)
        return [float(v) for v in total / (total.sum() or 1.0)]
