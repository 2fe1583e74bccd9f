"""A quality classifier: ordinal cumulative-link regression on graded ratings.

One score per text, linear in hashed text features, and ordered thresholds: the
probability of a grade of at least k is the logistic function of score minus
threshold k. It gives an expected grade and the tail probability that selects.

Features of a text are its words in lower case, the shapes of its words (letters, capitals,
digits, other signs; runs shortened) and whether a word repeats the one before; each
occurrence adds to its hashed feature, and the sum is divided by the root of the number
of words. Whole texts are read.

The fit uses at most ``RATED`` rated texts, those whose hashed ids are smallest, and of these no more, in
the same order, than hold ``ENTRIES`` distinct features together (the first is always used), so neither its cost nor the driver's memory
grows with the corpus or with the length of its texts. Defined results: a null or empty text has no feature,
so its score is 0; without ratings (or with one grade only) every text gets null
probabilities and is kept; ratings with a null are not used; repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anemos.llm.textarrays import _BYTE, Texts, chunks, mix, span_sums, word_hashes, words
from anemos.session import settle

#: Rated texts to fit on at most, and distinct features that they may hold in all; hashed features; rated texts that must hold a feature for it to get a weight; steps of
#: the fit; pull to zero, shared by all rated texts; tail to keep.
RATED, ENTRIES, FEATURES, COMMON, STEPS, PULL, KEEP = 6000, 8_000_000, 1 << 18, 20, 300, 0.06, 0.4
_SHAPE = np.array([3 if b >= 128 else 1 if 65 <= b <= 90 else 0 if 97 <= b <= 122 else 2 if 48 <= b <= 57 else b
                   for b in range(256)], dtype=np.uint8)


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Three hashed features per word in order, and each text's bounds in them."""
    spans = words(texts)
    hashes = word_hashes(texts, spans)
    shape = _SHAPE[texts.data]
    # A letter like the one before adds nothing, so the shape of a word doesn't depend on its length.
    fresh = np.ones(len(shape), dtype=bool)
    fresh[1:] = shape[1:] != shape[:-1]
    fresh[spans.starts] = True
    kept = np.concatenate(([0], np.cumsum(fresh)))
    shapes = mix(span_sums(_BYTE[shape[fresh]], kept[spans.starts], kept[spans.ends]) + np.uint64(1))
    same = np.zeros(len(hashes), dtype=np.uint64)
    same[1:] = hashes[1:] == hashes[:-1]
    same[spans.bounds[:-1][spans.bounds[:-1] < len(hashes)]] = 0
    flat = np.stack([hashes, shapes, mix(same + np.uint64(2))], axis=1).reshape(-1)
    return (flat >> np.uint64(46)).astype(np.int32), spans.bounds * 3


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, texts: Texts) -> np.ndarray:
        found, bounds = features(texts)
        n = np.diff(bounds)
        out = np.zeros(len(n))
        full = np.flatnonzero(n)
        if len(full):
            out[full] = np.add.reduceat(self.weights[found], bounds[:-1][full]) / np.sqrt(n[full] / 3)
        return out

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        return _logistic(scores[:, None] - self.thresholds[None])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(at: np.ndarray, value: np.ndarray, bounds: np.ndarray, grades: np.ndarray) -> Model:
    """Fit by Adam on all rows at once. Row ``i`` has features ``at[bounds[i]:bounds[i + 1]]``; grades count from 0."""
    levels = int(grades.max())
    # The first threshold is free, the others lie above it by positive steps.
    tail = np.clip([(grades >= k).mean() for k in range(1, levels + 1)], 0.01, 0.99)
    first = -np.log(tail / (1 - tail))
    free = np.concatenate((first[:1], np.log(np.maximum(np.diff(first), 0.05)), np.zeros(FEATURES)))
    state = [np.zeros_like(free), np.zeros_like(free)]
    row = np.repeat(np.arange(len(grades)), np.diff(bounds))
    for step in range(1, STEPS + 1):
        steps = np.exp(free[1:levels])
        thresholds = free[0] + np.concatenate(([0.0], np.cumsum(steps)))
        weights = free[levels:]
        score = np.bincount(row, weights[at] * value, minlength=len(grades))
        p = np.concatenate((np.ones((len(grades), 1)), _logistic(score[:, None] - thresholds),
                            np.zeros((len(grades), 1))), axis=1)
        i = np.arange(len(grades))
        slope = p * (1 - p)
        share = np.maximum(p[i, grades] - p[i, grades + 1], 1e-12)
        # Of the mean negative log-likelihood, by score and by threshold.
        by_score = -(slope[i, grades] - slope[i, grades + 1]) / share / len(grades)
        by_threshold = np.zeros(levels + 2)
        np.add.at(by_threshold, grades, slope[i, grades] / share / len(grades))
        np.add.at(by_threshold, grades + 1, -slope[i, grades + 1] / share / len(grades))
        by_threshold = by_threshold[1:-1]
        above = np.cumsum(by_threshold[::-1])[::-1]
        slope_of = np.concatenate((above[:1], above[1:] * steps,
                                   np.bincount(at, value * by_score[row], minlength=FEATURES) + PULL / len(grades) * weights))
        for k, (s, power) in enumerate(((0.9, 1), (0.99, 2))):
            state[k] = s * state[k] + (1 - s) * slope_of ** power
        free = free - 0.1 * (state[0] / (1 - 0.9 ** step)) / (np.sqrt(state[1] / (1 - 0.99 ** step)) + 1e-8)
    return Model(free[levels:], free[0] + np.concatenate(([0.0], np.cumsum(np.exp(free[1:levels])))))


def rated_features(texts: DataFrame) -> DataFrame:
    """Summed features of each text: place, grade, at (array<int>), value (array<float>). ``texts``: place, grade, text."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in chunks(batch.column(2)):
                found, bounds = features(own)
                at, value = [], []
                for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                    places, counts = np.unique(found[low:high], return_counts=True)
                    at.append(places)
                    value.append(counts / np.sqrt(max(1, (high - low) / 3)))
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(k).slice(own.first, len(own)) for k in (0, 1)), pa.array(at, pa.list_(pa.int32())),
                    pa.array(value, pa.list_(pa.float32()))], names=["place", "grade", "at", "value"])

    return texts.select("place", F.col("grade").cast("int").alias("grade"), "text").mapInArrow(
        sums, "place long, grade int, at array<int>, value array<float>")


def bounded(rows: DataFrame, entries: int) -> DataFrame:
    """The rows of ``rated_features`` that are used: by place, while they hold at most ``entries`` features together."""
    # One number a row, and at most ``rated`` rows.
    sizes = rows.select("place", F.size("at").alias("n")).orderBy("place", "n").toPandas()
    fits = int((sizes["n"].cumsum() <= entries).sum())
    return rows if fits == len(sizes) else rows.where(F.col("place") <= int(sizes["place"].iloc[max(0, fits - 1)]))


def fit(docs: DataFrame, ratings: DataFrame, rated: int = RATED, entries: int = ENTRIES) -> Model | None:
    """Fit on at most ``rated`` rated documents with ``entries`` features. ``docs``: doc_id, text; ``ratings``: doc_id, grade (from 0)."""
    usable = ratings.select("doc_id", "grade").where("doc_id IS NOT NULL AND grade IS NOT NULL")
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(rated)
    # At most ``rated`` rows are sent, and as many texts come back: of documents that share an id, the smallest text.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen.distinct()), "doc_id").groupBy(
        "doc_id", "grade").agg(F.min("text").alias("text")).withColumn("place", F.xxhash64("doc_id"))
    rows = bounded(settle(rated_features(texts), "rated"), entries).toArrow().combine_chunks()
    grades = rows.column("grade").to_numpy()
    if len(np.unique(grades)) < 2:
        return None
    lists = [rows.column(c).combine_chunks() for c in ("at", "value")]
    lists = [x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in lists]
    bounds = lists[0].offsets.to_numpy().astype(np.int64)
    at, value = (x.flatten().to_numpy(zero_copy_only=False) for x in lists)
    # What only a few texts hold would be learned by heart.
    kept = np.bincount(at, minlength=FEATURES)[at] >= min(COMMON, len(grades) // 10)
    bounds = np.concatenate(([0], np.cumsum(kept)))[bounds - bounds[0]]
    return fit_ordinal(at[kept], value[kept], bounds, grades)


def rate_with(spark: SparkSession, model: Model | None, keep: float = KEEP) -> Callable[[Column | str], Column]:
    """A column function: text to struct(expected_grade, tail_probability of the highest grade, selected)."""
    if model is None:
        return lambda _: F.struct(F.lit(None).cast("double").alias("expected_grade"),
                                  F.lit(None).cast("double").alias("tail_probability"), F.lit(True).alias("selected"))
    shared = spark.sparkContext.broadcast(model)  # one weight per hashed feature

    @F.arrow_udf("struct<expected_grade:double,tail_probability:double,selected:boolean>")
    def rate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for column in batches:
            parts = [own.scores(texts) for texts in chunks(column)]
            tails = own.tails(np.concatenate(parts) if parts else np.zeros(0))
            yield pa.StructArray.from_arrays(
                [pa.array(tails.sum(axis=1)), pa.array(tails[:, -1].copy()), pa.array(tails[:, -1] >= keep)],
                names=["expected_grade", "tail_probability", "selected"])

    return rate


def grades(labels: DataFrame) -> DataFrame:
    """Graded ratings from labels: 0 poor, 1 good but toxic, 2 good; null labels give null."""
    return labels.select("doc_id", (F.col("quality") * (2 - F.col("toxic"))).cast("int").alias("grade"))
