"""Language identification by error-correcting output codes.

Every language gets a codeword of bits. For each bit a binary classifier over hashed
letter pairs and triples (naive Bayes on their counts) tells the languages with a 1 from
those with a 0. A text's margins are decoded by loss: each language's loss is the sum,
over bits, of the logistic loss of the margin against its bit, times the bit's weight
(how far apart the two groups lay in training). The nearest codeword wins; a small gap to
the second is flagged as ambiguous.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and not
ambiguous; so is every text if nothing was learned. With one language learned, all other
texts get it with score 1. Ties go to the language that sorts first. Rows without text or
language teach nothing. Repeated rows count as often as they occur. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anemos.llm.textarrays import LOWER, Texts, chunks

#: Hashed features; bits of a code for more than seven languages, per doubling of their number; smallest clear gap.
FEATURES, BITS_PER_DOUBLING, CLEAR = 1 << 16, 10, 1.0
_LETTER = np.array([b if chr(b).isalpha() or b >= 128 else 32 for b in LOWER], dtype=np.uint8)


def grams(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashed pairs and triples of neighbouring bytes (other signs are a space), and each text's bounds in them."""
    data = _LETTER[texts.data]
    capital = np.zeros(len(data), dtype=bool)  # capitals of the Latin-1 letters in UTF-8
    capital[1:] = (texts.data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    data = (data + 32 * capital).astype(np.uint32)
    space = data == 32
    own = np.repeat(np.arange(len(texts)), np.diff(texts.offsets))
    codes, texts_of = [], []
    for n, factor in ((2, 0x9E3779B1), (3, 0x85EBCA77)):
        size = max(0, len(data) - n + 1)
        code = np.zeros(size, dtype=np.uint32)
        blank = np.zeros(size, dtype=bool)
        for k in range(n):
            code = (code << np.uint32(8)) | data[k:k + size]
            if k:
                blank |= space[k - 1:k - 1 + size] & space[k:k + size]
        good = ~blank & (own[:size] == own[n - 1:n - 1 + size])
        codes.append(((code[good] * np.uint32(factor)) >> np.uint32(16)).astype(np.int32))
        texts_of.append(own[:size][good])
    which = np.concatenate(texts_of)
    order = np.argsort(which, kind="stable")
    return np.concatenate(codes)[order], np.searchsorted(which[order], np.arange(len(texts) + 1))


def codewords(languages: int) -> np.ndarray:
    """One row of -1 and 1 per language: all ways to split up to seven languages, else the best of some random codes."""
    if languages <= 7:
        splits = np.arange(2 ** max(0, languages - 1) - 1)
        rest = [(splits >> k & 1) * 2 - 1 for k in range(languages - 1)]
        return np.array([np.ones(len(splits), dtype=int), *rest])[:languages]
    width, best, widest = BITS_PER_DOUBLING * int(np.ceil(np.log2(languages))), None, -1
    for seed in range(30):
        code = np.random.default_rng(seed).integers(0, 2, (languages, width)) * 2 - 1
        code = code[:, np.abs(code.sum(axis=0)) < languages]  # a bit that splits nothing says nothing
        near = int(((code.shape[1] - code @ code.T) // 2 + 2 * width * np.eye(languages, dtype=int)).min())
        if near > widest:
            best, widest = code, near
    return best


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray  # features x bits
    reliance: np.ndarray  # of each bit; 1 on average

    def decide(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language's number, score and gap to the second, of each text."""
        found, bounds = grams(texts)
        n = np.diff(bounds)
        margin = np.zeros((len(n), self.codes.shape[1]))
        full = np.flatnonzero(n)
        if len(full):
            margin[full] = np.add.reduceat(self.weights[found], bounds[:-1][full], axis=0) / np.sqrt(n[full])[:, None]
        loss = np.logaddexp(0, -margin[:, None, :] * self.codes[None]) @ self.reliance
        order = np.argsort(loss, axis=1, kind="stable")
        best = np.take_along_axis(loss, order[:, :1], 1)
        score = 1 / np.exp(best - loss).sum(axis=1)
        gap = (np.take_along_axis(loss, order[:, 1:2], 1) - best)[:, 0] if loss.shape[1] > 1 else np.full(len(n), np.inf)
        return order[:, 0], score, gap


def count_grams(rows: DataFrame) -> DataFrame:
    """Counts of features by language: lang, feature, n. ``rows``: lang, text."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for texts in chunks(batch.column(1)):
                found, bounds = grams(texts)
                own = np.array(langs[texts.first:texts.first + len(texts)], dtype=object)
                for lang in set(own):
                    mask = np.repeat(own == lang, np.diff(bounds))
                    if lang not in sums:
                        sums[lang] = np.zeros(FEATURES, dtype=np.int64)
                    sums[lang] += np.bincount(found[mask], minlength=FEATURES)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()),
                                              pa.array(total[at], pa.int64())], names=["lang", "feature", "n"])

    return rows.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(
        count, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))


def fit(rows: DataFrame) -> Model:
    """Learn from all rows (lang, text). The driver gets one count per language and feature, whatever the rows."""
    counts = count_grams(rows).toPandas()
    languages = sorted(counts["lang"].unique())
    shares = np.full((len(languages), FEATURES), 0.5)
    for i, lang in enumerate(languages):
        own = counts[counts["lang"] == lang]
        shares[i, own["feature"].to_numpy()] += own["n"].to_numpy()
    shares /= shares.sum(axis=1, keepdims=True)
    codes = codewords(len(languages))
    weights, apart = [], []
    for bit in codes.T:
        # Each language counts alike in its group, however many texts it has.
        one, zero = shares[bit > 0].mean(axis=0), shares[bit < 0].mean(axis=0)
        weights.append(np.log(one) - np.log(zero))
        apart.append(((one - zero) * weights[-1]).sum())
    reliance = np.sqrt(np.array(apart)) if apart else np.zeros(0)
    reliance = reliance / max(reliance.mean(), 1e-12) if apart else reliance
    return Model(languages, codes, np.array(weights, dtype=np.float32).reshape(len(apart), FEATURES).T.copy(), reliance)


def predict_with(spark: SparkSession, model: Model, clear: float = CLEAR) -> Callable[[Column], Column]:
    """A column function: text to struct(lang, score, ambiguous)."""
    kind = "struct<lang:string,score:double,ambiguous:boolean>"
    nothing = F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score"), F.lit(False).alias("ambiguous"))
    if not model.languages:
        return lambda text: F.when(text.isNull() | text.isNotNull(), nothing)
    shared = spark.sparkContext.broadcast(model)  # features x bits

    @F.arrow_udf(kind)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        names = np.array(own.languages, dtype=object)
        for column in batches:
            parts = [own.decide(texts) for texts in chunks(column)]
            best, score, gap = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else ([], [], [])
            yield pa.StructArray.from_arrays([
                pa.array(names[best] if len(best) else [], pa.string()), pa.array(score, pa.float64()),
                pa.array(np.asarray(gap) < clear, pa.bool_())], names=["lang", "score", "ambiguous"])

    return lambda text: F.when(text.rlike(r"\p{L}"), predict(text)).otherwise(nothing)


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether a document's CRC-32 of its id as text leaves this remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def learning_rows(docs: DataFrame) -> DataFrame:
    """Rows to learn from: those not held out. A null id belongs to no fold and teaches nothing."""
    return docs.select("doc_id", "lang", "text").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
