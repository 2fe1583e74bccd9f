"""Whitening of embeddings by a bidiagonal qd solver.

The covariance is never formed. Rows minus their mean go through a blockwise QR: every block
leaves one triangle, triangles are stacked and factored again, group by group, until one is left.
Householder reflections make that triangle bidiagonal. The dqds algorithm finds the squares of its
singular values one after the other to high relative accuracy; a twisted factorisation at each
of them gives its vector, and the reflections carry it back to the rows' space. Values so close
that their twisted vectors are no longer apart are solved as a group: inverse iteration on
the twisted factors, each vector freed of the earlier ones.

Only numbers per dimension (sums) and triangles of dimension x dimension travel; the driver sees at
most ``TOGETHER`` triangles. Rows are read four times (lengths and sums, triangles, check, result).

Defined results: rows whose vector is null or holds null or non-finite entries are left out, and so are
vectors whose length is not that of most others (ties: the longer) and empty ones. Entries become whole numbers
floor(1024 c) + 100000; those beyond ``LARGEST`` are cut to it. Repeated rows and rows with a null or repeated id all count and
all return. A direction without variance has ``whitened`` and ``explained`` 0 (and then ``identity_error`` is 1); a
deviation that no long can hold is null. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemos.llm.vectors import matrix

SCALE, SHIFT, LARGEST = 1024, 100_000, 10 ** 9
#: Rows of a block, triangles factored together.
BLOCK, TOGETHER = 4096, 64
EPS = np.finfo(float).eps


# --- rows ---------------------------------------------------------------------------------

def fitted_rows(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """Rows that take part (vec_id, x as array<long>) and their number of dimensions (0: none)."""
    vector = F.col(vector_col).cast("array<double>")
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = F.transform(vector, lambda c: F.greatest(F.least(F.floor(F.greatest(F.least(
        c * SCALE, F.lit(1e12)), F.lit(-1e12))) + SHIFT, F.lit(LARGEST)), F.lit(-LARGEST)).cast("long"))
    kept = rows.where(F.coalesce(good, F.lit(False)) & (F.size(vector_col) > 0)).select(
        F.col(id_col).alias("vec_id"), whole.alias("x"))
    most = kept.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if most is None:
        return kept.where("false"), 0
    return kept.where(F.size("x") == most["size"]), most["size"]


def sums(fit: DataFrame, dimensions: int) -> tuple[int, np.ndarray]:
    """Number of rows and the exact sum of each dimension (as Python integers)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dimensions, dtype=np.int64)
        for batch in batches:  # a task's sum fits: LARGEST x its rows
            x = matrix(batch.column("x"))
            n, total = n + len(x), total + x.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, dimensions), pa.int32()), pa.array([n, *total.tolist()], pa.int64())],
                                             names=["at", "value"])

    parts = fit.select("x").mapInArrow(run, "at int, value long")
    whole = {r["at"]: int(r["value"]) for r in parts.groupBy("at").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()}
    return whole.get(-1, 0), np.array([whole.get(k, 0) for k in range(dimensions)], dtype=object)


def centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """x - S / n; the whole part of the mean is taken off before anything is rounded."""
    floor = np.array([int(t) // n for t in total], dtype=np.int64)
    rest = np.array([(int(t) % n) / n for t in total])
    return (x - floor) - rest


def triangle(rows: np.ndarray) -> np.ndarray:
    """The triangle of a QR factorisation, filled up with zero rows to a square."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack((r, np.zeros((rows.shape[1] - len(r), rows.shape[1]))))


def factored(fit: DataFrame, n: int, total: np.ndarray) -> np.ndarray:
    """The triangle of all centred rows."""
    dimensions = len(total)

    def stack(parts: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        now = None
        for part in parts:
            now = triangle(part if now is None else np.vstack((now, part)))
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now.ravel()], pa.list_(pa.float64()))], ["r"])

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks():
            for batch in batches:
                x = matrix(batch.column("x"))
                for low in range(0, len(x), BLOCK):
                    yield centred(x[low:low + BLOCK], n, total)
        yield from stack(blocks())

    def of_triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from stack(matrix(batch.column("r"))[k].reshape(-1, dimensions)
                         for batch in batches for k in range(batch.num_rows))

    parts = fit.select("x")
    tasks = parts.rdd.getNumPartitions()
    left = parts.mapInArrow(of_rows, "r array<double>")
    while tasks > TOGETHER:  # each round leaves one triangle of TOGETHER
        tasks = -(-tasks // TOGETHER)
        left = left.coalesce(tasks) if tasks <= TOGETHER else left.repartition(tasks)
        left = left.mapInArrow(of_triangles, "r array<double>")
    found = [np.array(row["r"]).reshape(-1, dimensions) for row in left.collect()]
    return triangle(np.vstack(found)) if found else np.zeros((dimensions, dimensions))


# --- the solver ---------------------------------------------------------------------------

def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and upper diagonal of B in R = U B V', and the reflections whose product is V."""
    a = r.astype(float).copy()
    size = len(a)
    right = []
    for k in range(size):
        v = reflection(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < size - 2:
            v = reflection(a[k, k + 1:])
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ v, v)
            right.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def reflection(x: np.ndarray) -> np.ndarray:
    """The unit vector whose reflection sends x to a multiple of the first axis (zero: x stays)."""
    largest = np.abs(x).max()
    if largest == 0:
        return np.zeros_like(x)
    v = x / largest
    v[0] += np.copysign(np.sqrt(v @ v), v[0])
    return v / np.sqrt(v @ v)


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, falling; q, e: squares of its two diagonals.

    Each sweep moves all values down by a shift that stays below the smallest; shifts add up, and a value is
    found where the last off-diagonal is gone. A shift that proves too large is lowered; shift 0 always holds.
    """
    found: list[float] = []
    pending = [(q.astype(float), e.astype(float), 0.0, 0.0)]
    while pending:
        q, e, moved, rest = pending.pop()
        for _ in range(60 * (len(q) + 20)):
            while len(q) and (len(q) == 1 or e[-1] <= EPS ** 2 * (moved + q[-1])):
                found.append(moved + (rest + q[-1]))
                q, e = q[:-1], e[:-1][:max(0, len(q) - 2)]
            if not len(q):
                break
            apart = np.flatnonzero(e <= EPS ** 2 * moved)
            if len(apart):  # the matrix falls apart: both parts go on from the shifts so far
                k = apart[-1]
                pending.append((q[:k + 1], e[:k], moved, rest))
                q, e = q[k + 1:], e[k + 1:]
                continue
            if q[-1] > 1.5 * q[0]:  # small values belong to the end: the same matrix from its other corner
                q, e = q[::-1], e[::-1]
            shift = corner(q, e)
            while True:
                new_q, new_e, early = sweep(q, e, shift)
                if new_q is not None:
                    break
                # Only the last entry fell below zero: the shift less that much is a good bound.
                shift = max(0.0, shift + early) if early is not None and shift + early < shift else shift / 4
                if shift <= EPS * q[-1]:
                    shift = 0.0
            q, e = new_q, new_e
            total = moved + shift
            rest += shift - (total - moved)
            moved = total
        else:
            raise RuntimeError("dqds does not end")
    return np.sort(np.array(found))[::-1]


def corner(q: np.ndarray, e: np.ndarray) -> float:
    """A shift: the smaller value of the last two by two corner, just below it."""
    before = e[-2] if len(e) > 1 else 0.0
    a, b, c = q[-2] + before, q[-1] + e[-1], q[-2] * e[-1]
    half = (a - b) / 2
    low = b - c / (half + np.copysign(np.sqrt(half * half + c), half)) if c else min(a, b)
    return max(0.0, min(low, a, b) * (1 - 4 * EPS))


def sweep(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray | None, np.ndarray | None, float | None]:
    """One differential quotient-difference step; without arrays where the shift was too large.

    The third value is then the last d, if only that one is negative.
    """
    size = len(q)
    new_q, new_e = [0.0] * size, [0.0] * (size - 1)
    q_list, e_list = q.tolist(), e.tolist()
    d = q_list[0] - shift
    for k in range(size - 1):
        if d < 0:
            return None, None, None
        top = d + e_list[k]
        if top == 0:
            d = q_list[k + 1] - shift
            continue
        ratio = q_list[k + 1] / top
        new_q[k], new_e[k] = top, e_list[k] * ratio
        d = d * ratio - shift
    if d < 0:
        return None, None, d
    new_q[-1] = d
    return np.array(new_q), np.array(new_e), None


@dataclass
class Twisted:
    """B'B - value = N D N', N unit lower above the twist and unit upper below it."""

    upper: np.ndarray
    lower: np.ndarray
    d: np.ndarray
    twist: int

    @classmethod
    def at(cls, a: np.ndarray, b: np.ndarray, value: float) -> Twisted:
        size = len(a)
        largest = max(np.abs(a).max(), np.abs(b).max(initial=0.0), 1e-150)
        a = np.where(np.abs(a) < EPS * EPS * largest, EPS * EPS * largest, a)
        tiny = (EPS * largest) ** 2 * EPS
        solid = lambda x: x if abs(x) > tiny else np.copysign(tiny, x)
        q, e, ell = a * a, b * b, b / a[:-1]
        plus, upper, s = np.empty(size), np.empty(size - 1), np.empty(size)
        minus, lower, p = np.empty(size), np.empty(size - 1), np.empty(size)
        s[0] = -value
        for k in range(size):
            plus[k] = solid(s[k] + q[k])
            if k < size - 1:
                upper[k] = q[k] * ell[k] / plus[k]
                s[k + 1] = e[k] / plus[k] * s[k] - value
        p[-1] = q[-1] - value
        for k in range(size - 2, -1, -1):
            minus[k + 1] = solid(e[k] + p[k + 1])
            t = q[k] / minus[k + 1]
            lower[k] = ell[k] * t
            p[k] = p[k + 1] * t - value
        gamma = s + p + value
        twist = int(np.argmin(np.abs(gamma)))
        d = np.concatenate((plus[:twist], [solid(gamma[twist])], minus[twist + 1:]))
        return cls(upper, lower, d, twist)

    def spread(self, w: np.ndarray) -> np.ndarray:
        """x with N' x = w."""
        x = w.copy()
        for k in range(self.twist - 1, -1, -1):
            x[k] -= self.upper[k] * x[k + 1]
        for k in range(self.twist + 1, len(x)):
            x[k] -= self.lower[k - 1] * x[k - 1]
        return x

    def solve(self, v: np.ndarray) -> np.ndarray:
        """x with N D N' x = v."""
        y, r = v.copy(), self.twist
        for k in range(1, r + 1):
            y[k] -= self.upper[k - 1] * y[k - 1]
        for k in range(len(y) - 2, r - 1, -1):
            y[k] -= self.lower[k] * y[k + 1]
        return self.spread(y / self.d)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max()
    return x / np.sqrt(x @ x)


def vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray, most: int, close: float = 1e-6) -> np.ndarray:
    """Right singular vectors of the bidiagonal matrix for the first ``most`` of all its values (rows)."""
    out: list[np.ndarray] = []
    while len(out) < most:
        low = len(out)
        high = low + 1
        while high < len(values) and values[high - 1] - values[high] <= close * values[high - 1]:
            high += 1
        if high == low + 1 or values[low] == 0:
            one = np.zeros(len(a))
            twisted = Twisted.at(a, b, values[low])
            one[twisted.twist] = 1.0
            out.append(unit(twisted.spread(one)))
        else:
            out.extend(close_vectors(a, b, values[low:high]))
    return np.array(out[:most]).reshape(most, len(a))


def close_vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Vectors of values too close to be told apart one by one: their common space by iteration beside them, then its axes."""
    away = values[0] * (1 + 1e-10) + (values[0] - values[-1])
    twisted = Twisted.at(a, b, away)
    space = np.linalg.qr(np.random.default_rng(0).standard_normal((len(a), len(values))))[0]
    b_rows = lambda z: a[:, None] * z + np.vstack((b[:, None] * z[1:], np.zeros((1, z.shape[1]))))
    for _ in range(rounds):
        space = np.linalg.qr(np.column_stack([unit(twisted.solve(z)) for z in space.T]))[0]
        inner = b_rows(space)
        turned = np.linalg.svd(inner, full_matrices=False)[2]
        # B z minus its part along B's image of the space, carried back: what still leads out of the space.
        back = a[:, None] * inner + np.vstack((np.zeros((1, space.shape[1])), b[:, None] * inner[:-1]))
        if np.abs(back - space @ (space.T @ back)).max() <= 8 * EPS * values[0]:
            break
    return (space @ turned.T).T


@dataclass
class Directions:
    """Components of the covariance of n rows: unit vectors (rows), variances, shares of the whole variance."""

    n: int
    total: np.ndarray
    rows: np.ndarray
    variance: np.ndarray
    explained: np.ndarray


def directions(r: np.ndarray, n: int, total: np.ndarray, most: int) -> Directions:
    """The components of the triangle of all centred rows, by falling variance."""
    size = len(r)
    most = min(most, size)
    largest = np.abs(r).max(initial=0.0)
    if largest == 0:
        return Directions(n, total, np.eye(size)[:most], np.zeros(most), np.zeros(most))
    a, b, right = bidiagonal(r / largest)
    squares = dqds(a * a, b * b)
    squares = np.where(squares > (EPS * size) ** 2 * squares[0], squares, 0.0)
    found = vectors(a, b, squares, most)
    squares = squares[:most]
    for k in range(len(right) - 1, -1, -1):
        found[:, k + 1:] -= 2 * np.outer(found[:, k + 1:] @ right[k], right[k])
    whole = float(((r / largest) ** 2).sum())
    return Directions(n, total, found, squares * largest * largest / n, squares / whole)


# --- results ------------------------------------------------------------------------------

def project(x: np.ndarray, by: Directions) -> np.ndarray:
    """Whitened rows; a direction without variance gives 0."""
    scale = np.divide(1.0, np.sqrt(by.variance), out=np.zeros_like(by.variance), where=by.variance > 0)
    return centred(x, by.n, by.total) @ by.rows.T * scale


def identity_error(fit: DataFrame, by: Directions) -> float:
    """The largest entry of the whitened rows' covariance minus the identity."""
    size = len(by.rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.zeros((size + 1, size))
        for batch in batches:
            w = project(matrix(batch.column("x")), by)
            whole += np.vstack((w.T @ w, w.sum(axis=0)))
        yield pa.RecordBatch.from_pydict({"at": np.arange(whole.size, dtype=np.int32), "value": whole.ravel()})

    parts = fit.select("x").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    whole = np.zeros((size + 1, size))
    for row in parts.collect():
        whole.flat[row["at"]] = row["value"]
    mean = whole[-1] / by.n
    return float(np.abs(whole[:-1] / by.n - np.outer(mean, mean) - np.eye(size)).max())


def deviations(x: np.ndarray, n: int, total: np.ndarray) -> pa.Array:
    """Sums of (n x - S)^2, exact; null where a long can't hold it."""
    low = np.array([int(t) // n for t in total], dtype=np.int64)
    rest = np.array([int(t) % n for t in total], dtype=np.int64)
    away = x - low
    rough = ((away.astype(float) * n - rest) ** 2).sum(axis=1)
    fits = rough < 9.2e18
    away[~fits] = 0  # no product below overflows
    y = away * n - rest
    return pa.array((y * y).sum(axis=1), pa.int64(), mask=~fits)


def whiten(rows: DataFrame, most: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per remaining row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    fit, dimensions = fitted_rows(rows, id_col, vector_col)
    kind = fit.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    n, total = sums(fit, dimensions) if dimensions else (0, np.zeros(0, dtype=object))
    if not n:
        return rows.sparkSession.createDataFrame([], schema)
    by = directions(factored(fit, n, total), n, total, most)
    error = identity_error(fit, by)
    size = len(by.rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"))
            count = len(x)
            each = pa.array(np.repeat(np.arange(count), size))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(each), pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), count)),
                pa.array(np.full(count * size, n, dtype=np.int64)), deviations(x, n, total).take(each),
                pa.array(project(x, by).ravel()), pa.array(np.tile(by.explained, count)),
                pa.array(np.full(count * size, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return fit.mapInArrow(run, schema)
