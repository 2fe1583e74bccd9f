"""Regression trees over binned columns, grown and walked on arrays.

A tree is grown level by level: all open nodes of a level get the histograms of their rows, the best split of each is read
off running sums, and rows move to the children. Splits, their order among equals, depth and stops are those of Spark ML's forests.
Sums are whole numbers and exact, so the order of rows changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32
#: A row's weight and weighted grade are added up as one double: weight * HIGH + weight * grade.
HIGH = float(1 << 28)
MOST_GRADE = 7
#: Rows of one tree for which these sums and their products in ``best_splits`` are exact (2^53).
MOST_ROWS = 30_000_000
#: Rows and nodes that are looked at together, so that their arrays stay in the processor's caches.
ROWS_AT_ONCE, NODES_AT_ONCE = 1 << 17, 256
#: Nodes of a level whose histograms are kept for the next level (3.5 KB each with 14 columns).
KEPT = 4096


def thresholds(values: np.ndarray, rows: int | None = None) -> np.ndarray:
    """At most ``BINS`` - 1 limits between values so that each bin holds about the same number of them (of ``rows`` rows in all)."""
    most = min(BINS, len(values) if rows is None else rows) - 1
    distinct, counts = np.unique(values + 0.0, return_counts=True)
    between = (distinct[:-1] + distinct[1:]) / 2.0
    if len(between) <= max(most, 0):
        return between
    stride = len(values) / (most + 1)
    found, running, target = [], np.cumsum(counts), stride
    for i, limit in enumerate(between):
        if abs(running[i] - target) < abs(running[i + 1] - target):
            found.append(limit)
            target += stride
    return np.array(found)


@dataclass(frozen=True)
class Tree:
    """Nodes level by level from the left: the column a node splits (-1: it is a leaf), the last bin that goes left, the mean grade."""

    column: np.ndarray
    last: np.ndarray
    value: np.ndarray
    importance: np.ndarray

    def predict(self, bins: np.ndarray) -> np.ndarray:
        """Mean grade of the leaf of each row of ``bins`` (columns x rows)."""
        inner = self.column >= 0
        left = np.cumsum(inner) * 2 - 1  # children come in the order of their parents
        out = np.empty(bins.shape[1])
        rows, at = np.arange(bins.shape[1]), np.zeros(bins.shape[1], np.int64)
        while len(rows):
            moves = inner[at]
            done = ~moves
            out[rows[done]] = self.value[at[done]]
            rows, at = rows[moves], at[moves]
            at = left[at] + (bins[self.column[at], rows] > self.last[at])
        return out


def _histograms(bins, rows, packed, counts) -> np.ndarray:
    """Sums of ``packed`` per column, node and bin."""
    nodes = len(counts)
    if nodes == 1 and len(rows) > ROWS_AT_ONCE:
        cut = range(0, len(rows), ROWS_AT_ONCE)
        return sum(_histograms(bins, rows[i:i + ROWS_AT_ONCE], packed[i:i + ROWS_AT_ONCE], [len(rows[i:i + ROWS_AT_ONCE])]) for i in cut)
    base = np.repeat(np.arange(0, nodes * BINS, BINS), counts)
    place, out = np.empty(len(rows), np.int64), np.empty((len(bins), nodes * BINS))
    for f, column in enumerate(bins):
        np.add(base, column[rows], out=place)
        out[f] = np.bincount(place, packed, nodes * BINS)
    return out.reshape(len(bins), nodes, BINS)


def best_splits(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Column, last bin of the left side and gain (weight times fall of the variance) of each node's best split.

    The gain is the squared difference of both sides' means by their weights: zero exactly where the means are equal.
    Among equal gains the first column and bin are taken.
    """
    left = np.cumsum(sums, axis=2)
    whole = left[0, :, -1]
    weight = np.floor(whole / HIGH)
    grade = (whole - weight * HIGH)[:, None]
    left = left[:, :, :-1]
    left_weight = np.floor(left * (1 / HIGH))
    left -= left_weight * HIGH
    left *= weight[:, None]
    left -= left_weight * grade
    np.square(left, out=left)
    room = left_weight * (weight[:, None] - left_weight)
    np.divide(left, room, out=left, where=room > 0)
    left[room <= 0] = 0
    last = left.argmax(axis=2)
    gains = np.take_along_axis(left, last[:, :, None], 2)[:, :, 0]
    column = gains.argmax(axis=0)
    at = column, np.arange(len(column))
    return column, last[at], gains[at] / weight


def _chunks(counts):
    """Runs of nodes (first, end, first row, end of rows) to look at together."""
    ends, first = np.cumsum(counts), 0
    while first < len(counts):
        before = ends[first] - counts[first]
        end = min(max(int(np.searchsorted(ends, before + ROWS_AT_ONCE, side="right")), first + 1), first + NODES_AT_ONCE, len(counts))
        yield first, end, before, ends[end - 1]
        first = end


def _level(bins, rows, packed, counts, mixed, parents) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    """Best splits of the mixed nodes, and their histograms if these are few.

    Where the histograms of the ``parents`` are there, only the smaller child's rows are counted: the other has what is left.
    """
    counted = mixed
    if parents is not None:
        smaller = np.zeros(len(counts), bool)
        smaller[np.arange(0, len(counts), 2) + (counts[1::2] < counts[::2])] = True
        counted = smaller & np.repeat(mixed[::2] | mixed[1::2], 2)
    keep, nodes, sizes = np.repeat(counted, counts), np.flatnonzero(counted), counts[counted]
    rows, packed, found, kept = rows[keep], packed[keep], [], []
    for i, j, a, b in _chunks(sizes):
        sums = _histograms(bins, rows[a:b], packed[a:b], sizes[i:j])
        if parents is not None:
            pairs, at = nodes[i:j] // 2, 2 * np.arange(j - i) + nodes[i:j] % 2
            both = np.empty((len(bins), 2 * (j - i), BINS))
            both[:, at], both[:, at ^ 1] = sums, parents[:, pairs] - sums
            sums = both[:, mixed.reshape(-1, 2)[pairs].ravel()]
        found.append(best_splits(sums))
        if mixed.sum() <= KEPT:
            kept.append(sums)
    return *(np.concatenate(x) for x in zip(*found)), np.concatenate(kept, axis=1) if kept else None


def _moved(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    out = np.empty_like(x)
    out[to] = x
    return out


def grow(bins: np.ndarray, grades: np.ndarray, weights: np.ndarray, depth: int = 30) -> Tree:
    """The tree of rows whose column values are ``bins`` (columns x rows), each counted ``weights`` times.

    Grades are whole numbers from 0 to ``MOST_GRADE``.
    """
    rows = np.flatnonzero(weights).astype(np.int32)
    if not len(rows):
        return Tree(np.array([-1], np.int8), np.zeros(1, np.uint8), np.zeros(1), np.zeros(len(bins)))
    grade, weight = grades[rows], weights[rows].astype(float)
    packed = weight * HIGH + weight * grade
    counts, columns, lasts, values, importance, parents = np.array([len(rows)]), [], [], [], np.zeros(len(bins)), None
    for level in range(depth + 1):
        starts = np.cumsum(counts) - counts
        whole = np.add.reduceat(packed, starts)
        weight = np.floor(whole / HIGH)
        values.append((whole - weight * HIGH) / weight)
        column, last = np.full(len(counts), -1, np.int8), np.zeros(len(counts), np.uint8)
        columns.append(column)
        lasts.append(last)
        if level == depth:
            break
        mixed = np.minimum.reduceat(grade, starts) < np.maximum.reduceat(grade, starts)
        if not mixed.any():
            break
        best, edge, gain, sums = _level(bins, rows, packed, counts, mixed, parents)
        split = gain > 0
        column[mixed], last[mixed] = np.where(split, best, -1), np.where(split, edge, 0)
        importance += np.bincount(best, gain, len(bins))
        if not split.any():
            break
        parents = None if sums is None else sums[:, split]
        inner, best, edge = column >= 0, best[split], edge[split]
        keep = np.repeat(inner, counts)
        rows, packed, grade, counts = rows[keep], packed[keep], grade[keep], counts[inner]
        # Rows keep their order inside a child; children lie side by side.
        right = bins[np.repeat(best, counts), rows] > np.repeat(edge, counts).astype(np.uint8)
        rights = np.add.reduceat(right, np.cumsum(counts) - counts, dtype=np.int64)
        lefts = counts - rights
        to = np.empty(len(rows), np.int64)
        to[~right] = np.arange(len(rows) - rights.sum()) + np.repeat(np.cumsum(rights) - rights, lefts)
        to[right] = np.arange(rights.sum()) + np.repeat(np.cumsum(lefts), rights)
        rows, packed, grade = _moved(rows, to), _moved(packed, to), _moved(grade, to)
        counts = np.column_stack([lefts, rights]).ravel()
    return Tree(*(np.concatenate(x) for x in (columns, lasts, values)), importance / (importance.sum() or 1.0))
