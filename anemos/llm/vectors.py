"""Vectors as rows, and the steps that both graph operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """One row per id with a finite, non-zero vector: vec_id, vector (array<double>).

    Null ids, null vectors and vectors that hold null, NaN or infinity or are zero take no part. Of
    rows that share an id, the one with the smallest vector stays.
    """
    vector = F.col(vector_col).cast("array<double>")
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    solid = F.exists(vector, lambda x: x != 0)
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.coalesce(good & solid, F.lit(False))).groupBy("vec_id").agg(
        F.min("vector").alias("vector"))


def matrix(column: pa.Array) -> np.ndarray:
    """An Arrow column of equally long lists as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled to length one; first by the largest component, so that no square overflows or vanishes."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def cosines(units: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Cosines of matching rows, one sum per pair, so equal vectors get equal values."""
    return np.einsum("ij,ij->i", units, others)


def diverse(near: np.ndarray, near_cos: np.ndarray, units: np.ndarray, most: int, alpha: float) -> np.ndarray:
    """Of each row's candidates (nearest first), those that no chosen one covers; -1 fills up.

    A chosen candidate covers another if, after stretching by ``alpha``, it lies nearer to it
    than the row's own vector does (robust pruning; with alpha 1 the selection rule of
    navigable small worlds). Distances are 2 - 2 cos.
    """
    rows, width = near.shape
    out = np.full((rows, most), -1, dtype=np.int32)
    count = np.zeros(rows, dtype=np.int64)
    for low in range(0, rows, 256):  # 256 x width x width cosines at a time
        part = near[low:low + 256]
        own = units[part]
        apart = 2 - 2 * np.einsum("rid,rjd->rij", own, own, optimize=True)
        away = 2 - 2 * near_cos[low:low + 256]
        alive = part >= 0
        every = np.arange(len(part))
        for k in range(width):
            take = alive[:, k] & (count[low:low + 256] < most)
            at = every[take]
            out[low + at, count[low + at]] = part[at, k]
            count[low + at] += 1
            alive[at] &= alpha * apart[at, k] > away[at]
    return out


def nearest_in_blocks(units: np.ndarray, members: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each member's nearest other members (numbers of rows of ``units``) and their cosines, nearest first.

    All pairs inside one shard, whose size is bounded, block by block.
    """
    own = units[members]
    width = min(width, len(members) - 1)
    near = np.zeros((len(members), width), dtype=np.int32)
    cos = np.zeros((len(members), width))
    for low in range(0, len(members), 512):
        block = own[low:low + 512] @ own.T
        every = np.arange(len(block))
        block[every, low + every] = -np.inf
        top = np.argpartition(-block, width - 1, axis=1)[:, :width] if width else np.zeros((len(block), 0), dtype=int)
        value = np.take_along_axis(block, top, 1)
        order = np.argsort(-value, axis=1, kind="stable")
        near[low:low + 512] = members[np.take_along_axis(top, order, 1)]
        cos[low:low + 512] = np.take_along_axis(value, order, 1)
    return near, cos


def with_reverse(links: np.ndarray, most: int) -> np.ndarray:
    """Adjacency with the links of others to a row added, up to ``most`` in all; -1 fills up."""
    source = np.repeat(np.arange(len(links)), links.shape[1])
    target = links.reshape(-1)
    source, target = source[target >= 0], target[target >= 0]
    # Own links come before those of others.
    a = np.concatenate((source, target))
    b = np.concatenate((target, source))
    key = a.astype(np.int64) * (len(links) + 1) + b
    _, first = np.unique(key, return_index=True)
    first = np.sort(first)
    a, b = a[first], b[first]
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    place = np.arange(len(a)) - np.searchsorted(a, a)
    out = np.full((len(links), most), -1, dtype=np.int32)
    fits = place < most
    out[a[fits], place[fits]] = b[fits]
    return out


def beam_search(queries: np.ndarray, units: np.ndarray, links: np.ndarray, start: np.ndarray, width: int,
                together: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Greedy search of all queries at once: each one's ``width`` nearest nodes found, and their cosines.

    ``start``: nodes to begin at, one row per query. Each round every query opens its
    nearest unopened nodes of the beam; it ends when all beams are open. -1 fills up.
    """
    n = len(queries)
    seen = np.zeros((n, len(units)), dtype=bool)
    every = np.arange(n)[:, None]
    beam = np.full((n, width), -1, dtype=np.int32)
    cos = np.full((n, width), -np.inf)
    opened = np.ones((n, width), dtype=bool)

    def offer(rows: np.ndarray, nodes: np.ndarray) -> None:
        """Merge new nodes (-1: none) into the beams of some queries."""
        nodes = np.where((nodes >= 0) & ~seen[rows[:, None], nodes], nodes, -1)
        ordered = np.sort(nodes, axis=1)
        ordered[:, 1:][ordered[:, 1:] == ordered[:, :-1]] = -1
        good = ordered >= 0
        at, place = np.nonzero(good)
        nodes_flat = ordered[at, place]
        seen[rows[at], nodes_flat] = True
        value = np.full(ordered.shape, -np.inf)
        value[at, place] = np.einsum("ij,ij->i", queries[rows[at]], units[nodes_flat])
        both = np.concatenate((cos[rows], value), axis=1)
        top = np.argpartition(-both, width - 1, axis=1)[:, :width]
        cos[rows] = np.take_along_axis(both, top, 1)
        beam[rows] = np.take_along_axis(np.concatenate((beam[rows], ordered), axis=1), top, 1)
        opened[rows] = np.take_along_axis(np.concatenate((opened[rows], ~good), axis=1), top, 1)

    offer(np.arange(n), start)
    active = np.arange(n)
    while len(active):
        waiting = np.where(opened[active], -np.inf, cos[active])
        top = np.argpartition(-waiting, min(together, width) - 1, axis=1)[:, :together]
        valid = np.take_along_axis(waiting, top, 1) > -np.inf
        going = valid.any(axis=1)
        active, top, valid = active[going], top[going], valid[going]
        if not len(active):
            break
        at, place = np.nonzero(valid)
        opened[active[at], top[at, place]] = True
        nodes = np.where(valid, np.take_along_axis(beam[active], top, 1), -1)
        found = np.where(nodes[:, :, None] >= 0, links[nodes], -1).reshape(len(active), -1)
        offer(active, found)
    order = np.argsort(-cos, axis=1, kind="stable")
    return np.take_along_axis(beam, order, 1), cos[every, order]
