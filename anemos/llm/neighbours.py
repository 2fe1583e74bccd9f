"""Approximate nearest neighbours: a hierarchical small-world graph per shard, kept as flat neighbour arrays.

Equal vectors are one row of the index, the smallest id with the ``k + 1`` smallest ids, of which
no more can be in an answer. These rows are dealt to shards of about ``SHARD`` rows by a hash of
their id, so a shard's graph fits a task however many rows there are. A shard's index is one
row: vectors, ids, and for each layer the member nodes and a fixed number of neighbours of each. Layers are nested;
a node's top layer follows from a hash of its id. Every query searches every shard from
the top layer down, and the shards' results are merged. Scores of those found are exact.

Defined results: vectors that are null, zero or hold null or non-finite components take no
part, as queries or candidates; so do null ids; of rows with one id the smallest vector
stays; only vectors of one length are compared; fewer candidates than asked for are all returned, nearest first, ties to the
smaller id; an empty table gives no rows; columns other than the two named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anemos.llm.textarrays import mix
from anemos.llm.vectors import beam_search, cosines, diverse, matrix, nearest_in_blocks, unit, usable, with_reverse
from anemos.session import settle

#: Rows per shard; neighbours per node (twice as many in the lowest layer); candidates looked at to choose them; beam.
SHARD, LINKS, WIDTH, BEAM = 4096, 16, 64, 96
#: Queries of a shard searched at once.
BLOCK = 512
INDEX = "shard long, ids binary, same binary, counts binary, vectors binary, dimension int, layers array<binary>, links array<binary>"


def build_shard(ids: np.ndarray, vectors: np.ndarray, links: int = LINKS, width: int = WIDTH) -> tuple:
    """Layers from the lowest to the top: member nodes and their neighbours (numbers of rows)."""
    units = unit(vectors)
    # Each layer holds one in ``links`` nodes of the layer below.
    share = mix(ids.astype(np.uint64)).astype(np.float64) / 2.0 ** 64
    top = np.floor(-np.log(np.maximum(share, 1e-18)) / np.log(links)).astype(int)
    layers, neighbours = [], []
    for layer in range(int(top.max(initial=0)) + 1):
        members = np.flatnonzero(top >= layer)
        if layer and len(members) == 0:
            break
        most = 2 * links if layer == 0 else links
        near, cos = nearest_in_blocks(units, members, width)
        chosen = diverse(near, cos, units, links, 1.0)
        # Numbers within the layer, so that links of others can be added, then rows again.
        place = np.full(len(ids), -1, dtype=np.int32)
        place[members] = np.arange(len(members))
        full = with_reverse(np.where(chosen >= 0, place[chosen], -1), most)
        layers.append(members.astype(np.int32))
        neighbours.append(np.where(full >= 0, members[full], -1).astype(np.int32))
    return layers, neighbours


def build(rows: DataFrame, shards: int) -> DataFrame:
    """The index of distinct vectors (vec_id, vector, same: ids of equal vectors): one row per shard."""
    def one(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("vec_id")
        ids = table.column("vec_id").combine_chunks().to_numpy(zero_copy_only=False)
        vectors = matrix(table.column("vector").combine_chunks())
        same = table.column("same").combine_chunks()
        layers, links = build_shard(ids, vectors)
        return pa.table({
            "shard": pa.array([table.column("shard")[0].as_py()], pa.int64()),
            "ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
            "same": pa.array([same.flatten().to_numpy(zero_copy_only=False).astype(np.int64).tobytes()], pa.binary()),
            "counts": pa.array([np.diff(same.offsets.to_numpy()).astype(np.int64).tobytes()], pa.binary()),
            "vectors": pa.array([vectors.tobytes()], pa.binary()),
            "dimension": pa.array([vectors.shape[1]], pa.int32()),
            "layers": pa.array([[x.tobytes() for x in layers]], pa.list_(pa.binary())),
            "links": pa.array([[x.tobytes() for x in links]], pa.list_(pa.binary()))})

    own = rows.withColumn("shard", F.size("vector") * shards + F.pmod(F.xxhash64("vec_id"), F.lit(shards)))
    return own.groupBy("shard").applyInArrow(one, INDEX)


class Shard:
    """A shard's index read back."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        self.same, self.counts = (np.frombuffer(row[c], dtype=np.int64) for c in ("same", "counts"))
        self.first = np.cumsum(self.counts) - self.counts
        self.units = unit(np.frombuffer(row["vectors"]).reshape(len(self.ids), row["dimension"]))
        self.layers = [np.frombuffer(x, dtype=np.int32) for x in row["layers"]]
        self.links = []
        for members, flat in zip(self.layers, row["links"], strict=True):
            own = np.frombuffer(flat, dtype=np.int32).reshape(len(members), -1)
            full = np.full((len(self.ids), own.shape[1]), -1, dtype=np.int32)
            full[members] = own
            self.links.append(full)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest nodes found and their cosines, for units as queries."""
        start = np.repeat(self.layers[-1][:1][None], len(queries), axis=0)
        for layer in range(len(self.links) - 1, 0, -1):
            start = beam_search(queries, self.units, self.links[layer], start, 4, 2)[0]
        return beam_search(queries, self.units, self.links[0], start, beam)


def search(index: DataFrame, queries: DataFrame, k: int, shards: int, beam: int = BEAM) -> DataFrame:
    """Each query's k nearest rows of the index but itself: query_id, rank, vec_id, score. ``queries``: vec_id, vector."""
    # A shard's index comes first in its partition, then its queries stream past it.
    # Only vectors of one length share a shard.
    lowest = F.size("vector").cast("long") * shards
    every = F.explode(F.sequence(lowest, lowest + shards - 1))
    empty = {c.split(" ")[0]: c.split(" ")[1] for c in INDEX.split(", ")}
    asked = queries.select(every.alias("shard"), F.lit(1).alias("turn"), F.col("vec_id").alias("query_id"), "vector",
                           *(F.lit(None).cast(t).alias(c) for c, t in empty.items() if c != "shard"))
    held = index.select("shard", F.lit(0).alias("turn"), F.lit(None).cast("long").alias("query_id"),
                        F.lit(None).cast("array<double>").alias("vector"), *(c for c in empty if c != "shard"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = number = None
        for batch in batches:
            numbers, turns = batch.column("shard").to_numpy(), batch.column("turn").to_numpy()
            edges = np.flatnonzero(np.concatenate(([True], (numbers[1:] != numbers[:-1]) | (turns[1:] != turns[:-1]))))
            for low, high in zip(edges, np.append(edges[1:], len(numbers)), strict=True):
                if turns[low] == 0:
                    shard, number = Shard(batch.slice(low, 1).to_pylist()[0]), numbers[low]
                    continue
                if number != numbers[low]:
                    continue  # a shard that got no row
                for at in range(low, high, BLOCK):
                    part = batch.slice(at, min(BLOCK, high - at))
                    yield answers(shard, part.column("query_id").to_numpy(), unit(matrix(part.column("vector"))))

    def answers(shard: Shard, ids: np.ndarray, units: np.ndarray) -> pa.RecordBatch:
        nodes, _ = shard.search(units, beam)
        row, place = np.nonzero(nodes >= 0)
        found = nodes[row, place]
        score = cosines(units[row], shard.units[found])
        # One more than asked for, as the query itself may be the only row of a vector.
        row, _, score, found = first(row, shard.ids[found], score, k + 1, found)
        count = shard.counts[found]
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(shard.first[found], count)
        row, score, same = np.repeat(row, count), np.repeat(score, count), shard.same[at]
        other = same != ids[row]
        row, same, score = first(row[other], same[other], score[other], k)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[row]), pa.array(same), pa.array(score)], names=["query_id", "vec_id", "score"])

    def first(row: np.ndarray, own: np.ndarray, score: np.ndarray, most: int, *more: np.ndarray) -> list[np.ndarray]:
        """The best of each row, ties to the smaller id."""
        order = np.lexsort((own, -score, row))
        keep = order[np.arange(len(row)) - np.searchsorted(row[order], row[order]) < most]
        return [x[keep] for x in (row, own, score, *more)]

    near = held.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "turn").mapInArrow(
        run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def nearest(rows: DataFrame, id_col: str, vector_col: str, k: int, every: int = 50, shard_rows: int = SHARD) -> DataFrame:
    """Index all usable rows and search with those whose id is divisible by ``every``."""
    vectors = settle(usable(rows, id_col, vector_col), "vectors")
    # The row limit is applied before the shuffle too, so a vector of very many rows is a few.
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    distinct = settle(vectors.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("vector").agg(
        F.min("vec_id").alias("vec_id"), F.array_sort(F.collect_list("vec_id")).alias("same")), "distinct")
    shards = max(1, -(-distinct.count() // shard_rows))
    return search(settle(build(distinct, shards), "index"), vectors.where(F.col("vec_id") % every == 0), k, shards)
