"""Prefix trie of conversations by a splitter skeleton.

A conversation is a path of turns, a node a distinct path start, a prefix digest (the sum of its turns'
digests, each salted with its place) names it. Conversations with the same path are one row with a weight. Paths are
sorted and cut into shards by range. The starts of the shards' first paths, the splitters, form the skeleton:
every other node has all its members in one shard, as a start shared by two shards is also one of the
splitter between them. So the skeleton is broadcast, each sorted shard finishes its own nodes from the common lengths of
neighbours, and for skeleton nodes it hands on partial sums, which are reduced by node and then summed up the
skeleton itself.

Where a conversation has passed a multiple of ``STEP`` turns that no other path shares, the rest of
it is a chain of its own; its nodes come from running sums, so a very long conversation is no wide row. A path row
holds 24 bytes a turn of what is shared (to the next multiple of ``STEP``), a shard about ``SHARD`` turns. The skeleton
has at most (shards x length of a splitter) nodes and is all that the driver sees; beyond ``MOST_SHARDS`` shards get larger.

Defined results: rows with a null conversation belong to none; turns are ordered by number (null first), then
role, then text; a null role or text is empty; repeated rows are turns of their own. An empty table gives no node, not even a
root. Rebuilt conversations without turns are members of the root and end there. Columns other than the four named
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemos.operators.ordered import Series, number_rows, running_totals
from anemos.session import settle

#: Turns of a shard; shards at most.
SHARD, MOST_SHARDS = 500_000, 20_000
#: Turns after which a path that nobody shares is cut off.
STEP = 64
#: Conversations of one path up to which their ids are listed in a row; more are read in order.
LISTED = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()
DIGEST = "decimal(38,0)"


# --- paths --------------------------------------------------------------------------------

def placed_turns(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """Turns with their place from 1 and their conversation's number of turns: conv_id, pos, own, turn (digest), chars."""
    clean = rows.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    series = Series.measure(clean, ["conv_id"], ["turn", "role", "text"])
    numbered = number_rows(clean, series, "pos", "own")
    return numbered.select("conv_id", "pos", "own", F.sha2(F.concat(
        F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("turn"),
        F.length("text").cast("long").alias("chars"))


def rebuilt(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation behind the first turns of the first of its hundred, and those without turns.

    The first has conv_id, pos, turn, chars, last (boolean: its conversation ends there), the second conv_id.
    """
    base = F.col("conv_id") - F.col("conv_id") % 100
    convs = placed.where("pos = 1").select("conv_id", "own", base.alias("base"), (
        F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).alias("h"))
    bases = convs.where("conv_id = base").select("base", F.col("own").alias("there"))
    plan = settle(convs.join(bases, "base", "left").select("conv_id", "base", "own", "h", F.least(
        "h", F.coalesce("there", F.lit(0))).alias("k")), "plan")
    heads = placed.where("pos <= 5 AND conv_id % 100 = 0").select(F.col("conv_id").alias("base"), "pos", "turn", "chars")
    first = plan.where("k > 0").join(heads, "base").where("pos <= k").select(
        "conv_id", "pos", "turn", "chars", ((F.col("pos") == F.col("k")) & (F.col("own") <= F.col("h"))).alias("last"))
    later = placed.drop("own").join(plan, "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "turn", "chars",
        (F.col("pos") == F.col("own")).alias("last"))
    return first.unionByName(later), plan.where("k = 0 AND own <= h").select("conv_id")


def prefixes(turns: DataFrame) -> DataFrame:
    """Turns with the digest of the path up to them: conv_id, pos, prefix, chars, last."""
    salted = F.sha2(F.concat_ws(":", F.col("pos").cast("string"), "turn"), 256)
    number = lambda low, n: F.conv(F.substring(salted, low, n), 16, 10).cast(DIGEST)
    # 92 bits, so that sums of 10^10 turns stay below 38 digits.
    element = (number(1, 11) * F.lit(1 << 48).cast("decimal(15,0)") + number(12, 12)).cast(DIGEST)
    rows = settle(turns.select("conv_id", "pos", element.alias("element"), "chars", "last"), "turns")
    series = Series.measure(rows, ["conv_id"], ["pos"])
    return running_totals(rows, series, {"prefix": "element"}).select(
        "conv_id", "pos", F.col("prefix").cast(DIGEST).alias("prefix"), "chars", "last")


# --- shards -------------------------------------------------------------------------------

@dataclass
class Skeleton:
    """Digests of the splitters' starts, sorted, and the place of each in the table of its nodes."""

    digests: np.ndarray

    @classmethod
    def of(cls, paths: list[list]) -> Skeleton:
        nodes = {0, *(int(d) for path in paths for d in path)}
        return cls(np.sort(pairs_of(sorted(nodes))))

    def find(self, digests: np.ndarray) -> np.ndarray:
        """The number of each digest's node, -1 where it is none."""
        at = np.minimum(np.searchsorted(self.digests, digests), len(self.digests) - 1)
        return np.where(self.digests[at] == digests, at, -1)


#: A digest as two numbers that numpy can sort and compare.
PAIR = np.dtype([("high", "<u8"), ("low", "<u8")])


def pairs_of(numbers: list[int]) -> np.ndarray:
    out = np.zeros(len(numbers), dtype=PAIR)
    out["high"] = [x >> 64 for x in numbers]
    out["low"] = [x & (1 << 64) - 1 for x in numbers]
    return out


def pairs_in(column: pa.Array) -> np.ndarray:
    """Digests of an Arrow column of decimals (16 bytes each, low half first)."""
    raw = np.frombuffer(column.buffers()[1], dtype="<u8").reshape(-1, 2)[column.offset:column.offset + len(column)]
    out = np.zeros(len(raw), dtype=PAIR)
    out["low"], out["high"] = raw[:, 0], raw[:, 1]
    return out


@dataclass
class Shard:
    """Sorted distinct paths: path i has digests and chars ``bounds[i]:bounds[i + 1]``; tail: chars behind it or -1."""

    rep: np.ndarray
    weight: np.ndarray
    tail: np.ndarray
    bounds: np.ndarray
    digest: np.ndarray
    chars: np.ndarray

    def common(self) -> np.ndarray:
        """Turns that each path shares with the one before it; -1 for the first."""
        size = np.diff(self.bounds)
        out = np.zeros(len(size), dtype=np.int64)
        out[:1] = -1
        alive = np.arange(1, len(size))
        depth = 0
        while len(alive):
            alive = alive[(size[alive] > depth) & (size[alive - 1] > depth)]
            alive = alive[self.digest[self.bounds[alive] + depth] == self.digest[self.bounds[alive - 1] + depth]]
            depth += 1
            out[alive] = depth
        return out

    def nodes(self, skeleton: Skeleton) -> Iterator[dict[str, np.ndarray]]:
        """Columns of the nodes, depth by depth from the deepest; ``node``: a skeleton node's number (sums are partial), or -1."""
        size, common = np.diff(self.bounds), self.common()
        leaves = (self.tail >= 0).astype(np.int64)
        saved = np.where(self.tail >= 0, (self.weight - 1) * self.tail, 0)
        by_size = np.argsort(-size, kind="stable")
        sizes = -size[by_size]
        below: dict[str, np.ndarray] | None = None
        start_below = np.zeros(0, dtype=np.int64)
        for depth in range(int(size.max(initial=0)), -1, -1):
            rows = np.sort(by_size[:np.searchsorted(sizes, -depth, "right")])
            cut = np.flatnonzero(common[rows] < depth)
            start = rows[cut]
            if depth:
                last = self.bounds[start] + depth - 1
                digest, chars = self.digest[last], self.chars[last]
            else:
                digest, chars = np.zeros(len(start), dtype=PAIR), np.zeros(len(start), dtype=np.int64)
            node = skeleton.find(digest)
            n_convs, conv = np.add.reduceat(self.weight[rows], cut), np.minimum.reduceat(self.rep[rows], cut)
            ending = size[start] == depth
            children = (ending & (self.tail[start] >= 0)).astype(np.int64)
            if below is not None:
                parent = np.searchsorted(start, start_below, "right") - 1
                children += np.bincount(parent[below["node"] < 0], minlength=len(start))
                own = node[parent] < 0
                below["parent_conv"] = np.where(own, conv[parent], 0)
                below["parent_node"] = node[parent]
                yield below
            done = node < 0
            leaves[start] += done & (children == 0)
            saved[start] += np.where(done, (n_convs - 1) * chars, 0)
            below = {"node": node, "depth": np.full(len(start), depth), "conv_id": conv, "n_convs": n_convs,
                     "n_children": children, "n_leaves": np.add.reduceat(leaves[rows], cut),
                     "saved_tokens": np.add.reduceat(saved[rows], cut), "chars": chars,
                     "ends": ending & (self.tail[start] < 0), "ends_rep": self.rep[start]}
            start_below = start
        if below is not None:
            yield below | {"parent_conv": np.zeros(len(start_below), dtype=np.int64),
                           "parent_node": np.full(len(start_below), -1)}


NODES = ("node", "depth", "conv_id", "parent_conv", "parent_node", "n_convs", "n_children", "n_leaves", "saved_tokens",
         "chars", "ends_rep")


def finish(paths: DataFrame, skeleton: Skeleton) -> DataFrame:
    """The nodes of all shards; paths: shard, rep, weight, tail, digests, chars, in order inside a task."""
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
        now, parts = None, []
        for batch in batches:
            number = batch.column("shard").to_numpy()
            edges = np.flatnonzero(np.diff(number)) + 1
            for low, high in zip([0, *edges], [*edges, len(number)], strict=True):
                if high > low:
                    if parts and number[low] != now:
                        yield shard_of(parts)
                        parts = []
                    now = number[low]
                    parts.append(batch.slice(low, high - low))
        if parts:
            yield shard_of(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches):
            for level in shard.nodes(skeleton):
                nulls = {"ends_rep": ~level["ends"], "parent_conv": (level["parent_node"] >= 0) | (level["depth"] == 0)}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(level[c].astype(np.int64), mask=nulls.get(c)) for c in NODES], names=list(NODES))

    return paths.mapInArrow(run, ", ".join(f"{c} long" for c in NODES))


def shard_of(parts: list[pa.RecordBatch]) -> Shard:
    table = pa.Table.from_batches(parts).combine_chunks()
    column = lambda name: table.column(name).chunk(0)
    digests = column("digests")
    sizes = digests.value_lengths().to_numpy()
    numbers = [column(c).to_numpy() for c in ("rep", "weight", "tail")]
    return Shard(*numbers, np.concatenate(([0], np.cumsum(sizes))), pairs_in(digests.flatten()),
                 column("chars").flatten().to_numpy())


# --- the trie -----------------------------------------------------------------------------

def reduce_skeleton(partial: list) -> list[tuple]:
    """Whole values of the skeleton nodes from their reduced sums: node, depth, conv_id, parent_conv, n_convs, ..., ends_rep."""
    nodes = {r["node"]: r.asDict() | {"leaves": 0, "saved": 0} for r in partial}
    # Reduced sums hold all that shards have finished below a node; what skeleton nodes add themselves goes up here.
    for r in sorted(nodes.values(), key=lambda r: -r["depth"]):
        r["leaves"] += r["n_children"] == 0
        r["saved"] += (r["n_convs"] - 1) * r["chars"]
        if r["parent_node"] >= 0:
            above = nodes[r["parent_node"]]
            above["n_children"] += 1
            above["leaves"] += r["leaves"]
            above["saved"] += r["saved"]
    for r in nodes.values():
        r["n_leaves"] += r["leaves"]
        r["saved_tokens"] += r["saved"]
    return [(r["node"], r["depth"], r["conv_id"], nodes[r["parent_node"]]["conv_id"] if r["parent_node"] >= 0 else None,
             *(r[c] for c in ("n_convs", "n_children", "n_leaves", "saved_tokens", "ends_rep"))) for r in nodes.values()]


def chains(rows: DataFrame, cuts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of the rests that belong to one path each, and their chars by path (rep, tail)."""
    rest = settle(rows.join(cuts, "rep").where("pos > cut").select("rep", "weight", "pos", "chars", "last"), "rests")
    summed = running_totals(rest, Series.measure(rest, ["rep"], ["pos"]), {"up_to": "chars"}, {"tail": "chars"})
    nodes = summed.select(
        F.col("pos").alias("depth"), F.col("rep").alias("conv_id"), F.col("rep").alias("parent_conv"), F.col("weight").alias("n_convs"),
        (~F.col("last")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("weight") - 1) * (F.col("tail") - F.col("up_to") + F.col("chars"))).alias("saved_tokens"),
        F.when(F.col("last"), F.col("rep")).alias("ends_rep"))
    return nodes, rest.groupBy("rep").agg(F.sum("chars").alias("tail"))


def ends_digests(ends: DataFrame, groups: DataFrame) -> DataFrame:
    """For each path that conversations end with: rep, ends_sha256 of their ids in order."""
    many = groups.where(F.col("weight") > LISTED)
    hot = not many.isEmpty()
    usual = ends.join(many, ["depth", "prefix"], "left_anti") if hot else ends
    text = F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",")
    out = usual.groupBy("depth", "prefix").agg(F.min("conv_id").alias("rep"), F.sha2(text, 256).alias("ends_sha256")).select(
        "rep", "ends_sha256")
    if not hot:
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([digest.hexdigest()])], names=["rep", "ends_sha256"])

        now = digest = None
        for batch in batches:
            for rep, conv in zip(batch.column("rep").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if rep != now:
                    if now is not None:
                        yield row()
                    now, digest = rep, hashlib.sha256()
                digest.update(f",{conv}".encode() if rep != conv else str(conv).encode())
        if now is not None:
            yield row()

    # A digest is read in one go: one task a path, in order, holding one batch.
    ordered = ends.join(many, ["depth", "prefix"]).select("rep", "conv_id").repartition("rep").sortWithinPartitions("rep", "conv_id")
    return out.unionByName(ordered.mapInArrow(run, out.schema))


def prefix_trie(rows: DataFrame, **columns: str) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = rows.sparkSession
    turns, turnless = rebuilt(settle(placed_turns(rows, **columns), "placed"))
    walked = settle(prefixes(turns), "prefixes")
    zero = F.lit(0).cast("long")
    ends = settle(walked.where("last").select("conv_id", F.col("pos").alias("depth"), "prefix").unionByName(
        turnless.select("conv_id", zero.alias("depth"), F.lit(0).cast(DIGEST).alias("prefix"))), "ends")
    groups = settle(ends.groupBy("depth", "prefix").agg(F.min("conv_id").alias("rep"), F.count("*").alias("weight")), "groups")
    reps = groups.select("rep", "weight")
    own = settle(walked.withColumnRenamed("conv_id", "rep").join(reps, "rep"), "own")

    # Where a path is alone at a multiple of STEP, what follows is its own chain.
    marks = own.where(F.col("pos") % STEP == 0)
    alone = marks.groupBy("prefix").agg(F.count("*").alias("n"), F.min("rep").alias("rep"), F.min("pos").alias("pos")).where("n = 1")
    cuts = settle(alone.groupBy("rep").agg(F.min("pos").alias("cut")), "cuts")
    chained = None
    kept, tails = own, None
    if not cuts.isEmpty():
        chained, tails = chains(own, cuts)
        kept = own.join(cuts, "rep", "left").where("cut IS NULL OR pos <= cut")
    listed = kept.groupBy("rep", "weight").agg(F.array_sort(F.collect_list(F.struct("pos", "prefix", "chars"))).alias("turns"))
    empty = groups.where("depth = 0").select("rep", "weight", F.array().cast(f"array<{DIGEST}>").alias("digests"),
                                             F.array().cast("array<bigint>").alias("chars"))
    paths = listed.select("rep", "weight", F.col("turns.prefix").alias("digests"), F.col("turns.chars").alias("chars")).unionByName(empty)
    paths = paths.join(tails, "rep", "left") if tails is not None else paths.withColumn("tail", F.lit(None).cast("long"))
    paths = paths.withColumn("tail", F.coalesce("tail", F.lit(-1).cast("long")))
    shards = max(1, min(MOST_SHARDS, -(-own.count() // SHARD)))
    ranged = settle(paths.repartitionByRange(shards, "digests").withColumn("shard", F.spark_partition_id()), "shards")
    splitters = [r["first"] for r in ranged.groupBy("shard").agg(F.min("digests").alias("first")).collect()]
    skeleton = Skeleton.of(splitters)
    found = settle(finish(ranged.repartition(shards, "shard").sortWithinPartitions("shard", "digests"), skeleton), "nodes")

    partial = found.where("node >= 0").groupBy("node", "depth", "parent_node").agg(
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"), F.max("ends_rep").alias("ends_rep")).collect()
    names = ("depth", "conv_id", "parent_conv", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_rep")
    bones = spark.createDataFrame(reduce_skeleton(partial), "node long, " + ", ".join(f"{c} long" for c in names))
    above = F.broadcast(bones.select(F.col("node").alias("parent_node"), F.col("conv_id").alias("above")))
    finished = found.where("node < 0").join(above, "parent_node", "left").withColumn("parent_conv", F.coalesce("parent_conv", "above"))
    nodes = finished.select(*names).unionByName(bones.select(*names))
    if chained is not None:
        nodes = nodes.unionByName(chained.select(*names))
    told = nodes.where("ends_rep IS NOT NULL").join(
        ends_digests(ends, groups).withColumnRenamed("rep", "ends_rep"), "ends_rep").drop("ends_rep")
    silent = nodes.where("ends_rep IS NULL").drop("ends_rep").withColumn("ends_sha256", F.lit(NO_ENDS))
    return told.unionByName(silent).withColumnRenamed("parent_conv", "parent_conv_id")
