"""Near duplicates among embeddings: a robust-pruned flat graph and range search on it.

Centres that lie as close as near copies are one cluster, so a tight group isn't torn.
Vectors go to their nearest cluster and to all that are hardly farther, so neighbouring
clusters overlap. Each cluster is a shard (a large one is several, dealt by id). A shard's
graph links every vector to candidates that robust pruning leaves. The lists of a vector
from its shards are united to one flat graph. The search then runs shard by shard: from a
few medoids it goes greedily to a vector's surroundings, and from there over all links as
long as the cosine stays near the threshold; a vector whose surroundings are a large part of
the shard is compared with all of it. A vector that the greedy part doesn't lead back to
itself starts again at itself. Pairs found are verified in double precision and counted
in the first of the clusters that both have.

Recall is audited: some vectors are compared with all others. What their pairs need tells
how far clusters overlap, as long as a vector is in ``COPIES`` clusters on average at most; then the links found are
counted against theirs, and while they are too few, clusters overlap more within that bound and the search follows worse
links. Where that doesn't help, all vectors of the clusters whose audited vectors still miss links are
compared with every vector, block by block, and the graph serves the others.

Equal vectors are compared once, with a weight. Pairs aren't written: a task gives each of its
vectors a number of links and the smallest id of its local component.

Defined results: vectors that are null, zero or hold null or non-finite components link
with nothing; of rows that share an id the smallest vector counts, and each row gets the
id's result; a null id has no links, no component and isn't kept; vectors of different
lengths don't link; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemos.llm.components import components
from anemos.llm.vectors import beam_search, cosines, diverse, matrix, nearest_in_blocks, unit, usable, with_reverse
from anemos.session import settle

THRESHOLD = 0.9
#: Rows of a shard at most on average; rows that clusters are fitted on at most; of these per cluster at least.
SHARD, SAMPLE, PER_CLUSTER = 2048, 50_000, 10
#: Links chosen per vector and kept with those of others; candidates to choose from, of these far ones; pruning factor.
LINKS, KEPT, WIDTH, FAR, ALPHA = 16, 32, 40, 8, 1.2
#: Medoids to start from; beam; how far below the threshold links are still followed; searches at once.
MEDOIDS, BEAM, SLACK, BLOCK = 16, 24, 0.05, 256
#: Part of a shard from which on a vector is compared with the whole shard; cosines nearer to the threshold are summed again.
DENSE, CLOSE = 0.1, 1e-9
#: How much less than with its nearest cluster a vector's cosine with others of its clusters may be; the last is all clusters.
OVERLAPS = (0.02, 0.04, 0.06, 0.08, 0.1, 0.15, 0.25, 0.5, 4.0)
#: Clusters a vector may be in on average; vectors of failing clusters that are compared with all at once.
COPIES, TOGETHER = 8, 8192
#: Vectors compared with all others; share of their pairs that clusters must hold, and of their links to be found.
AUDITED, HELD, RECALL = 2000, 0.995, 0.99

log = logging.getLogger(__name__)


def centroids(vectors: DataFrame, count: int, shard_rows: int, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Unit centres of clusters for each vector length, fitted on at most ``sample`` rows with the smallest hashed ids."""
    wanted = max(1, -(-2 * count // shard_rows))
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(
        min(sample, max(1000, wanted * PER_CLUSTER))).toPandas()
    out = {}
    for size, own in rows.groupby(rows["vector"].map(len)):
        units = unit(np.array(own["vector"].to_list()))
        k = max(1, min(-(-wanted * len(own) // len(rows)), len(own) // PER_CLUSTER))
        centres = units[:k]
        for _ in range(4):
            nearest = np.argmax(units @ centres.T, axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, nearest, units)
            full = np.abs(sums).max(axis=1) > 0
            centres[full] = unit(sums[full])
        out[size] = centres
    return out


def merged(centres: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres ordered by cluster, and where each cluster starts: a centre takes all free ones that would link with it."""
    leader = np.full(len(centres), -1)
    for i in range(len(centres)):
        if leader[i] < 0:
            leader[(leader < 0) & (centres @ centres[i] >= threshold)] = i
            leader[i] = i
    order = np.argsort(leader, kind="stable")
    return centres[order], np.unique(leader[order], return_index=True)[1]


def gaps(units: np.ndarray, clusters: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How much less each row's cosine with each cluster (its nearest centre) is than with the row's nearest cluster."""
    centres, starts = clusters
    cos = np.maximum.reduceat(units @ centres.T, starts, axis=1)
    return cos.max(axis=1, keepdims=True) - cos


def memberships(vectors: DataFrame, clusters: dict[int, tuple[np.ndarray, np.ndarray]], overlap: float) -> DataFrame:
    """Each vector once per cluster it belongs to: cluster, others (all its clusters, ascending), and the columns it has.

    A cluster's number also tells the length of its vectors.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(clusters)  # at most SAMPLE / PER_CLUSTER vectors
    base = max((len(c[1]) for c in clusters.values()), default=0) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            sizes = np.diff(column.offsets.to_numpy())
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                for low in range(0, len(rows), 1024):
                    part = batch.take(pa.array(rows[low:low + 1024]))
                    # A length that the sample doesn't hold is one cluster.
                    own = shared.value.get(int(size), (np.zeros((1, size)), np.zeros(1, dtype=int)))
                    row, cluster = np.nonzero(gaps(unit(matrix(part.column("vector"))), own) <= overlap)
                    cluster = cluster + base * int(size)
                    edges = np.searchsorted(row, np.arange(part.num_rows + 1))
                    every = [cluster[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cluster, pa.int64()), pa.array([every[r] for r in row], pa.list_(pa.int64())),
                         *part.take(pa.array(row)).columns],
                        names=["cluster", "others", *batch.schema.names])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields)
    return vectors.mapInArrow(run, f"cluster long, others array<long>, {kinds}")


def audit(vectors: DataFrame, clusters: dict[int, tuple[np.ndarray, np.ndarray]], threshold: float,
          count: int = AUDITED) -> tuple[dict[int, int], np.ndarray, np.ndarray, dict[int, tuple[int, int]]]:
    """Some vectors against all: the links of each that has any, what share of its pairs clusters hold for each overlap,
    in how many clusters a vector is then, and each one's length and nearest cluster.

    The vectors are those with the smallest hashed ids. Each one's pairs count as a whole, so a
    large group doesn't hide the small ones.
    """
    rows = vectors.select("vec_id", "vector").orderBy(F.xxhash64(F.col("vec_id"), F.lit("audit")), "vec_id").limit(count).toPandas()
    asked = {}
    for size, own in rows.groupby(rows["vector"].map(len)):
        units = unit(np.array(own["vector"].to_list()))
        held = clusters.get(int(size), (np.zeros((1, size)), np.zeros(1, dtype=int)))
        asked[int(size)] = (own["vec_id"].to_numpy(), units, gaps(units, held), held)
    shared = vectors.sparkSession.sparkContext.broadcast(asked)  # AUDITED vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, pairs = {}, {}
        for batch in batches:
            column, ids = batch.column("vector"), batch.column("vec_id").to_numpy()
            weight = batch.column("weight").to_numpy()
            sizes = np.diff(column.offsets.to_numpy())
            for size in np.intersect1d(sizes, list(shared.value)):
                rows = np.flatnonzero(sizes == size)
                own, queries, apart, held = shared.value[int(size)]
                if int(size) not in links:
                    links[int(size)], pairs[int(size)] = np.zeros(len(own), int), np.zeros((len(own), len(OVERLAPS)), int)
                for low in range(0, len(rows), 1024):
                    part = rows[low:low + 1024]
                    units = unit(matrix(column.take(pa.array(part))))
                    q, r = np.nonzero(reaches(queries, units, threshold) & (own[:, None] != ids[part]))
                    np.add.at(links[int(size)], q, weight[part[r]])
                    need, away = np.zeros(len(q)), gaps(units, held)
                    # Most pairs have the same nearest cluster.
                    far = np.flatnonzero(apart.argmin(axis=1)[q] != away.argmin(axis=1)[r])
                    for at in range(0, len(far), 1024):
                        some = far[at:at + 1024]
                        need[some] = np.maximum(apart[q[some]], away[r[some]]).min(axis=1)
                    np.add.at(pairs[int(size)], (q, np.searchsorted(OVERLAPS, need)), 1)
        for size, total in links.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shared.value[size][0][some]), pa.array(total[some]), pa.array(list(pairs[size][some]), pa.list_(pa.int64()))],
                names=["vec_id", "links", "pairs"])

    told = vectors.select("vec_id", "vector", "weight").mapInArrow(run, "vec_id long, links long, pairs array<long>").groupBy(
        "vec_id").agg(F.sum("links").alias("links"), *(F.sum(F.col("pairs")[i]).alias(f"p{i}") for i in range(len(OVERLAPS)))).toPandas()
    pairs = told[[f"p{i}" for i in range(len(OVERLAPS))]].to_numpy(dtype=float)
    share = (pairs.cumsum(axis=1) / pairs.sum(axis=1, keepdims=True)).mean(axis=0) if len(told) else np.ones(len(OVERLAPS))
    copies = np.concatenate([(a[2][:, :, None] <= np.array(OVERLAPS)).sum(axis=1) for a in asked.values()]).mean(axis=0) if asked else np.ones(
        len(OVERLAPS))
    homes = {int(i): (size, int(c)) for size, (ids, _, apart, _) in asked.items() for i, c in zip(ids, apart.argmin(axis=1), strict=True)}
    return dict(zip(told["vec_id"].tolist(), told["links"].tolist(), strict=True)), share, copies, homes


def reaches(queries: np.ndarray, units: np.ndarray, threshold: float) -> np.ndarray:
    """Whether each query's cosine with each row reaches the threshold, near it by the sum that single pairs get."""
    cos = queries @ units.T
    hit = cos >= threshold
    row, node = np.nonzero(np.abs(cos - threshold) < CLOSE)
    hit[row, node] = cosines(queries[row], units[node]) >= threshold
    return hit


def build_graph(units: np.ndarray) -> np.ndarray:
    """Neighbours of each row of one shard: robust pruning over the nearest rows and some far ones; -1 fills up."""
    n = len(units)
    near, cos = nearest_in_blocks(units, np.arange(n), WIDTH)
    # Rows at fixed steps are far ones for each row, so that tight groups stay reachable from outside.
    far = (np.arange(n)[:, None] + (np.arange(1, FAR + 1) * max(1, n // (FAR + 1)))[None]) % n
    far_cos = np.stack([cosines(units, units[far[:, k]]) for k in range(FAR)], axis=1)
    far = np.where(far == np.arange(n)[:, None], -1, far)
    chosen = diverse(near, cos, units, LINKS - FAR // 2, ALPHA)
    order = np.argsort(-far_cos, axis=1, kind="stable")
    wide = diverse(np.take_along_axis(far, order, 1).astype(np.int32), np.take_along_axis(far_cos, order, 1), units,
                   FAR // 2, ALPHA)
    return with_reverse(np.concatenate((chosen, wide), axis=1), KEPT)


def medoids(units: np.ndarray, count: int = MEDOIDS) -> np.ndarray:
    """The row nearest to the mean of each of some groups around evenly spaced rows."""
    seeds = np.unique(np.linspace(0, len(units) - 1, min(count, len(units))).astype(int))
    group = np.argmax(units @ units[seeds].T, axis=1)
    out = []
    for g in np.unique(group):
        own = np.flatnonzero(group == g)
        out.append(own[np.argmax(units[own] @ units[own].mean(axis=0))])
    return np.array(out, dtype=np.int32)


def range_search(units: np.ndarray, links: np.ndarray, threshold: float, wider: int = 1) -> np.ndarray:
    """Whether each two rows are found and their cosine reaches the threshold: a symmetric matrix, as a shard is small."""
    n, starts, low_cos = len(units), medoids(units), threshold - SLACK * wider
    pairs = np.zeros((n, n), dtype=bool)
    for low in range(0, n, BLOCK):
        own = np.arange(low, min(low + BLOCK, n))
        queries = units[own]
        beam, cos = beam_search(queries, units, links, np.repeat(starts[None], len(own), axis=0), BEAM * wider)
        lost = np.flatnonzero(~(beam == own[:, None]).any(axis=1))
        if len(lost):
            start = np.concatenate((own[lost, None].astype(np.int32), beam[lost]), axis=1)
            beam[lost], cos[lost] = beam_search(queries[lost], units, links, start, BEAM * wider)
        seen = np.zeros(len(own) * n, dtype=bool)
        row, place = np.nonzero(beam >= 0)
        seen[row * n + beam[row, place]] = True
        row, place = np.nonzero((beam >= 0) & (cos >= low_cos))
        node = beam[row, place].astype(np.int64)
        while len(row):
            dense = np.bincount(row, minlength=len(own)) > max(DENSE * n, BEAM * wider)
            if dense.any():
                pairs[own[dense]] |= reaches(queries[dense], units, threshold)
                row, node = row[~dense[row]], node[~dense[row]]
            value = cosines(queries[row], units[node])
            hit = value >= threshold
            pairs[own[row[hit]], node[hit]] = True
            follow = value >= low_cos
            row, node = row[follow], node[follow]
            fresh = np.zeros_like(seen)
            onward = links[node]
            fresh[(row[:, None] * n + onward)[onward >= 0]] = True
            fresh &= ~seen
            seen |= fresh
            row, node = np.divmod(np.flatnonzero(fresh), n)
    pairs |= pairs.T
    np.fill_diagonal(pairs, False)
    return pairs


def local_roots(pairs: np.ndarray) -> np.ndarray:
    """The smallest row reachable from each row."""
    n = len(pairs)
    root = np.arange(n)
    while True:
        new = np.concatenate([np.where(pairs[low:low + BLOCK], root, n).min(axis=1) for low in range(0, n, BLOCK)])
        new = np.minimum(root, new)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_links(vectors: DataFrame, threshold: float = THRESHOLD, shard_rows: int = SHARD) -> DataFrame:
    """Weighted links and local components, per task: vec_id, links, root. ``vectors``: vec_id, vector, weight (stored)."""
    fitted = centroids(vectors, vectors.count(), shard_rows)
    clusters = {size: merged(centres, threshold) for size, centres in fitted.items()}
    exact, held, copies, homes = audit(vectors, clusters, threshold)
    top = max(0, int((copies <= COPIES).sum()) - 1)
    level, wider = min(int(np.argmax(held >= HELD)), top), 1
    known = vectors.sparkSession.createDataFrame(list(exact.items()), "vec_id long, exact long")
    while True:
        found = settle(found_links(vectors, clusters, OVERLAPS[level], threshold, shard_rows, wider), "found")
        counts = F.broadcast(known).join(found, "vec_id", "left").groupBy("vec_id", "exact").agg(F.sum("links").alias("links"))
        shares = {r["vec_id"]: (r["links"] or 0) / r["exact"] for r in counts.collect()}
        recall = sum(shares.values()) / len(exact) if exact else 1.0
        log.info("overlap %s (%.1f clusters a vector) holds %.4f of the pairs of %d vectors with links, %.4f of their links found",
                 OVERLAPS[level], copies[level], held[level], len(exact), recall)
        if recall >= RECALL:
            return found
        if level == top and SLACK * wider > 2:
            break
        level, wider = min(level + 1, top), wider * 2
    failing = {homes[i] for i, share in shares.items() if share < RECALL}
    log.info("vectors of %d clusters are compared with all", len(failing))
    marked = settle(mark(vectors, clusters, failing), "marked")
    others = found_links(marked.where("NOT failing").drop("failing"), clusters, OVERLAPS[level], threshold, shard_rows, wider)
    return settle(others.unionByName(links_with_all(marked, threshold)), "found")


def mark(vectors: DataFrame, clusters: dict[int, tuple[np.ndarray, np.ndarray]], failing: set[tuple[int, int]]) -> DataFrame:
    """Add whether a vector's nearest cluster is one of the failing ones (length, cluster)."""
    shared = vectors.sparkSession.sparkContext.broadcast((clusters, failing))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, bad = shared.value
        for batch in batches:
            column = batch.column("vector")
            sizes = np.diff(column.offsets.to_numpy())
            out = np.zeros(batch.num_rows, dtype=bool)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                numbers = [c for n, c in bad if n == size]
                for low in range(0, len(rows) if numbers else 0, 1024):
                    part = rows[low:low + 1024]
                    held = own.get(int(size), (np.zeros((1, size)), np.zeros(1, dtype=int)))
                    out[part] = np.isin(gaps(unit(matrix(column.take(pa.array(part)))), held).argmin(axis=1), numbers)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "failing"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields)
    return vectors.mapInArrow(run, f"{kinds}, failing boolean")


def links_with_all(marked: DataFrame, threshold: float) -> DataFrame:
    """All links of the failing vectors: vec_id, links, root. Others get their links with failing ones only.

    A block of some ``TOGETHER`` failing vectors at a time is sent to every task, so work is their number times all.
    """
    spark = marked.sparkSession
    blocks = -(-marked.where("failing").count() // TOGETHER)
    dealt = marked.withColumn("block", F.when(F.col("failing"), F.pmod(F.xxhash64(F.col("vec_id"), F.lit("block")), F.lit(blocks))))
    out = None
    for number in range(blocks):
        block = dealt.where(F.col("block") == number).select("vec_id", "vector", "weight").toPandas()
        asked = {int(size): (own["vec_id"].to_numpy(), unit(np.array(own["vector"].to_list())), own["weight"].to_numpy())
                 for size, own in block.groupby(block["vector"].map(len))}
        shared = spark.sparkContext.broadcast(asked)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = batch.column("vector")
                ids, weight = batch.column("vec_id").to_numpy(), batch.column("weight").to_numpy()
                failing = batch.column("failing").to_numpy(zero_copy_only=False)
                sizes = np.diff(column.offsets.to_numpy())
                for size in np.intersect1d(sizes, list(shared.value)):
                    rows = np.flatnonzero(sizes == size)
                    names, queries, weights = shared.value[int(size)]
                    for low in range(0, len(rows), 1024):
                        part = rows[low:low + 1024]
                        hit = reaches(queries, unit(matrix(column.take(pa.array(part)))), threshold) & (names[:, None] != ids[part])
                        q, r = np.nonzero(hit.any(axis=1))[0], np.nonzero(hit.any(axis=0))[0]
                        hit, other = hit[np.ix_(q, r)], ids[part][r]
                        root, back = names[q].copy(), other.copy()
                        while len(q):  # the smallest id that each is linked to, over any number of links of this block
                            new_back = np.minimum(back, np.where(hit, root[:, None], back[None]).min(axis=0))
                            new_root = np.minimum(root, np.where(hit, new_back[None], root[:, None]).min(axis=1))
                            if (new_root == root).all() and (new_back == back).all():
                                break
                            root, back = new_root, new_back
                        # A failing vector is counted as a query, in its own block.
                        told = np.where(failing[part][r], 0, weights[q] @ hit) if len(q) else np.zeros(0, dtype=np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.concatenate((names[q], other))),
                             pa.array(np.concatenate((hit @ weight[part][r], told)).astype(np.int64)),
                             pa.array(np.concatenate((root, back)))], names=["vec_id", "links", "root"])

        part = settle(marked.mapInArrow(run, "vec_id long, links long, root long"), "with-all")
        shared.unpersist()
        out = part if out is None else out.unionByName(part)
    return out


def found_links(vectors: DataFrame, clusters: dict[int, tuple[np.ndarray, np.ndarray]], overlap: float, threshold: float,
                shard_rows: int, wider: int) -> DataFrame:
    """One search of all shards: vec_id, links, root."""
    rows = settle(memberships(vectors, clusters, overlap), "members")
    parts = rows.groupBy("cluster").agg(F.ceil(F.count("*") / shard_rows).alias("parts"))
    dealt = settle(rows.join(parts, "cluster").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts"))), "shards")

    def build(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("vec_id")
        ids = table.column("vec_id").combine_chunks().to_numpy()
        links = build_graph(unit(matrix(table.column("vector").combine_chunks()))) if len(ids) > 1 else np.zeros((1, 0), int)
        named = np.where(links >= 0, ids[links], -1)
        return pa.table({"vec_id": pa.array(ids), "links": pa.array(list(named), pa.list_(pa.int64()))})

    lists = dealt.select("cluster", "part", "vec_id", "vector").groupBy("cluster", "part").applyInArrow(
        build, "vec_id long, links array<long>")
    # One list of KEPT ids for each cluster of a vector.
    graph = lists.groupBy("vec_id").agg(F.array_distinct(F.flatten(F.collect_list("links"))).alias("links"))
    # A cluster of several shards is searched by pairs of shards, so each pair of its vectors meets in a task.
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("with")
    tasks = dealt.join(graph, "vec_id").select("*", first).where(
        "parts = 1 OR with <> part").select("cluster", F.least("part", "with").alias("low"),
                                           F.greatest("part", "with").alias("high"), "part", "others", "vec_id", "vector",
                                           "weight", "links")

    def find(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("vec_id")
        number = lambda name: table.column(name).combine_chunks().to_numpy()
        ids, part, weight = number("vec_id"), number("part"), number("weight").astype(float)
        cluster, low, high = (number(x)[0] for x in ("cluster", "low", "high"))
        units = unit(matrix(table.column("vector").combine_chunks()))
        source, named = entries(table.column("links"))
        place = np.minimum(np.searchsorted(ids, named), len(ids) - 1)
        known = ids[place] == named
        source, place = source[known], place[known]
        at = np.arange(len(source)) - np.searchsorted(source, source)
        links = np.full((len(ids), int(at.max(initial=0)) + 1), -1, dtype=np.int32)
        links[source, at] = place
        pairs = range_search(units, links, threshold, wider)
        root = local_roots(pairs)
        # Pairs that share an earlier cluster are counted there.
        source, named = entries(table.column("others"))
        source, named = source[named < cluster], named[named < cluster]
        names, column = np.unique(named, return_inverse=True)
        earlier = np.zeros((len(ids), len(names)), dtype=np.float32)
        earlier[source, column] = 1
        total = np.zeros(len(ids))
        for start in range(0, len(ids), BLOCK):
            own = slice(start, start + BLOCK)
            # Two shards: pairs across, and those within the first only in its pair with the next shard.
            within = part[own, None] == part
            span = ~within | (low == high) | ((part == low) & (high == low + 1)) | (
                (part == high) & (low == high - 1) & (high == number("last")[0]))
            counted = pairs[own] & span
            if len(names):
                counted &= earlier[own] @ earlier.T == 0
            total[own] = counted @ weight
        keep = (total > 0) | (root != np.arange(len(ids)))
        return pa.table({"vec_id": pa.array(ids[keep]), "links": pa.array(total[keep].astype(np.int64)),
                         "root": pa.array(ids[root[keep]])})

    last = tasks.join(parts.select("cluster", (F.col("parts") - 1).alias("last")), "cluster")
    return last.groupBy("cluster", "low", "high").applyInArrow(find, "vec_id long, links long, root long")


def entries(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All entries of a column of lists, each with its row."""
    lists = column.combine_chunks()
    return np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy(zero_copy_only=False)


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                    shard_rows: int = SHARD) -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept (the smallest id of its component)."""
    valid = settle(usable(rows, id_col, vector_col), "vectors")
    same = settle(valid.groupBy("vector").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("weight")), "distinct")
    found = near_links(same.select("vec_id", "vector", "weight"), threshold, shard_rows)
    links = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    groups = components(found, "vec_id", "root").withColumnRenamed("id", "vec_id")
    classes = same.join(links, "vec_id", "left").join(groups, "vec_id", "left").select(
        "vector", F.col("vec_id").alias("first"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component"))
    # Equal vectors share a class; only repeated vectors need the join by vector.
    by_id = valid.join(classes, "vector").select(F.col("vec_id").alias("_id"), "n_links", "component")
    own = rows.select(F.col(id_col).alias("vec_id"))
    return own.join(by_id, F.col("vec_id") == F.col("_id"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", F.col("vec_id").cast("long")).alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", F.col("vec_id").cast("long")), F.lit(False)).alias("kept"))
