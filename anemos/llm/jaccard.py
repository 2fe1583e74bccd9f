"""N-gram Jaccard join: all documents whose sets of word shingles overlap enough, by T-occurrence search.

Sets that reach the threshold share a number of shingles among the first of each, in any one
order of all shingles (prefix filter with a count). Frequent shingles, which are counted first,
come last in that order. A document of whose first shingles too few are held by any other one has
no link and is left out. Of the rest, only the rarest of the shared first shingles count: as many as
make sure that similar documents still have one in common. So a passage that many documents
share, always more frequent than what near copies of one text share, brings nobody together.
Documents tied by such a shingle form blocks, and no link leaves a block.
Inside a block every document asks for those that occur often enough in the inverted lists of its
shingles: short lists are merged and counted, the longest ones are only probed by binary search
for what the merge left (DivideSkip). Links between documents that are already in one component
aren't looked for, so a group of thousands of near copies costs one verified link per document.

Equal sets within an input partition are represented by one; a block above a bound is cut into
tiles, and each pair of tiles is a task. Nothing is capped: every link is within or between tiles.

Defined results: a null or empty text, or one of white space, has an empty set and links with
nothing; fewer words than a shingle make one shingle of all; repeated rows of an id give a row
each and share its component; a null id has no component; an empty table gives no rows; columns
other than the two named are not read. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemos.llm.components import components
from anemos.llm.textarrays import chunks, mix, shingle_sets
from anemos.session import settle

WORDS, PERCENT = 5, 75
#: A shingle in more than this share of the documents is frequent. At most (average set size / share) shingles are.
FREQUENT = 1e-4
#: Shingles handled at once by a scan; shingles of a tile; weight of merging against probing in DivideSkip; postings
#: merged in the time of a probe.
TOGETHER, TILE, MU, PROBE = 1 << 21, 1 << 21, 0.01, 8
#: Percent of the smaller set that similar sets must share among their first shingles.
SHARE = 15
POSTING, SHARED, COPY, DOCUMENT = range(4)


def least_overlap(a, b, percent: int = PERCENT):
    """Shingles that sets of sizes a and b must share to reach the threshold."""
    return -(-percent * (a + b) // (100 + percent))


def frequent_shingles(docs: DataFrame, text_col: str, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many documents hold, sorted by hash, and their counts. They only decide an order.

    Each scan task counts what it has seen several times; the sums come to the driver if they pass
    ``FREQUENT`` of the documents, which bounds their number whatever the corpus.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for texts in chunks(batch.column(0)):
                sets = shingle_sets(texts, words)
                held += sets
                size += sum(map(len, sets))
                if size >= TOGETHER:
                    yield repeated(held)
                    held, size = [], 0
        if held:
            yield repeated(held)

    def repeated(sets: list[np.ndarray]) -> pa.RecordBatch:
        found, n = np.unique(np.concatenate(sets), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found[n > 1].view(np.int64)), pa.array(n[n > 1])], names=["s", "n"])

    least = max(2.0, FREQUENT * docs.count())
    sums = docs.select(text_col).mapInArrow(count, "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
    out = sums.where(F.col("n") > least).toPandas()
    order = np.argsort(out["s"].to_numpy().view(np.uint64))
    return out["s"].to_numpy().view(np.uint64)[order], out["n"].to_numpy()[order]


def first_shingles(own: np.ndarray, frequent: np.ndarray, counts: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The part of a set of which any set reaching the threshold shares ``needed`` with its own first part.

    Rare shingles come first, by hash, then frequent ones by count.
    """
    wanted = len(own) - -(-percent * len(own) // 100) + max(1, SHARE * len(own) // 100)
    if not len(frequent):
        return own[:wanted]
    at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
    common = frequent[at] == own
    rare = own[~common]
    if len(rare) >= wanted:
        return rare[:wanted]
    rest = own[common]
    return np.concatenate((rare, rest[np.lexsort((rest, counts[at[common]]))[:wanted - len(rare)]]))


def postings(docs: DataFrame, id_col: str, text_col: str, frequent: Broadcast, words: int, percent: int) -> DataFrame:
    """Rows by kind: POSTING (shingle, a: id), SHARED (shingle, a: id, b: number of holders), COPY (a, b: ids), DOCUMENT
    (a: id, b: size of its set).

    Of equal sets in a task only the first is posted. Frequent shingles, whose number of holders is
    known, need no posting, so no shingle has more postings than the bound of being frequent.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy, counts = frequent.value
        known: dict[tuple, int] = {}  # a set's digest to its first id
        held: list[tuple[int, np.ndarray]] = []
        size = 0
        for batch in batches:
            ids = batch.column(0)
            for texts in chunks(batch.column(1)):
                sets = shingle_sets(texts, words)
                own = ids.slice(texts.first, len(texts)).to_pylist()
                yield rows(DOCUMENT, None, pa.array(own, pa.int64()), np.array([len(s) for s in sets]))
                copies = []
                for doc, s in zip(own, sets, strict=True):
                    if doc is None or not len(s):
                        continue
                    first = known.setdefault((len(s), int(s.sum()), int(mix(s).sum())), doc)
                    if first != doc:
                        copies.append((doc, first))
                    else:
                        held.append((doc, first_shingles(s, heavy, counts, percent)))
                        size += len(held[-1][1])
                if copies:
                    a, b = np.array(copies, dtype=np.int64).T
                    yield rows(COPY, None, a, b)
                if size >= TOGETHER:
                    yield from together(held)
                    held, size = [], 0
        if held:
            yield from together(held)

    def together(held: list[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        heavy, counts = frequent.value
        shingle = np.concatenate([s for _, s in held])
        doc = np.repeat(np.array([d for d, _ in held], dtype=np.int64), [len(s) for _, s in held])
        at = np.minimum(np.searchsorted(heavy, shingle), max(0, len(heavy) - 1))
        common = heavy[at] == shingle if len(heavy) else np.zeros(len(shingle), dtype=bool)
        yield rows(SHARED, None, doc[common], counts[at[common]], shingle[common])
        shingle, doc = shingle[~common], doc[~common]
        for low in range(0, len(shingle), 50_000):
            yield rows(POSTING, shingle[low:low + 50_000], doc[low:low + 50_000], None)

    def rows(kind: int, key, a, b, shingle=None) -> pa.RecordBatch:
        """``key`` deals the rows; those that have none are dealt evenly, and alike if the task runs again."""
        n = len(a)
        if key is None:
            key = mix(np.array(pa.array(a).fill_null(0), dtype=np.int64).view(np.uint64))
        shingle = key if kind == POSTING else shingle
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(n, kind, dtype=np.int8)), pa.array(key.view(np.int64)), pa.array(a, pa.int64()),
            pa.nulls(n, pa.int64()) if b is None else pa.array(b, pa.int64()),
            pa.nulls(n, pa.int64()) if shingle is None else pa.array(shingle.view(np.int64))],
            names=["kind", "key", "a", "b", "shingle"])

    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return own.mapInArrow(scan, "kind byte, key long, a long, b long, shingle long")


def find_shared(rows: DataFrame) -> DataFrame:
    """Postings whose shingle has another one, as SHARED with the number of holders; other kinds pass."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, doc = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)  # postings of the last shingle so far
        for batch in batches:
            is_posting = batch.column(0).to_numpy() == POSTING
            passing = batch.filter(pa.array(~is_posting))
            if len(passing):
                yield pa.RecordBatch.from_arrays([passing.column(i) for i in (0, 4, 2, 3)], names=["kind", "shingle", "a", "b"])
            own = batch.filter(pa.array(is_posting))
            shingle = np.concatenate((shingle, own.column(1).to_numpy()))
            doc = np.concatenate((doc, own.column(2).to_numpy(zero_copy_only=False).astype(np.int64)))
            if len(shingle):
                last = np.searchsorted(shingle, shingle[-1])
                yield shared(shingle[:last], doc[:last])
                shingle, doc = shingle[last:], doc[last:]
        yield shared(shingle, doc)

    def shared(shingle: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate(([True], shingle[1:] != shingle[:-1]))) if len(shingle) else shingle
        holders = np.repeat(np.diff(starts, append=len(doc)), np.diff(starts, append=len(doc))) if len(shingle) else shingle
        several = holders > 1
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(several.sum(), SHARED, dtype=np.int8)), pa.array(shingle[several]), pa.array(doc[several]),
             pa.array(holders[several])], names=["kind", "shingle", "a", "b"])

    return rows.repartition("key").sortWithinPartitions("key", "a").mapInArrow(
        find, "kind byte, shingle long, a long, b long")


def blocks_of(rows: DataFrame, percent: int) -> DataFrame:
    """Documents that may have a link, with their block: id, component. ``rows``: of find_shared."""
    # What a document shares with a similar one at least, among the first shingles of both.
    smallest = F.floor((F.col("b") * percent + 99) / 100)
    least = F.greatest(F.lit(1), F.floor(smallest * SHARE / 100)).cast("long")
    both = rows.where(F.col("a").isNotNull() & F.col("kind").isin(SHARED, DOCUMENT)).select(
        F.col("a").alias("id"), F.when(F.col("kind") == DOCUMENT, -1).otherwise(F.col("b")).alias("holders"),
        F.when(F.col("kind") == DOCUMENT, least).otherwise(F.col("shingle")).alias("shingle"))

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * 3
        for batch in batches:
            kept = [np.concatenate((k, batch.column(i).to_numpy())) for i, k in enumerate(kept)]
            last = np.searchsorted(kept[0], kept[0][-1])  # all rows of a document at once
            yield chosen(*(k[:last] for k in kept))
            kept = [k[last:] for k in kept]
        yield chosen(*kept)

    def chosen(doc: np.ndarray, holders: np.ndarray, shingle: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))) if len(doc) else doc
        size = np.diff(starts, append=len(doc))
        # Sizes of a document's set (several rows of one id: the smallest) come before its shingles.
        heads = np.add.reduceat((holders < 0).astype(np.int64), starts) if len(doc) else doc
        needed = np.where(heads > 0, shingle[starts], 1) if len(doc) else doc
        place = np.arange(len(doc)) - np.repeat(starts + heads, size)
        keep = (place >= 0) & (place <= np.repeat(size - heads - needed, size))
        return pa.RecordBatch.from_arrays([pa.array(doc[keep]), pa.array(shingle[keep])], names=["id", "shingle"])

    first = both.repartition("id").sortWithinPartitions("id", "holders", "shingle").mapInArrow(rarest, "id long, shingle long")
    return components(tie(first), "id", "head")


def tie(rows: DataFrame) -> DataFrame:
    """Each id tied to the first one of its shingle: id, head."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = head = None
        for batch in batches:
            doc, shingle = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(doc):
                continue
            starts = np.flatnonzero(np.concatenate(([True], shingle[1:] != shingle[:-1])))
            firsts = doc[starts]
            if shingle[0] == last:
                firsts[0] = head
            last, head = shingle[-1], firsts[-1]
            ties = np.stack([doc, np.repeat(firsts, np.diff(starts, append=len(doc)))])
            ties = np.unique(ties[:, ties[0] != ties[1]], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(ties[0]), pa.array(ties[1])], names=["id", "head"])

    return rows.repartition("shingle").sortWithinPartitions("shingle", "id").mapInArrow(run, "id long, head long")


def search_block(ids: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Each document's smallest id reachable by links among these sets (sorted hashes, none empty)."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    group: dict[tuple, int] = {}
    which = np.zeros(len(sets), dtype=np.int64)  # number of the distinct set, by size
    distinct: list[np.ndarray] = []
    for i in order:
        key = (len(sets[i]), sets[i].tobytes())
        if key not in group:
            group[key] = len(distinct)
            distinct.append(sets[i])
        which[i] = group[key]
    n = len(distinct)
    label = np.arange(n)
    if n > 1:
        sizes = np.array([len(s) for s in distinct])
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        _, lists = np.unique(np.concatenate(distinct), return_inverse=True)
        # All inverted lists in one array: keys of (list, document), sorted.
        keys = np.sort(lists * n + np.repeat(np.arange(n), sizes))
        starts = np.searchsorted(keys, np.arange(lists.max() + 2) * n)
        members, lengths = keys % n, np.diff(starts)
        smallest = np.searchsorted(sizes, -(-percent * sizes // 100))

        def merged(some: np.ndarray, low: int, high: int) -> np.ndarray:
            """How many of these lists hold each document from low to high; zero below."""
            spread = lengths[some]
            held = members[np.repeat(starts[some] - np.cumsum(spread) + spread, spread) + np.arange(spread.sum())]
            return np.bincount(held[(held >= low) & (held < high)], minlength=high)

        for asking in range(1, n):
            low, size = smallest[asking], sizes[asking]
            own = lists[bounds[asking]:bounds[asking + 1]]
            own = own[lengths[own] > 1]
            least = least_overlap(size, -(-percent * size // 100), percent)
            if low >= asking or len(own) < least:
                continue
            own = own[np.argsort(lengths[own], kind="stable")]
            n_long = min(int(least / (MU * np.log(lengths[own[-1]]) + 1)), least - 1)
            short, long = own[:len(own) - n_long], own[len(own) - n_long:]
            count = merged(short, low, asking)
            found = np.flatnonzero(count >= least - n_long)
            found = found[label[found] != label[asking]]
            if len(found) * n_long * PROBE > lengths[long].sum():  # merging them too costs less than to probe them
                count, long = count + merged(long, low, asking), long[:0]
                found = found[count[found] >= least_overlap(size, sizes[found], percent)]
            found = found[np.argsort(-count[found], kind="stable")]
            while len(found):
                # The likeliest of each component that isn't joined yet.
                _, first = np.unique(label[found], return_index=True)
                tried = found[first]
                probes = (long[None] * n + tried[:, None]).reshape(-1)
                hits = keys[np.minimum(np.searchsorted(keys, probes), len(keys) - 1)] == probes
                shared = count[tried] + hits.reshape(len(tried), -1).sum(axis=1)
                for other in tried[shared >= least_overlap(size, sizes[tried], percent)]:
                    label[label == label[other]] = label[asking]
                found = np.delete(found, first)
                found = found[label[found] != label[asking]]
    own = label[which]
    low = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(low, own, ids)
    return low[own]


def search_blocks(docs: DataFrame, blocks: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """Links a, b (the smallest id of the component within the task). ``blocks``: id, block, tiles."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column(3)):
                packed = [s.tobytes() for s in shingle_sets(texts, words)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(texts.first, len(texts)) for i in range(3)), pa.array(packed, pa.binary())],
                    names=["id", "block", "tiles", "shingles"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ids, held = None, [], []
        for batch in batches:
            for *key, doc, shingles in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4), strict=True):
                if key != task:
                    if len(ids) > 1:
                        yield from answer(ids, held)
                    task, ids, held = key, [], []
                ids.append(doc)
                held.append(np.frombuffer(shingles.as_buffer(), dtype=np.uint64))
        if len(ids) > 1:
            yield from answer(ids, held)

    def answer(ids: list[int], held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        own = np.array(ids, dtype=np.int64)
        first = search_block(own, held, percent)
        tied = own != first
        if tied.any():
            yield pa.RecordBatch.from_arrays([pa.array(own[tied]), pa.array(first[tied])], names=["a", "b"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    packed = blocks.join(texts, "id").select("id", "block", "tiles", "text").mapInArrow(
        sets, "id long, block long, tiles long, shingles binary")
    own = F.pmod(F.xxhash64("id"), F.col("tiles"))
    tasks = packed.withColumn("own", own).withColumn(
        "with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))).where("tiles = 1 OR with <> own").select(
        "block", F.least("own", "with").alias("low"), F.greatest("own", "with").alias("high"), "id", "shingles")
    return tasks.where(F.octet_length("shingles") > 0).repartition("block", "low", "high").sortWithinPartitions(
        "block", "low", "high", "id").mapInArrow(search, "a long, b long")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                      percent: int = PERCENT, tile: int = TILE) -> DataFrame:
    """One row per row: the id, n_shingles, component_id (the smallest id reachable by links)."""
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_shingles(docs, text_col, words))
    rows = settle(find_shared(postings(docs, id_col, text_col, frequent, words, percent)), "postings")
    sizes = rows.where(F.col("kind") == DOCUMENT).select(F.col("a").alias("id"), F.col("b").alias("n"))
    blocks = settle(blocks_of(rows, percent), "blocks")
    tiles = blocks.join(sizes, "id").groupBy("component").agg(F.ceil(F.sum("n") / tile).alias("tiles"))
    dealt = blocks.join(tiles, "component").select("id", F.col("component").alias("block"), "tiles")
    found = search_blocks(docs, dealt, id_col, text_col, words, percent)
    links = settle(found.union(rows.where(F.col("kind") == COPY).select("a", "b")), "similar")
    groups = components(links)
    return sizes.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles")).join(
        groups, F.col(id_col) == F.col("id"), "left").select(
        id_col, "n_shingles", F.coalesce("component", id_col).alias("component_id"))
