"""Removal of repeated byte strings by longest-previous-factor arrays.

A position's previous factor is the longest string that starts there and also starts at an earlier position
(smaller document, or earlier in the same one). In suffix order it is shared with the previous or the next suffix
whose position is smaller, so nearest smaller values on both sides give all factors. Bytes covered by a factor
of ``length`` bytes are removed; first copies stay.

One suffix order of all texts is never needed: only suffixes that agree in ``length`` bytes matter to one another.
1. The least hash of the ``gram``-byte strings inside a window of ``length`` bytes names the window's group, so equal windows share
   a group. Windows side by side with one group form a piece, a few dozen of them. Pieces travel as hashes
   and places, without text: a piece that occurs earlier as a whole repeats in all its windows, so equal pieces count as one
   entry of the order, the first. Groups of one piece have no previous factor.
2. Texts of the remaining pieces, the first of each kind, are fetched by one join. Each group's windows are sorted (sparse
   suffix array), neighbours are compared, and previous factors are taken from nearest smaller positions.
3. Windows of groups beyond ``GROUP_BYTES`` are dealt out by a 128-bit digest instead: equal windows meet, and the first of them
   is the previous factor of the others.

Pieces equal to one that the same task has met often and earlier are decided there. Groups that hold more than
``HEAVY`` of a sample of documents are dealt out by piece as well, so no task gets all of a common line. Sample and
limits choose the way, not the result.

Defined results: a null text is empty; a null id counts as the smallest; rows with the same id are
ordered by a hash of their text, and of equal rows one is first. Ids are longs. Texts shorter than ``length``
lose nothing. An empty table gives no rows; other columns are not read. Matches are compared by
64-bit hashes within a group named by another one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anemos.llm.textarrays import CHUNK, Texts, _Powers, chunks, mix
from anemos.session import fresh_path, settle

LENGTH, GRAM = 100, 40
#: Windows of a piece at most; bytes of pieces sorted together; bytes of a group that one task sorts.
WINDOWS, BATCH_BYTES, GROUP_BYTES = 1023, 1 << 20, 4 << 20
#: Documents sampled to find common groups, and the share of them that makes a group common.
SAMPLED, HEAVY = 20_000, 0.005
#: Frequent pieces that a task remembers.
REMEMBERED = 1 << 16
NO_ID = -(1 << 63)
_U = np.uint64
_POWERS = _Powers()
_BYTE, _OTHER = mix(np.arange(256, dtype=np.uint64)), mix(np.arange(1000, 1256, dtype=np.uint64))
LONGS = "doc long, dg long"


# --- pieces -------------------------------------------------------------------------------

def sliding(x: np.ndarray, width: int, least: Callable) -> np.ndarray:
    """Minimum or maximum of every ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = least(x[:-step], x[step:])
        done += step
    return x


@dataclass
class Pieces:
    """Runs of windows with one group: text number, first byte, windows, group, hash of its bytes, whether it may repeat in itself."""

    text: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    key: np.ndarray
    piece: np.ndarray
    again: np.ndarray


def span_hashes(data: np.ndarray, table: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function from starts and ends to hashes of the bytes between."""
    up, down = _POWERS.reach(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(table[data] * up[:-1], out=sums[1:])
    return lambda low, high: mix((sums[high] - sums[low]) * down[low] + (high - low).astype(np.uint64))


def cut_pieces(texts: Texts, length: int, gram: int) -> Pieces:
    data, n = texts.data, len(texts.data)
    width = length - gram + 1
    sizes = np.diff(texts.offsets)
    if n < length or not (sizes >= length).any():
        none = np.zeros(0, dtype=np.int64)
        return Pieces(none, none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool))
    at = np.arange(n - gram + 1)
    grams = span_hashes(data, _BYTE)(at, at + gram)
    group = sliding(grams, width, np.minimum)
    edge = np.zeros(len(group) + 1, dtype=np.int32)
    large = sizes >= length
    np.add.at(edge, texts.offsets[:-1][large], 1)
    np.add.at(edge, texts.offsets[1:][large] - length + 1, -1)
    valid = np.cumsum(edge[:-1]) > 0
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (group[1:] != group[:-1])
    start = np.flatnonzero(first)
    count = np.concatenate(([0], np.cumsum(valid)))
    windows = count[np.append(start[1:], len(group))] - count[start]
    if (windows > WINDOWS).any():
        parts = -(-windows // WINDOWS)
        each = np.repeat(np.arange(len(start)), parts)
        inner = np.arange(len(each)) - np.repeat(np.cumsum(parts) - parts, parts)
        start, windows = start[each] + inner * WINDOWS, np.minimum(windows[each] - inner * WINDOWS, WINDOWS)
    key = group[start]
    # Grams that are the least of some window; two neighbours of one value mean that a piece may hold its own copy.
    padded = np.zeros(len(group) + 2 * (width - 1), dtype=np.uint64)
    padded[width - 1:width - 1 + len(group)] = np.where(valid, group, _U(0))
    least = np.flatnonzero(sliding(padded, width, np.maximum) == grams)
    twice = least[:-1][(grams[least[1:]] == grams[least[:-1]]) & (np.diff(least) <= length)]
    again = np.zeros(len(start), dtype=bool)
    near = np.searchsorted(start, twice, "right") - 1
    for shift in (-1, 0, 1):
        j = np.clip(near + shift, 0, len(start) - 1)
        again[j[key[j] == grams[twice]]] = True
    hashes = span_hashes(data, _OTHER)(start, start + windows + length - 1)
    return Pieces(np.searchsorted(texts.offsets, start, "right") - 1, start, windows, key, hashes, again)


def sliced(column: pa.Array, length: int) -> Iterator[tuple[Texts, int]]:
    """Chunks of texts; a very long text comes in overlapping slices, with the place of its first byte."""
    for texts in chunks(column):
        if len(texts.data) <= 2 * CHUNK:
            yield texts, 0
            continue
        for low in range(0, len(texts.data) - length + 1, CHUNK):
            part = texts.data[low:low + CHUNK + length - 1]
            yield Texts(part, np.array([0, len(part)]), texts.first), low


class Frequent:
    """Pieces that a task has met several times, with the earliest place of each; a bounded number."""

    def __init__(self):
        self.name = np.zeros(0, dtype=np.uint64)
        self.place = np.zeros((0, 3), dtype=np.int64)

    def later(self, name: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Which of a chunk's pieces have an earlier equal one that goes on."""
        order = np.lexsort((place[:, 2], place[:, 1], place[:, 0], name))
        name, place = name[order], place[order]
        same = np.append(False, name[1:] == name[:-1])
        late = same.copy()
        firsts = np.flatnonzero(~same)
        if len(self.name):
            at = np.minimum(np.searchsorted(self.name, name[firsts]), len(self.name) - 1)
            known = self.name[at] == name[firsts]
            mine, theirs = place[firsts], self.place[at]
            sign = np.sign(mine[:, 0].astype(float) - theirs[:, 0])
            sign = np.where(mine[:, 0] == theirs[:, 0], 0, np.where(mine[:, 0] > theirs[:, 0], 1, -1))
            for k in (1, 2):
                sign = np.where(sign == 0, np.sign(np.where(mine[:, k] > theirs[:, k], 1, np.where(mine[:, k] < theirs[:, k], -1, 0))), sign)
            late[firsts[known & (sign > 0)]] = True
            self.place[at[known & (sign < 0)]] = mine[known & (sign < 0)]
        else:
            known = np.zeros(len(firsts), dtype=bool)
        new = firsts[~known & (np.diff(np.append(firsts, len(name))) > 1)][:REMEMBERED - len(self.name)]
        if len(new):
            both = np.concatenate((self.name, name[new]))
            sort = np.argsort(both)
            self.name, self.place = both[sort], np.concatenate((self.place, place[new]))[sort]
        out = np.empty(len(order), dtype=bool)
        out[order] = late
        return out


def packed_place(start: np.ndarray, windows: np.ndarray, again: np.ndarray, done: np.ndarray) -> np.ndarray:
    """Place of a piece as one number that sorts by start."""
    return ((start << 10 | windows) << 2) | again.astype(np.int64) << 1 | done


def span_of(at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    start = at >> 12
    return start, start + ((at >> 2) & 1023) + length - 1


def pieces_of(docs: DataFrame, heavy: np.ndarray, length: int, gram: int) -> DataFrame:
    """All pieces of doc, dg, text: route, key, piece, doc, dg, at."""
    names = ["route", "key", "piece", "doc", "dg", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = Frequent()
        for batch in batches:
            doc, dg = (batch.column(c).to_numpy() for c in ("doc", "dg"))
            for texts, base in sliced(batch.column("text"), length):
                p = cut_pieces(texts, length, gram)
                if not len(p.start):
                    continue
                row = p.text + texts.first
                own = base + p.start - (texts.offsets[p.text] if not base else 0)
                place = np.column_stack((doc[row], dg[row], own))
                done = frequent.later(mix(p.key ^ mix(p.piece)), place)
                at = packed_place(own, p.windows, p.again, done)
                route = np.where(np.isin(p.key, heavy), mix(p.key ^ p.piece), p.key)
                route = np.where(done, mix(p.piece ^ at.astype(np.uint64)), route)
                nothing = _U(0)
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64) if x.dtype == np.uint64 else x) for x in (
                    route, np.where(done, nothing, p.key), np.where(done, nothing, p.piece), doc[row], dg[row], at)], names=names)

    return docs.select("doc", "dg", "text").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def heavy_keys(docs: DataFrame, length: int, gram: int) -> np.ndarray:
    """Groups in more than a share of the documents, by a bounded sample; at most (pieces of a text / share) of them."""
    count = docs.count()
    if count < 1000:
        return np.zeros(0, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, _ in sliced(batch.column("text"), length):
                p = cut_pieces(texts, length, gram)
                both = np.unique(np.column_stack((p.text.astype(np.uint64), p.key)), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 1].view(np.int64))], names=["key"])

    sampled = docs.select("text").sample(min(1.0, SAMPLED / count), seed=7)
    least = max(20, int(HEAVY * min(count, SAMPLED)))
    found = sampled.mapInArrow(run, "key long").groupBy("key").count().where(F.col("count") >= least).collect()
    return np.sort(np.array([r["key"] for r in found], dtype=np.int64).view(np.uint64))


def sort_out(pieces: DataFrame, heavy: np.ndarray) -> DataFrame:
    """Of pieces in order, the later of equal ones (kind 0) and the first of those whose group has more (kind 1): doc, dg, key, at, kind."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last first piece, whose group may go on, and whether it is wanted anyway
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, piece, doc, dg, at = (batch.column(c).to_numpy() for c in ("key", "piece", "doc", "dg", "at"))
            done = (at & 1).astype(bool)
            yield rows(doc[done], dg[done], key[done], at[done], 0)
            key, piece, doc, dg, at = (x[~done] for x in (key, piece, doc, dg, at))
            if not len(key):
                continue
            before_key, before_piece = (np.append(np.int64(0), x[:-1]) for x in (key, piece))
            same_key, same = key == before_key, (key == before_key) & (piece == before_piece)
            same_key[0] = last is not None and last[0] == key[0]
            same[0] = same_key[0] and last[1] == piece[0]
            last = (key[-1], piece[-1])
            yield rows(doc[same], dg[same], key[same], at[same], 0)
            first = np.flatnonzero(~same)
            if not len(first):
                continue
            wanted = (at[first] & 2).astype(bool) | np.isin(key[first].view(np.uint64), heavy)
            shared = key[first[1:]] == key[first[:-1]]
            wanted[1:] |= shared
            wanted[:-1] |= shared
            if held is not None:
                joined = held[0][2] == key[first[0]]
                wanted[0] |= joined
                if held[1] or joined:
                    yield rows(*(np.array([x]) for x in held[0]), 1)
            send = first[:-1][wanted[:-1]]
            yield rows(doc[send], dg[send], key[send], at[send], 1)
            k = first[-1]
            held = ((doc[k], dg[k], key[k], at[k]), wanted[-1])
        if held is not None and held[1]:
            yield rows(*(np.array([x]) for x in held[0]), 1)

    def rows(doc, dg, key, at, kind) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (doc, dg, key, at)] + [pa.array(np.full(len(doc), kind, dtype=np.int32))],
                                          names=["doc", "dg", "key", "at", "kind"])

    ordered = pieces.repartition("route").sortWithinPartitions("route", "key", "piece", "doc", "dg", "at")
    return ordered.mapInArrow(run, f"{LONGS}, key long, at long, kind int")


# --- previous factors ---------------------------------------------------------------------

def longest_previous(position: np.ndarray, common: np.ndarray, least: int) -> np.ndarray:
    """Longest previous factor of each suffix, in suffix order; below ``least`` it is 0.

    ``position``: of each suffix in the corpus; ``common[i]``: bytes that suffix i shares with the one before it. The nearest
    suffix of a smaller position is reached by jumps over suffixes whose own nearest smaller one is known so far:
    all between are larger. A jump's factor is the least of those jumped over.
    """
    n = len(position)
    out = np.zeros(n, dtype=np.int64)
    for back in (False, True):
        spot = position[::-1] if back else position
        share = np.append(common[1:], 0)[::-1] if back else common.copy()
        share[:1] = 0
        near = np.arange(-1, n - 1)
        active = np.flatnonzero(share >= least)
        while len(active):
            active = active[(spot[near[active]] >= spot[active]) & (share[active] >= least)]
            if not len(active):
                break
            step = near[active]
            share_new, near_new = np.minimum(share[active], share[step]), near[step]
            share[active], near[active] = share_new, near_new
            active = active[share_new >= least]
        found = np.where(share >= least, share, 0)
        np.maximum(out, found[::-1] if back else found, out=out)
    return out


def previous_factors(data: np.ndarray, start: np.ndarray, position: np.ndarray, length: int) -> np.ndarray:
    """Which windows of ``length`` bytes (at ``start`` in data) have an earlier equal one (by ``position``)."""
    view = np.lib.stride_tricks.sliding_window_view(data, length)
    rows = np.ascontiguousarray(view[start])
    order = np.argsort(rows.view(f"S{length}").ravel(), kind="stable")
    common = np.zeros(len(order), dtype=np.int64)
    for low in range(1, len(order), 65536):
        high = min(len(order), low + 65536)
        differ = rows[order[low:high]] != rows[order[low - 1:high - 1]]
        common[low:high] = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    out = np.empty(len(order), dtype=bool)
    out[order] = longest_previous(position[order], common, length) >= length
    return out


def repeated_spans(batch: pa.Table, length: int) -> pa.RecordBatch:
    """Removed spans of some whole groups of pieces: doc, dg, start, stop."""
    data_column = batch.column("data").combine_chunks()
    doc, dg, first = (batch.column(c).to_numpy() for c in ("doc", "dg", "start"))
    bounds = np.frombuffer(data_column.buffers()[1], dtype=np.int32)[data_column.offset:data_column.offset + len(doc) + 1].astype(np.int64)
    data = np.frombuffer(data_column.buffers()[2], dtype=np.uint8)
    windows = np.diff(bounds) - length + 1
    each = np.repeat(np.arange(len(doc)), windows)
    inner = np.arange(len(each)) - np.repeat(np.cumsum(windows) - windows, windows)
    _, rank = np.unique(np.column_stack((doc, dg)), axis=0, return_inverse=True)
    position = (rank.reshape(-1)[each] << 40) + first[each] + inner
    hit = previous_factors(data, bounds[each] + inner, position, length)
    # Runs of windows found side by side in a piece.
    new = hit.copy()
    new[1:] &= ~hit[:-1] | (each[1:] != each[:-1])
    end = hit.copy()
    end[:-1] &= ~hit[1:] | (each[1:] != each[:-1])
    low, high = np.flatnonzero(new), np.flatnonzero(end)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (
        doc[each[low]], dg[each[low]], first[each[low]] + inner[low], first[each[high]] + inner[high] + length)],
        names=["doc", "dg", "start", "stop"])


SPAN = f"{LONGS}, start long, stop long"


def group_spans(pieces: DataFrame, length: int) -> DataFrame:
    """Removed spans of groups that a task can sort; some groups are sorted together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            key = batch.column("key").to_numpy()
            edges = np.append(np.flatnonzero(np.diff(key)) + 1, len(key))
            low = 0
            for high in edges:  # whole runs of one key
                if parts and size >= BATCH_BYTES and key[low] != parts[-1].column("key")[-1].as_py():
                    yield repeated_spans(pa.Table.from_batches(parts), length)
                    parts, size = [], 0
                part = batch.slice(low, high - low)
                if len(part):
                    parts.append(part)
                    size += part.column("data").nbytes
                low = high
        if parts:
            yield repeated_spans(pa.Table.from_batches(parts), length)

    return pieces.repartition("key").sortWithinPartitions("key").mapInArrow(run, SPAN)


def large_group_spans(pieces: DataFrame, length: int) -> DataFrame:
    """Removed spans of groups too large for a task: windows by digest, all but the first of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = np.frombuffer(batch.column("data")[i].as_buffer(), dtype=np.uint8)
                low = np.arange(len(data) - length + 1)
                n = len(low)
                yield pa.RecordBatch.from_arrays([
                    pa.array(span_hashes(data, _BYTE)(low, low + length).view(np.int64)),
                    pa.array(span_hashes(data, _OTHER)(low, low + length).view(np.int64)),
                    *(pa.array(np.full(n, batch.column(c)[i].as_py(), dtype=np.int64)) for c in ("doc", "dg")),
                    pa.array(batch.column("start")[i].as_py() + low)], names=["a", "b", "doc", "dg", "start"])

    windows = settle(pieces.mapInArrow(run, f"a long, b long, {LONGS}, start long"), "windows")
    place = F.struct("doc", "dg", "start")
    first = windows.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return windows.join(first, ["a", "b"]).where(place > F.col("first")).select(
        "doc", "dg", "start", (F.col("start") + length).alias("stop"))


# --- texts --------------------------------------------------------------------------------

def kept_of(data: memoryview, spans: np.ndarray) -> tuple[int, int, str]:
    """Bytes and runs removed, and the digest of what is left; spans: starts and stops in any order."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > reach[:-1])
    starts = spans[new, 0]
    stops = reach[np.append(np.flatnonzero(new)[1:] - 1, len(spans) - 1)]
    digest, at = hashlib.sha256(), 0
    for low, high in zip(starts.tolist(), stops.tolist(), strict=True):
        digest.update(data[at:low])
        at = high
    digest.update(data[at:])
    return int((stops - starts).sum()), len(starts), digest.hexdigest()


@dataclass
class Told:
    """Rows of the texts' table: kind 0 a result, 1 a piece for the suffix order, 2 a text that waits for it."""

    doc: list
    dg: list
    kind: list
    key: list
    start: list
    data: list
    spans: list
    n_bytes: list
    n_removed: list
    n_spans: list
    kept_sha256: list

    KINDS = ("long", "long", "int", "long", "long", "binary", "array<long>", "long", "long", "long", "string")

    @classmethod
    def schema(cls) -> str:
        return ", ".join(f"{f.name} {k}" for f, k in zip(fields(cls), cls.KINDS, strict=True))

    @classmethod
    def empty(cls) -> Told:
        return cls(*([] for _ in fields(cls)))

    def add(self, doc, dg, kind, key=None, start=None, data=None, spans=None, n_bytes=None, n_removed=None, n_spans=None,
            kept_sha256=None):
        for f, v in zip(fields(self), (doc, dg, kind, key, start, data, spans, n_bytes, n_removed, n_spans, kept_sha256), strict=True):
            getattr(self, f.name).append(v)

    def batch(self) -> pa.RecordBatch:
        kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "string": pa.string()}
        return pa.RecordBatch.from_arrays([pa.array(getattr(self, f.name), kinds[k]) for f, k in zip(fields(self), self.KINDS, strict=True)],
                                          names=[f.name for f in fields(self)])


def tell(docs: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """Results of texts that are decided, pieces and whole texts of the others."""
    lists = found.groupBy("doc", "dg").agg(F.collect_list(F.struct("key", "at", "kind")).alias("found"))
    joined = docs.join(lists, ["doc", "dg"], "left").select("doc", "dg", "text", "found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = Told.empty(), 0
            text = batch.column("text").cast(pa.large_binary())
            lists = batch.column("found")
            for i in range(batch.num_rows):
                doc, dg, data = batch.column("doc")[i].as_py(), batch.column("dg")[i].as_py(), memoryview(text[i].as_buffer())
                n = len(data)
                if not lists[i].is_valid:
                    out.add(doc, dg, 0, n_bytes=n, n_removed=0, n_spans=0, kept_sha256=hashlib.sha256(data).hexdigest())
                    continue
                own = lists[i].values
                key, at, kind = (own.field(c).to_numpy() for c in ("key", "at", "kind"))
                start, stop = span_of(at, length)
                copied = np.column_stack((start, stop))[kind == 0]
                if not kind.any():
                    removed, runs, digest = kept_of(data, copied)
                    out.add(doc, dg, 0, n_bytes=n, n_removed=removed, n_spans=runs, kept_sha256=digest)
                    continue
                for k in np.flatnonzero(kind).tolist():
                    out.add(doc, dg, 1, key=int(key[k]), start=int(start[k]), data=bytes(data[start[k]:stop[k]]))
                    size += int(stop[k] - start[k])
                out.add(doc, dg, 2, data=bytes(data), spans=copied.ravel())
                size += n
                if size > CHUNK:
                    yield out.batch()
                    out, size = Told.empty(), 0
            yield out.batch()

    return joined.mapInArrow(run, Told.schema())


def finish(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """Results of the texts that waited: doc, dg, n_bytes, n_removed, n_spans, kept_sha256."""
    lists = spans.groupBy("doc", "dg").agg(F.flatten(F.collect_list(F.array("start", "stop"))).alias("more"))
    joined = texts.join(lists, ["doc", "dg"], "left").select("doc", "dg", "data", "spans", "more")
    names = ["doc", "dg", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                data = memoryview(batch.column("data")[i].as_buffer())
                own = [batch.column(c)[i].values.to_numpy() for c in ("spans", "more") if batch.column(c)[i].is_valid]
                spans = np.concatenate([np.zeros(0, dtype=np.int64), *own]).reshape(-1, 2)
                if len(spans):
                    rows.append((len(data), *kept_of(data, spans)))
                else:
                    rows.append((len(data), 0, 0, hashlib.sha256(data).hexdigest()))
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("dg"), *(pa.array(c, pa.int64()) for c in columns[:3]),
                                              pa.array(columns[3], pa.string())], names=names)

    return joined.mapInArrow(run, f"{LONGS}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spark = docs.sparkSession
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    unique = ids.groupBy("doc_id").count().where("count > 1").isEmpty()
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
                       (F.lit(0).cast("long") if unique else F.xxhash64(text)).alias("dg"), text.alias("text"))
    heavy = heavy_keys(base, length, gram)
    found = settle(sort_out(pieces_of(base, heavy, length, gram), heavy), "found")
    path = fresh_path(spark, "told")
    tell(base, found, length).write.partitionBy("kind").parquet(path)
    told = spark.read.schema(Told.schema()).parquet(path)

    pieces = told.where("kind = 1").select("key", "doc", "dg", "start", "data")
    large = settle(pieces.groupBy("key").agg(F.sum(F.length("data")).alias("size")).where(F.col("size") > GROUP_BYTES).select("key"), "large")
    if large.isEmpty():
        spans = group_spans(pieces, length)
    else:
        spans = group_spans(pieces.join(large, "key", "left_anti"), length).unionByName(
            large_group_spans(pieces.join(large, "key", "left_semi"), length))
    names = ["doc", "dg", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    out = told.where("kind = 0").select(*names).unionByName(finish(told.where("kind = 2").select("doc", "dg", "data", "spans"), spans))
    if not unique:  # of equal rows the first stays, the others go whole
        copy = F.row_number().over(Window.partitionBy("doc", "dg").orderBy("n_bytes")) > 1
        gone = copy & (F.col("n_bytes") >= length)
        out = out.withColumn("gone", gone).select(
            "doc", "dg", "n_bytes", F.when(F.col("gone"), F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
            F.when(F.col("gone"), 1).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
            F.when(F.col("gone"), hashlib.sha256(b"").hexdigest()).otherwise(F.col("kept_sha256")).alias("kept_sha256"))
    return out.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), *names[2:])
