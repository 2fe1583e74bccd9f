"""Packing of documents into sequences of a fixed number of tokens: shortest pack first, over lengths.

A document longer than a sequence is cut into whole sequences and a rest. The pieces
are then packed by their lengths alone: the histogram of lengths has at most
``capacity`` rows whatever the corpus, patterns of lengths are formed from it on the
driver, and each piece finds its place in a pattern by its rank among the pieces of
its length. No piece but its length and rank is moved for the packing.

Defined results: a null or empty text is a document of the end token alone; repeated
rows are packed once each; an empty table gives no pieces; columns other than the two
named are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anemos.llm.bpe import Bpe, encoder

CAPACITY, END_ID = 2048, 1
#: Pieces of one length that are ranked in one task.
RANKED_TOGETHER = 50_000
#: Slots of patterns that are sent to every task at most (some 60 bytes each); more of them are joined by a shuffle.
SENT = 500_000


def cut_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                  capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: id, start, length, ids_crc32, doc_tokens and, if asked for, the ids.

    ``doc_tokens`` counts the end token; ``ids_crc32`` is over little-endian unsigned 32-bit ids.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Bpe(path))  # a vocabulary
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, shared.value)
        for batch in batches:
            row = 0
            for flat, bounds in encode.encode(batch.column(1)):
                rows, starts, lengths, sums, totals, tokens = [], [], [], [], [], []
                for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    ids = np.append(flat[low:high], end_id).astype("<u4")
                    for start in range(0, len(ids), capacity):
                        piece = ids[start:start + capacity]
                        rows.append(row)
                        starts.append(start)
                        lengths.append(len(piece))
                        sums.append(zlib.crc32(piece.tobytes()))
                        totals.append(len(ids))
                        if with_ids:
                            tokens.append(piece.astype(np.int32))
                    row += 1
                columns = [batch.column(0).take(pa.array(rows, pa.int64())),
                           *(pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals))]
                names = [id_col, "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    columns, names = [*columns, pa.array(tokens, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = own.schema["id"].dataType.simpleString()
    return own.mapInArrow(cut, f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long"
                          + ", ids array<int>" * with_ids)


def shortest_pack_first(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """Patterns as (number of sequences, lengths in them), from the number of pieces of each length.

    Lengths are placed longest first, each into the shortest packs so far; where even those
    are too full, new packs are opened. Packs of one pattern move together, so the work
    follows the number of patterns, not of pieces.
    """
    packs: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)
    shortest: list[int] = []
    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens")
        left = histogram[length]
        while left:
            while shortest and not packs[shortest[0]]:
                heapq.heappop(shortest)
            filled = shortest[0] if shortest else capacity
            if filled + length > capacity:
                filled, found, pattern = 0, left, []
            else:
                found, pattern = packs[filled].pop()
            taken = min(left, found)
            if taken < found:
                packs[filled].append((found - taken, pattern))
            packs[filled + length].append((taken, [*pattern, length]))
            heapq.heappush(shortest, filled + length)
            left -= taken
    return [x for filled in sorted(packs, reverse=True) for x in packs[filled]]


def slots(patterns: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset) of each place in the patterns."""
    out, ranks, sequence = [], defaultdict(int), 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            out.append((length, ranks[length], ranks[length] + count, sequence, offset))
            ranks[length] += count
            offset += length
        sequence += count
    return out


def pack(pieces: DataFrame, order: tuple[str, ...] = ("doc_id", "start", "ids_crc32"),
         capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id (dense, from 0) and offset to pieces with a ``length``; read twice, so pass a stored table."""
    spark = pieces.sparkSession
    # At most ``capacity`` rows.
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = slots(shortest_pack_first(histogram, capacity))
    # Many pieces of one length are ranked in several parts, each on top of the parts before it.
    parts = spark.createDataFrame([(k, -(-n // RANKED_TOGETHER)) for k, n in histogram.items()],
                                  "length long, _parts long")
    dealt = pieces.join(F.broadcast(parts), "length").withColumn(
        "_part", F.pmod(F.xxhash64(*order), F.col("_parts"))).drop("_parts")
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("length", "_part").agg(F.count("*").alias("_n")).select(
        "length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("length", "_part").orderBy(*order)
    ranked = dealt.withColumn("_rank", F.row_number().over(within)).join(sizes, ["length", "_part"]).withColumn(
        "_rank", F.col("_rank") + F.col("_base") - 1)
    table = spark.createDataFrame(places, "_length long, _first long, _end long, _sequence long, offset long")
    table = F.broadcast(table) if len(places) <= SENT else table
    hit = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end"))
    return ranked.join(table, hit).withColumn(
        "sequence_id", F.col("_sequence") + F.col("_rank") - F.col("_first")).select(
        *pieces.columns, "sequence_id", "offset")


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """Token rows from packed pieces with ids: sequence_id, ids, n_tokens without padding.

    A sequence is padded to ``capacity`` unless its length is a power of two. A group is
    one sequence, at most ``capacity`` tokens.
    """
    joined = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"]))
    out = packed.groupBy("sequence_id").agg(joined.alias("ids")).withColumn("n_tokens", F.size("ids"))
    even = F.bit_count("n_tokens") == 1
    padding = F.array_repeat(F.lit(pad_id), F.when(even, 0).otherwise(capacity - F.col("n_tokens")).cast("int"))
    return out.withColumn("ids", F.concat("ids", padding))
