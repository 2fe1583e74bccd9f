"""Chat formatting by multi-party perspective rotation.

A dialogue of several speakers is rendered once for each of them: that speaker is the
assistant, all others are named users, system turns stay. The mask tells which characters
to train on: the assistant's contents with their end marker.

A rendering is cut into chunks by turn number (``CHUNK`` turns), one row each; the texts of
a dialogue's chunks in order are its whole rendering. Where turn numbers repeat, so that a
chunk has more than ``MOST`` rows, it is cut along its order into parts of ``ROWS`` rows, one
row each; equal rows are counted before, so they can be cut apart too. So a dialogue of very
many turns is never one group: a task holds the turns of one chunk or part. All is DataFrame
work but the digest of a chunk of many parts, which reads them one after the other.

Defined results: turns are ordered by number, then role, then text, so repeated and tied rows
have their place and are all rendered; a null turn counts as 0; a null text is an empty
content; a null or blank role is shown as the user ``unknown``, who gets no perspective of their own (a speaker of
that name does, and comes after it in a tie); a dialogue without speakers gives no row; rows without a dialogue id belong to none; markers inside a content are
broken by a zero-width space, signs that a name can't hold become ``_``; an empty table
gives no rows; columns other than the four named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anemos.session import settle

CHUNK = 64
#: Rows of a chunk at most, above which it is cut; rows of its parts then.
MOST, ROWS = 1024, 64
START, STOP, MARKER, BROKEN = "<|im_start|>", "<|im_end|>\n", "<|im_", "<\u200b|im_"
SYSTEM, UNKNOWN = "system", "unknown"


def turns(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """Clean turns: conv_id, turn, role, content, named (whether the role is a name and not blank)."""
    named = F.coalesce(F.trim(role_col) != "", F.lit(False))
    role = F.when(named, F.trim(role_col)).otherwise(UNKNOWN)
    content = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit(MARKER), F.lit(BROKEN))
    return rows.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("conv_id"), F.coalesce(F.col(turn_col), F.lit(0)).cast("long").alias("turn"),
        role.alias("role"), content.alias("content"), named.alias("named"))


def head(role: Column, mine: Column) -> Column:
    """The opening line of a turn; ``mine``: it is the speaker's own."""
    name = F.regexp_replace(role, "[^A-Za-z0-9_.-]", "_")
    shown = F.when(role == SYSTEM, SYSTEM).when(mine, "assistant").otherwise(F.concat(F.lit("user name="), name))
    return F.concat(F.lit(START), shown, F.lit("\n"))


def cut(rows: DataFrame, size: int) -> DataFrame:
    """Chunks of many rows in parts of ``size`` rows in order: conv_id, chunk, part, parts, turns."""
    order = ("turn", "role", "content", "named")
    counted = rows.groupBy("conv_id", "chunk", *order).agg(F.count("*").alias("n"))
    # Ranges of the whole order, so one chunk can be in many; stored, as other samples would give other ranges.
    ranged = settle(counted.repartitionByRange("conv_id", "chunk", *order).withColumn("range", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy("conv_id", "chunk", "range").agg(F.sum("n").alias("n"))
    every = Window.partitionBy("conv_id", "chunk")
    earlier = every.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("conv_id", "chunk", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"),
                         F.ceil(F.sum("n").over(every) / size).alias("parts"))
    inside = Window.partitionBy("conv_id", "chunk", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.withColumn("stop", F.sum("n").over(inside)).join(starts, ["conv_id", "chunk", "range"]).withColumn(
        "stop", F.col("start") + F.col("stop")).withColumn("start", F.col("stop") - F.col("n"))
    part = F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("stop") - 1) / size)))
    copies = F.least("stop", (F.col("part") + 1) * size) - F.greatest("start", F.col("part") * size)
    listed = placed.withColumn("part", part).withColumn("copies", copies.cast("int")).groupBy("conv_id", "chunk", "part", "parts").agg(
        F.array_sort(F.collect_list(F.struct(*order, "copies"))).alias("turns"))
    return listed.withColumn("turns", F.flatten(F.transform("turns", lambda t: F.array_repeat(
        F.struct(*(t[c].alias(c) for c in order)), t["copies"]))))


def perspectives(rows: DataFrame, chunk: int = CHUNK, most: int = MOST, size: int = ROWS, **columns: str) -> DataFrame:
    """One row per dialogue, speaker, chunk and part: conv_id, speaker, chunk, part, parts, turns, text, spans.

    ``spans``: array of (start, stop) in characters of the chunk's text (its parts' texts in order), in order: what the
    assistant says. Chunks of at most ``most`` rows have one part.
    """
    clean = turns(rows, **columns).withColumn("chunk", F.floor(F.col("turn") / chunk))
    talk = clean.where(F.col("named") & (F.col("role") != SYSTEM))
    # As many rows as dialogues have speakers; stored, so that the join can split a dialogue of very many chunks.
    speakers = settle(talk.select("conv_id", F.col("role").alias("speaker")).distinct(), "speakers")
    large = settle(clean.groupBy("conv_id", "chunk").count().where(F.col("count") > most).select("conv_id", "chunk"), "large")
    cuts = not large.isEmpty()
    usual = clean.join(large, ["conv_id", "chunk"], "left_anti") if cuts else clean
    chunks = usual.groupBy("conv_id", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "content", "named"))).alias("turns")).select(
        "conv_id", "chunk", F.lit(0).cast("long").alias("part"), F.lit(1).cast("long").alias("parts"), "turns")
    out = rendered(chunks, speakers)
    if cuts:
        parts = cut(clean.join(large, ["conv_id", "chunk"], "left_semi"), size)
        # Where each part starts, from lengths alone: rows without texts.
        lengths = rendered(parts, speakers).select("conv_id", "speaker", "chunk", "part", F.length("text").cast("long").alias("length"))
        before = Window.partitionBy("conv_id", "speaker", "chunk").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = lengths.select("conv_id", "speaker", "chunk", "part", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))
        moved = rendered(parts, speakers).join(offsets, ["conv_id", "speaker", "chunk", "part"]).withColumn(
            "spans", F.transform("spans", lambda s: F.struct((s["start"] + F.col("offset")).alias("start"), (s["stop"] + F.col("offset")).alias("stop"))))
        out = out.unionByName(moved.drop("offset"))
    return out


def rendered(chunks: DataFrame, speakers: DataFrame) -> DataFrame:
    """Each chunk or part as each of its dialogue's speakers has it, spans from its own start."""
    mine = lambda t: t["named"] & (t["role"] == F.col("speaker"))
    seen = chunks.join(speakers, "conv_id").withColumn("pieces", F.transform("turns", lambda t: F.struct(
        head(t["role"], mine(t)).alias("head"), F.concat(t["content"], F.lit(STOP)).alias("body"), mine(t).alias("mine"))))
    size = lambda p: (F.length(p["head"]) + F.length(p["body"])).cast("long")
    empty = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    walked = F.aggregate(
        "pieces", F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans")),
        lambda state, p: F.struct((state["at"] + size(p)).alias("at"), F.when(p["mine"], F.concat(state["spans"], F.array(F.struct(
            (state["at"] + F.length(p["head"])).alias("start"), (state["at"] + size(p)).alias("stop"))))).otherwise(
            state["spans"]).alias("spans")))
    return seen.select(
        "conv_id", "speaker", "chunk", "part", "parts", F.size("turns").cast("long").alias("turns"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "").alias("text"),
        walked["spans"].alias("spans"))


def digests(seen: DataFrame) -> DataFrame:
    """One row per dialogue, speaker and chunk: conv_id, speaker, chunk, turns, chars, trained_chars, text_sha256, spans (as text)."""
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string"))), ",")
    trained = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    told = seen.select("conv_id", "speaker", "chunk", "part", "parts", "turns", F.length("text").cast("long").alias("chars"),
                       trained.alias("trained_chars"), "text", listed.alias("spans"))
    keys, sums = ("conv_id", "speaker", "chunk"), ("turns", "chars", "trained_chars")
    names = [*keys, *sums, "text_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kinds = None, None

        def row() -> pa.RecordBatch:
            key, total, digest, spans = now
            values = (*key, *total, digest.hexdigest(), ",".join(spans))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=names)

        for batch in batches:
            kinds = [batch.schema.field(c).type for c in (*keys, *sums, "text", "spans")]
            for i in range(batch.num_rows):
                key = tuple(batch.column(c)[i].as_py() for c in keys)
                if now is None or now[0] != key:
                    if now is not None:
                        yield row()
                    now = (key, [0] * len(sums), hashlib.sha256(), [])
                for k, c in enumerate(sums):
                    now[1][k] += batch.column(c)[i].as_py()
                now[2].update(batch.column("text")[i].as_py().encode())
                if spans := batch.column("spans")[i].as_py():
                    now[3].append(spans)
        if now is not None:
            yield row()

    one = told.where("parts = 1").withColumn("text_sha256", F.sha2("text", 256)).select(*names)
    many = told.where("parts > 1").repartition(*keys).sortWithinPartitions(*keys, "part").drop("part", "parts")
    return one.unionByName(many.mapInArrow(run, one.schema))
