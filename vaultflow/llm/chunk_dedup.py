"""Repeated passages by content-defined chunking.

A gear hash rolls over the bytes of a text; where some of its bits are zero a chunk may end, so cuts follow the content and an
insertion moves only the cuts next to it. Chunks are compared by a 128-bit digest over all documents: the first place of a
digest (smallest id, then smallest position) keeps it, every other place is a repeat. Runs of neighbouring repeats make a span.
Rows are told apart by id and a hash of their text, so an id that several texts share, or none, mixes nothing.

Digests are counted with partial sums before the shuffle; places are then joined only with digests that occur twice or more,
by a sort-merge join whose hot partitions Spark splits, so a passage that a third of all documents share is in no single task.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultflow.llm import text as T
from vaultflow.session import stage

SHORTEST = 24
LONGEST = 1024
#: Bits of the gear hash that are zero at a cut: 32 bytes between possible cuts on average.
MASK = np.uint32(0b11111 << 15)
#: Bytes whose gear values reach the highest of those bits.
REACH = 32
#: Least bytes of a span that counts as a repeated passage.
LEAST_BYTES = 96

# One number per byte value, from a rule.
GEAR = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(13)).astype(np.uint32)
GEAR = ((GEAR ^ (GEAR >> np.uint32(15))) * np.uint32(0x2C1B3C6D)).astype(np.uint32)


def possible_cuts(data: np.ndarray) -> np.ndarray:
    """Places after which a chunk may end; the hash of a place covers at most the ``REACH`` bytes up to it."""
    found = []
    for at in range(0, len(data), T.PIECE):
        low = max(0, at - REACH)
        h = GEAR[data[low:at + T.PIECE]]
        width = 1
        while width < REACH:  # the sum of g << age, doubling how far back it reaches
            older = np.zeros_like(h)
            older[width:] = h[:-width] << np.uint32(width)
            h = h + older
            width *= 2
        zero = np.flatnonzero((h & MASK) == 0) + low + 1
        found.append(zero[zero > at])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def cuts(data: np.ndarray) -> list[int]:
    """Ends of the chunks: the first possible cut ``SHORTEST`` or more after the last, ``LONGEST`` bytes at most."""
    out, at, n = [], 0, len(data)
    for c in possible_cuts(data).tolist():
        while c - at > LONGEST:
            at += LONGEST
            out.append(at)
        if c - at >= SHORTEST:
            at = c
            out.append(at)
    while n - at > LONGEST:
        at += LONGEST
        out.append(at)
    if at < n:
        out.append(n)
    return out


def _chunked(docs: DataFrame, id_col: str, text_col: str, places: bool) -> DataFrame:
    """A row per chunk: digest as two numbers, and with ``places`` id, hash of the text, number of the chunk in it, first byte, bytes."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["hi", "lo", *(["id", "text", "chunk", "start", "size"] if places else ["n"])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = T.flat(b.column(1))
            for low, high in T.groups_of_rows(offsets):
                digests, row, start, size, chunk = bytearray(), [], [], [], []
                for k in range(low, high):
                    own = data[offsets[k]:offsets[k + 1]]
                    ends = cuts(own)
                    raw, at = own.tobytes(), 0
                    for e in ends:
                        digests += blake2b(raw[at:e], digest_size=16).digest()
                        at = e
                    row += [k] * len(ends)
                    start += [0, *ends[:-1]] if ends else []
                    size += np.diff([0, *ends]).tolist()
                    chunk += range(len(ends))
                pairs = np.frombuffer(bytes(digests), np.int64).reshape(-1, 2)
                if places:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1])),
                         b.column(0).take(pa.array(row, pa.int64())), b.column(2).take(pa.array(row, pa.int64())), pa.array(chunk, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int32())], names)
                elif len(pairs):
                    some, n = np.unique(pairs, axis=0, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.ascontiguousarray(some[:, 0])), pa.array(np.ascontiguousarray(some[:, 1])), pa.array(n)], names)

    kinds = f"hi bigint, lo bigint, id {id_type}, text bigint, chunk int, start bigint, size int" if places else "hi bigint, lo bigint, n bigint"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("_text")).mapInArrow(run, kinds)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, copy, rows, chunk, start, size, first_id, first_text) of every chunk that is not the first of its digest.

    Positions and sizes are in bytes of UTF-8. Null and empty texts have no chunks; a null id sorts first. Texts of one id come in
    order of their hash. Rows that repeat both id and text come right after the first of them: that one has ``copy`` 0, and one row
    with ``copy`` 1 stands for all the others, ``rows`` of them.
    """
    many = stage(_chunked(docs, id_col, text_col, False).groupBy("hi", "lo").agg(F.sum("n").alias("n")).where("n > 1")
                 .select(F.col("hi").alias("_hi"), F.col("lo").alias("_lo")), "digests")
    places = stage(_chunked(docs, id_col, text_col, True).join(many, (F.col("hi") == F.col("_hi")) & (F.col("lo") == F.col("_lo"))).drop("_hi", "_lo"),
                   "places")
    place = F.struct("id", "text", "chunk")
    first = stage(places.groupBy(F.col("hi").alias("_hi"), F.col("lo").alias("_lo"), "id", "text").agg(F.min("chunk").alias("chunk"))
                  .groupBy("_hi", "_lo").agg(F.min(place).alias("_first")), "first")
    one = F.lit(1).cast("bigint")
    alike = places.groupBy("hi", "lo", "id", "text", "chunk", "start", "size").agg(F.count("*").alias("_n"))
    copies = F.when(place > F.col("_first"), F.array(F.struct(F.lit(0).alias("copy"), one.alias("rows")))).otherwise(F.array())
    copies = F.concat(copies, F.when(F.col("_n") > 1, F.array(F.struct(F.lit(1).alias("copy"), (F.col("_n") - 1).alias("rows")))).otherwise(F.array()))
    return (alike.join(first, (F.col("hi") == F.col("_hi")) & (F.col("lo") == F.col("_lo")))
            .select("id", "text", F.explode(copies).alias("_copy"), "chunk", "start", "size", "_first")
            .select("id", "text", "_copy.*", "chunk", "start", "size", F.col("_first.id").alias("first_id"), F.col("_first.text").alias("first_text")))


def _spans(docs: DataFrame, id_col: str, text_col: str, least_bytes: int) -> DataFrame:
    """(id, text, copy, rows, start, n_bytes, n_chunks, first_id): the spans of every different row, and of its copies once."""
    row = ("id", "text", "copy", "rows")
    run = Window.partitionBy(*row).orderBy("start", "chunk")
    own = F.col("first_id").eqNullSafe(F.col("id")) & (F.col("first_text") == F.col("text"))
    before = F.lag(F.struct((F.col("start") + F.col("size")).alias("end"), "_own")).over(run)
    found = (repeats(docs, id_col, text_col).withColumn("_own", own).withColumn("_before", before)
             .withColumn("_new", F.when((F.col("_before.end") == F.col("start")) & (F.col("_before._own") == F.col("_own")), 0).otherwise(1))
             .withColumn("_run", F.sum("_new").over(run)))
    return (found.groupBy(*row, "_run", "first_id")
            .agg(F.min("start").alias("start"), F.sum("size").alias("n_bytes"), F.count("*").alias("n_chunks"))
            .groupBy(*row, "_run")
            .agg(F.min("start").alias("start"), F.sum("n_bytes").alias("n_bytes"), F.sum("n_chunks").alias("n_chunks"),
                 F.min(F.struct(-F.col("n_bytes"), "first_id"))["first_id"].alias("first_id"))
            .where(F.col("n_bytes") >= least_bytes).drop("_run"))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(doc_id, start, n_bytes, n_chunks, first_doc_id): runs of repeated chunks of ``least_bytes`` or more.

    ``first_doc_id`` is the document that keeps most of the passage (ties: the smallest id), which may be the same document,
    earlier; repeats of a row's own text and of others' make spans of their own. Texts that share an id, or have none, each have
    spans of their own, and of rows that are equal in id and text every one but the first repeats it whole. An empty table gives an empty one.
    """
    found = _spans(docs, id_col, text_col, least_bytes)
    one = F.lit(1).cast("bigint")
    return (found.withColumn("_row", F.explode(F.sequence(one, F.col("rows"))))
            .select(F.col("id").alias(id_col), "start", "n_bytes", "n_chunks", F.col("first_id").alias("first_doc_id")))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """The rows of ``docs`` with every later copy of a passage cut out of the text; all columns and rows stay.

    Chunks may begin inside a character, so a cut moves in to whole characters. Rows that are equal in id and text cannot be told
    apart: all of them are cut as the first is.
    """
    removed = (_spans(docs, id_col, text_col, least_bytes).where("copy = 0").groupBy(F.col("id").alias("_id"), F.col("text").alias("_hash"))
               .agg(F.sort_array(F.collect_list(F.struct("start", "n_bytes"))).alias("_spans")))
    kind = docs.schema[text_col].dataType

    @F.arrow_udf(kind)
    def without(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for t, cut in zip(texts, spans):
            raw, kept, at = t.as_py().encode("utf-8"), [], 0
            for s in cut.as_py():
                low, high = s["start"], s["start"] + s["n_bytes"]
                while low < high and raw[low] & 0xC0 == 0x80:
                    low += 1
                while low < high < len(raw) and raw[high] & 0xC0 == 0x80:
                    high -= 1
                kept.append(raw[at:low])
                at = high
            out.append(b"".join([*kept, raw[at:]]).decode("utf-8"))
        return pa.array(out, pa.string())

    joined = (docs.select(F.struct("*").alias("_row"))
              .join(removed, (F.xxhash64(F.col("_row")[text_col]) == F.col("_hash")) & F.col("_row")[id_col].eqNullSafe(F.col("_id")), "left")
              .withColumn("_text", F.col("_row")[text_col]))
    text = F.when(F.col("_spans").isNotNull(), without(F.coalesce("_text", F.lit("")), F.coalesce("_spans", F.array()))).otherwise(F.col("_text"))
    return joined.select(*[text.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns])
