"""Document fingerprints as invertible Bloom lookup sketches of paragraphs.

A paragraph is a run of text between line breaks or ends of sentences (``.``, ``!``, ``?``), so that texts on one line have several; the
k-th equal paragraph of a text counts as one of its own, so a text is a bag of them. Each has a 64-bit digest, and a sketch of
``cells`` cells holds it in ``PLACES`` of them, one in each third of the sketch: a cell is the number of its digests, their exclusive or,
and the exclusive or of a check number of each. Sketches of one size subtract cell by cell; what both texts have cancels out. Peeling
then takes digests out of cells that hold just one, until the difference is empty (all differing digests are recovered) or no
such cell is left. In that case both texts are sketched again with twice the cells, and so on until it works.

The fingerprint of a text is its sketch with ``CELLS`` cells, in base 64; equal texts have equal fingerprints wherever they are made, and
fingerprints may be kept and compared later (``difference``).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultflow.llm import text as words_of
from vaultflow.session import stage

#: Cells of a fingerprint; a multiple of PLACES.
CELLS = 24
PLACES = 3
#: Cells that are worked on at a time in a task.
AT_ONCE = 1 << 20
#: Bytes of text that are worked on at a time.
BYTES = 8 << 20

# counts are kept modulo 2^16, which is enough to see that one digest is left
CELL = np.dtype([("count", "<i2"), ("key", "<u8"), ("check", "<u4")])
#: Bytes that end a paragraph: line feed and the ends of sentences.
ENDS = np.zeros(256, bool)
ENDS[[0x0A, *b".!?"]] = True
_OCCURRENCE = np.uint64(0x9E3779B97F4A7C15)
_CHECK = np.uint64(0xC2B2AE3D27D4EB4F)


def digests(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the paragraphs of all texts one after another, and where each text's begin (one more than texts)."""
    data, offsets = words_of.flat(texts)
    w = words_of.words(data, offsets, ENDS)
    # equal to k earlier ones of its text: another paragraph
    keys = words_of.within(w.hash, w.row)
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    earlier = np.zeros(len(keys), np.uint64)
    earlier[order] = np.arange(len(keys)) - np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
    return words_of.mixed(w.hash + earlier * _OCCURRENCE), np.searchsorted(w.row, np.arange(len(texts) + 1))


def _checks(keys: np.ndarray) -> np.ndarray:
    return (words_of.mixed(keys ^ _CHECK) >> np.uint64(32)).astype(np.uint32)


def _at(keys: np.ndarray, cells: int) -> Iterator[np.ndarray]:
    """The cell of each key in each part of the sketch; depends on the number of cells, so a larger one deals keys anew."""
    part = np.uint64(cells // PLACES)
    for k in range(PLACES):
        salt = np.uint64(((2 * k + 1) * 0x165667B19E3779F9 + cells * 0x27D4EB2F165667C5) & (2 ** 64 - 1))
        yield (words_of.mixed(keys + salt) % part).astype(np.int64) + k * int(part)


def sketches(keys: np.ndarray, starts: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """One row of cells per text."""
    rows = len(starts) - 1
    out = np.zeros(rows * cells, CELL)
    row = np.repeat(np.arange(rows), np.diff(starts))
    keys = keys[starts[0]:starts[-1]]
    check = _checks(keys)
    for place in _at(keys, cells):
        at = row * cells + place
        np.add.at(out["count"], at, 1)
        np.bitwise_xor.at(out["key"], at, keys)
        np.bitwise_xor.at(out["check"], at, check)
    return out.reshape(rows, cells)


def subtract(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cells of what ``a`` has (counts above 0) and ``b`` has (below 0), without what both have."""
    out = np.empty_like(a)
    out["count"] = a["count"] - b["count"]
    out["key"] = a["key"] ^ b["key"]
    out["check"] = a["check"] ^ b["check"]
    return out


def peel(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, side, whole) of differences, one row each: the digests recovered, side 1 or -1, and which rows came out empty.

    All rows are peeled at once, a layer at a time. A digest that both sides hold several of comes out that often.
    """
    size = cells.shape[1]
    c = cells.copy()
    count, key, check = c["count"], c["key"], c["check"]
    found = []
    while True:
        row, at = np.nonzero(np.abs(count) == 1)
        pure = _checks(key[row, at]) == check[row, at]
        row, at = row[pure], at[pure]
        if not len(row):
            break
        # a digest may show in several of its cells
        _, one = np.unique(words_of.within(key[row, at], row), return_index=True)
        row, at = row[one], at[one]
        k, side = key[row, at], count[row, at]
        own = _checks(k)
        for place in _at(k, size):
            np.subtract.at(count, (row, place), side)
            np.bitwise_xor.at(key, (row, place), k)
            np.bitwise_xor.at(check, (row, place), own)
        found.append((row, k, side))
    whole = ~(count.any(1) | key.any(1) | check.any(1))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int32), whole
    row, k, side = (np.concatenate(x) for x in zip(*found))
    return row, k, side, whole


class Texts:
    """Paragraph digests of texts, sketched on demand."""

    def __init__(self, texts: pa.Array):
        self.keys, self.starts = digests(texts)

    def __len__(self) -> int:
        return len(self.starts) - 1

    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)

    def sketches(self, which: np.ndarray, cells: int = CELLS) -> np.ndarray:
        counts = self.sizes()[which]
        starts = np.concatenate([[0], np.cumsum(counts)])
        at = np.arange(starts[-1]) + np.repeat(self.starts[which] - starts[:-1], counts)
        return sketches(self.keys[at], starts, cells)


def differing(a: Texts, ia: np.ndarray, b: Texts, ib: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(pair, digest, side, cells) of each digest that text ``ia[pair]`` has more often than ``ib[pair]`` (side 1) or less often (-1);
    ``cells`` is the sketch size that each pair needed. Pairs whose difference does not peel are sketched again, twice as large.
    """
    used = np.zeros(len(ia), np.int64)
    left, out = np.arange(len(ia)), []
    while len(left):
        again = []
        step = max(1, AT_ONCE // cells)
        for at in range(0, len(left), step):
            some = left[at:at + step]
            row, key, side, whole = peel(subtract(a.sketches(ia[some], cells), b.sketches(ib[some], cells)))
            good = whole[row]
            out.append((some[row[good]], key[good], side[good]))
            used[some[whole]] = cells
            again.append(some[~whole])
        left, cells = np.concatenate(again), cells * 2
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int32), used
    pair, key, side = (np.concatenate(x) for x in zip(*out))
    return pair, key, side, used


def likeness(a: Texts, ia: np.ndarray, b: Texts, ib: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """Common paragraphs over all paragraphs of both texts (1 where both have none), from the digests that peeling recovers; and the cells needed."""
    pair, _, side, used = differing(a, ia, b, ib, cells)
    apart = np.bincount(pair, minlength=len(ia))
    both = a.sizes()[ia] + b.sizes()[ib]
    return np.where(both > 0, (both - apart) / np.maximum(both + apart, 1), 1.0), used


def written(cells: np.ndarray) -> list[bytes]:
    """Sketches as bytes."""
    raw = np.ascontiguousarray(cells).view(np.uint8).reshape(len(cells), -1)
    return [r.tobytes() for r in raw]


def read(fingerprints: list[str]) -> np.ndarray:
    """Sketches from base 64, all of one size."""
    return np.stack([np.frombuffer(base64.b64decode(f), CELL) for f in fingerprints])


def difference(a: str, b: str) -> tuple[set[int], set[int]] | None:
    """Digests that only one of two texts has, from their fingerprints alone; None if there are more than the sketch gives back."""
    row, key, side, whole = peel(subtract(read([a]), read([b])))
    if not whole[0]:
        return None
    return {int(k) for k in key[side > 0]}, {int(k) for k in key[side < 0]}


def _pieces(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``BYTES`` of text, or one longer row."""
    _, offsets = words_of.flat(batch.column(column))
    for low, high in words_of.groups_of_rows(offsets, BYTES):
        yield batch.slice(low, high - low)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS) -> DataFrame:
    """(id, n_paragraphs, fingerprint) of every row; a null text counts as empty, a null id stays null, repeated ids each get a row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _pieces(batch, 1):
                t = Texts(b.column(1))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(t.sizes().astype(np.int64)), pa.array(written(t.sketches(np.arange(len(t)), cells)), pa.binary())],
                    ["id", "n_paragraphs", "fingerprint"])

    made = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_paragraphs bigint, fingerprint binary")
    return made.withColumn("fingerprint", F.base64("fingerprint"))


def changed_paragraphs(versions: DataFrame, old_col: str = "old", new_col: str = "new", id_col: str = "doc_id", cells: int = CELLS) -> DataFrame:
    """(id, digest, change): paragraphs that two versions of a text do not share, ``change`` ``added`` or ``removed``.

    ``versions`` has both texts in one row. The digest is 16 hexadecimal digits; the k-th equal paragraph of a text has its own. Null
    texts count as empty, rows without a difference give no row; rows that repeat an id are compared each for itself.
    """
    kind = versions.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch, 1):
                for b in _pieces(part, 2):
                    old, new = Texts(b.column(1)), Texts(b.column(2))
                    pair, key, side, _ = differing(new, np.arange(len(new)), old, np.arange(len(old)), cells)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(pair)), pa.array([f"{int(k):016x}" for k in key], pa.string()),
                         pa.array(np.where(side > 0, "added", "removed").tolist(), pa.string())], ["id", "digest", "change"])

    rows = versions.select(F.col(id_col).alias("id"), F.col(old_col).alias("old"), F.col(new_col).alias("new"))
    return rows.mapInArrow(run, f"id {kind}, digest string, change string").withColumnRenamed("id", id_col)


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _compared(cells: int):
    """Function of ids, texts and the text after each: the columns of ``next_edits``."""
    def done(ids: list, texts: list[str], following: list[str]) -> list:
        edited = [_edited(t, f) for t, f in zip(texts, following)]
        own, cut, after = Texts(pa.array(texts, pa.large_string())), Texts(pa.array(edited, pa.large_string())), Texts(pa.array(following, pa.large_string()))
        every = np.arange(len(texts))
        near_edited, used = likeness(own, every, cut, every, cells)
        near_next, _ = likeness(own, every, after, every, cells)
        return [ids, [len(t) for t in texts], [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited],
                written(own.sketches(every, cells)), written(cut.sketches(every, cells)), near_edited.tolist(), near_next.tolist(), used.tolist()]

    return done


def _schema(kind: str) -> str:
    return (f"id {kind}, n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double, "
            "cells_edited bigint")


def next_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS) -> DataFrame:
    """Fingerprint of every text and of its edited text, and how near they and the next text's fingerprint are.

    Rows are in descending order of the id (null ids last, equal ids by a hash of the text); the next of the last row is the first. The edited text
    has the last ``n // 2`` of its n characters replaced by the first as many of the next text, or all that it has. Null texts are
    empty; two texts without paragraphs have likeness 1. An empty table gives no rows, a single row is its own next. Texts are sorted by range, moved
    once, and looked at in order; of each task only the first and the last row go on to a second step that joins them up.
    """
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    done = _compared(cells)
    arrow = pa.schema([("role", pa.string()), ("part", pa.int32()), ("text", pa.string())])

    # The last text of a task has its successor in a later task, so it leaves as it is, as does the first one for the task before.
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: tuple | None = None  # the row whose successor has not come yet

        def rows(role: str, columns: list, texts: list) -> pa.RecordBatch:
            n = len(columns[0])
            tail = [pa.array([role] * n, pa.string()), pa.array([part] * n, pa.int32()), pa.array(texts, pa.string())]
            kinds = [None, pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int64()]
            own = [pa.array(c, k or id_type) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(own + tail, ["id", *_NAMES, *arrow.names])

        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for b in _pieces(batch, 1):
                ids, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
                if held is None:
                    yield rows("first", [ids[:1], *[[None]] * len(_NAMES)], texts[:1])
                else:
                    ids, texts = [held[0], *ids], [held[1], *texts]
                if len(ids) > 1:
                    yield rows("done", done(ids[:-1], texts[:-1], texts[1:]), [None] * (len(ids) - 1))
                held = (ids[-1], texts[-1])
        if held is not None:
            yield rows("last", [[held[0]], *[[None]] * len(_NAMES)], [held[1]])

    # the last key tells rows apart that are equal in all: a group of copies under one id is dealt over several tasks
    ordered = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
               .withColumn("_h", F.xxhash64("text")).withColumn("_n", F.monotonically_increasing_id())
               .repartitionByRange(F.desc_nulls_last("id"), "_h", "_n").sortWithinPartitions(F.desc_nulls_last("id"), "_h", "_n").select("id", "text"))
    first_step = stage(ordered.mapInArrow(run, _schema(kind) + ", role string, part int, text string"), "edits")
    # tasks are few: their numbers, and no texts, are put in order
    parts = [r["part"] for r in first_step.where("role = 'last'").select("part").orderBy("part").collect()]
    follows = spark.createDataFrame([(p, parts[(k + 1) % len(parts)]) for k, p in enumerate(parts)], "part int, follows int")
    heads = first_step.where("role = 'first'").select(F.col("part").alias("follows"), F.col("text").alias("next_text"))
    seams = (first_step.where("role = 'last'").select("id", "part", "text").join(follows, "part").join(heads, "follows")
             .select("id", "text", "next_text"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _pieces(batch, 1):
                if b.num_rows:
                    out = done(b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()], [t or "" for t in b.column(2).to_pylist()])
                    own = [pa.array(c, k) for c, k in zip(out[1:], [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int64()])]
                    yield pa.RecordBatch.from_arrays([b.column(0), *own], ["id", *_NAMES])

    inner = first_step.where("role = 'done'").select("id", *_NAMES)
    return (inner.unionByName(seams.mapInArrow(close, _schema(kind))).withColumnRenamed("id", id_col)
            .withColumns({c: F.base64(c) for c in ("fingerprint", "edited_fingerprint")}))


_NAMES = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "cells_edited")
