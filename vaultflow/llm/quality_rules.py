"""Quality rules: plain counts with fixed limits, and a hashed n-gram classifier behind them.

The classifier is a logistic regression over hashed frequencies of words, word pairs, and runs of three and four characters. It is
trained on labelled rows by full gradients, each the sum of one row of sums per partition, and its scores are calibrated to
probabilities by a logistic curve through rows that the training did not see.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultflow.llm import text as T
from vaultflow.llm.quality_classifier import labelled, texts_of
from vaultflow.session import stage

#: Buckets of hashed n-grams, shared by all kinds.
BITS = 16
#: Labelled rows used at most, those with the smallest hash of their id.
TRAIN_ROWS = 4_000
STEPS = 40
MIN_WORDS = 50
#: Highest share of words in repeated windows, in percent.
MOST_REPEATED = 50
THRESHOLD = 0.5
KINDS = 4

_SYMBOL = np.array([chr(c) in "#*$%&|<>" for c in range(256)])
#: First bytes of characters that are in words.
_CHARACTER = ~T.SPACES & ~np.array([0x80 <= c <= 0xBF for c in range(256)])


def _bucket(keys: np.ndarray, kind: int) -> np.ndarray:
    return ((keys + np.uint64(kind + 1)) * np.uint64(0x9FB21C651E98DF25) >> np.uint64(64 - BITS)).astype(np.int32)


def _characters(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where characters begin in UTF-8 bytes, and their bytes as one number each."""
    inner = (part & 0xC0) == 0x80
    start = np.flatnonzero(~inner)
    value = part[start].astype(np.uint64)
    if inner.any():
        more = np.ones(len(start), bool)
        for k in range(1, 4):
            at = np.minimum(start + k, len(part) - 1)
            more &= (start + k < len(part)) & inner[at]
            value = np.where(more, value << np.uint64(8) | part[at], value)
    return start, value


def _character_grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(kind, row, bucket) of runs of three and four characters within a text, a piece at a time."""
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        to = min(at + T.PIECE, end)
        start, value = _characters(data[at:min(to + 16, end)])  # four characters have 16 bytes at most
        row = np.searchsorted(offsets, start + at, "right") - 1
        own = int(np.searchsorted(start, to - at))
        for kind, size in ((2, 3), (3, 4)):
            n = max(0, min(own, len(start) - size + 1))
            key = value[:n]
            for k in range(1, size):
                key = key * np.uint64(0x9E3779B97F4A7C15) + value[k:n + k]
            whole = row[:n] == row[size - 1:n + size - 1]
            yield kind, row[:n][whole], _bucket(key[whole], kind)
        at = to


def _grams(data: np.ndarray, offsets: np.ndarray, w: T.Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    yield 0, w.row, _bucket(w.hash, 0)
    pair, first = T.windows(w, 2)
    yield 1, w.row[first], _bucket(pair, 1)
    yield from _character_grams(data, offsets)


def _linear(data: np.ndarray, offsets: np.ndarray, w: T.Words, weights: np.ndarray) -> np.ndarray:
    """Sum over the kinds of the mean weight of a text's n-grams, plus the constant."""
    rows = len(offsets) - 1
    total, count = np.zeros((KINDS, rows)), np.zeros((KINDS, rows))
    for kind, row, bucket in _grams(data, offsets, w):
        total[kind] += np.bincount(row, weights[bucket], rows)
        count[kind] += np.bincount(row, minlength=rows)
    return (total / np.maximum(count, 1)).sum(0) + weights[-1]


def _sparse(data: np.ndarray, offsets: np.ndarray, w: T.Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and frequencies of each text."""
    rows = len(offsets) - 1
    dense = np.zeros((rows, 1 << BITS), np.float32)
    count = np.zeros((KINDS, rows))
    held = list(_grams(data, offsets, w))
    for kind, row, _ in held:
        count[kind] += np.bincount(row, minlength=rows)
    for kind, row, bucket in held:
        np.add.at(dense, (row, bucket), (1 / np.maximum(count[kind], 1))[row])
    for k in range(rows):
        some = np.flatnonzero(dense[k])
        yield some.astype(np.int32), dense[k][some]


@dataclass
class Model:
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def probability(self, linear: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * linear + self.shift, -30, 30)))


def _counts(data: np.ndarray, offsets: np.ndarray, w: T.Words) -> list[np.ndarray]:
    rows = len(offsets) - 1
    lines = T.words(data, offsets, T.NEWLINE)
    # a line counts if a word begins in it
    filled = np.searchsorted(w.start, lines.end) > np.searchsorted(w.start, lines.start)
    _, again = T.repeated(T.within(lines.hash, lines.row))
    of = lambda row: np.bincount(row, minlength=rows)
    return [of(w.row), T.sums(data, offsets, _CHARACTER), T.sums(data, offsets, _SYMBOL),
            of(lines.row[again & filled]), of(w.row[T.repeated_windows(w, 3)])]


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(column: pa.Array, model: Model | None) -> pa.StructArray:
    """The counts and the probability of each text; null counts as empty."""
    data, offsets = T.flat(column)
    parts: list[list[np.ndarray]] = [[np.zeros(0)] for _ in range(len(NAMES) + 1)]
    for low, high in T.groups_of_rows(offsets):
        own = offsets[low:high + 1]
        w = T.words(data, own)
        chance = np.full(high - low, 0.5) if model is None else model.probability(_linear(data, own, w, model.weights))
        for part, values in zip(parts, [*_counts(data, own, w), chance]):
            part.append(values)
    whole = [np.concatenate(p) for p in parts]
    return pa.StructArray.from_arrays([*(pa.array(x.astype(np.int64)) for x in whole[:-1]), pa.array(whole[-1])], [*NAMES, "probability"])


def _gradient(rows: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Gradient of the log loss, the loss, and the number of rows: each partition sends its sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, loss, n = np.zeros(len(weights)), 0.0, 0
        for b in batches:
            ends = b.column(0).offsets.to_numpy()
            at, x = b.column(0).flatten().to_numpy(), b.column(1).flatten().to_numpy()
            row = np.repeat(np.arange(b.num_rows), np.diff(ends))
            y = b.column(2).to_numpy()
            linear = np.bincount(row, weights[at] * x, b.num_rows) + weights[-1]
            p = 1 / (1 + np.exp(-np.clip(linear, -30, 30)))
            total[:-1] += np.bincount(at, (p - y)[row] * x, len(weights) - 1)
            total[-1] += (p - y).sum()
            loss -= np.log(np.where(y > 0, p, 1 - p) + 1e-12).sum()
            n += b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.float32).tobytes()]), pa.array([loss]), pa.array([float(n)])], ["g", "loss", "n"])

    parts = rows.select("at", "x", "y").mapInArrow(run, "g binary, loss double, n double").toArrow().to_pylist()
    return sum(np.frombuffer(p["g"], np.float32).astype(float) for p in parts), sum(p["loss"] for p in parts), sum(p["n"] for p in parts)


def _platt(linear: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of the logistic curve through the scores, with targets drawn in from 0 and 1."""
    ones, zeros = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([linear, np.ones(len(linear))], 1)
    b = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (target - p) - 1e-3 * (b - [1.0, 0.0]))
        b = b + np.clip(step, -2, 2)
    return max(float(b[0]), 1e-3), float(b[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        most: int = TRAIN_ROWS, steps: int = STEPS, rate: float = 1.0) -> Model | None:
    """Train on at most ``most`` labelled ids, one text each, four fifths for the weights and one for the calibration; None without labels."""
    chosen = labelled(labels, F.lit(True), most, id_col, label_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = T.flat(b.column(0))
            for low, high in T.groups_of_rows(offsets, 1 << 16):
                for step in range(low, high, 64):
                    own = offsets[step:min(step + 64, high) + 1]
                    found = list(_sparse(data, own, T.words(data, own)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.list_(pa.float32())),
                         b.column(1).slice(step, len(found)), b.column(2).slice(step, len(found))], ["at", "x", "y", "part"])

    found = (texts_of(docs, chosen, id_col, text_col).mapInArrow(run, "at array<int>, x array<float>, y double, part int"))
    rows = stage(found.repartition(8), "grams")
    used = rows.where("part < 4")
    weights = np.zeros((1 << BITS) + 1)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        gradient, loss, n = _gradient(used, weights.astype(np.float32))
        if not n:
            return None
        gradient = gradient / n + 1e-6 * weights
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient ** 2
        weights = weights - rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-7)
    model = Model(weights.astype(np.float32))
    seen = rows.where("part = 4").toArrow()  # a fifth of at most ``most`` rows
    if not seen.num_rows:
        return model
    linear = np.array([float(weights[a] @ np.array(x)) + weights[-1] for a, x in zip(seen["at"].to_pylist(), seen["x"].to_pylist())])
    model.slope, model.shift = _platt(linear, seen["y"].to_numpy())
    return model


def judged(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, counts, probability, base_failed, kept) for every row.

    A null text counts as empty: no words, so it fails. Without a model the probability is 0.5 and only the rules decide.
    Rows that repeat an id are judged one by one; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(f"struct<{','.join(f'{n}:bigint' for n in NAMES)},probability:double>")
    def measure(column: pa.Array) -> pa.Array:
        return measured(column, sent.value)

    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return (docs.select(F.col(id_col), measure(F.col(text_col)).alias("_m")).select(id_col, "_m.*")
            .withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= THRESHOLD)))


def apply(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return judged(docs, fit(docs, labels, id_col, text_col), id_col, text_col)
