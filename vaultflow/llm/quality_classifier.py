"""Quality scores of documents: random Fourier features of document statistics, ridge regression, isotonic calibration.

A text becomes a short vector of statistics (lengths, character classes, repetition). Random Fourier features turn it into a
vector whose inner products approximate a Gaussian kernel, so a linear ridge fit is a kernel fit. Partitions add up their share
of the normal equations; only those sums, of fixed size, reach the driver. An isotonic curve through the scores of rows that
the fit did not see turns scores into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultflow.llm import text as T
from vaultflow.session import stage

#: Labelled rows used at most, those with the smallest hash of their id.
TRAIN_ROWS = 20_000
FEATURES = 256
SIZE = 18

_LETTER = np.array([chr(c).isalpha() or c > 127 for c in range(256)])
_UPPER = np.array([0x41 <= c <= 0x5A for c in range(256)])
_LOWER = np.array([0x61 <= c <= 0x7A for c in range(256)])
_DIGIT = np.array([0x30 <= c <= 0x39 for c in range(256)])


def _among(chars: str) -> np.ndarray:
    return np.array([chr(c) in chars for c in range(256)])


_POINT, _SYMBOL, _LOUD, _END = _among(".,;:"), _among("#*$%&|<>"), _among("!?"), _among(".!?")


def statistics(column: pa.Array) -> np.ndarray:
    """A row of statistics for each text; null and empty texts give zeros."""
    data, offsets = T.flat(column)
    return np.concatenate([_statistics(data, offsets[low:high + 1]) for low, high in T.groups_of_rows(offsets)]
                          or [np.zeros((0, SIZE))])


def _statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    rows = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1).astype(float)
    w = T.words(data, offsets)
    lines = T.words(data, offsets, T.NEWLINE)
    n = T.per_row(w.row, rows)
    some = np.maximum(n, 1)
    length = (w.end - w.start).astype(float)
    mean = T.per_row(w.row, rows, length) / some
    spread = np.sqrt(np.maximum(T.per_row(w.row, rows, length ** 2) / some - mean ** 2, 0))
    upper, lower = T.sums(data, offsets, _UPPER), T.sums(data, offsets, _LOWER)

    key = T.within(w.hash, w.row)
    order = np.argsort(key, kind="stable")
    new = np.ones(len(key), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    heads = np.flatnonzero(new)
    times = np.diff(np.append(heads, len(key))).astype(float)
    of = w.row[order[heads]]
    distinct = T.per_row(of, rows)
    top = np.zeros(rows)
    np.maximum.at(top, of, times)
    entropy = np.log(some) - T.per_row(of, rows, times * np.log(times)) / some

    covered = T.repeated_windows(w, 3)
    _, again = T.repeated(T.within(lines.hash, lines.row))
    n_lines = T.per_row(lines.row, rows)

    last = data[w.end - 1] if len(w.end) else np.zeros(0, np.uint8)
    begins = data[w.start] if len(w.end) else np.zeros(0, np.uint8)
    of_words = lambda flag: T.per_row(w.row, rows, flag.astype(float)) / some
    columns = [
        np.log1p(n), mean, spread, T.sums(data, offsets, _LETTER) / size, upper / np.maximum(upper + lower, 1),
        T.sums(data, offsets, _DIGIT) / size, T.sums(data, offsets, _POINT) / size,
        np.sqrt(T.sums(data, offsets, _SYMBOL) / size), np.sqrt(T.sums(data, offsets, _LOUD) / size),
        np.log1p(n / np.maximum(n_lines, 1)), distinct / some, np.sqrt(top / some),
        entropy / np.maximum(np.log(some), 1), of_words(covered),
        T.per_row(lines.row, rows, again.astype(float)) / np.maximum(n_lines, 1),
        of_words(length == 1), of_words(_END[last]), of_words(_UPPER[begins]),
    ]
    return np.where((n > 0)[:, None], np.stack(columns, 1), 0.0)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    heights: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.sqrt(2 / len(self.phase)) * np.cos(z @ self.waves + self.phase)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights[:-1] + self.weights[-1]

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.knots, self.heights)


def isotonic(scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and heights of the non-decreasing curve that is closest to the labels (pool adjacent violators)."""
    at, where = np.unique(scores, return_inverse=True)
    blocks: list[list[float]] = []  # sum of labels, rows, sum of scores
    for x, y, k in zip(at, np.bincount(where, labels), np.bincount(where)):
        blocks.append([y, k, x * k])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            y, k, s = blocks.pop()
            blocks[-1] = [blocks[-1][0] + y, blocks[-1][1] + k, blocks[-1][2] + s]
    # a block's share of ones is drawn a little to the middle, so that few rows never give certainty
    return (np.array([s / k for _, k, s in blocks]), np.array([(y + 0.5) / (k + 1) for y, k, _ in blocks]))


def labelled(labels: DataFrame, allowed: Column, most: int, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(_id, y, part) of at most ``most`` labelled ids, by smallest hash; y is the majority of an id's labels."""
    known = (labels.where(allowed & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg((F.avg(label_col) >= 0.5).cast("double").alias("y")))
    return (known.withColumn("_h", F.xxhash64("_id", F.lit(9))).orderBy("_h", "_id").limit(most)
            .select("_id", "y", F.pmod("_h", F.lit(5)).cast("int").alias("part")))


def texts_of(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_text, y, part): one text of each chosen id, the smallest where rows share it, so there are no more rows than ids."""
    # ``chosen`` has at most as many rows of 20 bytes as ids may be learned from
    found = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
    return found.groupBy("_id", "y", "part").agg(F.min("_text").alias("_text")).select("_text", "y", "part")


def _added(table: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Normal equations of the rows of ``table``: each partition sends one row of sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = len(model.phase) + 1
        square, right = np.zeros((side, side)), np.zeros(side)
        for b in batches:
            if b.num_rows:
                x = np.stack(b.column(0).to_numpy(zero_copy_only=False))
                z = np.hstack([model.features(x), np.ones((len(x), 1))])
                square += z.T @ z
                right += z.T @ b.column(1).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array([square.tobytes()]), pa.array([right.tobytes()])], ["square", "right"])

    parts = table.select("x", "y").mapInArrow(run, "square binary, right binary").toArrow().to_pylist()
    total = [sum(np.frombuffer(p[k]) for p in parts) for k in ("square", "right")]
    return total[0].reshape(len(total[1]), -1), total[1]


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", most: int = TRAIN_ROWS, ridge: float = 1e-4, seed: int = 9) -> Model | None:
    """Fit on at most ``most`` of the labelled ids for which ``allowed`` holds, one text each; None if there are none.

    Four fifths give the fit and the last fifth the calibration (all of them if a fifth would be empty).
    """
    chosen = labelled(labels, allowed, most, id_col, label_col)

    @F.arrow_udf("array<double>")
    def measured(column: pa.Array) -> pa.Array:
        return pa.array(list(statistics(column)), pa.list_(pa.float64()))

    rows = texts_of(docs, chosen, id_col, text_col).select(measured("_text").alias("x"), "y", "part")
    rows = stage(rows.repartition(8), "labelled")
    x = [F.col("x")[k] for k in range(SIZE)]
    first = rows.agg(F.count("*"), *[F.avg(c) for c in x], *[F.stddev_pop(c) for c in x]).first()
    if not first[0]:
        return None
    mean, scale = np.array(first[1:SIZE + 1]), np.array(first[SIZE + 1:])
    random = np.random.default_rng(seed)
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), random.normal(0, 1 / np.sqrt(SIZE), (SIZE, FEATURES)),
                  random.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1), np.zeros(1), np.zeros(1))
    square, right = _added(rows.where("part < 4"), model)
    count = max(square[-1, -1], 1.0)
    model.weights = np.linalg.solve(square / count + ridge * np.eye(len(right)), right / count)
    seen = rows.where("part = 4").select("x", "y").toArrow()  # at most ``most`` rows
    if not seen.num_rows:
        seen = rows.select("x", "y").toArrow()
    got = np.array(seen["x"].to_pylist())
    model.knots, model.heights = isotonic(model.raw(got), seen["y"].to_numpy())
    return model


def scored(text: Column, model: Model | None) -> Column:
    """Score of a text from 0 to 1, higher for likelier good ones; 0.5 for all if there was nothing to learn from.

    Null and empty texts have statistics of zero and are scored like any other.
    """
    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        if model is None:
            return pa.array(np.full(len(column), 0.5))
        return pa.array(model.score(statistics(column)))

    return score(text)


def crc(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as empty text."""
    return (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % mod).cast("int")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", fold: int = 1, folds: int = 3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; rows of ``fold`` are never learned from."""
    model = fit(docs, labels, crc(id_col, folds) != fold, id_col, text_col, label_col)
    return (docs.select(F.col(id_col), (crc(id_col, folds) == fold).alias("held_out"), scored(F.col(text_col), model).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
