"""Hard negatives by inner product search with pruning by coordinates, after LEMP.

Vectors of whole numbers are sorted by length and cut into buckets of similar length. A bucket holds its vectors and, for every
coordinate, the list of its vectors sorted by that coordinate's value. For an anchor and a least score that is still of interest, a
bucket whose longest vector cannot reach it is passed over. In the others, each of the anchor's largest coordinates (its focus) has a range
of values outside which no vector of the bucket's length can reach the score; the ranges are found in the sorted lists, the
shortest one gives the candidates, the others are intersected with it, and what is left is verified by exact inner products.

The buckets are a written table that stays where it is. Anchors go to it in blocks of a bounded number; a task keeps the best of each
anchor among its buckets, so its least scores rise as it goes, and a pass over a fixed share of the buckets before that gives least scores to
start from. Pruning only ever leaves out what cannot be among the best, so results are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultflow.session import stage

#: Vectors in a bucket at most.
BUCKET = 2048
#: Anchors that go to the tasks at a time, about.
BLOCK = 16_384
#: Coordinates of an anchor whose ranges are intersected.
FOCUS = 4
#: One bucket in so many is looked at beforehand, for least scores to start from.
PILOT = 32

_BUCKET_DDL = "bucket bigint, length double, most bigint, ids binary, labels binary, vectors binary, sorted binary"


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256) -> DataFrame:
    """(id, label, v): rows that take part, each component x as ``floor(scale * x)``.

    Rows with a null id, label or vector, or with a component that is null or not finite, take no part.
    """
    x = F.col(vector_col)
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull()).where(~odd)
            .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                    F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double"))).alias("v")))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows; those with fewer components are filled up with zeros."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    wide = int(lengths.max(initial=0))
    out = np.zeros((len(lengths), wide), np.int64)
    out[np.arange(wide)[None, :] < lengths[:, None]] = values
    return out


def index(vectors: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Buckets of ``whole_vectors``, the longest vectors first; written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, bucket):
                some = b.slice(at, bucket)
                m = _matrix(some.column(2))
                order = np.argsort(m.T, axis=1, kind="stable").astype(np.int32)
                length = float(np.sqrt((m.astype(np.float64) ** 2).sum(1).max(initial=0)))
                ids = some.column(0).to_numpy()
                cells = [int(ids[0]), length, int(np.abs(m).max(initial=0)), ids.tobytes(), some.column(1).to_numpy().tobytes(), m.tobytes(), order.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, _BUCKET_TYPES)], _BUCKET_NAMES)

    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")))
    rows = vectors.withColumn("_norm", norm)
    ordered = rows.repartitionByRange(F.desc("_norm"), "id").sortWithinPartitions(F.desc("_norm"), "id")
    return stage(ordered.select("id", "label", "v").mapInArrow(run, _BUCKET_DDL), "buckets")


_BUCKET_NAMES = ["bucket", "length", "most", "ids", "labels", "vectors", "sorted"]
_BUCKET_TYPES = [pa.int64(), pa.float64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]


class Bucket:
    """One row of ``index``, read back."""

    def __init__(self, length: float, most: int, ids: bytes, labels: bytes, vectors: bytes, order: bytes):
        self.length, self.most = length, most
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.vectors = np.frombuffer(vectors, np.int64).reshape(len(self.ids), -1)
        self.order = np.frombuffer(order, np.int32).reshape(self.vectors.shape[1], len(self.ids))
        self._as: dict[type, np.ndarray] = {}
        self._sorted: dict[int, np.ndarray] = {}

    def exact(self, of: type) -> np.ndarray:
        if of not in self._as:
            self._as[of] = self.vectors.astype(of)
        return self._as[of]

    def sorted(self, f: int) -> np.ndarray:
        if f not in self._sorted:
            self._sorted[f] = self.vectors[self.order[f], f]
        return self._sorted[f]


class Ranges(NamedTuple):
    focus: np.ndarray
    low: np.ndarray
    high: np.ndarray


def feasible(q: np.ndarray, norm: float, focus: np.ndarray, length: float, least: float) -> Ranges | None:
    """Values that each focus coordinate may have in a vector no longer than ``length`` whose inner product with ``q`` is ``least`` or more.

    With a coordinate x the rest of the vector is no longer than sqrt(length^2 - x^2), so the product is at most q_f x + |rest of q| sqrt(length^2 - x^2).
    None if no vector reaches ``least``. Ranges are a little wide, never narrow, for rounding.
    """
    if least > norm * length * (1 + 1e-9):
        return None
    a = q[focus].astype(np.float64)
    square = norm * norm
    if square == 0:
        wide = np.full(len(focus), np.inf)
        return Ranges(focus, -wide, wide)
    rest = np.sqrt(np.maximum(square - a * a, 0))
    root = math.sqrt(max(length * length * square - least * least, 0.0))
    slack = 1e-6 * (length + 1)
    low = np.where(-a * length >= least, -length, (a * least - rest * root) / square) - slack
    high = np.where(a * length >= least, length, (a * least + rest * root) / square) + slack
    return Ranges(focus, low, high)


def candidates(bucket: Bucket, r: Ranges) -> np.ndarray | None:
    """Places in the bucket whose focus coordinates are all in range; None for all of them."""
    best, at, n = None, None, len(bucket.ids)
    spans = []
    for f, low, high in zip(r.focus.tolist(), r.low.tolist(), r.high.tolist()):
        values = bucket.sorted(f)
        a, b = int(values.searchsorted(low, "left")), int(values.searchsorted(high, "right"))
        spans.append(b - a)
        if best is None or b - a < best:
            best, at = b - a, (f, a, b)
    if best is None or best == n:
        return None
    found = bucket.order[at[0]][at[1]:at[2]]
    for f, low, high, span in zip(r.focus.tolist(), r.low.tolist(), r.high.tolist(), spans):
        if f != at[0] and span < n and len(found):
            x = bucket.vectors[found, f]
            found = found[(x >= low) & (x <= high)]
    return found


@dataclass
class Anchors:
    """A block of anchors, and of each the bands of scores that are looked for: the best ``k`` within each band."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    low: np.ndarray  # anchors x bands; a band whose low is above its high is not looked for
    high: np.ndarray
    same: bool  # partners of the same label, or of others

    def prepared(self) -> None:
        self.norms = np.sqrt((self.vectors.astype(np.float64) ** 2).sum(1))
        self.most = np.abs(self.vectors).max(1, initial=0)
        self.focus = np.argsort(-np.abs(self.vectors), axis=1, kind="stable")[:, :FOCUS]


class Best:
    """The best ``k`` partners of every band so far: higher scores first, then smaller ids."""

    def __init__(self, anchors: Anchors, k: int):
        self.anchors, self.k = anchors, k
        self.least = anchors.low.copy()
        self.found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def look(self, bucket: Bucket) -> None:
        a = self.anchors
        wide = bucket.vectors.shape[1]
        least = np.where(self.least <= a.high, self.least, np.iinfo(np.int64).max).min(1)
        reach = least <= a.norms * bucket.length * (1 + 1e-9)
        for i in np.flatnonzero(reach & (least < np.iinfo(np.int64).max)).tolist():
            q = a.vectors[i]
            focus = a.focus[i]
            r = feasible(q, a.norms[i], focus[focus < wide], bucket.length, float(least[i]))
            if r is None:
                continue
            at = candidates(bucket, r)
            label = bucket.labels == a.labels[i] if at is None else bucket.labels[at] == a.labels[i]
            keep = np.flatnonzero(label if self.same else ~label)
            at = keep if at is None else at[keep]
            at = at[bucket.ids[at] != a.ids[i]]
            if not len(at):
                continue
            self._merge(i, bucket.ids[at], self._scores(bucket, at, q[:wide], int(a.most[i])))

    @property
    def same(self) -> bool:
        return self.anchors.same

    @staticmethod
    def _scores(bucket: Bucket, at: np.ndarray, q: np.ndarray, most: int) -> np.ndarray:
        bound = most * bucket.most * max(len(q), 1)
        if bound >= 1 << 63:
            raise OverflowError("an inner product may not fit into 64 bits")
        of = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
        own = bucket.exact(of)[:, :len(q)]
        return (own[at] @ q.astype(of)).astype(np.int64)

    def _merge(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        a = self.anchors
        for j in range(a.low.shape[1]):
            fits = np.flatnonzero((scores >= self.least[i, j]) & (scores <= a.high[i, j]))
            if not len(fits):
                continue
            s, who = scores[fits], ids[fits]
            if (i, j) in self.found:
                s, who = np.concatenate([self.found[i, j][0], s]), np.concatenate([self.found[i, j][1], who])
            order = np.lexsort((who, -s))[:self.k]
            self.found[i, j] = s[order], who[order]
            if len(order) == self.k:
                self.least[i, j] = max(self.least[i, j], s[order[-1]])

    def rows(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        for (i, j), (s, who) in self.found.items():
            yield i, j, s, who


def _best_in_tasks(buckets: DataFrame, anchors: Anchors, k: int) -> DataFrame:
    """(anchor, band, score, id): the best of every band in each task's buckets; anchor and band are positions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors.prepared()
        best = Best(anchors, k)
        for b in batches:
            for r in b.to_pylist():
                best.look(Bucket(r["length"], r["most"], r["ids"], r["labels"], r["vectors"], r["sorted"]))
        rows = list(best.rows())
        if rows:
            n = [len(s) for _, _, s, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([i for i, *_ in rows], n), pa.int32()), pa.array(np.repeat([j for _, j, *_ in rows], n), pa.int32()),
                 pa.array(np.concatenate([s for *_, s, _ in rows]), pa.int64()), pa.array(np.concatenate([w for *_, w in rows]), pa.int64())],
                ["anchor", "band", "score", "id"])

    wanted = buckets.select("length", "most", "ids", "labels", "vectors", "sorted")
    return wanted.mapInArrow(run, "anchor int, band int, score bigint, id bigint")


def _best(buckets: DataFrame, anchors: Anchors, k: int, pilot: int = PILOT) -> DataFrame:
    """(anchor, band, rank, id, score): the best ``k`` of every band over all buckets, exact, rank from 1."""
    low = anchors.low
    if pilot > 1:
        first = _ranked(_best_in_tasks(buckets.where(F.pmod(F.xxhash64("bucket"), F.lit(pilot)) == 0), anchors, k), k).where(F.col("rank") == k)
        low = low.copy()
        for r in first.collect():  # one row of each anchor and band of the block at most
            low[r["anchor"], r["band"]] = max(low[r["anchor"], r["band"]], r["score"])
    return _ranked(_best_in_tasks(buckets, Anchors(anchors.ids, anchors.labels, anchors.vectors, low, anchors.high, anchors.same), k), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "band").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


_NONE, _ALL = -(1 << 62), 1 << 62
_RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, percent: int = 80, block: int = BLOCK,
         bucket: int = BUCKET, pilot: int = PILOT) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for ``whole_vectors`` and some of them as anchors.

    An anchor's positives are the best ``positives`` other rows of its label; of each positive, the best ``negatives`` rows of other
    labels whose score is at most the positive's and at least ``percent`` of it are returned, higher scores first, then smaller ids.
    Rows count each for itself where they repeat an id, but are never partners of a row with the same id; anchors that repeat in all count once.
    Vectors of different length are compared as if filled up with zeros. A score that might not fit into 64 bits is an error. Without anchors,
    positives or negatives in range there are no rows.
    """
    spark = vectors.sparkSession
    own = stage(anchors.select("id", "label", "v").distinct(), "anchors")
    blocks = -(-own.count() * 5 // (4 * block))
    buckets = index(vectors, bucket)
    parts = []
    for n in range(blocks):
        # a block: bounded, whatever the tables hold
        some = own.where(F.pmod(F.xxhash64("id", "label", "v"), F.lit(blocks)) == n).toArrow()
        if not some.num_rows:
            continue
        some = some.combine_chunks().to_batches()[0]
        ids, labels, m = some.column(0).to_numpy(), some.column(1).to_numpy(), _matrix(some.column(2))
        everything = np.full((len(ids), 1), _NONE, np.int64), np.full((len(ids), 1), _ALL, np.int64)
        close = _best(buckets, Anchors(ids, labels, m, *everything, True), positives, pilot).collect()  # positives of the block at most
        scores = np.full((len(ids), positives), -1, np.int64)
        who = np.zeros((len(ids), positives), np.int64)
        for r in close:
            scores[r["anchor"], r["rank"] - 1], who[r["anchor"], r["rank"] - 1] = r["score"], r["id"]
        # where a positive's score is below zero, no score is between a part of it and itself
        low = np.where(scores >= 0, -(-scores * percent // 100), _ALL)
        found = stage(_best(buckets, Anchors(ids, labels, m, low, np.where(scores >= 0, scores, _NONE), False), negatives, pilot), "negatives")
        named = spark.createDataFrame([(int(r["anchor"]), r["rank"] - 1, int(ids[r["anchor"]]), r["id"], r["score"]) for r in close],
                                      "anchor int, band int, anchor_id bigint, positive_id bigint, positive_score bigint")
        parts.append(found.join(named, ["anchor", "band"]).select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], _RESULT)


def with_noise(vectors: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """The label of each row whose id is divisible by ``every`` moved on by one."""
    return vectors.withColumn("label", F.when(F.col("id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label")))


#: The same by comparing every anchor with every row.
ORACLE = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other)::INTEGER AS rank,
       s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""
