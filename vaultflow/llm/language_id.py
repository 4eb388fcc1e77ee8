"""Language of texts by prediction by partial matching over bytes.

Each language has a context tree of up to ``ORDER`` bytes. A byte costs minus the logarithm of its probability in the longest
context that the tree knows; where it was never seen there, the cost of the escape (method C, without exclusions) is added and the
context gets one byte shorter, down to a uniform guess. The statistics are frozen after training, so every cost is worked out
once and scoring is a lookup of the last bytes, longest first. The language with the shortest code wins.

Texts are compared in lower case, with every run of ASCII characters other than letters as one space.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultflow.llm import text as T
from vaultflow.llm.quality_classifier import crc

ORDER = 4
#: Bytes of text learned from per language, about; documents are chosen by hash of their id.
TRAIN_BYTES = 4 << 20
#: Longest contexts kept, an equal share for each language: its most frequent ones, or all that it has.
CONTEXTS = 400_000
UNKNOWN = "und"
CHUNK = 1 << 18

_LETTER = np.array([c > 127 or chr(c).isalpha() for c in range(256)])
_ASCII_LETTER = np.array([c < 128 and chr(c).isalpha() for c in range(256)])
_SHOWN = np.where(_LETTER, np.arange(256), 0x20).astype(np.uint8)


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compared bytes with ``ORDER`` spaces before each text, the places of the bytes to be coded, and their texts."""
    part = data[offsets[0]:offsets[-1]]
    shown = _SHOWN[part]
    gap = shown == 0x20
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    inner = (offsets[1:-1] - offsets[0])
    keep[inner[inner < len(part)]] = ~gap[inner[inner < len(part)]]
    if len(part):
        keep[0] = not gap[0]
    ends = np.append(0, np.cumsum(keep))[offsets - offsets[0]]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(ends))
    place = np.arange(len(row)) + ORDER * (row + 1)
    out = np.full(len(row) + ORDER * (len(offsets) - 1), 0x20, np.uint8)
    out[place] = shown[keep]
    return out, place, row


def keys(out: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The last ``ORDER`` + 1 bytes at each place as one number."""
    key = np.zeros(len(place), np.uint64)
    for k in range(ORDER, -1, -1):
        key = key << np.uint64(8) | out[place - k]
    return key


class Table:
    """Rows of a sorted set of keys, by open addressing."""

    def __init__(self, known: np.ndarray):
        self.bits = np.uint64(64 - max(4, int(2 * len(known)).bit_length()))
        self.keys = np.zeros(1 << int(np.uint64(64) - self.bits), np.uint64)
        self.rows = np.full(len(self.keys), -1, np.int32)
        left, slot = np.arange(len(known)), self._slot(known)
        while len(left):
            free = self.rows[slot] < 0
            _, first = np.unique(slot[free], return_index=True)
            take = np.flatnonzero(free)[first]
            self.rows[slot[take]] = left[take]
            self.keys[slot[take]] = known[left[take]]
            rest = np.ones(len(left), bool)
            rest[take] = False
            left, slot = left[rest], (slot[rest] + 1) % len(self.keys)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key * np.uint64(0x9FB21C651E98DF25) >> self.bits).astype(np.int64)

    def find(self, key: np.ndarray) -> np.ndarray:
        slot = self._slot(key)
        row = self.rows[slot]
        other = np.flatnonzero((row >= 0) & (self.keys[slot] != key))
        while len(other):
            slot[other] = (slot[other] + 1) % len(self.keys)
            row[other] = self.rows[slot[other]]
            other = other[(row[other] >= 0) & (self.keys[slot[other]] != key[other])]
        return row


@dataclass
class Model:
    """For each length of key from 1 to ``ORDER`` + 1: its table, cost in bits and cost of an escape by language."""
    languages: list[str]
    tables: list[Table]
    cost: list[np.ndarray]
    escape: list[np.ndarray]  # of contexts of 0 to ``ORDER`` bytes

    def bits(self, key: np.ndarray) -> np.ndarray:
        """Cost of the last byte of each key in each language."""
        out = np.zeros((len(key), len(self.languages)), np.float32)
        left = np.arange(len(key))
        for size in range(ORDER + 1, 0, -1):
            own = key[left] & np.uint64((1 << (8 * size)) - 1)
            row = self.tables[size - 1].find(own)
            seen = row >= 0
            out[left[seen]] += self.cost[size - 1][row[seen]]
            left = left[~seen]
            if not len(left):
                return out
            if size > 1:
                context = self.tables[size - 2].find(own[~seen] >> np.uint64(8))
                known = context >= 0
                out[left[known]] += self.escape[size - 1][context[known]]
            else:
                out[left] += self.escape[0][0] + np.float32(8)
        return out


def frozen(languages: list[str], language: np.ndarray, key: np.ndarray, count: np.ndarray) -> Model:
    """The model from how often each key of ``ORDER`` + 1 bytes was seen in each language."""
    n_languages = len(languages)
    known = [np.unique(key)]
    for size in range(ORDER, 0, -1):
        mask = np.uint64((1 << (8 * size)) - 1)
        known.append(np.unique(np.concatenate([known[-1] & mask, known[-1] >> np.uint64(8)])))
    known.reverse()

    def summed(at: np.ndarray, rows: int, values: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(at, values[:, k], rows) for k in range(n_languages)], 1)

    seen = np.zeros((len(known[-1]), n_languages))
    np.add.at(seen, (np.searchsorted(known[-1], key), language), count)
    counts = [seen]
    for size in range(ORDER, 0, -1):  # a shorter key was seen wherever a longer one ends in it
        at = np.searchsorted(known[size - 1], known[size] & np.uint64((1 << (8 * size)) - 1))
        counts.append(summed(at, len(known[size - 1]), counts[-1]))
    counts.reverse()
    cost, escape = [], []
    for size in range(1, ORDER + 2):
        n = counts[size - 1]
        context = np.zeros(len(n), np.int64) if size == 1 else np.searchsorted(known[size - 2], known[size - 1] >> np.uint64(8))
        rows = 1 if size == 1 else len(known[size - 2])
        total, kinds = summed(context, rows, n), summed(context, rows, (n > 0).astype(float))
        fled = np.where(total > 0, -np.log2(np.maximum(kinds, 1) / np.maximum(total + kinds, 1)), 0.0)
        direct = -np.log2(np.maximum(n, 1) / np.maximum(total + kinds, 1)[context])
        shorter = np.full((len(n), n_languages), 8.0) if size == 1 else (
            cost[-1][np.searchsorted(known[size - 2], known[size - 1] & np.uint64((1 << (8 * (size - 1))) - 1))])
        cost.append(np.where(n > 0, direct, fled[context] + shorter).astype(np.float32))
        escape.append(fled.astype(np.float32))
    return Model(languages, [Table(k) for k in known], cost, escape)


def fit(docs: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        train_bytes: int = TRAIN_BYTES, contexts: int = CONTEXTS) -> Model | None:
    """Train on about ``train_bytes`` of each language among the rows for which ``allowed`` holds; None without any.

    Every language is learned, from one document at least and from all it has if that is less than ``train_bytes``; a language with
    few texts keeps all its contexts, however much text the others have.
    """
    rows = (docs.where(allowed & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")))
    place = F.pmod(F.xxhash64("id", F.lit(10)), F.lit(1 << 20))
    sizes = (rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n"), F.min(F.when(F.octet_length("text") > 0, place)).alias("least"))
             .where("n > 0").collect())  # a row per language
    names = sorted(r["lang"] for r in sizes)
    if not names:
        return None
    # documents below this place are learned from, the first one in any case
    upto = {r["lang"]: max(int(min(1.0, train_bytes / r["n"]) * (1 << 20)), r["least"] + 1) for r in sizes}
    known = F.create_map(*[F.lit(x) for k, n in enumerate(names) for x in (n, k)])
    bounds = F.array(*[F.lit(upto[n]) for n in names])
    some = (rows.withColumn("language", F.element_at(known, F.col("lang")))
            .where(F.col("language").isNotNull() & (place < F.get(bounds, F.col("language")))).select("language", "text"))
    share = max(1, contexts // len(names))
    most = Window.orderBy(F.desc("n"), "key")  # first among a sixteenth of a language's contexts, then among what is left of all

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = T.flat(pc.utf8_lower(b.column(1)))
            language = b.column(0).to_numpy()
            for low, high in T.groups_of_rows(offsets):
                out, place, row = symbols(data, offsets[low:high + 1])
                key, of = keys(out, place), language[low:high][row]
                for k in np.unique(of):
                    found, n = np.unique(key[of == k], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), k, np.int32)), pa.array(found.view(np.int64)), pa.array(n)],
                                                     ["language", "key", "n"])

    counted = (some.mapInArrow(run, "language int, key bigint, n bigint").groupBy("language", "key").agg(F.sum("n").alias("n"))
               .withColumn("_n", F.row_number().over(most.partitionBy("language", F.pmod("key", F.lit(16))))).where(F.col("_n") <= share)
               .withColumn("_n", F.row_number().over(most.partitionBy("language"))).where(F.col("_n") <= share)
               .select("language", "key", "n").toArrow())
    if not counted.num_rows:
        return None
    return frozen(names, *(counted[c].to_numpy() for c in ("language",)), counted["key"].to_numpy().view(np.uint64), counted["n"].to_numpy())


def identified(column: pa.Array, model: Model | None) -> pa.StructArray:
    """Language and score of each text."""
    lower = pc.utf8_lower(pc.fill_null(column, ""))
    data, offsets = T.flat(lower)
    names, scores = [UNKNOWN] * len(column), np.zeros(len(column))
    for low, high in T.groups_of_rows(offsets) if model else ():
        own = offsets[low:high + 1]
        letters = T.sums(data, own, _ASCII_LETTER) > 0
        for k in np.flatnonzero(~letters & (np.diff(own) > 0)):
            letters[k] = any(c.isalpha() for c in lower[low + int(k)].as_py())
        out, place, row = symbols(data, own)
        total = np.zeros((high - low, len(model.languages)))
        for at in range(0, len(place), CHUNK):
            bits, of = model.bits(keys(out, place[at:at + CHUNK])), row[at:at + CHUNK]
            for k in range(len(model.languages)):
                total[:, k] += np.bincount(of, bits[:, k], high - low)
        count = np.bincount(row, minlength=high - low)
        mean = total / np.maximum(count, 1)[:, None]
        best = mean.argmin(1)
        # how much of the belief the winner has after some two dozen bytes like the text's average one
        odds = np.exp2(-(mean - mean.min(1, keepdims=True)) * np.minimum(count, 24)[:, None])
        for k in np.flatnonzero(letters):
            names[low + int(k)] = model.languages[best[k]]
            scores[low + int(k)] = 1 / odds[k].sum()
    return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], ["lang_pred", "score"])


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fold: int = 2,
             folds: int = 4) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row; rows of ``fold`` are never learned from.

    Null texts and texts without a letter are ``und`` with score 0, and so is everything if there was nothing to learn
    from. Equally long codes: the language first in the alphabet.
    """
    held = crc(id_col, folds) == fold
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, ~held, id_col, text_col, lang_col))

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def identify(column: pa.Array) -> pa.Array:
        return identified(column, sent.value)

    return (docs.select(F.col(id_col), held.alias("held_out"), identify(F.col(text_col)).alias("_p"))
            .select(id_col, "held_out", "_p.lang_pred", "_p.score"))
