"""Spelling variants by reduced-alphabet generation.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. Letters are hashed to a few symbols; words
that are near have reduced words that are equal or one edit apart. So the full one-edit neighbourhood of every distinct reduced word
is generated over the few symbols (and not over the whole alphabet), met with the vocabulary of reduced words, and the words behind
reduced words that meet are verified on their original strings.

Neighbours are formed as 64-bit hashes from sums over the places of a word, so a word of n letters costs n times the number of symbols
however long it is, and what is shuffled are pairs of numbers. Two words that are one edit apart also agree in their whole first half or
their whole last half; only words behind meeting reduced words that agree in a half are compared, so a reduced word that very many
words share does not bring all of them together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultflow.llm import text as words_of
from vaultflow.llm.components import _jump
from vaultflow.session import stage

#: Symbols that letters are reduced to.
SYMBOLS = 8
#: Neighbours formed at a time in a task.
AT_ONCE = 1 << 20
#: Letters from which on two words are compared in another way: the edit distance takes time by the square of the length.
LONG = 256
LETTERS = "[A-Za-zÀ-ÿ]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def planted(run: Column, id_: Column, every: int = 199) -> Column:
    """A lower-cased run, with one code point taken out where the hash of id and run says so; a null id counts as empty text."""
    h = F.crc32(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(F.pmod(h, F.lit(every)) == 0, cut).otherwise(run)


def words_in(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 6, every: int = 199) -> DataFrame:
    """(word, n): how often each word of ``shortest`` code points or more is in all texts, after ``planted``; only A to Z are lower-cased."""
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"{LETTERS}{{{shortest},}}"), F.lit(0))
    found = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
             .select("id", F.explode(runs).alias("run"))
             .withColumn("run", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", _UPPER, _LOWER)).otherwise(F.col("run"))))
    return (found.select(planted(F.col("run"), F.col("id"), every).alias("word")).where(F.length("word") >= shortest)
            .groupBy("word").agg(F.count("*").alias("n")))


def reduced(codes: np.ndarray, symbols: int = SYMBOLS) -> np.ndarray:
    """The symbol of each code point."""
    return (words_of.mixed(codes.astype(np.uint64) + np.uint64(0x51)) % np.uint64(symbols)).astype(np.int64)


def _weights(symbols: int, places: int) -> np.ndarray:
    """A random number for each place and symbol: the hash of a reduced word is the sum of those of its letters."""
    at = np.arange(places, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    return words_of.mixed(at + (np.arange(symbols, dtype=np.uint64)[None, :] + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F))


def _sums(weights: np.ndarray, s: np.ndarray, shift: int) -> np.ndarray:
    """Sum of the first k letters of each word (k from 0), each letter counted as if it stood ``shift`` places further on."""
    length = s.shape[1]
    places = np.arange(length) + shift
    own = weights[np.maximum(places, 0)[None, :], s]
    out = np.zeros((len(s), length + 1), np.uint64)
    np.cumsum(own, axis=1, out=out[:, 1:])
    return out


def reduced_hash(s: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Hash of reduced words of one length, a row each; the length counts."""
    return words_of.mixed(_sums(weights, s, 0)[:, -1] + np.uint64(s.shape[1]))


def neighbourhood(s: np.ndarray, weights: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, hash) of every word that is one edit away from a reduced word, and of itself; ``s`` has words of one length as rows."""
    rows, length = s.shape
    symbols = weights.shape[1]
    here, later, sooner = (_sums(weights, s, d) for d in (0, 1, -1))
    index = np.arange(rows)

    def hashed(sums: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        sums = sums.reshape(rows, -1)
        return np.repeat(index, sums.shape[1]), words_of.mixed(sums + np.uint64(n)).ravel()

    total = here[:, -1:]
    yield hashed(total, length)
    if length:
        # without the letter at k: those before it stay, those after it move one place forward
        yield hashed(here[:, :-1] + (sooner[:, -1:] - sooner[:, 1:]), length - 1)
    for x in range(symbols):
        # symbol x in place of the letter at k, and before it or at the end
        own = weights[np.arange(length)[None, :], s]
        other = s != x
        row, h = hashed(total - own + weights[:length, x][None, :], length)
        yield row[other.ravel()], h[other.ravel()]
        yield hashed(here + (later[:, -1:] - later) + weights[:length + 1, x][None, :], length + 1)


def _codes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words one after another, and where each begins."""
    joined = "".join(words.to_pylist())
    counts = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.frombuffer(joined.encode("utf-32-le"), np.uint32), np.concatenate([[0], np.cumsum(counts)])


def _by_length(words: pa.Array, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(which words, their symbols, weights) for words of one length, at most so many that their neighbours are about ``AT_ONCE``."""
    codes, at = _codes(words)
    s = reduced(codes, symbols)
    lengths = np.diff(at)
    for length in np.unique(lengths):
        which = np.flatnonzero(lengths == length)
        weights = _weights(symbols, int(length) + 1)
        step = max(1, AT_ONCE // ((2 * symbols + 1) * (int(length) + 1)))
        for k in range(0, len(which), step):
            some = which[k:k + step]
            yield some, s[at[some][:, None] + np.arange(length)[None, :]], weights


def with_reduced(vocabulary: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """``vocabulary`` (word, n) with ``r``, the hash of the reduced word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = np.zeros(b.num_rows, np.uint64)
            for some, s, weights in _by_length(b.column(0), symbols):
                r[some] = reduced_hash(s, weights)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(r.view(np.int64))], ["word", "n", "r"])

    return vocabulary.select("word", F.col("n").cast("long")).mapInArrow(run, "word string, n bigint, r bigint")


def neighbours(classes: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(r, near): every reduced word, given by one word of its class, with the hashes of its one-edit neighbourhood, itself included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = b.column(0).to_numpy()
            for some, s, weights in _by_length(b.column(1), symbols):
                owner, near = (np.concatenate(x) for x in zip(*neighbourhood(s, weights)))
                # a letter taken out of a run of equal ones gives the same word several times
                order = np.lexsort((near, owner))
                owner, near = owner[order], near[order]
                new = np.ones(len(near), bool)
                new[1:] = (near[1:] != near[:-1]) | (owner[1:] != owner[:-1])
                owner, near = owner[new], near[new]
                for k in range(0, len(near), AT_ONCE):
                    yield pa.RecordBatch.from_arrays([pa.array(r[some][owner[k:k + AT_ONCE]]), pa.array(near[k:k + AT_ONCE].view(np.int64))], ["r", "near"])

    return classes.select("r", "word").mapInArrow(run, "r bigint, near bigint")


def _halves(word: Column, c: Column) -> Column:
    """First and last part of a word for comparison with one of ``c`` letters in common: (side, half)."""
    m = F.floor(c / 2).cast("int")
    return F.array(F.struct(F.lit(0).alias("side"), F.substring(word, F.lit(1), m).alias("half")),
                   F.struct(F.lit(1).alias("side"), F.substring(word, F.length(word) - (c - m) + 1, c - m).alias("half")))


def is_near(a: Column, b: Column) -> Column:
    """Are two different words one edit apart. Long ones are compared behind their first difference, in time by their length."""
    first = F.array_position(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.coalesce(x == y, F.lit(False))), False).cast("int")
    behind = lambda w, other: F.substring(w, first + (F.length(w) >= F.length(other)).cast("int"), F.length(w))
    return F.when(F.greatest(F.length(a), F.length(b)) <= LONG, F.levenshtein(a, b, 1) == 1).otherwise(behind(a, b) == behind(b, a))


def near_words(vocabulary: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, other, other_n): every word of a vocabulary (word, n) with each word that is near it, both ways round.

    Words are distinct; null words are left out. An empty vocabulary, or one without near words, gives no rows.
    """
    v = stage(with_reduced(vocabulary.where("word is not null"), symbols), "reduced-words")
    classes = v.groupBy("r").agg(F.min("word").alias("word"))
    met = (neighbours(classes, symbols).join(classes.select(F.col("r").alias("near")), "near", "left_semi"))
    length, other_length = F.length("word"), F.col("c")
    # as the one that looks: c is the shorter of its own length and that of the class it meets, which may be one less or more
    own = (v.join(met, "r").select("word", "n", F.col("near").alias("meets"), F.explode(F.array(length, length - 1)).alias("c"))
           .select("word", "n", "meets", "c", F.explode(_halves(F.col("word"), other_length)).alias("h")))
    there = (v.select(F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("r").alias("meets"),
                      F.explode(F.array(length, length - 1)).alias("c"))
             .select("other", "other_n", "meets", "c", F.explode(_halves(F.col("other"), other_length)).alias("h")))
    on = ["meets", "c", "side", "half"]
    flat = lambda d: d.withColumns({"side": F.col("h.side"), "half": F.col("h.half")}).drop("h")
    both = flat(own).join(flat(there), on)
    m = F.floor(F.col("c") / 2).cast("int")
    # a pair is looked at once: with c the shorter length, and by its last half only if the first ones differ
    once = ((F.col("c") == F.least(F.length("word"), F.length("other")))
            & ((F.col("side") == 0) | (F.substring("word", F.lit(1), m) != F.substring("other", F.lit(1), m))))
    return (both.where(once & (F.col("word") != F.col("other"))).where(is_near(F.col("word"), F.col("other")))
            .select("word", "n", "other", "other_n"))


def variants(vocabulary: DataFrame, least_ratio: int = 5, symbols: int = SYMBOLS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of a vocabulary (word, n).

    ``form`` is the near word of largest n, the first in code-point order among equals, if its n is at least ``least_ratio`` times the word's; else
    null. ``root`` is the last word when forms are followed from the word, the word itself where it has none.
    """
    v = stage(vocabulary, "vocabulary")
    best = (near_words(v, symbols).groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other"))).alias("best"))
            .select(F.col("word").alias("_w"), "n_near", F.col("best.other").alias("_form"), (-F.col("best.minus")).alias("_form_n")))
    enough = F.col("_form_n") >= least_ratio * F.col("n")
    known = stage(v.join(best, F.col("word") == F.col("_w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("_form")).alias("form"), F.when(enough, F.col("_form_n")).alias("form_n")), "forms")
    followed = _jump(known.where("form is not null").select(F.col("word").alias("node"), F.col("form").alias("parent")))
    return (known.join(followed, F.col("word") == F.col("node"), "left")
            .select("word", "form", F.coalesce("parent", "word").alias("root"), "n", "n_near", "form_n"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 6, least: int = 5, every: int = 199,
                      least_ratio: int = 5, symbols: int = SYMBOLS) -> DataFrame:
    """Words of all texts with the word that each is most likely a variant of; see ``variants`` and ``words_in``.

    Words with at least ``least`` occurrences count. Null and empty texts have no words, an empty table gives no rows, rows that repeat count each,
    other columns are not read.
    """
    return variants(words_in(docs, id_col, text_col, shortest, every).where(F.col("n") >= least), least_ratio, symbols)
