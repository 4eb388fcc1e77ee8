"""Benchmark passages in documents, found by greedy string tiling.

Documents and benchmark items that share a seed (a run of ``min_match`` words) are compared: the longest match of words that
neither side has used yet is marked as a tile, again and again, until no match of ``min_match`` words is left. Matches are
found by Karp-Rabin hashes of the runs and extended along diagonals. The share of the item's words under tiles is its coverage;
moving passages around does not change it much, unlike the longest match. An item of fewer than ``min_match`` words has no seed: it is
searched as one run of all its words, which must be there as it is.

A word is a run of letters and digits; in scripts that put no spaces between words each character is one.

The benchmark is a stated query set: it is sent to the tasks in blocks of bounded size, and each block is compared with all
documents. No document is moved.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DataType, IntegerType, StructField, StructType

from vaultflow.llm import text as T

MIN_MATCH = 5
COVERAGE = 0.6
#: Bytes of benchmark text sent to the tasks at a time.
BLOCK_BYTES = 4 << 20
#: Pairs of places formed at a time, and matches without room after which the rest are looked through.
PAIRS = 1 << 20
FRUITLESS = 1024


@dataclass
class Short:
    """Items of equally few words."""
    size: int
    ids: list
    hashes: np.ndarray  # words of each item, a row per item
    runs: np.ndarray  # hash of each item's words, ascending


@dataclass
class Items:
    """A block of benchmark items: words of all of them one after another, and their seeds, sorted."""
    ids: list
    first: np.ndarray  # where the words of each item begin, one more than items
    hashes: np.ndarray
    seeds: np.ndarray  # distinct, sorted
    seed_at: np.ndarray  # where the places of each seed begin, one more than seeds
    places: np.ndarray  # index of a seed's first word
    filter: np.ndarray  # by the low bits of a hash: is there such a seed
    short: list[Short]


#: Characters of scripts that are written without spaces between words.
UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"
#: Least first byte of their UTF-8.
UNSPACED_BYTE = 0xE0


def tokens(column: pa.Array) -> Iterator[tuple[int, int, T.Words]]:
    """Lower-case words of letters and digits, for ranges of texts of bounded size."""
    lower = pc.utf8_lower(column)
    data, offsets = T.flat(lower)
    for low, high in T.groups_of_rows(offsets):
        if (data[offsets[low]:offsets[high]] >= UNSPACED_BYTE).any():
            yield low, high, T.words(*T.flat(pc.replace_substring_regex(lower.slice(low, high - low), UNSPACED, r" \1 ")), T.NOT_ALNUM)
        else:
            yield low, high, T.words(data, offsets[low:high + 1], T.NOT_ALNUM)


def _shorts(found: dict[int, list[tuple[object, np.ndarray]]]) -> list[Short]:
    """Short items by their number of words."""
    out = []
    for size, some in sorted(found.items()):
        hashes = np.stack([h for _, h in some])
        row, none = np.repeat(np.arange(len(some)), size), np.zeros(hashes.size, np.int64)
        runs, _ = T.windows(T.Words(row, none, none, hashes.ravel()), size)
        order = np.argsort(runs, kind="stable")
        out.append(Short(size, [some[k][0] for k in order], hashes[order], runs[order]))
    return out


def items_of(table: pa.Table, min_match: int, short: bool = False) -> Items:
    """The block with items of at least ``min_match`` words, and with ``short`` those of fewer, but at least one."""
    ids, first, hashes, runs, places, few = [], [0], [], [], [], {}
    for low, high, w in tokens(table.column(1).combine_chunks()):
        for k in range(low, high):
            own = w.hash[np.searchsorted(w.row, k - low):np.searchsorted(w.row, k - low, "right")]
            if len(own) < min_match:
                if short and len(own):
                    few.setdefault(len(own), []).append((table.column(0)[k].as_py(), own))
                continue
            ids.append(table.column(0)[k].as_py())
            none = np.zeros(len(own), np.int64)
            seed, at = T.windows(T.Words(none, none, none, own), min_match)
            runs.append(seed)
            places.append(at + first[-1])
            hashes.append(own)
            first.append(first[-1] + len(own))
    every = np.concatenate(runs) if runs else np.zeros(0, np.uint64)
    order = np.argsort(every, kind="stable")
    seeds, at = np.unique(every[order], return_index=True)
    small = np.zeros(1 << max(16, int(len(seeds)).bit_length() + 5), bool)
    small[seeds & np.uint64(len(small) - 1)] = True
    joined = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return Items(ids, np.array(first), joined(hashes, np.uint64), seeds, np.append(at, len(every)),
                 joined(places, np.int64)[order], small, _shorts(few))


def _short_found(w: T.Words, short: Short) -> Iterator[tuple[int, int]]:
    """(text, item) for every short item that is in a text, once."""
    run, first = T.windows(w, short.size)
    at = np.searchsorted(short.runs, run)
    upto = np.searchsorted(short.runs, run, "right")
    while (at < upto).any():  # as often as equal items repeat
        left = at < upto
        at, upto, first = at[left], upto[left], first[left]
        sure = np.ones(len(at), bool)
        for step in range(short.size):  # word by word, in case two runs have one hash
            sure &= w.hash[first + step] == short.hashes[at, step]
        yield from np.unique(np.stack([w.row[first[sure]], at[sure]], 1), axis=0).tolist()
        at = at + 1


def _diagonals(i: np.ndarray, j: np.ndarray, n: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of ``n`` seeds that begin at (i, j); those that continue one another on a diagonal of one item are joined."""
    diagonal = i - j - np.searchsorted(first, j, "right")
    order = np.argsort((diagonal << 32) + i)
    i, j, n, diagonal = i[order], j[order], n[order], diagonal[order]
    new = np.ones(len(i), bool)
    new[1:] = (i[1:] != i[:-1] + n[:-1]) | (np.diff(diagonal) != 0)
    heads = np.flatnonzero(new)
    return i[heads], j[heads], np.add.reduceat(n, heads) if len(heads) else n


def _matches(hits: np.ndarray, seeds: np.ndarray, w: T.Words, items: Items, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Longest matches (place in the text, place in the items, words) from the places of seeds in a text.

    Pairs of places are formed ``PAIRS`` at a time and only their runs are kept, so a text and an item that both repeat a few
    words very often need memory by their lengths, not by their product.
    """
    count = items.seed_at[seeds + 1] - items.seed_at[seeds]
    upto = np.append(0, np.cumsum(count))
    found, low = [], 0
    while low < len(hits):
        high = max(low + 1, int(np.searchsorted(upto, upto[low] + PAIRS, "right")) - 1)
        times = count[low:high]
        i = np.repeat(hits[low:high], times)
        j = items.places[np.repeat(items.seed_at[seeds[low:high]], times) + np.arange(len(i)) - np.repeat(upto[low:high] - upto[low], times)]
        # word by word, in case two runs have one hash
        sure = np.ones(len(i), bool)
        for step in range(size):
            sure &= w.hash[i + step] == items.hashes[j + step]
        found.append(_diagonals(i[sure], j[sure], np.ones(int(sure.sum()), np.int64), items.first))
        low = high
    i, j, n = _diagonals(*(np.concatenate(x) for x in zip(*found)), items.first)
    return i, j, n + size - 1


def tile(i: np.ndarray, j: np.ndarray, n: np.ndarray, n_item: int, size: int) -> tuple[int, int]:
    """Words of the item under tiles, and the longest tile: the longest unmarked match first, ties by place."""
    order = np.lexsort((j, i, -n))
    i, j, n = i[order] - i.min(), j[order], n[order]
    in_doc, in_item = np.zeros(int((i + n).max()), bool), np.zeros(n_item, bool)
    pieces: list[tuple[int, int, int]] = []  # what is left of matches that are partly marked
    at = longest = fruitless = 0
    while at < len(n) or pieces:
        whole = (-int(n[at]), int(i[at]), int(j[at])) if at < len(n) else None
        if whole is None or (pieces and pieces[0] < whole):
            whole = heapq.heappop(pieces)
        else:
            at += 1
        m, a, b = -whole[0], whole[1], whole[2]
        marked = in_doc[a:a + m] | in_item[b:b + m]
        if not marked.any():
            in_doc[a:a + m] = in_item[b:b + m] = True
            longest = max(longest, m)
            if in_item.all():
                break
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[True], marked, [True]]).astype(np.int8))).reshape(-1, 2)
        left = edges[edges[:, 1] - edges[:, 0] >= size].tolist()
        for low, high in left:  # comes back in its place
            heapq.heappush(pieces, (low - high, a + low, b + low))
        fruitless += not left
        if fruitless == FRUITLESS:  # put aside all that have too few unmarked words by now
            room = np.append(0, np.cumsum(~in_item))
            keep = room[j[at:] + n[at:]] - room[j[at:]] >= size
            i, j, n, at, fruitless = i[at:][keep], j[at:][keep], n[at:][keep], 0, 0
    return int(in_item.sum()), longest


def found_in(column: pa.Array, items: Items, size: int, coverage: float) -> list[list[dict]]:
    """For each text, the items of which ``coverage`` or more is under tiles."""
    out: list[list[dict]] = [[] for _ in range(len(column))]
    if not len(items.seeds) and not items.short:
        return out
    for low, _, w in tokens(column):
        for short in items.short:
            for k, q in _short_found(w, short):
                out[low + k].append({"item_id": short.ids[q], "item_words": short.size, "covered_words": short.size, "longest_tile": short.size})
        if not len(items.seeds):
            continue
        run, first = T.windows(w, size)
        maybe = np.flatnonzero(items.filter[run & np.uint64(len(items.filter) - 1)])
        at = np.minimum(np.searchsorted(items.seeds, run[maybe]), len(items.seeds) - 1)
        same = items.seeds[at] == run[maybe]
        hits, at = first[maybe[same]], at[same]
        rows = w.row[hits]
        for k in np.unique(rows):  # only texts that share a seed
            mine = slice(np.searchsorted(rows, k), np.searchsorted(rows, k, "right"))
            i, j, n = _matches(hits[mine], at[mine], w, items, size)
            item = np.searchsorted(items.first, j, "right") - 1
            order = np.argsort(item, kind="stable")
            i, j, n, item = i[order], j[order], n[order], item[order]
            for q, head in zip(*np.unique(item, return_index=True)):
                which = slice(head, np.searchsorted(item, q, "right"))
                start, words = int(items.first[q]), int(items.first[q + 1] - items.first[q])
                if n[which].sum() < coverage * words:
                    continue  # tiles cover no more than the matches together
                covered, longest = tile(i[which], j[which] - start, n[which], words, size)
                if covered >= coverage * words:
                    out[low + int(k)].append({"item_id": items.ids[q], "item_words": words, "covered_words": covered, "longest_tile": longest})
    return out


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", min_match: int = MIN_MATCH,
           block_bytes: int = BLOCK_BYTES) -> Iterator[Items]:
    """The benchmark in blocks of about ``block_bytes``, dealt by hash; only one is in the driver at a time."""
    named = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes)
    for k in range(n):
        yield items_of(named.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).toArrow(), min_match, short=True)


def match_type(id_type: DataType) -> ArrayType:
    return ArrayType(StructType([StructField("item_id", id_type), *(StructField(n, IntegerType()) for n in ("item_words", "covered_words", "longest_tile"))]))


def matches_of(docs: DataFrame, text_col: str, items: Items, id_type: DataType, min_match: int, coverage: float) -> Column:
    """Array of the items of one block that a text contains."""
    sent = docs.sparkSession.sparkContext.broadcast(items)
    kind = match_type(id_type)

    @F.arrow_udf(kind)
    def find(column: pa.Array) -> pa.Array:
        return pa.array(found_in(column, sent.value, min_match, coverage), to_arrow_type(kind))

    return find(F.col(text_col))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", min_match: int = MIN_MATCH,
                 coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, item_words, covered_words, longest_tile, coverage) for every contaminated pair.

    Null and empty texts contain nothing; an item with fewer than ``min_match`` words is found where all of them stand in a row, one without
    words nowhere; equal items and repeated rows each get their pairs; an empty benchmark gives an empty table.
    """
    id_type = benchmark.schema[item_id_col].dataType
    parts = [docs.select(F.col(id_col), F.explode(matches_of(docs, text_col, items, id_type, min_match, coverage)).alias("_m"))
             for items in blocks(benchmark, item_id_col, item_text_col, min_match, block_bytes)]
    if not parts:
        parts = [docs.where("false").select(F.col(id_col), F.explode(F.lit(None).cast(match_type(id_type))).alias("_m"))]
    return (reduce(DataFrame.unionByName, parts)
            .select(id_col, "_m.item_id", "_m.item_words", "_m.covered_words", "_m.longest_tile",
                    (F.col("_m.covered_words") / F.col("_m.item_words")).alias("coverage")))


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
          item_text_col: str = "text", min_match: int = MIN_MATCH, coverage: float = COVERAGE,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that contain no item, all columns as they are."""
    id_type = benchmark.schema[item_id_col].dataType
    for items in blocks(benchmark, item_id_col, item_text_col, min_match, block_bytes):
        docs = docs.where(F.size(matches_of(docs, text_col, items, id_type, min_match, coverage)) == 0)
    return docs
