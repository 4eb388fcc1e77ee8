"""Near copies by SimHash: fingerprints of word shingles, linked at a small Hamming distance by ball hashing.

Two fingerprints at distance 2r or less have a middle at distance r or less from both. Every distinct fingerprint therefore
stands for all its variants with up to r flipped bits, and two fingerprints that share a variant are at distance 2r or less.
Variants are shuffled by their leading bits: a fingerprint travels once for each leading part that its variants have, and the
task that holds a leading part forms the variants that belong to it. So each variant is formed and compared exactly once, while the
rows that move are about a fifteenth of the variants.

How many bits lead follows from the number of fingerprints, so that the mean part stays small. A part that is crowded all the same,
because many fingerprints begin alike, is cut by further bits, before the shuffle where it has very many rows and in its task otherwise.

Equal texts share a fingerprint and are handled as one, so groups of copies of any size cost one row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultflow.llm.components import components
from vaultflow.session import stage

SEED = 42
#: Variants are shuffled by this many leading bits, or by as many more as keep the mean part at ``PART_ROWS`` rows.
LEAD = 16
PART_ROWS = 1 << 16
#: A part with more rows than this is cut by ``MORE`` further bits, again and again.
CROWDED_ROWS = 1 << 18
MORE = 8
#: Variants formed at a time in a task (twice as many at most), further bits that a task cuts by, and words hashed at a time.
AT_ONCE = 1 << 20
STEP = 4
WORDS = 1 << 17
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _pieces(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words of a text, a bounded number of bytes at a time."""
    at = 0
    while at < len(text):
        to = at + size
        gap = _SPACE.search(text, to)
        to = gap.start() if gap else len(text)
        yield text[at:to].split()
        at = to


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64 majority bits over the hashes of all shingles of a text, repeats included; 0 if there is no word."""
    ones, count, held = np.zeros(64, np.int64), 0, []
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    first = True

    def add(run: list[bytes]) -> None:
        nonlocal ones, count
        joined = b" ".join(run)
        ends = np.cumsum([len(w) + 1 for w in run])
        starts = [0, *ends[:-1].tolist()][:len(run) - shingle + 1]
        stops = (ends - 1).tolist()[shingle - 1:]
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, stops)), np.uint64, len(starts))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
        count += len(h)

    for piece in _pieces(raw):
        held += piece
        while len(held) >= WORDS:
            add(held[:WORDS])
            held, first = held[WORDS - shingle + 1:], False
    if len(held) >= shingle:
        add(held)
    elif held and first:
        h = np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], np.uint64)
        ones, count = np.unpackbits(h.view(np.uint8), bitorder="little").astype(np.int64), 1
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed 64-bit number; a null text counts as empty."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp bigint")


def _masks(bits: list[int], most: int) -> list[int]:
    return [sum(1 << b for b in c) for k in range(most + 1) for c in combinations(bits, k)]


def _span(variants: np.ndarray, owner: np.ndarray, fps: np.ndarray) -> np.ndarray:
    """Links between owners of equal variants that keep all of them connected: rows of (larger, smaller) fingerprint."""
    order = np.lexsort((owner, variants))
    v, o = variants[order], owner[order]
    new = np.ones(len(v), bool)
    new[1:] = v[1:] != v[:-1]
    head = o[np.maximum.accumulate(np.where(new, np.arange(len(v)), 0))]
    pairs = np.unique(np.stack([o, head], 1)[~new], axis=0)
    a, b = pairs[:, 0], pairs[:, 1]
    part, kept = np.arange(len(fps)), []
    while len(a):
        x, y = part[a], part[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        high, low = np.maximum(x, y), np.minimum(x, y)
        top, where = np.unique(high, return_index=True)
        kept.append(np.stack([fps[a[where]], fps[b[where]]], 1))
        part[top] = low[where]
        while not np.array_equal(up := part[part], part):
            part = up
    return np.concatenate(kept) if kept else np.zeros((0, 2), np.uint64)


def _formed(fps: np.ndarray, lead: np.ndarray, left: np.ndarray, low: list[list[int]], bits: int) -> Iterator[np.ndarray]:
    """Links among fingerprints of whole parts, all of their variants formed together."""
    rest = 64 - bits
    base = (lead.astype(np.uint64) << np.uint64(rest)) | (fps & np.uint64((1 << rest) - 1)) if bits else fps
    made, owners = [], []
    for k, masks in enumerate(low):
        who = np.flatnonzero(left == k)
        flips = np.array(masks, np.uint64)
        made.append((base[who][:, None] ^ flips[None, :]).ravel())
        owners.append(np.repeat(who.astype(np.int32), len(flips)))
    v, o = np.concatenate(made), np.concatenate(owners)
    s = np.sort(v)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if len(twice):
        at = np.minimum(np.searchsorted(twice, v), len(twice) - 1)
        hit = twice[at] == v
        yield _span(v[hit], o[hit], fps)


def _colliding(fps: np.ndarray, lead: np.ndarray, left: np.ndarray, low: list[list[int]], bits: int) -> Iterator[np.ndarray]:
    """Links among fingerprints of one or more leading parts of ``bits`` bits, in the order of their parts.

    ``left`` is how many flips remain for the low bits, ``low`` the flips by that number. Parts are worked off in runs of about
    ``AT_ONCE`` variants. A part with more of them is cut by its next bits in the way that the whole was, so every variant is formed once.
    """
    if not len(fps):
        return
    sizes = np.array([len(m) for m in low])[left]
    starts = np.flatnonzero(np.r_[True, lead[1:] != lead[:-1]])
    weights = np.add.reduceat(sizes, starts)
    rest = max(0, 64 - bits - STEP)
    large = (weights > AT_ONCE) & (bits < 64)
    run = np.cumsum(np.where(large, 0, weights)) // AT_ONCE
    of = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(fps)]))
    for r in np.unique(run[~large]):
        here = (~large & (run == r))[of]
        yield from _formed(fps[here], lead[here], left[here], low, bits)
    if not large.any():
        return
    steps = [(m >> rest, m.bit_count()) for m in low[-1] if not m & ((1 << rest) - 1)]
    lower = [[m for m in masks if m < 1 << rest] for masks in low]
    for p in np.flatnonzero(large):
        here = of == p
        f, n = fps[here], left[here]
        next_bits = (f >> np.uint64(rest)) & np.uint64((1 << (64 - bits - rest)) - 1)
        begins = lead[here].astype(np.uint64) << np.uint64(64 - bits - rest)
        cut = []
        for m, flips in steps:
            may = n >= flips
            cut.append((begins[may] | (next_bits[may] ^ np.uint64(m)), n[may] - flips, f[may]))
        parts, remain, whose = (np.concatenate(c) for c in zip(*cut))
        order = np.argsort(parts, kind="stable")
        yield from _colliding(whose[order], parts[order], remain[order], lower, 64 - rest)


def _cut(rows: DataFrame, bits: int, more: int, half: int) -> DataFrame:
    """Rows (part, left, fp) of parts of ``bits`` bits, sent to every part of ``more`` bits more that variants of theirs have."""
    flips = F.array(*[F.struct(F.lit(m).cast("bigint").alias("m"), F.lit(m.bit_count()).alias("n")) for m in _masks(list(range(more)), half)])
    here = F.shiftrightunsigned("fp", 64 - bits - more).bitwiseAND(F.lit((1 << more) - 1).cast("bigint")).bitwiseXOR(F.col("_f.m"))
    return (rows.withColumn("_f", F.explode(flips)).where(F.col("_f.n") <= F.col("left"))
            .select(F.shiftleft("part", more).bitwiseOR(here).alias("part"), (F.col("left") - F.col("_f.n")).cast("byte").alias("left"), "fp"))


def _lead(n: int, half: int) -> int:
    """Leading bits for ``n`` fingerprints."""
    bits = LEAD
    while bits < 40 and n * len(_masks(list(range(bits)), half)) > PART_ROWS << bits:
        bits += 1
    return bits


def _sent(one: DataFrame, half: int) -> DataFrame:
    """(bits, part, left, fp): every fingerprint for each leading part of its variants; crowded parts are longer by some bits."""
    n = one.count()
    bits = _lead(n, half)
    # fingerprints are narrow, so a file split holds millions of them: tasks are cut by rows, as each becomes many
    dealt = one.repartition(-(-n // PART_ROWS) or 1, "fp")
    rows = _cut(dealt.select(F.lit(0).cast("bigint").alias("part"), F.lit(half).cast("byte").alias("left"), "fp"), 0, bits, half)
    most = one.groupBy(F.shiftrightunsigned("fp", 64 - bits)).count().agg(F.max("count")).first()[0] or 0
    done = []
    # no part has more rows than the most common beginning times the parts that one fingerprint is sent to
    crowded = most * len(_masks(list(range(bits)), half)) > CROWDED_ROWS
    while crowded and bits + MORE <= 64:
        many = stage(rows.groupBy("part").count().where(F.col("count") > CROWDED_ROWS).select("part"), "crowded")
        if many.isEmpty():
            break
        done.append(rows.join(many, "part", "left_anti").withColumn("bits", F.lit(bits)))
        rows = stage(_cut(rows.join(many, "part", "left_semi"), bits, MORE, half), "cut")
        bits += MORE
    sent = rows.withColumn("bits", F.lit(bits))
    for part in done:
        sent = sent.unionByName(part)
    return sent.select("bits", "part", "left", "fp")


def near_pairs(fps: DataFrame, distance: int = 4, fp_col: str = "fp") -> DataFrame:
    """(u, v): links between distinct fingerprints at ``distance`` bits or less that connect all such fingerprints.

    Any two fingerprints at that distance are in one connected part of the result, and every link of the result is
    verified. ``distance`` is even; null fingerprints are left out.
    """
    half = distance // 2
    if distance % 2 or half > 4:
        raise ValueError("distance is an even number up to 8")
    one = stage(fps.select(F.col(fp_col).cast("bigint").alias("fp")).where("fp is not null").distinct(), "fingerprints-once")
    kind = np.dtype([("bits", np.int32), ("part", np.uint64), ("left", np.int8), ("fp", np.uint64)])
    many = AT_ONCE // 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low: dict[int, list[list[int]]] = {}

        def links(group: np.ndarray) -> Iterator[pa.RecordBatch]:
            for bits in np.unique(group["bits"]).tolist():
                if bits not in low:
                    low[bits] = [_masks(list(range(64 - bits)), k) for k in range(half + 1)]
                own = group[group["bits"] == bits]
                for found in _colliding(own["fp"], own["part"], own["left"], low[bits], bits):
                    if len(found):
                        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(found[:, k]).view(np.int64)) for k in (0, 1)], ["u", "v"])

        held = np.zeros(0, kind)
        for b in batches:
            rows = np.zeros(b.num_rows, kind)
            rows["bits"], rows["left"] = b.column(0).to_numpy(), b.column(2).to_numpy()
            rows["part"], rows["fp"] = (b.column(k).to_numpy().view(np.uint64) for k in (1, 3))
            held = np.concatenate([held, rows])
            if len(held) < many:
                continue
            # whole parts only: rows arrive sorted by part
            last = held[-1]
            open_rows = int(np.argmax(((held["bits"] != last["bits"]) | (held["part"] != last["part"]))[::-1]))
            if open_rows:
                yield from links(held[:-open_rows])
                held = held[-open_rows:]
        if len(held):
            yield from links(held)

    pairs = _sent(one, half).repartition("bits", "part").sortWithinPartitions("bits", "part").mapInArrow(run, "u bigint, v bigint")
    return pairs.distinct().where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    distance: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    ``component_id`` is the smallest id that can be reached over fingerprints at ``distance`` bits or less, the row's own
    included. Null and empty texts have fingerprint zero and are linked like any other; rows that repeat an id each get a row;
    a null id gets its component from the other rows, or null. Other columns, whatever their names, are not read.
    """
    marked = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = stage(marked.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    linked = components(near_pairs(classes, distance))
    named = (classes.join(linked, F.col("fp") == F.col("node"), "left")
             .select("fp", "least", F.coalesce("component", "fp").alias("component")))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of = stage(named.join(smallest, "component").select(F.col("fp").alias("_fp"), "component_id"), "members")
    return (marked.join(of, F.col("fp") == F.col("_fp"))
            .select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
