from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from vaultflow.llm import components, simhash


def plain_fingerprint(text, size=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    runs = [b" ".join(words[k:k + size]) for k in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps, distance):
    """Smallest id reachable, by comparing all pairs."""
    group = {k: k for k in range(len(fps))}

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= distance:
                group[max(root(a), root(b))] = min(root(a), root(b))
    return [root(k) for k in range(len(fps))]


@pytest.mark.parametrize("text", [None, "", " \n\t", "one", "One TWO three", "a b c d", "a b c d e", "Ä ß Ö É é x y z",
                                  "x " * 300000, "tab\tand\x0bfeed\x0c end\r\n of line"])
def test_fingerprint_follows_its_definition(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_shingles_cross_the_pieces_of_a_long_text(prose, monkeypatch):
    text = prose(1, 5000)
    monkeypatch.setattr(simhash, "WORDS", 100)
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("distance", [2, 4])
def test_links_equal_all_pairs(spark, distance):
    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for k in range(200):  # chains around a few of them, and random places far from any
        near = rng.choice(fps)
        for b in rng.sample(range(64), rng.randint(0, 6)):
            near ^= 1 << b
        fps.append(near)
    fps += [0, 3, (1 << 64) - 1]
    rows = [(int(np.uint64(f).astype(np.int64)),) for f in fps]
    found = simhash.near_pairs(spark.createDataFrame(rows, "fp long"), distance)
    known = {n: c for n, c in components.components(found).collect()}
    want = plain_groups(fps, distance)
    value = lambda k: rows[k][0]
    group = {}
    for k, w in enumerate(want):
        group.setdefault(w, set()).add(known.get(value(k), value(k)))
    assert all(len(v) == 1 for v in group.values())
    assert len({next(iter(v)) for v in group.values()}) == len(group)


def test_variants_in_several_passes_give_the_same_links(spark, monkeypatch):
    rng = random.Random(4)
    base = rng.getrandbits(64)
    fps = np.array(sorted({base ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)}), np.uint64)
    low = [simhash._masks(list(range(44)), k) for k in range(3)]
    lead, left = np.zeros(len(fps), np.int32) + int(base >> 44), np.full(len(fps), 2)
    keep = (fps >> np.uint64(44)) == np.uint64(base >> 44)
    whole = np.concatenate(list(simhash._colliding(fps[keep], lead[keep], left[keep], low, 20)))
    monkeypatch.setattr(simhash, "AT_ONCE", 5000)
    parts = np.concatenate(list(simhash._colliding(fps[keep], lead[keep], left[keep], low, 20)))
    assert {int(x) for x in whole.ravel()} == {int(x) for x in parts.ravel()}


def crowd(seed, n=900):
    """Fingerprints most of which begin alike, many of them near another one."""
    rng = random.Random(seed)
    fps = {(0x8421 << 48) | rng.getrandbits(48) for _ in range(n // 3)} | {rng.getrandbits(64) for _ in range(n // 6)}
    around = sorted(fps)
    while len(fps) < n:
        near = rng.choice(around)
        for b in rng.sample(range(64), rng.randint(1, 5)):
            near ^= 1 << b
        fps.add(near)
    return sorted(fps)


def groups_by_links(fps, links):
    """The same as ``plain_groups``, from links."""
    at, group = {f: k for k, f in enumerate(fps)}, list(range(len(fps)))
    for _ in range(len(fps)):
        before = list(group)
        for u, v in links:
            group[at[u]] = group[at[v]] = min(group[at[u]], group[at[v]])
        if group == before:
            break
    return group


@pytest.mark.parametrize("at_once", [1 << 20, 30_000, 700])
def test_parts_cut_in_a_task_form_each_variant_once(at_once, monkeypatch):
    fps = np.array(crowd(5), np.uint64)
    monkeypatch.setattr(simhash, "AT_ONCE", at_once)
    formed, own = [], simhash._formed
    monkeypatch.setattr(simhash, "_formed", lambda f, lead, left, low, bits: (formed.append(sum(len(low[k]) for k in left)), own(f, lead, left, low, bits))[1])
    rows = sorted(((int(f) >> 60) ^ m, 2 - m.bit_count(), int(f)) for f in fps for m in simhash._masks([0, 1, 2, 3], 2))
    part, left, fp = (np.array(c, kind) for c, kind in zip(zip(*rows), (np.uint64, np.int8, np.uint64)))
    found = list(simhash._colliding(fp, part, left, [simhash._masks(list(range(60)), k) for k in range(3)], 4))
    links = {tuple(map(int, pair)) for some in found for pair in some}
    assert sum(formed) == len(fps) * 2081 and (at_once > 700 or max(formed) <= 2 * at_once)
    assert all(1 <= (u ^ v).bit_count() <= 4 for u, v in links)
    assert groups_by_links([int(f) for f in fps], links) == plain_groups([int(f) for f in fps], 4)


@pytest.mark.parametrize("crowded_rows", [1 << 18, 400, 60])
def test_crowded_parts_are_cut_before_the_shuffle(spark, monkeypatch, crowded_rows):
    fps = crowd(6)
    monkeypatch.setattr(simhash, "CROWDED_ROWS", crowded_rows)
    table = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    sizes = simhash._sent(table, 2).groupBy("bits", "part").count().collect()
    assert {r["bits"] for r in sizes} - {16} == (set() if crowded_rows > 400 else {24} if crowded_rows == 400 else {24, 32})
    assert max(r["count"] for r in sizes) <= crowded_rows
    links = {(u & (1 << 64) - 1, v & (1 << 64) - 1) for u, v in simhash.near_pairs(table).collect()}
    assert groups_by_links(fps, links) == plain_groups(fps, 4)


def test_leading_bits_follow_the_number_of_fingerprints():
    assert [simhash._lead(n, 2) for n in (0, 10 ** 6, 10 ** 7)] == [16, 16, 16]
    for n in (10 ** 9, 10 ** 10, 10 ** 11):
        bits = simhash._lead(n, 2)
        assert n * (1 + bits + bits * (bits - 1) // 2) / 2 ** bits <= simhash.PART_ROWS


def test_groups_of_documents(documents, prose):
    one, two = prose(1, 400), prose(2, 400)
    rows = [(5, one), (3, one + " tail"), (9, one), (9, one), (4, two), (7, None), (8, ""), (6, "  \n"), (2, two.upper()), (None, two),
            (20, "a " * 200000), (21, "a " * 200001)]
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["component_id"]) for r in simhash.near_duplicates(documents(rows)).collect()))
    by = {i: c for missing, i, c in got if not missing}
    texts = [t for _, t in rows]
    want = plain_groups([plain_fingerprint(t) for t in texts], 4)
    for w in set(want):
        ids = [rows[k][0] for k in range(len(rows)) if want[k] == w and rows[k][0] is not None]
        assert {by[i] for i in ids} == {min(ids)}
    assert len(got) == len(rows) and (True, 0, 2) in got


def test_empty_table(documents):
    assert simhash.near_duplicates(documents([])).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(60)] + [(1000, k) for k in range(1001, 1400)] + [(5000, 5000), (None, 3)]
    got = {n: c for n, c in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert {got[k] for k in range(61)} == {0} and {got[k] for k in range(1000, 1400)} == {1000} and len(got) == 461
