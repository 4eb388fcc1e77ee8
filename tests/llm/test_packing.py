from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vaultflow.llm import packing


def padding(lengths, ends):
    return sum(min(e for e in ends if e >= n) - n for n in lengths)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=25), st.integers(1, 4))
def test_boundaries_have_the_least_padding(lengths, buckets):
    cells = sorted(Counter(lengths).items())
    top, count = np.array([n for n, _ in cells]), np.array([k for _, k in cells])
    ends = packing.boundaries(count, top * count, top, buckets)
    least = min(padding(lengths, [*c, max(lengths)]) for k in range(buckets) for c in combinations(top[:-1].tolist(), min(k, len(top) - 1)))
    assert ends == sorted(set(ends)) and ends[-1] == max(lengths) and len(ends) == min(buckets, len(top))
    assert padding(lengths, ends) == least


@pytest.mark.parametrize("length", [0, 1, 4095, 4096, 4097, 8191, 8193, 123457, 2 ** 40 + 12345])
def test_cells_keep_the_leading_bits(spark, length):
    got = spark.range(1).select(packing.cell(F.lit(length).cast("bigint")).alias("c")).first()["c"]
    drop = max(0, length.bit_length() - 12)
    assert got == length >> drop << drop


def test_every_row_is_packed(spark, documents):
    rows = [(k, "w " * (k % 37)) for k in range(400)] + [(7, "w " * 7), (None, "x y"), (None, None), (500, None), (501, ""), (502, "long " * 90000)]
    got = packing.pack(documents(rows), packing.n_words(F.col("text")), buckets=4, budget=100).toPandas()
    assert len(got) == len(rows)
    assert sorted(got["length"]) == sorted(len((t or "").split()) for _, t in rows)
    assert (got["length"] <= got["padded_length"]).all()
    for (_, padded), bucket in got.groupby(["bucket", "padded_length"]):
        size = max(1, 100 // max(padded, 1))
        places = sorted(zip(bucket["batch"], bucket["slot"]))
        assert places == [(k // size, k % size) for k in range(len(bucket))]
        inside = bucket[bucket["doc_id"].notna()].sort_values(["batch", "slot"])["doc_id"].tolist()
        assert inside == sorted(inside)
    assert packing.pack(documents([]), packing.n_words(F.col("text"))).count() == 0


def test_long_texts_are_padded_nearly_as_by_the_exact_optimum():
    rng = np.random.default_rng(3)
    lengths = np.sort(np.exp(rng.uniform(np.log(3000), np.log(400_000), 3000)).astype(np.int64))
    drop = np.maximum(np.floor(np.log2(lengths)).astype(np.int64) + 1 - 12, 0)
    padded = []
    for cells in (lengths, lengths >> drop << drop):
        _, first, count = np.unique(cells, return_index=True, return_counts=True)
        ends = packing.boundaries(count, np.add.reduceat(lengths, first), lengths[first + count - 1], 4)
        padded.append(int(np.array(ends)[np.searchsorted(ends, lengths)].sum()))
    assert padded[0] <= padded[1] <= padded[0] * (1 + 1 / 2048)


def plain_boundaries(count, total, top, buckets):
    """Every cut tried, the earliest of equally good ones."""
    m = len(count)
    rows, tokens = np.append(0, np.cumsum(count)), np.append(0, np.cumsum(total))
    best, cuts = [0] + [10 ** 18] * m, []
    for _ in range(min(buckets, m)):
        now, cut = [10 ** 18] * (m + 1), [0] * (m + 1)
        for j in range(1, m + 1):
            now[j], cut[j] = min((best[i] + int(top[j - 1] * (rows[j] - rows[i]) - (tokens[j] - tokens[i])), i) for i in range(j))
        best, cuts = now, [*cuts, cut]
    ends, j = [], m
    for cut in reversed(cuts):
        ends.append(int(top[j - 1]))
        j = cut[j]
    return ends[::-1]


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_and_ties_are_those_of_trying_every_cut(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(packing, "STEP", int(rng.integers(1, 200)))
    m = int(rng.integers(1, 90))
    top = np.sort(rng.choice(np.arange(3 * m + 3), m, replace=False))
    count = rng.integers(1, 4, m)
    for buckets in (1, 2, 5, 8):
        assert packing.boundaries(count, top * count, top, buckets) == plain_boundaries(count, top * count, top, buckets)


def test_many_different_lengths():
    top = np.arange(200_000)
    ends = packing.boundaries(np.ones(200_000, np.int64), top, top, 8)
    assert np.allclose(np.diff([-1, *ends]), 25_000, atol=1)


def test_lengths_over_4096_have_the_exact_optimum(spark, documents):
    lengths = [4097, 4098, 4099, 5001, 5003, 9000, 9001, 9003, 9004, 20_001, 20_002, 20_009]
    docs = documents([(k, "w " * n) for k, n in enumerate(lengths)])
    got = packing.pack(docs, packing.n_words(F.col("text")), buckets=6).toPandas()
    least = min(padding(lengths, [*c, 20_009]) for c in combinations(lengths[:-1], 5))
    assert (got["padded_length"] - got["length"]).sum() == least
    near = packing.pack(docs, packing.n_words(F.col("text")), buckets=6, coarse=True).toPandas()
    assert (near["padded_length"] - near["length"]).sum() > least
