"""Ids remembered by their number."""

from __future__ import annotations

import random
from collections import OrderedDict

import pytest
from pyspark.sql import functions as F

from vaultflow.operators import memory
from vaultflow.session import stage


def replayed(rows, most, cache=None):
    """Request by request: {seq: (repeat, mark)} and the ids remembered at the end."""
    cache = OrderedDict(cache or {})
    out = {}
    for seq, id, dead in sorted(rows):
        repeat = id is not None and id in cache
        mark = not repeat and not dead
        if mark:
            cache[id if id is not None else ("no id", seq)] = True
            while len(cache) > most:
                cache.popitem(last=False)
        out[seq] = (repeat, mark)
    return out, cache


def random_requests(seed, n, ids, hot=0.0):
    r = random.Random(seed)
    return [(k * 2, "hot" if r.random() < hot else None if r.random() < 0.02 else f"i{r.randrange(ids)}", r.random() < 0.1) for k in range(n)]


@pytest.mark.parametrize("most, ids, hot, slice_rows", [(50, 300, 0.0, 10 ** 6), (7, 40, 0.3, 90), (1, 5, 0.0, 10 ** 6), (1000, 30, 0.4, 200)])
def test_marks_equal_the_replay(spark, most, ids, hot, slice_rows):
    rows = random_requests(most, 900, ids, hot)
    df = spark.createDataFrame(rows, "seq BIGINT, transactionId STRING, dead BOOLEAN").repartition(4)
    got = memory.marked(df, most, slice_rows=slice_rows).collect()
    want, _ = replayed(rows, most)
    assert {r.seq: (r.repeat, r.mark) for r in got} == want
    numbers = [r.number for r in sorted(got) if r.mark]
    assert numbers == list(range(1, len(numbers) + 1)) and all(r.number is None for r in got if not r.mark)
    assert any(x[0] for x in want.values())


def test_marks_carried_over(spark):
    rows = random_requests(9, 600, 60)
    want, _ = replayed(rows, 20)
    known, before, got = None, 0, {}
    for k in range(3):
        part = spark.createDataFrame(rows[200 * k:200 * (k + 1)], "seq BIGINT, transactionId STRING, dead BOOLEAN")
        out = memory.marked(part, 20, known, before)
        got |= {r.seq: (r.repeat, r.mark) for r in out.collect()}
        last = out.where("mark and transactionId is not null").select("transactionId", "number")
        known = (last if known is None else last.unionByName(known)).groupBy("transactionId").agg(F.max("number").alias("number"))
        before += out.where("mark").count()
    assert got == want


def test_no_requests(spark):
    none = spark.createDataFrame([], "seq BIGINT, transactionId STRING, dead BOOLEAN")
    assert memory.marked(none, 5).count() == 0


def test_a_short_memory_is_walked_in_many_slices(spark, monkeypatch):
    slices = []
    monkeypatch.setattr(memory, "stage", lambda df, label: (slices.append(df.count()) if label == "memory-slices" else None, stage(df, label))[1])
    rows = spark.range(250_000).select(F.col("id").alias("seq"), F.concat(F.lit("t"), F.col("id") % 70).alias("transactionId"), F.lit(False).alias("dead"))
    out = memory.marked(rows, 50)
    assert slices == [3] and out.where("repeat").isEmpty() and out.agg(F.max("number")).first()[0] == 250_000
