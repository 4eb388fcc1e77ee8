from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from vaultflow.llm import paragraph_sketch as ps
from vaultflow.llm import queries


def paragraphs(text):
    return Counter(p for p in re.split(r"[\n.!?]", text or "") if p)


def alike(a, b):
    a, b = paragraphs(a), paragraphs(b)
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def expected(rows):
    """Row by row: descending ids, the next of the last is the first."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda x: -x[0])
    out = {}
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        out[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), alike(t, edited), alike(t, after), edited)
    return out


def lines(rng, n, pool=400):
    return "\n".join(f"line {rng.randrange(pool)} of ü some kind" for _ in range(n))


def test_peeling_gives_back_what_differs():
    rng = random.Random(11)
    a = [lines(rng, rng.randrange(0, 60), 40) for _ in range(80)] + ["", "x\n" * 500, "same\nlines"]
    b = [lines(rng, rng.randrange(0, 60), 40) for _ in range(80)] + ["", "x\n" * 350 + "y", "same\nlines"]
    ta, tb, every = ps.Texts(pa.array(a)), ps.Texts(pa.array(b)), np.arange(len(a))
    pair, key, side, used = ps.differing(ta, every, tb, every, cells=6)
    bag = lambda t, k: set(t.keys[t.starts[k]:t.starts[k + 1]].tolist())
    for k in every:
        own, other = bag(ta, k), bag(tb, k)
        assert len(own) == sum(paragraphs(a[k]).values())
        assert set(key[(pair == k) & (side > 0)].tolist()) == own - other and set(key[(pair == k) & (side < 0)].tolist()) == other - own
    assert used[-1] == 6 and used.max() > 24
    got, _ = ps.likeness(ta, every, tb, every)
    assert got == pytest.approx([alike(x, y) for x, y in zip(a, b)])


def test_kept_fingerprints_compare(spark, documents):
    old = "One. Two.\nThree and more. Four"
    new = old.replace("Two", "2") + "\nFive"
    rows = {r["id"]: r for r in ps.fingerprints(documents([(1, old), (2, new), (3, None), (4, ""), (5, old), (6, "\n".join(map(str, range(500))))])).collect()}
    added, removed = ps.difference(rows[2]["fingerprint"], rows[1]["fingerprint"])
    assert (len(added), len(removed)) == (2, 1) and ps.difference(rows[1]["fingerprint"], rows[5]["fingerprint"]) == (set(), set())
    assert rows[3]["fingerprint"] == rows[4]["fingerprint"] and rows[4]["n_paragraphs"] == 0 and rows[1]["n_paragraphs"] == 4
    assert ps.difference(rows[6]["fingerprint"], rows[1]["fingerprint"]) is None
    versions = spark.createDataFrame([(1, old, new, 0), (2, None, "a", 0), (3, old, old, 0), (None, "b", "", 0)], "doc_id int, old string, new string, id int")
    got = sorted((r["id"] or 0, r["change"]) for r in ps.changed_paragraphs(versions.withColumnRenamed("id", "x")).withColumnRenamed("doc_id", "id").collect())
    assert got == [(0, "removed"), (1, "added"), (1, "added"), (1, "removed"), (2, "added")]


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_next_edits_equal_doing_it_row_by_row(spark, documents, parts):
    rng = random.Random(parts)
    rows = [(k * 3, lines(rng, rng.randrange(0, 40))) for k in range(60)] + [(1, None), (2, ""), (4, "ü" * 9), (5, "long. " * 200_000), (7, "no newline at all")]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = ps.next_edits(documents(rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 2)
    want = expected(rows)
    assert len(got) == len(rows)
    for r in got:
        n, sha, near_edited, near_next, _ = want[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, sha)
        assert (r["near_edited"], r["near_next"]) == pytest.approx((near_edited, near_next))
    whole = ps.fingerprints(documents([(i, x[4]) for i, x in want.items()])).collect()
    assert {r["id"]: r["fingerprint"] for r in whole} == {r["doc_id"]: r["edited_fingerprint"] for r in got}


def test_null_and_repeated_ids_and_no_rows(spark, documents):
    assert ps.next_edits(documents([])).count() == 0
    one = ps.next_edits(documents([(None, "a\nb")])).collect()
    assert [(r["doc_id"], r["n_chars"], r["near_next"]) for r in one] == [(None, 3, 1.0)]
    rows = [(1, "same text here.\nand there")] * 30 + [(None, "x\ny")] * 20 + [(2, "q")]
    got = ps.next_edits(documents(rows)).collect()
    assert len(got) == 51 and sorted(r["near_next"] for r in got) == [0.0] * 3 + [1.0] * 48


def test_the_query_on_a_given_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = expected([(r["doc_id"], r["text"]) for r in docs])
    got = queries.QUERIES["op11_paragraph_sketch"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        n, sha, near_edited, near_next, _ = want[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, sha) and (r["near_edited"], r["near_next"]) == pytest.approx((near_edited, near_next))
    closer = sum(r["near_edited"] > r["near_next"] for r in got)
    assert closer >= 0.9 * len(got)
