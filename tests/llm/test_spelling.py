from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vaultflow.llm import queries, spelling


def counted(rows):
    words = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def plain(words):
    out = {}
    patterns = {}
    for w in words:  # near words share a word with one place left open
        for k in range(len(w) + 1):
            patterns.setdefault(w[:k] + "?" + w[k:], set()).add(w)
            if k < len(w):
                patterns.setdefault(w[:k] + "?" + w[k + 1:], set()).add(w)
    links = {w: set() for w in words}
    for group in patterns.values():
        for a in group:
            links[a] |= {b for b in group if near(a, b)}
    for w, n in words.items():
        best = min(links[w], key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 5 * n else None
        out[w] = [form, None, n, len(links[w]), words.get(form)]
    for w in words:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        out[w][1] = root
    return {w: tuple(x) for w, x in out.items()}


def result(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


@pytest.mark.parametrize("symbols", [2, 8])
def test_variants_equal_comparing_all_words(spark, symbols):
    rng = random.Random(symbols)
    words = {}
    while len(words) < 1500:
        w = "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 9)))
        words[w] = rng.choice([5, 6, 30, 200, 1000])
    words |= {"aaaaaaaa" + c: 7 for c in "abcdefghijklmnop"} | {"x" * n: n + 5 for n in range(20)} | {"": 9}
    v = spark.createDataFrame(list(words.items()) + [(None, 3)], "word string, n long").repartition(5)
    want = plain(words)
    got = result(spelling.variants(v.where("word is not null"), symbols=symbols))
    assert got == want and any(x[0] for x in want.values())
    assert spelling.near_words(v, symbols).where("word is null or other is null").count() == 0


def test_neighbourhood_is_whole():
    rng = random.Random(3)
    for length in (1, 2, 5, 9):
        weights = spelling._weights(3, length + 1)
        s = np.array([[rng.randrange(3) for _ in range(length)] for _ in range(4)])
        wide = spelling._weights(3, length + 2)
        hashed = lambda w: int(spelling.reduced_hash(np.array([w], dtype=np.int64).reshape(1, len(w)), wide)[0])
        parts = list(spelling.neighbourhood(s, weights))
        row, h = (np.concatenate(x) for x in zip(*parts))
        for k in range(4):
            w = s[k].tolist()
            want = {tuple(w)} | {tuple(w[:i] + [x] + w[i:]) for i in range(length + 1) for x in range(3)}
            want |= {tuple(w[:i] + [x] + w[i + 1:]) for i in range(length) for x in range(3)} | {tuple(w[:i] + w[i + 1:]) for i in range(length)}
            assert set(h[row == k].tolist()) == {hashed(list(x)) for x in want}


def test_words_of_texts(spark, documents, prose):
    rows = [(k, prose(k % 7, 400) + " Élancée ÉLANCÉE naïveté× abc_defghij d'abcdefg") for k in range(60)]
    rows += [(100, None), (101, ""), (None, "nothing nothing nothing nothing nothing"), (7, prose(1, 50)), (7, prose(1, 50)), (8, ("q" * 300_000 + " ") * 6),
             (9, ("q" * 299_999 + "r ") * 30 + "q" * 100_000 + "\n" + "word " * 200_000)]
    words = counted(rows)
    got = {r["word"]: r["n"] for r in spelling.words_in(documents(rows)).where("n >= 5").collect()}
    assert got == words and any(len(w) == 300_000 for w in words)
    some = result(spelling.spelling_variants(documents(rows)))
    short = plain({w: n for w, n in words.items() if len(w) < 100})
    assert {w: x for w, x in some.items() if len(w) < 100} == short
    long = {w: x for w, x in some.items() if len(w) >= 100}
    assert sorted((x[2], x[3]) for x in long.values()) == [(6, 1), (30, 1)] and all(x[1].endswith("r") for x in long.values())


def test_no_words(spark, documents):
    assert spelling.spelling_variants(documents([])).count() == 0
    assert spelling.spelling_variants(documents([(1, "short ones only"), (2, None)])).count() == 0


def test_the_query_on_a_given_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = plain(counted([(r["doc_id"], r["text"]) for r in docs]))
    assert result(queries.QUERIES["op13_spelling_variants"](spark, sf)) == want and any(x[0] for x in want.values())


def test_letters_become_symbols():
    s = spelling.reduced(np.arange(97, 123))
    assert s.min() >= 0 and s.max() < spelling.SYMBOLS and len(set(s.tolist())) > 4
    codes, at = spelling._codes(pa.array(["aé", "", "z"]))
    assert codes.tolist() == [97, 233, 122] and at.tolist() == [0, 2, 2, 3]


def test_near_words_short_and_long(spark):
    rng = random.Random(9)
    pairs = []
    for n in (0, 1, 4, 255, 256, 257, 900):
        w = "".join(rng.choice("abé") for _ in range(n))
        for _ in range(12):
            k = rng.randrange(n + 1)
            other = rng.choice([w[:k] + "x" + w[k:], w[:k] + "x" + w[k + 1:], w[:k] + w[k + 1:], w[:k] + "xy" + w[k:], "x" + w[1:k] + "z" + w[k + 1:], w + w[:1]])
            pairs += [(w, other), (other, w)] if other != w else []
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", spelling.is_near(F.col("a"), F.col("b")).alias("near")).collect()
    assert all(r["near"] == near(r["a"], r["b"]) for r in got) and {r["near"] for r in got} == {True, False}
