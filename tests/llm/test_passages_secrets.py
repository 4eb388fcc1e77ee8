from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vaultflow.llm import decontaminate, secret_scan


def plain_tiling(doc, item, size):
    """Greedy string tiling by trying every place, longest match first, then by place."""
    marked_d, marked_i, longest = set(), set(), 0
    while True:
        best = None
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while (i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n]
                       and i + n not in marked_d and j + n not in marked_i):
                    n += 1
                if n >= size and (best is None or n > best[0]):
                    best = (n, i, j)
        if best is None:
            return len(marked_i), longest
        n, i, j = best
        marked_d |= set(range(i, i + n))
        marked_i |= set(range(j, j + n))
        longest = max(longest, n)


def test_tiling_equals_trying_every_place():
    rng = random.Random(5)
    for _ in range(60):
        doc, item = [rng.choice("abcd") for _ in range(rng.randint(3, 40))], [rng.choice("abcd") for _ in range(rng.randint(3, 16))]
        table = pa.table({"id": [1], "text": [" ".join(item)]})
        items = decontaminate.items_of(table, 3)
        got = decontaminate.found_in(pa.array([" ".join(doc)]), items, 3, 0.0)[0]
        covered, longest = plain_tiling(doc, item, 3)
        assert [(g["covered_words"], g["longest_tile"]) for g in got] == ([(covered, longest)] if covered else [])


def test_tiling_does_not_depend_on_how_many_pairs_are_formed_at_a_time(monkeypatch):
    rng = random.Random(15)
    texts = [[" ".join(rng.choice("abc") for _ in range(rng.randint(1, most))) for _ in range(25)] for most in (60, 20)]
    items = decontaminate.items_of(pa.table({"id": range(25), "text": texts[1]}), 3)
    want = decontaminate.found_in(pa.array(texts[0]), items, 3, 0.5)
    monkeypatch.setattr(decontaminate, "PAIRS", 5)
    monkeypatch.setattr(decontaminate, "FRUITLESS", 1)
    assert decontaminate.found_in(pa.array(texts[0]), items, 3, 0.5) == want and any(want)
    for k, q in ((k, q) for k in range(25) for q in range(25)):
        item = texts[1][q].split()
        covered, longest = plain_tiling(texts[0][k].split(), item, 3)
        got = [(g["covered_words"], g["longest_tile"]) for g in want[k] if g["item_id"] == q]
        assert got == ([(covered, longest)] if covered >= 0.5 * len(item) and covered else [])


def test_text_and_item_that_repeat_one_word():
    items = decontaminate.items_of(pa.table({"id": [1, 2], "text": ["a " * 400 + "b c d e f g h", "a " * 300 + "b " * 300]}), 5)
    got = decontaminate.found_in(pa.array(["a " * 100_000, "a " * 100_000 + "c d e f g h"]), items, 5, 0.6)
    assert [[(g["item_id"], g["covered_words"], g["longest_tile"]) for g in x] for x in got] == [[(1, 400, 400)], [(1, 406, 400)]]


def test_contaminated_documents(spark, documents, prose):
    items = [(k, prose(500 + k, 40)) for k in range(12)] + [(20, None), (21, "too short"), (22, prose(500, 40)), (None, prose(530, 30))]
    parts = items[3][1].split()
    moved = " ".join(parts[20:] + "and something between them".split() + parts[:20])
    rows = [(1, prose(1, 300)), (2, prose(2, 200) + " " + items[0][1].upper().replace(" ", ",\n") + " " + prose(3, 50)), (3, moved), (4, None), (5, ""),
            (6, " ".join(parts[:15])), (7, items[1][1]), (7, items[1][1]), (8, "w " * 300000 + items[2][1]), (9, prose(530, 30))]
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    got = sorted((r["doc_id"], -1 if r["item_id"] is None else r["item_id"]) for r in decontaminate.contaminated(documents(rows), bench).collect())
    assert got == [(2, 0), (2, 22), (3, 3), (7, 1), (7, 1), (8, 2), (9, -1)]
    some = sorted((r["doc_id"], -1 if r["item_id"] is None else r["item_id"])
                  for r in decontaminate.contaminated(documents(rows), bench, block_bytes=300).collect())
    assert some == got
    assert sorted(r["doc_id"] for r in decontaminate.clean(documents(rows), bench).collect()) == [1, 4, 5, 6]
    assert decontaminate.contaminated(documents(rows), bench.where("false")).count() == 0
    assert decontaminate.contaminated(documents([]), bench).count() == 0


def test_short_items_and_scripts_without_spaces(spark, documents):
    items = [(1, "the cat sat down"), (2, "Three short words"), (3, "three SHORT words!"), (4, "..."), (5, ""), (6, None), (7, "zyzzyva"),
             (8, "今天天气很好我们去公园散步"), (9, "猫が好き"), (10, "สวัสดีครับ"), (11, "mixed 漢字 and latin words here")]
    rows = [(1, "and then the cat sat down, again THE CAT SAT DOWN."), (2, "the cat sat; up and down"), (3, "three short, words"), (4, "three short" + " x" * 300_000 + " words"),
            (5, "他说今天天气很好我们去公园散步吧"), (6, "今天天气不好"), (7, "私は猫が好きです zyzzyvas"), (8, "a zyzzyva"), (9, "บอกว่าสวัสดีครับนะ"),
            (10, "so mixed 漢字 and latin words here it is"), (11, "漢 字"), (12, None), (13, "猫 が 好 き"), (14, "公园散步今天天气很好我们去")]
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    found = decontaminate.contaminated(documents(rows), bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [
        (1, 1), (3, 2), (3, 3), (5, 8), (7, 9), (8, 7), (9, 10), (10, 11), (13, 9), (14, 8)]
    assert {(r["item_words"], r["covered_words"], r["longest_tile"], r["coverage"]) for r in found if r["item_id"] in (1, 2)} == {(4, 4, 4, 1.0), (3, 3, 3, 1.0)}
    some = decontaminate.contaminated(documents(rows), bench, block_bytes=40).collect()
    assert sorted(map(str, some)) == sorted(map(str, found))
    assert sorted(r["doc_id"] for r in decontaminate.clean(documents(rows), bench).collect()) == [2, 4, 6, 11, 12]


def test_short_items_equal_a_plain_search():
    rng = random.Random(8)
    items = [[rng.choice("ab") for _ in range(rng.randint(1, 4))] for _ in range(30)]
    block = decontaminate.items_of(pa.table({"id": range(30), "text": [" ".join(x) for x in items]}), 5, short=True)
    texts = [[rng.choice("abc") for _ in range(rng.randint(0, 12))] for _ in range(80)]
    got = decontaminate.found_in(pa.array([" ".join(t) for t in texts]), block, 5, 0.6)
    for text, found in zip(texts, got):
        want = [k for k, x in enumerate(items) if any(text[i:i + len(x)] == x for i in range(len(text)))]
        assert sorted(f["item_id"] for f in found) == want


def hexes(rng, n=40):
    return "".join(rng.choice("0123456789abcdef") for _ in range(n))


def test_forest_keeps_secrets_and_drops_look_alikes(spark, documents, prose):
    rng = random.Random(6)
    secrets = [hexes(rng) for _ in range(60)]
    rows = [(k, f'{prose(k, 30)} token = "{s}" {prose(k + 1, 30)}') for k, s in enumerate(secrets)]
    rows += [(100 + k, f"{prose(k, 20)} order {rng.randrange(10 ** 15, 10 ** 16)} and commit {hexes(rng)} here") for k in range(60)]
    rows += [(300, None), (301, ""), (302, f'secret="{secrets[0]}"'), (302, f'secret="{secrets[0]}"'), (None, f'api_key: "{hexes(rng)}"'),
             (303, "a" * 500000 + "1" + ' password = "' + hexes(rng) + '"'), (304, "ü" * 1000 + f' token = "{secrets[1]}" ü'),
             (305, f'token = "{secrets[1]}" token = "{secrets[2]}"')]
    docs = documents(rows)
    forest = secret_scan.train(secret_scan.silver_findings(docs, path_col="source"), secret_scan.dictionary_of(docs))
    got = secret_scan.findings(docs, forest, path_col="source").collect()
    texts = {}
    for i, t in rows:
        texts.setdefault(i, t)
    for r in got:
        piece = texts[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert re.fullmatch(r"[A-Za-z0-9+/_=-]{16,}", piece) and any(c.isdigit() for c in piece)
    ids = lambda flag: {r["doc_id"] for r in got if r["is_secret"] == flag}
    assert {k for k in range(60)} | {302, 304, 305} <= ids(True) and not {100 + k for k in range(60)} & ids(True)
    assert sum(r["doc_id"] == 302 for r in got) == 2 and sum(r["doc_id"] == 305 for r in got) == 2
    clean = {}
    for r in secret_scan.redact(docs, forest, path_col="source").collect():
        clean.setdefault(r["doc_id"], r)
    assert clean[305]["text"] == 'token = "[SECRET]" token = "[SECRET]"' and clean[300]["text"] is None and clean[305]["_row"] == "x"
    assert clean[304]["text"] == "ü" * 1000 + ' token = "[SECRET]" ü' and clean[100]["text"] == texts[100]
    plan = secret_scan.findings(docs, forest)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_scan_without_rows_or_labels(spark, documents):
    docs = documents([])
    nothing = secret_scan.train(secret_scan.silver_findings(docs), secret_scan.dictionary_of(docs))
    assert secret_scan.findings(docs, nothing).count() == 0 and secret_scan.redact(docs, nothing).count() == 0
    some = documents([(1, "key 0123456789abcdef0 here")])
    assert [r["is_secret"] for r in secret_scan.findings(some, nothing).collect()] == [True]


def test_scores_are_those_of_the_model(spark):
    rng = np.random.default_rng(2)
    rows = [(hexes(random.Random(k), 20 + k % 20), "token = \"" if k % 2 else "commit ", "\"" if k % 2 else " ", "a/test" if k % 3 else None, k % 2 if rng.random() < 0.9 else 0)
            for k in range(200)]
    labelled = spark.createDataFrame(rows, "candidate string, before string, after string, path string, label int")
    forest = secret_scan.train(labelled, "the|and", trees=7, depth=4)
    assert len(forest.trees) == 7
    f = secret_scan._feature_struct(F.col("candidate"), F.col("before"), F.col("after"), F.coalesce("path", F.lit("")), F.lit("the|and")).alias("f")
    got = labelled.select("label", f).select("label", forest.score(F.col("f")).alias("s")).toPandas()
    assert got["s"].between(0, 1).all() and got[got["label"] == 1]["s"].mean() > got[got["label"] == 0]["s"].mean() + 0.3


def test_secrets_without_quotes_behind_bearer_and_of_providers(spark, documents, prose):
    rng = random.Random(16)
    rows = [(k, f'{prose(k, 30)} token = "{hexes(rng)}" {prose(k + 1, 30)}') for k in range(60)]
    rows += [(100 + k, f"{prose(k, 20)} commit {hexes(rng)} here, checksum={hexes(rng)} and order {rng.randrange(10 ** 15, 10 ** 16)}") for k in range(60)]
    values = {200: hexes(rng), 201: "wJalr7UtnFEMI/K7MDENG/bPxRfiCYzEXAMPLEKEY", 202: hexes(rng), 203: hexes(rng), 204: "ghp_" + hexes(rng, 36), 205: hexes(rng, 24)}
    rows += [(200, f"token={values[200]}"), (201, f"x\nexport AWS_SECRET_ACCESS_KEY={values[201]}\ny"), (202, f"https://a.b/c?token={values[202]}&x=1"),
             (203, f"Authorization: Bearer {values[203]}"), (204, f"{prose(1, 9)} {values[204]} {prose(2, 9)}"), (205, f"OAUTH2_CLIENT_SECRET = {values[205]}")]
    docs = documents(rows)
    forest = secret_scan.train(secret_scan.silver_findings(docs, path_col="source"), secret_scan.dictionary_of(docs))
    got = secret_scan.findings(docs, forest, path_col="source").collect()
    texts = dict(rows)
    secrets = {(r["doc_id"], texts[r["doc_id"]][r["start"]:r["start"] + r["length"]]) for r in got if r["is_secret"]}
    assert set(values.items()) <= secrets and not {k for k, _ in secrets if 100 <= k < 200}
    assert {r["doc_id"]: r["text"] for r in secret_scan.redact(docs, forest, path_col="source").collect()}[201] == "x\nexport AWS_SECRET_ACCESS_KEY=[SECRET]\ny"


def test_rare_secrets_are_learned_and_kept(spark, documents):
    rng = random.Random(26)
    rows = [(k, f"see commit {hexes(rng)} there") for k in range(400)] + [(1000, f'token = "{hexes(rng)}"'), (1001, f'secret = "{hexes(rng)}"')]
    docs = documents(rows)
    labelled = secret_scan.silver_findings(docs, most=20).cache()
    assert labelled.where("label = 1").count() > 0 and labelled.where("label = 0").count() <= 20 + 2 * 9
    forest = secret_scan.train(labelled, "", most=30)
    got = {r["doc_id"]: r["is_secret"] for r in secret_scan.findings(docs, forest).collect()}
    assert got[1000] and got[1001] and not any(got[k] for k in range(400))
    only = secret_scan.train(labelled.where("label = 0"), "")
    assert all(r["is_secret"] for r in secret_scan.findings(docs, only).collect())


def test_values_of_any_characters_behind_a_secrets_name(spark, documents, prose):
    rng = random.Random(36)
    rows = [(k, f'{prose(k, 30)} token = "{hexes(rng)}" {prose(k + 1, 30)}') for k in range(60)]
    rows += [(100 + k, f"{prose(k, 20)} commit {hexes(rng)} and order {rng.randrange(10 ** 15, 10 ** 16)} here") for k in range(60)]
    values = {200: "hunter!2#x", 201: "QwErTzUiOpAsDfGhJkLy", 202: "p@ss.w0rd/&1x", 203: "vorelba kalomi tusavor", 204: "Zx9!kk,Lq", 205: "aB3.dE5.fG7-hI9"}
    rows += [(200, f'password = "{values[200]}"'), (201, f"API_KEY={values[201]}\n"), (202, f"?pwd={values[202]}&user=bob"),
             (203, f"{{'secret': '{values[203]}'}}"), (204, f"my passwd: {values[204]}, then"), (205, f"Bearer {values[205]}"),
             (300, "a" * 300000 + " token: " + "b!" * 300000), (301, "the author: somebody-else"), (302, "_token" * 20000), (303, "password = \"" + "w " * 1000)]
    docs = documents(rows)
    forest = secret_scan.train(secret_scan.silver_findings(docs, path_col="source"), secret_scan.dictionary_of(docs))
    got = secret_scan.findings(docs, forest, path_col="source").collect()
    texts = dict(rows)
    found = {(r["doc_id"], texts[r["doc_id"]][r["start"]:r["start"] + r["length"]]): r["is_secret"] for r in got}
    assert set(values.items()) <= found.keys() and not any(k == 301 for k, _ in found)
    assert all(found[x] for x in values.items()) and not {k for (k, _), s in found.items() if s and 100 <= k < 200}
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redact(docs, forest, path_col="source").collect()}
    assert clean[202] == "?pwd=[SECRET]&user=bob" and clean[204] == "my passwd: [SECRET], then"


def test_very_long_chains_tokens_and_quotes(spark, documents):
    rows = [(1, "q " + "ab=c1" * 100_000), (2, "a1" * 500_000), (3, '"' * 100_000), (4, "ab=" * 100_000 + "x1y2z3w4v5x1y2z3w4v5"), (5, 'token = "' + "a=1b" * 50_000 + '"'),
            (6, "\\\"" * 100_000), (7, "x=" + "A" * 1_000_000), (8, "a=" * 200_000 + "=" * 200_000)]
    docs = documents(rows)
    forest = secret_scan.train(secret_scan.silver_findings(docs, path_col="source"), secret_scan.dictionary_of(docs))
    got = secret_scan.findings(docs, forest, path_col="source").collect()
    texts = dict(rows)
    pieces = {(r["doc_id"], texts[r["doc_id"]][r["start"]:r["start"] + r["length"]]) for r in got}
    assert (4, "x1y2z3w4v5x1y2z3w4v5") in pieces and (2, "a1" * 500_000) in pieces
    assert {r["doc_id"]: len(r["text"]) for r in secret_scan.redact(docs, forest, path_col="source").collect()}[3] == 100_000


@pytest.mark.parametrize("size, secrets", [("sf0.001", 0), ("sf0.01", 13)])
def test_secrets_found_in_small_tables(spark, size, secrets):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    forest = secret_scan.train(secret_scan.silver_findings(docs, path_col="source"), secret_scan.dictionary_of(docs))
    assert secret_scan.findings(docs, forest, path_col="source").where("is_secret").count() == secrets


def test_made_findings_need_rows(spark, documents):
    assert secret_scan.silver_findings(documents([])).count() == 0
    labels = {r["label"] for r in secret_scan.silver_findings(documents([(1, None)])).select("label").distinct().collect()}
    assert labels == {0, 1}
