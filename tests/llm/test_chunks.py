from __future__ import annotations

from hashlib import blake2b

import numpy as np

from vaultflow.llm import chunk_dedup as C


def plain_cuts(raw: bytes):
    """Rolling the hash byte by byte."""
    out, at, h = [], 0, 0
    for k, b in enumerate(raw):
        h = (h * 2 + int(C.GEAR[b])) & 0xFFFFFFFF
        n = k + 1 - at
        # only places REACH bytes into the text see a full window; before, the shorter one is the same sum
        if (n >= C.SHORTEST and not h & int(C.MASK)) or n == C.LONGEST:
            at = k + 1
            out.append(at)
    return out + ([len(raw)] if at < len(raw) else [])


def plain_spans(rows):
    first, places = {}, []
    for i, t in rows:
        raw, at = (t or "").encode(), 0
        for e in C.cuts(np.frombuffer(raw, np.uint8)):
            key = blake2b(raw[at:e], digest_size=16).digest()
            first.setdefault(key, (i, at))
            places.append((i, at, e - at, first[key]))
            at = e
    runs, now = [], None
    for i, at, n, kept in places:
        if kept != (i, at):
            own = kept[0] == i
            if now and now["id"] == i and now["end"] == at and now["own"] == own:
                now["end"] += n
            else:
                now = {"id": i, "start": at, "end": at + n, "own": own, "of": {}}
                runs.append(now)
            now["of"][kept[0]] = now["of"].get(kept[0], 0) + n
    return {(r["id"], r["start"], r["end"] - r["start"], min(r["of"], key=lambda k: (-r["of"][k], k)))
            for r in runs if r["end"] - r["start"] >= C.LEAST_BYTES}


def test_cuts_are_those_of_the_rolling_hash(prose):
    for raw in (b"", b"x", b"a" * 5000, prose(3, 3000).encode(), "äöü ß ".encode() * 700):
        assert C.cuts(np.frombuffer(raw, np.uint8)) == plain_cuts(raw)


def test_an_insertion_moves_only_near_cuts(prose):
    text = prose(5, 2000).encode()
    other = text[:3000] + b"inserted words " + text[3000:]

    def pieces(raw):
        ends = C.cuts(np.frombuffer(raw, np.uint8))
        return {raw[a:b] for a, b in zip([0, *ends], ends)}

    assert len(pieces(text) - pieces(other)) <= 4


def test_repeated_passages_are_found(documents, prose):
    passage = prose(77, 60)
    rows = [(k, prose(k, 100) + ("\n" + passage + "\n" if k % 5 == 0 else " ") + prose(100 + k, 80)) for k in range(30)]
    rows += [(40, prose(3, 100)), (41, None), (42, ""), (43, passage + " " + passage), (44, "é" * 3000)]
    got = {(r["doc_id"], r["start"], r["n_bytes"], r["first_doc_id"]) for r in C.spans(documents(rows)).collect()}
    assert got == plain_spans(rows)
    assert {i for i, *_ in got} >= {5, 10, 15, 20, 25, 43} and not {1, 2, 4, 6} & {i for i, *_ in got}


def test_text_without_repeats(documents, prose):
    one = prose(9, 300)
    docs = documents([(1, one), (2, "ü " + one), (3, None), (4, prose(10, 50))])
    got = {r["doc_id"]: r for r in C.deduplicated(docs).collect()}
    assert got[1]["text"] == one and got[3]["text"] is None and len(got[2]["text"]) < 200 and got[2]["_row"] == "x"
    assert got[4]["text"] == prose(10, 50)
    assert C.spans(documents([])).count() == 0


def test_repeated_rows_and_ties(documents, prose):
    one = prose(9, 100)
    got = {(r["doc_id"], r["first_doc_id"]) for r in C.spans(documents([(1, one), (1, one), (2, one), (None, one)])).collect()}
    assert (2, None) in got and all(first is None for _, first in got)


def plain_spans_of_rows(rows):
    """[(id, start, bytes, first id)] of rows (id, text, hash), whatever ids they share."""
    first, out, seen = {}, [], set()
    for i, t, h in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        again = (i, h) in seen
        seen.add((i, h))
        raw, at, runs = (t or "").encode(), 0, []
        for e in C.cuts(np.frombuffer(raw, np.uint8)):
            key = blake2b(raw[at:e], digest_size=16).digest()
            kept = first.setdefault(key, (i, h, at))
            if kept != (i, h, at) or again:
                own = kept[:2] == (i, h)
                if runs and runs[-1]["end"] == at and runs[-1]["own"] == own:
                    runs[-1]["end"] = e
                else:
                    runs.append({"start": at, "end": e, "own": own, "of": {}})
                runs[-1]["of"][kept[0]] = runs[-1]["of"].get(kept[0], 0) + e - at
            at = e
        for r in runs:
            if r["end"] - r["start"] >= C.LEAST_BYTES:
                out.append((i, r["start"], r["end"] - r["start"], min(r["of"], key=lambda k: (-r["of"][k], k is not None, k or 0))))
    return sorted(out, key=str)


def test_ids_that_repeat_or_are_missing(spark, documents, prose):
    from pyspark.sql import functions as F
    a, b, c = prose(31, 300), prose(32, 300), prose(33, 80)
    rows = [(1, a), (2, b), (3, a), (3, b), (3, b), (None, c), (None, c), (None, prose(34, 50) + " " + c), (None, None), (4, c + " " + c), (4, ""), (5, a), (5, a), (5, a)]
    docs = documents(rows)
    hashed = [(r["doc_id"], r["text"], r["h"]) for r in docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()]
    got = sorted(((r["doc_id"], r["start"], r["n_bytes"], r["first_doc_id"]) for r in C.spans(docs).collect()), key=str)
    assert got == plain_spans_of_rows(hashed)
    whole = [(i, s, n) for i, s, n, _ in got]
    assert whole.count((5, 0, len(a.encode()))) == 3 and whole.count((3, 0, len(b.encode()))) == 2 and (3, 0, len(a.encode())) in whole
    assert (None, 0, len(c.encode()), None) in got


def test_texts_of_one_id_are_cut_apart(documents, prose):
    a, b = prose(41, 200), prose(42, 200)
    rows = [(1, a), (2, a + " ä " + prose(43, 40)), (2, b), (None, b), (3, prose(44, 30))]
    got = sorted(((r["doc_id"], len(r["text"])) for r in C.deduplicated(documents(rows)).collect()), key=str)
    by = {}
    for i, n in got:
        by.setdefault(i, []).append(n)
    assert by[None] == [len(b)] and by[1] == [len(a)] and by[3] == [len(prose(44, 30))]
    assert sorted(by[2]) == sorted([0, next(n for n in by[2] if n)]) and max(by[2]) < 500
