from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pytest

from vaultflow.llm import token_files, warc_store
from vaultflow.session import new_folder


def test_scan_stitches_documents_over_blocks(spark):
    rng = np.random.default_rng(1)
    rows, want = [], []
    for file in range(6):
        flat = rng.integers(0, 9, 0 if file == 5 else int(rng.integers(1, 300))).astype(np.uint16)
        start = 0
        for k, end in enumerate(np.flatnonzero(flat == 3).tolist()):
            want.append((file, k, start, end - start, True))
            start = end + 1
        if start < len(flat):
            want.append((file, int((flat == 3).sum()), start, len(flat) - start, False))
        rows += [(file, 2 * k, bytearray(flat[b:b + 7].tobytes()), 1) for k, b in enumerate(range(0, len(flat), 7))]
    rows += [(6, 0, None, 1), (6, 1, bytearray(np.array([3, 3], np.uint16).tobytes()), 1)]
    want += [(6, 0, 0, 0, True), (6, 1, 1, 0, True)]
    blocks = spark.createDataFrame(rows, "file int, block int, data binary, n int").repartition(4)
    for together in (2, 5, 4096):
        got = sorted((r["file"], r["document"], r["start"], r["n_tokens"], r["ended"]) for r in token_files.scan(blocks, 3, together=together).collect())
        assert got == sorted(want)
    assert token_files.scan(blocks.where("false"), 3).count() == 0


def test_counts_equal_direct_encoding(spark, documents, prose, monkeypatch):
    rows = [(k, prose(k, 40 * k)) for k in range(25)] + [(30, None), (31, ""), (31, "twice"), (None, "no id"), (32, "long words here " * 60000),
                                                         (33, "<|endoftext|> is text"), (34, "é" * 5000)]
    enc = token_files.encoder(open(token_files.VOCABULARY, "rb").read())
    want = sorted((i is None, i or 0, len(enc.encode_ordinary(t or ""))) for i, t in rows)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"])
                 for r in token_files.counts(documents(rows), new_folder(spark, "tokens"), block=64).collect())
    assert got == want
    assert token_files.counts(documents([]), new_folder(spark, "tokens")).count() == 0


def test_parts_of_a_long_text_give_the_same_tokens(prose, monkeypatch):
    enc = token_files.encoder(open(token_files.VOCABULARY, "rb").read())
    monkeypatch.setattr(token_files, "PIECE", 50)
    for text in (prose(1, 400), "a  b   c\n\n d 12 3 " * 40, "x" * 500):
        assert np.concatenate(list(token_files.encoded(text, enc))).tolist() == enc.encode_ordinary(text)


def test_a_vocabulary_that_is_too_large_is_refused(spark, monkeypatch):
    monkeypatch.setattr(token_files, "MOST_BYTES", 10)
    with pytest.raises(ValueError):
        token_files.vocabulary(spark)


PAGES = "page_id long, url string, html string, sha256 string, head string"


def plain_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_records_come_back_as_they_were_written(spark):
    rows = [(1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (3, None, None), (4, "http://a/4", ""), (5, "http://a/ü 5\r\nX: y", "é" * 100000),
            (6, "http://a/6", "other"), (6, "http://a/6", "other"), (6, "http://a/6", "<p>one</p>"), (None, "http://a/n", "<p>one</p>"), (None, "u", "alone")]
    path = new_folder(spark, "warc")
    warc_store.write(spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES).repartition(3), path)
    stored = spark.read.parquet(f"{path}/payloads").collect()
    assert len(stored) == len({r[2] or "" for r in rows}) and all(hashlib.sha256(r["payload"]).hexdigest() == r["sha256"] for r in stored)
    got = warc_store.records(spark, path).collect()
    assert len(got) == len(rows)
    for r in got:
        head, payload = r["head"], bytes(r["payload"])
        body = b"" if r["record_type"] == "revisit" else payload
        assert bytes(r["record"]) == head.encode() + body + b"\r\n\r\n"
        fields, http = head.split("\r\n\r\n", 1)
        declared = int(re.search(r"\r\nContent-Length: (\d+)$", fields)[1])
        assert declared == len(http.encode()) + len(body) and f"sha1:{plain_digest(payload)}" in fields
        assert fields.startswith("WARC/1.1\r\nWARC-Type: ") and "X: y" not in fields.split("\r\n")
    kinds = sorted((str(r["page_id"]), bytes(r["payload"])[:10].decode(errors="ignore"), r["record_type"], r["refers_to"]) for r in got)
    assert kinds == sorted([("1", "<p>one</p>", "revisit", 6), ("2", "<p>one</p>", "revisit", 6), ("3", "", "revisit", 4), ("4", "", "response", None),
                            ("5", "é" * 5, "response", None), ("6", "other", "response", None), ("6", "other", "response", None),
                            ("6", "<p>one</p>", "response", None), ("None", "<p>one</p>", "revisit", 6), ("None", "alone", "response", None)])
    whole = sorted(map(str, (tuple(r) for r in warc_store.described(spark, path).collect())))
    assert whole == sorted(map(str, (tuple(r) for r in warc_store.summary(spark, path).collect())))
    short = {(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc_store.summary(spark, path).collect()}
    assert (1, 10, plain_digest(b"<p>one</p>"), "revisit", 6) in short and (5, 200000, plain_digest(("é" * 100000).encode()), "response", None) in short


def test_short_payloads_are_all_responses(spark):
    path = new_folder(spark, "warc")
    warc_store.write(spark.createDataFrame([(1, "u", "ab", "", ""), (2, "u", "ab", "", ""), (3, "u", "abcdef", "", ""), (4, "u", "abcdef", "", "")], PAGES), path, least_bytes=3)
    assert {(r["page_id"], r["record_type"]) for r in warc_store.summary(spark, path).collect()} == {
        (1, "response"), (2, "response"), (3, "revisit"), (4, "response")}
    empty = new_folder(spark, "warc")
    warc_store.write(spark.createDataFrame([], PAGES), empty)
    assert warc_store.records(spark, empty).count() == 0


def test_damaged_payloads_are_noticed(spark):
    path = new_folder(spark, "warc")
    spark.createDataFrame([("0" * 64, bytearray(b"other"))], "sha256 string, payload binary").write.parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="does not match its digest"):
        warc_store.payloads(spark, path).collect()
