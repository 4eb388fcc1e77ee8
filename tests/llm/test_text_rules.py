from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vaultflow.llm import quality_classifier, quality_rules, text

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(t):
    t = t or ""
    w = WORD.findall(t)
    runs = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    inside = {k + d for k in range(len(w) - 2) if runs[tuple(w[k:k + 3])] > 1 for d in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t #ß|\r", max_size=60)), max_size=8), st.integers(1, 40))
def test_counts_follow_their_definition(texts, piece):
    before, text.PIECE = text.PIECE, piece
    try:
        got = quality_rules.measured(pa.array(texts, pa.string()), None).to_pylist()
        stats = quality_classifier.statistics(pa.array(texts, pa.string()))
    finally:
        text.PIECE = before
    assert [tuple(g[n] for n in quality_rules.NAMES) for g in got] == [plain_counts(t) for t in texts]
    assert stats.shape == (len(texts), quality_classifier.SIZE) and np.isfinite(stats).all()
    assert np.allclose(stats, quality_classifier.statistics(pa.array(texts, pa.string())))


def test_sliced_columns_and_long_texts():
    texts = ["x y", None, "word " * 300000 + "\nend", "", "ü" * 1500000]
    column = pa.array(["skip", *texts], pa.string()).slice(1)
    got = quality_rules.measured(column, None).to_pylist()
    assert [tuple(g[n] for n in quality_rules.NAMES) for g in got] == [plain_counts(t) for t in texts]


def labelled_rows(prose):
    good = [(k, prose(k, 120)) for k in range(120)]
    bad = [(200 + k, " | ".join(prose(k, 80).upper().split()) + " *** !!") for k in range(60)]
    return good, bad


def test_rules_learn_from_labels(spark, documents, prose):
    good, bad = labelled_rows(prose)
    docs = documents([*good, *bad, (900, None), (901, ""), (902, "few words"), (902, "few words"), (903, "again and again " * 60)])
    labels = spark.createDataFrame([(i, 1, "a") for i, _ in good[:90]] + [(i, 0, "b") for i, _ in bad[:45]] + [(5, None, "c"), (None, 1, "d")],
                                   "doc_id long, quality int, text string")
    got = {r["doc_id"]: r for r in quality_rules.apply(docs, labels).collect()}
    assert all(got[i]["kept"] for i, _ in good) and not any(got[i]["kept"] for i, _ in bad)
    for i, t in ((900, None), (901, ""), (902, "few words"), (903, "again and again " * 60)):
        assert got[i]["base_failed"] and not got[i]["kept"]
        assert tuple(got[i][n] for n in quality_rules.NAMES) == plain_counts(t)
    nothing = {r["doc_id"]: r["kept"] for r in quality_rules.apply(docs, labels.where("false")).collect()}
    assert nothing[5] and not nothing[902]
    assert quality_rules.apply(documents([]), labels).count() == 0


def test_classifier_learns_without_the_held_out_fold(spark, documents, prose):
    good, bad = labelled_rows(prose)
    rows = [*good, *bad, (900, None), (901, ""), (None, "no id"), (5, good[5][1])]
    docs = documents(rows)
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(3, None)], "doc_id long, quality int")
    got = quality_classifier.classify(docs, labels).toPandas()
    assert len(got) == len(rows) and got["score"].between(0, 1).all()
    import zlib
    known = got[got["doc_id"].notna()]
    assert [bool(h) for h in known["held_out"]] == [zlib.crc32(str(int(i)).encode()) % 3 == 1 for i in known["doc_id"]]
    good_ids = {i for i, _ in good}
    held = known[known["held_out"] & (known["doc_id"] < 900)]
    assert (held["predicted"] == [int(i in good_ids) for i in held["doc_id"]]).mean() > 0.95
    # labels of the fold change nothing
    other = labels.selectExpr("doc_id", "case when crc32(string(doc_id)) % 3 = 1 then 1 - quality else quality end as quality")
    again = quality_classifier.classify(docs, other).toPandas()
    join = got.merge(again, on="doc_id")
    assert np.allclose(join["score_x"], join["score_y"])
    empty = quality_classifier.classify(docs, labels.where("false")).toPandas()
    assert (empty["score"] == 0.5).all()
    assert quality_classifier.classify(documents([]), labels).count() == 0


def test_isotonic_is_the_closest_rising_curve():
    scores, labels = np.array([1.0, 2, 2, 3, 4, 5]), np.array([0.0, 1, 0, 0, 1, 1])
    at, height = quality_classifier.isotonic(scores, labels)
    assert (np.diff(height) >= 0).all() and (np.diff(at) > 0).all()


@pytest.mark.parametrize("n", [0, 1, 5])
def test_windows_stay_inside_a_text(n):
    data, offsets = text.flat(pa.array(["a b c", "a b", "c a b c"][:n], pa.string()))
    w = text.words(data, offsets)
    runs, first = text.windows(w, 3)
    assert len(runs) == sum(max(0, len(t.split()) - 2) for t in ["a b c", "a b", "c a b c"][:n]) == len(first)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é漢😀 \n", max_size=30)), max_size=8), st.integers(1, 40))
def test_character_grams_are_runs_of_code_points(texts, piece):
    before, text.PIECE = text.PIECE, piece
    try:
        data, offsets = text.flat(pa.array(texts, pa.string()))
        found = [(kind, r, b) for kind, row, bucket in quality_rules._character_grams(data, offsets) for r, b in zip(row.tolist(), bucket.tolist())]
    finally:
        text.PIECE = before

    def bucket(gram, kind):
        key = 0
        for c in gram:
            key = (key * 0x9E3779B97F4A7C15 + int.from_bytes(c.encode(), "big")) % 2 ** 64
        return (key + kind + 1) * 0x9FB21C651E98DF25 % 2 ** 64 >> (64 - quality_rules.BITS)

    want = [(kind, k, bucket(t[i:i + size], kind)) for k, t in enumerate(texts) for kind, size in ((2, 3), (3, 4)) for i in range(len(t or "") - size + 1)]
    assert Counter(found) == Counter(want)


def test_an_id_that_repeats_is_learned_from_once(spark, documents, prose):
    good, bad = labelled_rows(prose)
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad], "doc_id long, quality int")
    repeated = documents([*good, *bad] + [(0, "~ later text")] * 300)
    chosen = quality_classifier.labelled(labels, quality_classifier.F.lit(True), 50)
    rows = quality_classifier.texts_of(repeated, chosen, "doc_id", "text").collect()
    assert len(rows) == 50 and not any(r["_text"].startswith("~") for r in rows)
    once = quality_classifier.classify(documents([*good, *bad]), labels).toPandas().sort_values("doc_id")
    again = quality_classifier.classify(repeated, labels).toPandas()
    again = again.drop_duplicates("doc_id").sort_values("doc_id")
    assert np.allclose(once["score"][1:], again["score"][1:], atol=1e-6)


def test_logistic_weights_against_a_plain_fit(spark, documents, prose):
    """Gradient steps in tasks against the same steps on one dense matrix."""
    good, bad = labelled_rows(prose)
    rows = [*good[:30], *bad[:30]]
    labels = spark.createDataFrame([(i, 1) for i, _ in good[:30]] + [(i, 0) for i, _ in bad[:30]], "doc_id long, quality int")
    model = quality_rules.fit(documents(rows), labels, steps=15)
    part = {r["_id"]: r["part"] for r in quality_classifier.labelled(labels, quality_classifier.F.lit(True), 4000).collect()}
    used = [(i, t) for i, t in rows if part[i] < 4]
    data, offsets = text.flat(pa.array([t for _, t in used]))
    x = np.zeros((len(used), (1 << quality_rules.BITS) + 1))
    x[:, -1] = 1
    for k, (at, share) in enumerate(quality_rules._sparse(data, offsets, text.words(data, offsets))):
        x[k, at] = share
    y, w = np.array([float(i < 200) for i, _ in used]), np.zeros(x.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, 16):
        g = (1 / (1 + np.exp(-x @ w)) - y) @ x / len(used) + 1e-6 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-7)
    assert np.allclose(x @ model.weights, x @ w, rtol=0.02, atol=0.05)


def test_platt_curve_has_the_least_loss():
    rng = np.random.default_rng(4)
    scores = rng.normal(0, 2, 300)
    y = (rng.random(300) < 1 / (1 + np.exp(-(1.7 * scores - 0.4)))).astype(float)
    slope, shift = quality_rules._platt(scores, y)
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (300 - y.sum() + 2))

    def loss(a, b):
        p = 1 / (1 + np.exp(-(a * scores + b)))
        return -(target * np.log(p) + (1 - target) * np.log(1 - p)).sum()

    assert all(loss(slope, shift) <= loss(slope + da, shift + db) for da in (-0.02, 0, 0.02) for db in (-0.02, 0, 0.02))


def test_ridge_solution_against_a_plain_fit(spark, documents, prose):
    good, bad = labelled_rows(prose)
    rows = [*good, *bad]
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad], "doc_id long, quality int")
    true = quality_classifier.F.lit(True)
    model = quality_classifier.fit(documents(rows), labels, true)
    part = {r["_id"]: r["part"] for r in quality_classifier.labelled(labels, true, quality_classifier.TRAIN_ROWS).collect()}
    stats = quality_classifier.statistics(pa.array([t for _, t in rows]))
    assert np.allclose(model.mean, stats.mean(0)) and np.allclose(model.scale[stats.std(0) > 1e-9], stats.std(0)[stats.std(0) > 1e-9])
    z = np.hstack([model.features(stats), np.ones((len(rows), 1))])
    used = np.array([part[i] < 4 for i, _ in rows])
    y = np.array([float(i < 200) for i, _ in rows])
    n = used.sum()
    plain = np.linalg.solve(z[used].T @ z[used] / n + 1e-4 * np.eye(z.shape[1]), z[used].T @ y[used] / n)
    assert np.allclose(z @ model.weights, z @ plain, atol=1e-6)
