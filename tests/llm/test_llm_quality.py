from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from awkward_rows import AWKWARD
from tradewind.llm import quality
from tradewind.llm.features import Sparse, labelled_sample, mixed, scan

WORD = re.compile("[^\x20\x09-\x0d]+")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, "x"), (2, 0, "x"), (2, 1, "x"), (None, 1, "x"), (3, None, "x"), (4, 7, "x"), (99, 0, "x")],
        "doc_id bigint, quality int, text string",
    )


def test_counts_of_awkward_rows(awkward):
    model = quality.Model(np.zeros(4 << quality.BITS), 0.0, 0.0, 50.0)
    got = quality.judge(awkward, model).collect()
    want = Counter()
    for r in AWKWARD:
        m = measures(r[1])
        failed = m[0] < 20 or 100 * m[4] > 30 * m[0]
        want[(r[0], *m, failed, not failed)] += 1
    assert Counter((*r[:6], r.base_failed, r.kept) for r in got) == want


@pytest.mark.parametrize(
    "text",
    ["a b c d e f g h a b c d e f g h", "A b c d e f g h a b c d e f g h", "a " * 30, "x\ny\nx\n \nx y\n", "#*$%&|<> ##"],
)
def test_counts(spark, text):
    docs = spark.createDataFrame([(1, text), (2, "q w e r t y u i " * 3), (3, text)], "doc_id bigint, text string")
    model = quality.Model(np.zeros(4 << quality.BITS), 0.0)
    got = {r.doc_id: tuple(r[1:6]) for r in quality.judge(docs.coalesce(1), model).collect()}
    assert got[1] == got[3] == measures(text)


def test_sample_is_bounded_and_clean(awkward, labels):
    rows = labelled_sample(awkward, labels, "quality", 2).collect()
    assert sorted((r.doc_id, r.label) for r in rows) == [(1, 1), (2, 1)]
    assert len(labelled_sample(awkward, labels, "quality", 1).collect()) <= 2


def test_without_both_labels_all_or_nothing_is_kept(awkward, nothing, labels):
    assert quality.fit(awkward, labels.limit(0)).probability(np.zeros(1))[0] > 0.99
    assert quality.fit(nothing, labels).probability(np.zeros(1))[0] > 0.99
    assert quality.fit(awkward, labels.where("quality = 0 AND doc_id = 2")).probability(np.zeros(1))[0] < 0.01


def test_empty(nothing):
    model = quality.Model(np.zeros(4 << quality.BITS), 0.0)
    assert quality.judge(nothing, model).count() == 0


def test_pairs_and_words_stay_inside_their_text():
    texts = [b"", b"one two", b" ", b"two one two", b"x"]
    s = scan(texts)
    kinds = list(quality._grams(s))
    assert np.diff(kinds[0][1]).tolist() == [0, 2, 0, 3, 1]
    assert np.diff(kinds[1][1]).tolist() == [0, 1, 0, 2, 0]
    one, two = kinds[0][0][:2]
    assert kinds[0][0].tolist()[2:5] == [two, one, two]


def test_logistic_regression_finds_the_optimum():
    rng = np.random.default_rng(1)
    dense = (rng.random((300, 12)) < 0.4) * rng.random((300, 12))
    y = (dense @ np.linspace(-3, 3, 12) + rng.normal(0, 0.5, 300) > 0).astype(float)
    x = Sparse.of([(np.flatnonzero(r), r[np.flatnonzero(r)]) for r in dense], 12)
    w, b = quality.logistic(x, y, rounds=5000)
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    error = (1 / (1 + np.exp(-(dense @ w + b))) - y) * share
    assert np.abs(dense.T @ error + 1e-3 * w).max() < 1e-5 and abs(error.sum()) < 1e-5


def test_calibrated_probabilities_match_frequencies():
    rng = np.random.default_rng(2)
    margin = rng.normal(0, 3, 20000)
    y = (rng.random(20000) < 1 / (1 + np.exp(-(0.5 * margin - 1)))).astype(float)
    slope, shift = quality.platt(margin, y)
    assert abs(slope - 0.5) < 0.03 and abs(shift + 1) < 0.06


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    verdict = {r.doc_id: r.kept for r in quality.op2_quality(spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    right = [verdict[r.doc_id] == bool(r.quality) for r in labels if r.doc_id in verdict]
    assert np.mean(right) > 0.9


def test_a_text_scores_alone_as_among_others():
    rng = np.random.default_rng(11)
    weights = rng.normal(size=(2 + len(quality.GRAMS)) << quality.BITS)
    texts = [b"", b"ab", b"abc", b"a short one", b"x" * 50, "é 中文".encode(), b" lead and trail ", b"end\n", b"a\0"]
    together = quality._margins(scan(texts), weights)
    turned = quality._margins(scan(texts[::-1]), weights)[::-1]
    alone = [quality._margins(scan([t]), weights)[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-12) and np.allclose(turned, alone, atol=1e-12)


def brute_margin(text, weights):
    """Weighted shares of words, word pairs and byte n-grams, counted one by one."""
    raw = (text or "").encode()
    size, pick = 1 << quality.BITS, np.uint64(64 - quality.BITS)
    bucket = lambda h, kind: int(h >> pick) + kind * size
    hashes = [scan([w.encode()]).hash[0] for w in WORD.findall(text or "")]
    pairs = [mixed(np.array([a * np.uint64(3) + b]))[0] for a, b in zip(hashes, hashes[1:])]
    kinds = [[bucket(h, 0) for h in hashes], [bucket(h, 1) for h in pairs]]
    for kind, n in enumerate(quality.GRAMS, start=2):
        codes = [np.uint64(int.from_bytes(raw[i : i + n], "big") + n) for i in range(len(raw) - n + 1)]
        kinds.append([bucket(mixed(np.array([c]))[0], kind) for c in codes])
    return sum(quality.SCALE * sum(weights[b] for b in some) / max(len(some), 1) for some in kinds)


def test_probabilities_equal_a_dictionary_version(spark):
    rng = np.random.default_rng(13)
    weights = rng.normal(size=(2 + len(quality.GRAMS)) << quality.BITS)
    model = quality.Model(weights, 0.1, 0.7, -0.2)
    texts = [r[1] for r in AWKWARD if r[0] not in (6, 7)] + ["One two, THREE\tfour\n" * 9, "ab", "a\0b c\0"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    with np.errstate(over="ignore"):
        want = {i: float(model.probability(np.array([brute_margin(t, weights)]))[0]) for i, t in enumerate(texts)}
    for r in quality.judge(docs, model).collect():
        assert r.quality == pytest.approx(want[r.doc_id], abs=1e-9)


def test_labels_of_missing_documents_take_no_places(spark):
    docs = spark.createDataFrame([(i, "text" if i >= 20 else None) for i in range(10, 40)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    got = labelled_sample(docs, labels, "quality", 10).collect()
    assert sorted(r.doc_id for r in got) == list(range(20, 40))


def test_accuracy_on_held_out_documents(spark):
    """Fitted on half of the labelled documents, judged on the others; the README gives the figures."""
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = quality.fit(docs, labels.where(half))
    others = labels.where(~half).select("doc_id", F.col("quality").alias("truth"))
    got = quality.judge(docs.join(others.select("doc_id"), "doc_id", "left_semi"), model).join(others, "doc_id").collect()
    assert np.mean([(r.quality >= 0.5) == bool(r.truth) for r in got]) > 0.85
