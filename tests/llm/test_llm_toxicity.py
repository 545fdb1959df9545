from __future__ import annotations

import re

import numpy as np
from pyspark.sql import functions as F

from awkward_rows import AWKWARD
from tradewind.llm import toxicity
from tradewind.llm.features import Sparse, scan


def test_cumulative_link_finds_the_optimum():
    rng = np.random.default_rng(4)
    dense = (rng.random((400, 6)) < 0.5).astype(float)
    score = dense @ np.array([2.0, -1, 0.5, 0, 1, -2])
    grade = np.digitize(score + rng.logistic(0, 1, 400), [-1, 1, 2.5])
    x = Sparse.of([(np.flatnonzero(r), np.ones(int(r.sum()))) for r in dense], 6)
    w, cut = toxicity.cumulative_link(x, grade, 4, sparse=0.0, penalty=0.0, rounds=3000)
    assert (np.diff(cut) > 0).all()

    def loss(weights, cuts):
        edge = np.concatenate([[-np.inf], cuts, [np.inf]])
        p = lambda t: 1 / (1 + np.exp(-t))
        s = dense @ weights
        return -np.log(p(edge[grade + 1] - s) - p(edge[grade] - s)).mean()

    best = loss(w, cut)
    for i in range(6):
        for step in (0.02, -0.02):
            moved = w.copy()
            moved[i] += step
            assert loss(moved, cut) > best - 1e-6
    for i in range(3):
        for step in (0.02, -0.02):
            moved = cut.copy()
            moved[i] += step
            assert loss(w, moved) > best - 1e-6


def test_an_l1_penalty_silences_noise():
    rng = np.random.default_rng(5)
    dense = (rng.random((600, 40)) < 0.3).astype(float)
    grade = np.where(dense[:, 0] == 1, 1 + (dense[:, 1] == 1), 0)
    x = Sparse.of([(np.flatnonzero(r), np.ones(int(r.sum()))) for r in dense], 40)
    w, _ = toxicity.cumulative_link(x, grade, 3, sparse=5e-3)
    assert w[0] > 1 and np.abs(w[2:]).max() < 0.5 * w[0]


def words_model(spark):
    bad, good = ["awful", "nasty", "vile", "rotten"], [f"calm{i}" for i in range(50)]
    rng = np.random.default_rng(6)
    rows, labels = [], []
    for i in range(400):
        words = list(rng.choice(good, 30))
        toxic = i % 4 == 0
        if toxic:
            words[3:6] = rng.choice(bad, 3)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"), labels


def test_learns_words_and_their_beginnings(spark):
    docs, labels, known = words_model(spark)
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.severities(docs, model).collect()}
    assert all(got[i].toxic == bool(t) for i, t in known)
    fresh = spark.createDataFrame(
        [(1, "calm1 AWFUL. calm2 nasty, vile"), (2, "calm1 calm2"), (3, None), (4, "nastyness")],
        "doc_id bigint, text string",
    )
    found = {r.doc_id: r for r in toxicity.severities(fresh, model).collect()}
    assert found[1].toxic and not found[2].toxic and not found[3].toxic
    assert found[1].expected_severity > found[4].expected_severity > found[2].expected_severity
    assert sorted(r.doc_id for r in toxicity.without_toxic(fresh, model).collect())[:2] == [2, 3]


def test_awkward_rows_and_no_labels(spark, awkward, nothing):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.fit(awkward, none)
    got = toxicity.severities(awkward, model).collect()
    assert len(got) == len(AWKWARD) and not any(r.toxic for r in got)
    assert toxicity.without_toxic(awkward, model).collect() == awkward.collect()
    trained = toxicity.fit(*words_model(spark)[:2])
    assert toxicity.without_toxic(awkward, trained).count() == len(AWKWARD)
    assert toxicity.severities(nothing, trained).count() == 0
    assert toxicity.without_toxic(nothing, trained).count() == 0


def test_labelled_documents(spark):
    folder = "/root/testdata/sf0.1"
    verdict = {r.doc_id: r.toxic for r in toxicity.op9_toxicity(spark, folder).collect()}
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    clean = [verdict[i] for i, t in labels if t == 0]
    toxic = [verdict[i] for i, t in labels if t == 1]
    assert np.mean(clean) < 0.01 and np.mean(toxic) > 0.9


def brute_score(text: str | None, model: toxicity.Model) -> float:
    """Sum of the weights of the distinct words and word beginnings, one word at a time."""
    weight = dict(zip(model.features.tolist(), model.weights.tolist()))
    found = set()
    for word in re.split(r"[^0-9A-Za-z\x80-\U0010ffff]+", text or ""):
        raw = word.encode()
        if raw:
            one = scan([raw])
            found.add(int(one.hash[0] >> np.uint64(32)))
            for size in toxicity.PREFIXES:
                if len(raw) > size:
                    found.add(int(one.prefix_hash(size)[1][0] >> np.uint64(32)))
    return sum(weight.get(f, 0.0) for f in found)


def test_scores_equal_a_dictionary_version(spark, awkward):
    model = toxicity.fit(*words_model(spark)[:2])
    rng = np.random.default_rng(12)
    vocabulary = ["awful", "Nasty", "VILE.", "rotten,calm1", "nastyness", "calm2", "é-awful", "vil", "", "\n", "rottenest!"]
    texts = [r[1] for r in AWKWARD if r[0] not in (6, 7)] + [" ".join(rng.choice(vocabulary, rng.integers(0, 30))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    for r in toxicity.severities(docs, model).collect():
        p = model.grades(np.array([brute_score(texts[r.doc_id], model)]))[0]
        assert abs(r.p_toxic - (1 - p[0])) < 1e-9
        assert abs(r.expected_severity - p @ np.arange(len(p))) < 1e-9 and r.grade == int(p.argmax())
    assert len({brute_score(t, model) for t in texts}) > 10


def test_verdicts_of_held_out_documents(spark):
    """Fitted on half of the labelled documents, judged on the others."""
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = toxicity.fit(docs, labels.where(half))
    judged = docs.join(labels.where(~half).select("doc_id", F.col("toxic").alias("truth")), "doc_id")
    verdict = toxicity.severities(judged, model).select("doc_id", "toxic")
    got = verdict.join(labels.select("doc_id", F.col("toxic").alias("truth")), "doc_id").collect()
    assert np.mean([r.toxic for r in got if r.truth == 0]) < 0.02 and np.mean([r.toxic for r in got if r.truth == 1]) > 0.8
