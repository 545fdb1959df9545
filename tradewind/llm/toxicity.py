"""Toxicity: severity grades from sparse text features by cumulative-link ordinal regression.

P(grade <= k) is the logistic function of a threshold minus one linear score, so the weights are
shared by all grades and only the ordered thresholds differ. The features are the distinct words of
the whole text and the distinct beginnings of longer words (so that inflected forms of a stem count
together), hashed to 32 bits. Labels tell toxic from clean; the severity of a toxic example is graded
by how many marker features (those seen almost only in toxic examples of the sample) it has.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import documents, text_or_empty
from tradewind.llm.features import Scan, Sparse, labelled_sample, scan, slices

SAMPLE_PER_CLASS = 2500  # bound of the fitting sample, per class
PREFIXES = (3, 4, 5, 6, 7, 8)  # bytes
MOST_FEATURES, LEAST_Z = 2000, 4.0
GRADES = 4  # 0 is clean; toxic examples get 1 to 3 by thirds of their marker features
REJECT_FROM = 0.5
_SIEVE_BITS = 16


@dataclass
class Model:
    features: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint32))  # sorted
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))
    thresholds: np.ndarray = field(default_factory=lambda: np.full(GRADES - 1, 50.0))

    def grades(self, score: np.ndarray) -> np.ndarray:
        """P(grade = k), one row per score."""
        below = _logistic(self.thresholds[None, :] - score[:, None])
        edge = np.concatenate([np.zeros((len(score), 1)), below, np.ones((len(score), 1))], axis=1)
        return np.maximum(np.diff(edge, axis=1), 0.0)


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


# Punctuation becomes a blank, so that a full stop hides no word.
_PUNCTUATION = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def _letters_only(text: bytes) -> bytes:
    return text.translate(_PUNCTUATION)


def _features(s: Scan):
    """(word numbers, 32-bit features): every word, and every beginning of a longer one."""
    high = np.uint64(32)
    yield np.arange(len(s.hash)), (s.hash >> high).astype(np.uint32)
    for size in PREFIXES:
        words, code = s.prefix_hash(size)
        yield words, (code >> high).astype(np.uint32)


# --- fitting -------------------------------------------------------------------------------------


def word_rows(sample: DataFrame) -> DataFrame:
    """(doc_id, label, features): the distinct features of a sample of (doc_id, text, label)."""

    def run(batches):
        for batch in batches:
            rows = []
            for _, part in slices(batch.column("text")):
                s = scan([_letters_only(t) for t in part])
                text = s.text_of.astype(np.uint64) << np.uint64(32)
                both = np.unique(np.concatenate([text[w] | f for w, f in _features(s)]))
                cuts = np.searchsorted(both, np.arange(len(part) + 1, dtype=np.uint64) << np.uint64(32))
                rows += [both[a:b].astype(np.uint32).tobytes() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())],
                names=["doc_id", "label", "features"],
            )

    id_type = sample.schema["doc_id"].dataType.simpleString()
    picked = sample.select("doc_id", "label", "text")
    return picked.mapInArrow(run, f"doc_id {id_type}, label int, features binary")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Fitted on at most ``per_class`` documents of each label; equal texts of a label count once.

    Without toxic and clean examples nothing can be told apart, and the model finds nothing toxic.
    """
    sample = labelled_sample(docs, labels, "toxic", per_class).groupBy("text", "label").agg(
        F.min("doc_id").alias("doc_id")
    )
    found = word_rows(sample).collect()
    found.sort(key=lambda r: r["doc_id"])
    toxic = np.array([r["label"] for r in found], dtype=bool)
    if toxic.all() or not toxic.any():
        return Model()
    rows = [np.frombuffer(r["features"], dtype=np.uint32) for r in found]
    least = max(4, int(0.005 * toxic.sum()))
    # Features that stand out in both halves of the sample by a z score, so that the words of single
    # examples, or of a few alike ones, are not learnt by heart.
    half = np.random.default_rng(0).permutation(len(rows)) % 2
    names, z = None, None
    for h in (0, 1):
        own, score = _stand_out([r for r, x in zip(rows, half) if x == h], toxic[half == h], least // 2)
        if names is None:
            names, z = own, score
        else:
            names, a, b = np.intersect1d(names, own, assume_unique=True, return_indices=True)
            z = np.minimum(z[a], score[b])
    best = np.argsort(-z, kind="stable")[:MOST_FEATURES]
    chosen = np.sort(names[best[z[best] >= LEAST_Z]])
    if not len(chosen):
        return Model()
    kept = []
    for r in rows:
        at = np.minimum(np.searchsorted(chosen, r), len(chosen) - 1)
        kept.append(at[chosen[at] == r])
    x = Sparse.of([(c, np.ones(len(c))) for c in kept], len(chosen))
    everywhere = np.bincount(x.column, minlength=len(chosen))
    in_toxic = np.bincount(x.column, weights=np.repeat(toxic, np.diff(x.first)), minlength=len(chosen))
    hits = x.dot((in_toxic >= 0.9 * everywhere).astype(np.float64))
    thirds = np.quantile(hits[toxic], [1 / 3, 2 / 3])
    grade = np.where(toxic, 1 + (hits > thirds[0]) + (hits > thirds[1]), 0).astype(np.int64)
    weights, thresholds = cumulative_link(x, grade, GRADES)
    return Model(chosen, weights, thresholds)


def _stand_out(rows, toxic: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(features, deviations by which a feature's number of toxic examples is above chance)."""
    names, place = np.unique(np.concatenate(rows), return_inverse=True)
    everywhere = np.bincount(place, minlength=len(names))
    bad = np.repeat(toxic, [len(r) for r in rows])
    in_toxic = np.bincount(place, weights=bad, minlength=len(names))
    share = everywhere / len(rows)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * max(toxic.sum(), 1))
    often = everywhere >= max(2, least)
    return names[often], ((in_toxic - share * toxic.sum()) / spread)[often]


def cumulative_link(
    x: Sparse, grade: np.ndarray, grades: int, sparse: float = 1e-4, penalty: float = 1e-4, rounds: int = 800
) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights (L1 and L2 penalised) and ordered thresholds of the proportional-odds model.

    Adam steps on the mean negative log-likelihood with a proximal L1 step; thresholds are a first one
    plus positive gaps, so they stay ordered.
    """
    n = len(grade)
    share = np.bincount(grade, minlength=grades).cumsum()[:-1] / n
    start = np.clip(share, 1e-3, 1 - 1e-3)
    cut = np.maximum.accumulate(np.log(start / (1 - start)) + 1e-2 * np.arange(grades - 1))
    state = np.concatenate([np.zeros(x.columns), cut[:1], np.log(np.maximum(np.diff(cut), 1e-2))])
    first, second = np.zeros_like(state), np.zeros_like(state)
    d = x.columns
    rate = 0.05
    for step in range(1, rounds + 1):
        theta = np.cumsum(np.concatenate([state[d : d + 1], np.exp(state[d + 1 :])]))
        score = x.dot(state[:d])
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        hi, lo = _logistic(edge[grade + 1] - score), _logistic(edge[grade] - score)
        hi, lo = np.where(grade == grades - 1, 1.0, hi), np.where(grade == 0, 0.0, lo)
        p = np.maximum(hi - lo, 1e-9)
        up, down = hi * (1 - hi) / p / n, lo * (1 - lo) / p / n
        by_cut = np.zeros(grades - 1)
        np.add.at(by_cut, np.minimum(grade, grades - 2), np.where(grade < grades - 1, -up, 0.0))
        np.add.at(by_cut, np.maximum(grade - 1, 0), np.where(grade > 0, down, 0.0))
        tail = np.cumsum(by_cut[::-1])[::-1]  # a gap moves every threshold above it
        slope = np.concatenate(
            [x.back(up - down) + penalty * state[:d], tail[:1], tail[1:] * np.exp(state[d + 1 :])]
        )
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        size = rate / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        state = state - size * first / (1 - 0.9**step)
        state[:d] = np.sign(state[:d]) * np.maximum(np.abs(state[:d]) - np.minimum(size[:d] * sparse, 0.02), 0)
        rate = 0.05 if step < rounds * 0.6 else 0.05 * (1 - (step / rounds - 0.6) / 0.45)
    return state[:d], np.cumsum(np.concatenate([state[d : d + 1], np.exp(state[d + 1 :])]))


# --- scoring -------------------------------------------------------------------------------------


def _slim(model: Model) -> Model:
    live = model.weights != 0
    return Model(model.features[live], model.weights[live], model.thresholds)


def _scores(column: pa.Array, model: Model) -> np.ndarray:
    """Sum of the weights of the distinct features of each text."""
    score = np.zeros(len(column))
    if not len(model.features):
        return score
    shift = np.uint32(32 - _SIEVE_BITS)
    sieve = np.zeros(1 << _SIEVE_BITS, dtype=bool)
    sieve[model.features >> shift] = True
    for first, part in slices(column):
        s = scan([_letters_only(t) for t in part])
        text, found = s.text_of, []
        for words, features in _features(s):
            maybe = np.flatnonzero(sieve[features >> shift])  # few, and only these are looked up
            at = np.minimum(np.searchsorted(model.features, features[maybe]), len(model.features) - 1)
            known = model.features[at] == features[maybe]
            found.append(text[words[maybe[known]]] * len(model.features) + at[known])
        pairs = np.unique(np.concatenate(found))
        score[first : first + len(part)] = np.bincount(
            pairs // len(model.features), weights=model.weights[pairs % len(model.features)], minlength=len(part)
        )
    return score


def severities(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, expected_severity, p_toxic, grade (likeliest), toxic.

    The whole text counts; null text is empty, and repeated rows and null ids are graded like any other.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    picked = docs.select("doc_id", text_or_empty("text").alias("text"))
    slim = _slim(model)

    def run(batches):
        for batch in batches:
            p = slim.grades(_scores(batch.column("text"), slim))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(p @ np.arange(p.shape[1])),
                    pa.array(1 - p[:, 0]),
                    pa.array(p.argmax(axis=1).astype(np.int32)),
                ],
                names=["doc_id", "expected_severity", "p_toxic", "grade"],
            )

    schema = f"doc_id {id_type}, expected_severity double, p_toxic double, grade int"
    return picked.mapInArrow(run, schema).withColumn("toxic", F.col("p_toxic") >= REJECT_FROM)


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text is not judged toxic, all columns as they are.

    Only the text goes to Python, and one truth value a row comes back.
    """
    slim = _slim(model)

    @F.arrow_udf("boolean")
    def toxic(text: pa.Array) -> pa.Array:
        return pa.array(1 - slim.grades(_scores(text, slim))[:, 0] >= REJECT_FROM)

    return docs.where(~toxic(F.col("text")))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity and verdict of every document, by a model fitted on the labelled ones."""
    docs = documents(spark, sf_dir)
    return severities(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
