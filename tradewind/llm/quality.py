"""Quality: counting rules first, then a calibrated classifier of hashed n-grams.

The classifier is a logistic regression over hashed words, word pairs and character n-grams (n-grams
of UTF-8 bytes), each kind as shares of its total, fitted on a bounded sample of labelled rows. A
quarter of the sample, unseen by the fit, calibrates the margin to a probability (Platt scaling).
Documents are scored in Arrow batches and judged against fixed thresholds.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import documents, text_or_empty
from tradewind.llm.features import Scan, Sparse, labelled_sample, mixed, scan, slices, total_per_text

SAMPLE_PER_CLASS = 1000  # bound of the fitting sample, per class
BITS, GRAMS, SCALE = 15, (3, 4), 20.0
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 20, 30, 8
KEEP_FROM, SURE_FROM = 0.5, 0.9
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_IN_WORD = np.array([b & 0xC0 != 0x80 for b in range(256)])  # first byte of a code point


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (margin + self.bias) + self.shift, -60, 60)))


# --- features ------------------------------------------------------------------------------------


def _grams(s: Scan):
    """(buckets, bounds per text) of each kind of feature, each kind in buckets of its own."""
    size, pick = 1 << BITS, np.uint64(64 - BITS)
    yield (s.hash >> pick).astype(np.int64), s.first_word
    same_text = np.ones(max(len(s.hash) - 1, 0), dtype=bool)
    inner = s.first_word[1:-1]
    same_text[inner[(inner > 0) & (inner < len(s.hash))] - 1] = False
    pairs = mixed(s.hash[:-1] * np.uint64(3) + s.hash[1:])[same_text]
    bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(same_text)])
    yield (pairs >> pick).astype(np.int64) + size, bounds[np.minimum(s.first_word, len(same_text))]
    wide = np.concatenate([s.raw, np.zeros(8, np.uint8)]).astype(np.uint64)
    for kind, n in enumerate(GRAMS, start=2):
        code = np.zeros(len(s.raw), dtype=np.uint64)
        for k in range(n):
            code = (code << np.uint64(8)) | wide[k : k + len(s.raw)]
        # A gram ends with its text at the latest, so a text's grams do not depend on the one behind it.
        number = np.maximum(s.text_end - s.text_start - n + 1, 0)
        first = np.cumsum(number) - number
        at = np.arange(int(number.sum())) + np.repeat(s.text_start - first, number)
        buckets = (mixed(code[at] + np.uint64(n)) >> pick).astype(np.int64) + kind * size
        yield buckets, np.r_[first, len(at)]


def _margins(s: Scan, weights: np.ndarray) -> np.ndarray:
    margin = np.zeros(len(s.text_start))
    for buckets, bounds in _grams(s):
        count = np.maximum(np.diff(bounds), 1)
        margin += SCALE * total_per_text(weights[buckets], bounds) / count
    return margin


def _rows(s: Scan):
    kinds = list(_grams(s))
    for i in range(len(s.text_start)):
        parts = []
        for buckets, bounds in kinds:
            own = buckets[bounds[i] : bounds[i + 1]]
            column, count = np.unique(own, return_counts=True)
            parts.append((column, SCALE * count / max(len(own), 1)))
        yield np.concatenate([c for c, _ in parts]), np.concatenate([v for _, v in parts])


def feature_rows(sample: DataFrame) -> DataFrame:
    """(doc_id, label, columns, values) of a sample; the lists as bytes of int32 and float32 numbers."""

    def run(batches):
        for batch in batches:
            rows = []
            for _, part in slices(batch.column("text")):
                rows += [(c.astype("<i4").tobytes(), v.astype("<f4").tobytes()) for c, v in _rows(scan(part))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("label"),
                    pa.array([c for c, _ in rows], pa.binary()),
                    pa.array([v for _, v in rows], pa.binary()),
                ],
                names=["doc_id", "label", "columns", "values"],
            )

    id_type = sample.schema["doc_id"].dataType.simpleString()
    picked = sample.select("doc_id", "label", "text")
    return picked.mapInArrow(run, f"doc_id {id_type}, label int, columns binary, values binary")


# --- fitting -------------------------------------------------------------------------------------


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Fitted on at most ``per_class`` documents of each label.

    Without labelled rows of both kinds nothing can be told apart, and the model keeps everything
    (or nothing, if all labels are 0).
    """
    found = feature_rows(labelled_sample(docs, labels, "quality", per_class)).collect()
    found.sort(key=lambda r: r["doc_id"])
    columns = (2 + len(GRAMS)) << BITS
    y = np.array([r["label"] for r in found], dtype=np.float64)
    if len(set(y)) < 2:
        return Model(np.zeros(columns), 0.0, 0.0, -50.0 if len(y) and not y.any() else 50.0)
    rows = [(np.frombuffer(r["columns"], "<i4"), np.frombuffer(r["values"], "<f4")) for r in found]
    held = np.random.default_rng(0).permutation(len(rows)) % 4 == 3
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(rows), dtype=bool)
    train = Sparse.of([r for r, h in zip(rows, held) if not h], columns)
    weights, bias = logistic(train, y[~held])
    unseen = held if held.any() else ~held
    margin = Sparse.of([r for r, h in zip(rows, unseen) if h], columns).dot(weights) + bias
    slope, shift = platt(margin, y[unseen])
    return Model(weights, bias, slope, shift)


def logistic(x: Sparse, y: np.ndarray, penalty: float = 1e-3, rounds: int = 120) -> tuple[np.ndarray, float]:
    """Weights and bias of an L2-penalised logistic regression with balanced classes (accelerated gradient)."""
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    step = 1 / (0.25 * x.bound() * share.max() + 0.25 + penalty)
    w, b = np.zeros(x.columns), 0.0
    v, c, t = w, b, 1.0
    for _ in range(rounds):
        error = (1 / (1 + np.exp(-np.clip(x.dot(v) + c, -60, 60))) - y) * share
        new_w, new_b = v - step * (x.back(error) + penalty * v), c - step * error.sum()
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new_w + (t - 1) / new_t * (new_w - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return w, float(b)


def platt(margin: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of the probability, by Newton steps on smoothed targets."""
    pos, neg = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    center, scale = margin.mean(), margin.std() or 1.0
    x = np.stack([(margin - center) / scale, np.ones(len(y))], axis=1)
    beta = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(hessian, x.T @ (target - p))
        beta += np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1] - beta[0] * center / scale)


# --- counting rules ------------------------------------------------------------------------------


def repeated_words(s: Scan, window: int = WINDOW) -> np.ndarray:
    """Per text: words covered by a window of words that occurs at least twice in that text."""
    n = len(s.hash)
    counts = np.zeros(len(s.text_start), dtype=np.int64)
    if n < window:
        return counts
    text = s.text_of
    code = np.zeros(n - window + 1, dtype=np.uint64)
    for k in range(window):  # case counts here, so the bytes decide below
        code = mixed(code * np.uint64(5) + s.hash[k : n - window + 1 + k])
    inside = np.flatnonzero(text[: n - window + 1] == text[window - 1 :])
    code = mixed(code[inside] + text[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(code, kind="stable")
    equal = code[order][1:] == code[order][:-1]
    likely = np.unique(np.r_[order[1:][equal], order[:-1][equal]])
    seen: dict[tuple, list[int]] = {}
    raw = s.raw.tobytes() if len(likely) else b""
    for at in inside[likely].tolist():  # few: only windows whose hash repeats in their text
        words = tuple(raw[s.start[at + k] : s.end[at + k]] for k in range(window))
        seen.setdefault((text[at], words), []).append(at)
    covered = np.zeros(n + 1, dtype=np.int64)
    for places in seen.values():
        if len(places) > 1:
            np.add.at(covered, np.array(places), 1)
            np.add.at(covered, np.array(places) + window, -1)
    hit = np.cumsum(covered[:-1]) > 0
    return total_per_text(hit, s.first_word).astype(np.int64)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def _measures(part: list[bytes], s: Scan) -> list[np.ndarray]:
    bounds = np.r_[s.text_start, len(s.raw)]
    return [
        np.diff(s.first_word),
        total_per_text(_IN_WORD[s.raw] & ~s.space, bounds).astype(np.int64),
        total_per_text(_SYMBOL[s.raw], bounds).astype(np.int64),
        np.array([repeated_lines(t) for t in part], dtype=np.int64),
        repeated_words(s),
    ]


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, the five counts, base_failed, quality (probability), band, kept.

    Null text is empty; repeated rows and null ids are judged like any other. ``band`` is "keep" from a
    probability of 0.9, "review" from 0.5 (both stay) and "reject" below, or if a counting rule fails.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{m} bigint" for m in MEASURES)
    picked = docs.select("doc_id", text_or_empty("text").alias("text"))

    def run(batches):
        for batch in batches:
            got = []
            for _, part in slices(batch.column("text")):
                s = scan(part)
                got.append([*_measures(part, s), model.probability(_margins(s, model.weights))])
            arrays = [pa.array(np.concatenate(c)) for c in zip(*got)]
            if arrays:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *arrays], names=["doc_id", *MEASURES, "quality"]
                )

    scored = picked.mapInArrow(run, f"doc_id {id_type}, {counts}, quality double")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    passed = ~F.col("base_failed") & (F.col("quality") >= KEEP_FROM)
    band = F.when(~passed, "reject").when(F.col("quality") >= SURE_FROM, "keep").otherwise("review")
    return scored.withColumn("base_failed", failed).withColumns({"band": band, "kept": passed})


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document, by a model fitted on the labelled ones."""
    docs = documents(spark, sf_dir)
    return judge(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
