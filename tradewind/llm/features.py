"""Hashed text features in Arrow batches, and the bounded labelled samples that models are fitted on."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 20  # bytes of text looked at together
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
# Byte 0 must add to a hash too, or words that end in it would equal shorter ones.
_LOWER = np.array([1 + (b + 32 if 65 <= b <= 90 else b) for b in range(256)], dtype=np.uint64)


@dataclass
class Scan:
    """Words of several texts: bytes of all, bounds of each text, bounds and hash of each word."""

    raw: np.ndarray
    space: np.ndarray
    text_start: np.ndarray
    text_end: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first_word: np.ndarray  # of each text, and one past the last
    hash: np.ndarray
    sums: np.ndarray
    inverse: np.ndarray

    def prefix_hash(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers, hashes of their first ``size`` bytes) of the words that are longer."""
        longer = np.flatnonzero(self.end - self.start > size)
        at = self.start[longer]
        return longer, mixed((self.sums[at + size] - self.sums[at]) * self.inverse[at] + np.uint64(size))

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.text_start)), np.diff(self.first_word))


def chunks(texts: list[bytes], most: int = CHUNK):
    """(first index, texts) with at most ``most`` bytes each, or one longer text."""
    first, total = 0, 0
    for i, text in enumerate(texts):
        if i > first and total + len(text) > most:
            yield first, texts[first:i]
            first, total = i, 0
        total += len(text)
    if first < len(texts):
        yield first, texts[first:]


def scan(texts: list[bytes]) -> Scan:
    raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    text_start = np.cumsum(sizes + 1) - sizes - 1
    space = _SPACE[raw]
    before = np.r_[True, space[:-1]]
    start, end = np.flatnonzero(before & ~space), np.flatnonzero(space & ~before)
    powers = np.full(len(raw), _BASE)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LOWER[raw] * powers)])
    powers[:] = _INVERSE
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    return Scan(
        raw,
        space,
        text_start,
        text_start + sizes,
        start,
        end,
        np.searchsorted(start, np.r_[text_start, len(raw)]),
        mixed((sums[end] - sums[start]) * powers[start]),
        sums,
        powers,
    )


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * _MIX
    return h ^ (h >> np.uint64(32))


def total_per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values[first[i]:first[i + 1]]`` for every i; empty ranges give 0."""
    sums = np.concatenate([np.zeros(1), np.cumsum(values, dtype=np.float64)])
    return sums[first[1:]] - sums[first[:-1]]


def utf8(column) -> list[bytes]:
    return [v.as_buffer().to_pybytes() for v in column]


def slices(column: pa.Array, most: int = CHUNK):
    """(first row, texts as bytes) of slices of at most ``most`` bytes, or one longer text; null is empty.

    Bytes come from the Arrow buffers, and only one slice of a batch is alive at a time.
    """
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(column):
        before = ends[first - 1] if first else 0
        after = max(int(np.searchsorted(ends, before + most, side="right")), first + 1)
        yield first, [v.as_buffer().to_pybytes() if v.is_valid else b"" for v in column[first:after]]
        first = after


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, text, label): at most ``per_class`` documents of label 0 and of label 1 each.

    They are those with the smallest hashes of their ids, so the sample depends on the ids alone. Labels
    other than 0 and 1, nulls, and labels of documents that are unknown or have no text are left out before
    the bound counts; of conflicting labels of one document the larger counts.
    """
    there = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").alias("d"))
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where("doc_id IS NOT NULL AND label IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .join(there, F.col("doc_id") == F.col("d"), "left_semi")
        .withColumn("order", F.xxhash64("doc_id"))
    )
    parts = [known.where(F.col("label") == c).orderBy("order", "doc_id").limit(per_class) for c in (0, 1)]
    chosen = parts[0].unionAll(parts[1]).select(F.col("doc_id").alias("d"), "label")
    return (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("d"))  # at most 2 * per_class rows
        .where("text IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.min("label").alias("label"))
    )


@dataclass
class Sparse:
    """Rows of (column, value) lists."""

    first: np.ndarray
    column: np.ndarray
    value: np.ndarray
    columns: int

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]], columns: int) -> Sparse:
        first = np.r_[0, np.cumsum([len(c) for c, _ in rows])].astype(np.int64)
        column = np.concatenate([c for c, _ in rows]) if rows else np.empty(0, np.int64)
        value = np.concatenate([v for _, v in rows]) if rows else np.empty(0)
        return cls(first, column, value, columns)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return total_per_text(self.value * weights[self.column], self.first)

    def back(self, per_row: np.ndarray) -> np.ndarray:
        spread = np.repeat(per_row, np.diff(self.first))
        return np.bincount(self.column, weights=self.value * spread, minlength=self.columns)

    def bound(self, rounds: int = 12) -> float:
        """About the largest eigenvalue of X'X, by power iteration."""
        v = np.ones(self.columns)
        norm = 1.0
        for _ in range(rounds):
            v = self.back(self.dot(v / np.linalg.norm(v)))
            norm = float(np.linalg.norm(v)) or 1.0
        return norm * 1.1
