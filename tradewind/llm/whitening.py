"""Embedding whitening by incremental eigendecomposition.

A partition keeps the spectrum (count, mean, eigenvectors and eigenvalues of the scatter around that
mean) of the vectors it has seen. One more vector is one centred rank-one update, and a long batch of them
is first turned into as many vectors of the same scatter as there are dimensions. An update's deviation
from the mean, in the eigenvectors' coordinates, is deflated (coordinates without weight, and all but one of
equal eigenvalues, stay as they are), the roots of the secular equation are the new eigenvalues, and
coordinates recomputed from the roots give orthogonal eigenvectors. Spectra of partitions are merged in
small groups, level by level: the eigenvectors of one, scaled, and the difference of the means are
successive rank-one updates of the other. The merged eigenvectors span the space of a last distributed
Rayleigh-Ritz step over exactly centred vectors, which settles components to double precision.

Memory and messages depend on the number of dimensions only, never on the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import written

SCALE, COMPONENTS = 256, 4
MERGED_TOGETHER = 16  # spectra merged in one group on average, and those that the driver merges at last
ORTHOGONAL_EVERY = 64  # updates after which rounding is swept out of the eigenvectors
_EPS = np.finfo(float).eps
_HALF = 1 << 31
_MOST = 2**63 - 1


# --- rank-one updates ----------------------------------------------------------------------------


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(z**2 / (d - x)) = 0 for ascending distinct ``d`` and ``z`` without zeros.

    They come as (index of the nearest pole, distance from it), all roots at once, so that differences to
    the poles keep full precision. Steps come from a rational curve through the two poles around a root and are
    halved into the bracket where they leave it.
    """
    n = len(d)
    weight = z * z
    above = np.append(d[1:], d[-1] + weight.sum())  # the last root has no pole above it
    gap = above - d
    middle = 1 + (weight / (d[None, :] - (d + gap / 2)[:, None])).sum(axis=1)
    left = (middle >= 0) | (np.arange(n) == n - 1)
    origin = np.where(left, np.arange(n), np.minimum(np.arange(n) + 1, n - 1))
    delta = d[None, :] - d[origin][:, None]  # poles seen from each root's origin
    low = np.where(left, 0.0, -gap / 2)
    high = np.where(left, np.where(np.arange(n) == n - 1, gap, gap / 2), 0.0)
    low_pole, high_pole = d - d[origin], above - d[origin]
    lower = np.tri(n, dtype=bool)  # poles up to the root's own
    x = (low + high) / 2
    for _ in range(100):
        distance = delta - x[:, None]
        term = weight / distance
        f = 1 + term.sum(axis=1)
        size = 1 + np.abs(term).sum(axis=1)
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        done = (np.abs(f) <= 8 * _EPS * size) | (high - low <= 2 * _EPS * np.maximum(np.abs(low), np.abs(high)))
        if done.all():
            break
        slope = term / distance
        below, over = (slope * lower).sum(axis=1), (slope * ~lower).sum(axis=1)
        a, b = low_pole - x, high_pole - x
        c = f - a * below - b * over
        p = (a + b) * f - a * b * (below + over)
        q = a * b * f
        root = np.sqrt(np.maximum(p * p - 4 * q * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
        new = x + step
        inside = np.isfinite(new) & (new > low) & (new < high)
        x = np.where(done, x, np.where(inside, new, (low + high) / 2))
    return origin, x


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending eigenvalues and eigenvectors (columns) of ``vectors diag(values) vectors' + v v'``."""
    size = float(np.sqrt(v @ v))
    if size == 0:
        return values, vectors
    z = vectors.T @ v
    tiny = 8 * _EPS * max(float(np.abs(values).max(initial=0)), size * size)
    values, vectors = values.copy(), vectors.copy()
    # Deflation: of equal eigenvalues a rotation leaves one with all the weight.
    live = np.flatnonzero(np.abs(z) * size > tiny)
    for i, j in zip(live[:-1], live[1:]):
        if values[j] - values[i] > tiny:
            continue
        r = np.hypot(z[i], z[j])
        c, s = z[j] / r, z[i] / r
        rotated = c * vectors[:, i] - s * vectors[:, j]
        vectors[:, j] = s * vectors[:, i] + c * vectors[:, j]
        vectors[:, i] = rotated
        z[i], z[j] = 0.0, r
    live = np.flatnonzero(np.abs(z) * size > tiny)
    if not len(live):
        return values, vectors
    d, w = values[live], z[live]
    origin, x = secular_roots(d, w)
    # (root j) - (pole i), exact to rounding; from it, the weights that these roots belong to.
    apart = d[origin][:, None] - d[None, :] + x[:, None]
    apart = np.where(apart == 0, _EPS * tiny, apart)
    own = d[None, :] - d[:, None]
    np.fill_diagonal(own, 1.0)
    n = len(d)
    ratio = np.abs(apart)
    # prod_j (root_j - d_i) / prod_{j != i} (d_j - d_i), pairing factors of about equal size
    paired = ratio.T.copy()
    k = np.arange(n)
    for_i = np.abs(own)
    upper = k[None, :] > k[:, None]
    # root j-1 lies between d_{j-1} and d_j: pair it with pole j above i, root j with pole j below i
    shifted = np.ones((n, n))
    shifted[:, 1:] = paired[:, :-1]
    factor = np.where(upper, shifted / for_i, np.where(upper.T, paired / for_i, 1.0))
    better = np.sqrt(np.prod(factor, axis=1) * paired[:, -1])
    w = np.copysign(better, w)
    turn = w[:, None] / apart.T  # column j: weights / (root_j - pole)
    turn /= np.sqrt((turn * turn).sum(axis=0))
    vectors[:, live] = vectors[:, live] @ turn
    values[live] = d[origin] + x
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Number, mean and scatter (eigenvalues, eigenvectors) of some vectors."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    updates: int = 0

    @classmethod
    def empty(cls, wide: int) -> Spectrum:
        return cls(0, np.zeros(wide), np.zeros(wide), np.eye(wide))

    def _update(self, v: np.ndarray) -> None:
        self.values, self.vectors = rank_one(self.values, self.vectors, v)
        self.updates += 1
        if self.updates % ORTHOGONAL_EVERY == 0:
            self.vectors = orthogonal(self.vectors)

    def add(self, x: np.ndarray) -> None:
        apart = x - self.mean
        if self.n:
            self._update(apart * np.sqrt(self.n / (self.n + 1)))
        self.n += 1
        self.mean = self.mean + apart / self.n

    def add_all(self, x: np.ndarray) -> None:
        """Rows of many vectors: an orthogonal transformation first turns their deviations from their own mean
        into as many rows as there are dimensions, which have the same scatter and are the updates."""
        if len(x) <= 2 * x.shape[1]:
            for row in x:
                self.add(row)
            return
        mean = x.mean(axis=0)
        for row in np.linalg.qr(x - mean, mode="r"):
            self._update(row)
        self._shift(mean, len(x))

    def _shift(self, mean: np.ndarray, n: int) -> None:
        """Accounts for the way between two means, once the scatter around the other is in."""
        apart, total = mean - self.mean, self.n + n
        self._update(apart * np.sqrt(self.n * n / total))
        self.mean, self.n = self.mean + apart * (n / total), total

    def merge(self, other: Spectrum) -> None:
        if not other.n:
            return
        if self.n:
            for value, vector in zip(other.values, other.vectors.T):
                if value > 0:
                    self._update(vector * np.sqrt(value))
            self._shift(other.mean, other.n)
        else:
            self.n, self.mean, self.values, self.vectors = other.n, other.mean, other.values, other.vectors

    def row(self) -> tuple[int, bytes, bytes, bytes]:
        return self.n, *(np.ascontiguousarray(a, "<f8").tobytes() for a in (self.mean, self.values, self.vectors))

    @classmethod
    def of(cls, row: dict) -> Spectrum:
        mean, values, vectors = (np.frombuffer(row[c], "<f8") for c in ("mean", "values", "vectors"))
        return cls(row["n"], mean, values, vectors.reshape(len(mean), len(mean)))


def orthogonal(q: np.ndarray) -> np.ndarray:
    """The orthogonal matrix next to an almost orthogonal one, by one step towards its polar factor."""
    return q @ (1.5 * np.eye(len(q)) - 0.5 * (q.T @ q))


# --- vectors -------------------------------------------------------------------------------------


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): floor(scale * c) of every component as a long, saturated at the ends of its range.

    Vectors that are null or hold a null, NaN or infinite component are left out; rows without an id stay.
    """
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            kept, rows = [], []
            for i, row in enumerate(column):
                if not row.is_valid or row.values.null_count:
                    continue
                v = np.floor(np.asarray(row.values.to_numpy(zero_copy_only=False), np.float64) * scale)
                if np.isfinite(v).all():
                    kept.append(i)
                    rows.append(_longs(v))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(kept, pa.int64())), pa.array(rows, pa.list_(pa.int64()))],
                names=["vec_id", "x"],
            )

    return vectors.select("vec_id", "embedding").mapInArrow(run, f"vec_id {kind}, x array<bigint>")


def _longs(v: np.ndarray) -> np.ndarray:
    small = np.abs(v) < 2.0**63
    return np.where(small, np.where(small, v, 0).astype(np.int64), np.where(v > 0, _MOST, -_MOST - 1))


def _matrix(column, wide: int) -> np.ndarray:
    """Vectors of a batch as rows of longs; shorter ones end in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == wide).all():
        return flat.reshape(len(sizes), wide)
    x = np.zeros((len(sizes), wide), dtype=np.int64)
    x[np.arange(wide) < sizes[:, None]] = flat
    return x


# --- the fit -------------------------------------------------------------------------------------


@dataclass
class Whitening:
    """Exact sums over the fit list and the leading components of its covariance."""

    n: int
    sums: list[int]
    components: np.ndarray  # one row each
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centre(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre()) @ self.components.T / np.sqrt(self.eigenvalues)

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Sum over dimensions of (n * x - S)**2, exact; the largest long stands for what is beyond it."""
        largest = max((abs(s) for s in self.sums), default=0) + self.n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
        if largest * largest * max(x.shape[1], 1) < _MOST:
            apart = self.n * x - np.array(self.sums, dtype=np.int64)
            return (apart * apart).sum(axis=1)
        exact = [min(sum((self.n * int(a) - s) ** 2 for a, s in zip(row, self.sums)), _MOST) for row in x]
        return np.array(exact, dtype=np.int64)


def _sums(fit_list: DataFrame) -> tuple[int, int, list[int]]:
    """Rows, dimensions and exact sums per dimension; halves of the longs are added up apart."""
    wide = fit_list.agg(F.max(F.size("x")).alias("d")).first()["d"] or 0

    def run(batches):
        n, high, low = 0, np.zeros(wide, np.int64), np.zeros(wide, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), wide)
            high += (x >> 31).sum(axis=0)
            low += (x & (_HALF - 1)).sum(axis=0)
            n += len(x)
        yield pa.RecordBatch.from_pydict({"at": np.arange(wide + 1), "high": np.r_[high, n], "low": np.r_[low, 0]})

    parts = fit_list.select("x").mapInArrow(run, "at bigint, high bigint, low bigint")
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    rows = {r["at"]: (int(r["high"]), int(r["low"])) for r in parts.groupBy("at").agg(*exact).collect()}  # one per dimension
    n = rows.pop(wide, (0, 0))[0]
    return n, wide, [rows[i][0] * _HALF + rows[i][1] for i in range(wide)] if n else []


_SPECTRUM = "n bigint, mean binary, values binary, vectors binary"


def merged_spectrum(fit_list: DataFrame, wide: int) -> Spectrum:
    """Spectrum of all vectors: of each partition by rank-one updates, then of groups of spectra."""

    def run(batches):
        own = Spectrum.empty(wide)
        for batch in batches:
            own.add_all(_matrix(batch.column(0), wide).astype(np.float64))
        if own.n:
            yield _spectrum_row(own)

    def merge(table: pa.Table) -> pa.Table:
        whole = Spectrum.empty(wide)
        for row in table.sort_by("part").to_pylist():
            whole.merge(Spectrum.of(row))
        return pa.Table.from_batches([_spectrum_row(whole)])

    def level(spectra: DataFrame) -> DataFrame:
        return written(spectra.withColumn("part", F.monotonically_increasing_id()), "spectra")

    spectra = level(fit_list.select("x").mapInArrow(run, _SPECTRUM))
    while (count := spectra.count()) > MERGED_TOGETHER:
        group = F.pmod(F.xxhash64("part"), F.lit(-(-count // MERGED_TOGETHER)))
        spectra = level(spectra.groupBy(group.alias("of")).applyInArrow(merge, _SPECTRUM))
    whole = Spectrum.empty(wide)
    for row in spectra.orderBy("part").collect():  # at most MERGED_TOGETHER
        whole.merge(Spectrum.of(row.asDict()))
    return whole


def _spectrum_row(spectrum: Spectrum) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array([v], k) for v, k in zip(spectrum.row(), kinds)], names=["n", "mean", "values", "vectors"]
    )


def _second_moments(fit_list: DataFrame, rows_of, size: int) -> np.ndarray:
    """Sum of r r' over rows r (``size`` numbers) that ``rows_of`` makes of a matrix of vectors."""

    def run(batches):
        total = np.zeros((size, size))
        for batch in batches:
            r = rows_of(batch.column(0))
            total += r.T @ r
        yield pa.RecordBatch.from_pydict({"at": np.arange(size * size), "value": total.ravel()})

    parts = fit_list.select("x").mapInArrow(run, "at bigint, value double")
    found = parts.groupBy("at").agg(F.sum("value").alias("value")).collect()  # one number per pair of dimensions
    total = np.zeros(size * size)
    for r in found:
        total[r["at"]] = r["value"]
    return total.reshape(size, size)


def fit(fit_list: DataFrame, components: int = COMPONENTS) -> Whitening:
    """``fit_list`` holds each distinct vector once in ``x``. Components without variance are left out."""
    n, wide, sums = _sums(fit_list)
    none = Whitening(n, sums, np.empty((0, wide)), np.empty(0), 0.0)
    if not n or not wide:
        return none
    centre = none.centre()
    basis = np.linalg.qr(merged_spectrum(fit_list, wide).vectors[:, ::-1])[0]
    ritz = _second_moments(fit_list, lambda column: (_matrix(column, wide) - centre) @ basis, wide) / n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    trace = float(np.trace(ritz))
    kept = int((values[:components] > wide * _EPS * max(trace, 0)).sum())
    if not kept:
        return none
    model = Whitening(n, sums, (basis @ turn[:, :kept]).T, values[:kept].copy(), trace)
    covariance = _second_moments(fit_list, lambda column: model.project(_matrix(column, wide)), kept) / n
    model.identity_error = float(np.abs(covariance - np.eye(kept)).max())
    return model


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per remaining row and component.

    Rows whose vector is null or holds a null or non-finite entry are left out; rows without an id and
    repeated rows are whitened like any other, but each distinct vector counts once in the fit. Vectors of
    fewer dimensions end in zeros, components of variance zero have no rows, an empty table gives none.
    """
    rows = written(quantised(vectors, scale), "vectors")
    # Empty vectors and those that only end in zeros are the same vector as their shorter form.
    fit_list = written(rows.select(_padded(rows).alias("x")).distinct(), "distinct")
    model = fit(fit_list, components)
    count, wide = len(model.eigenvalues), len(model.sums)
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1), wide)
            of = np.repeat(np.arange(len(x)), count)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(of)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    pa.array(model.deviation(x)[of]),
                    pa.array(model.project(x).ravel()),
                    pa.array(np.tile(model.eigenvalues / model.trace, len(x))),
                ],
                names=["vec_id", "component", "deviation", "whitened", "explained"],
            )

    schema = f"vec_id {kind}, component int, deviation bigint, whitened double, explained double"
    if not count:
        found = rows.sparkSession.createDataFrame([], schema)
    else:
        found = rows.mapInArrow(run, schema)
    return found.select(
        "vec_id",
        "component",
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        "explained",
        F.lit(model.identity_error).alias("identity_error"),
    )


def _padded(rows: DataFrame):
    """``x`` with zeros up to the widest vector."""
    wide = rows.agg(F.max(F.size("x")).alias("d")).first()["d"] or 0
    missing = F.greatest(F.lit(wide) - F.size("x"), F.lit(0))
    return F.when(missing == 0, F.col("x")).otherwise(F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), missing)))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the four leading components of the distinct ones."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
