from __future__ import annotations

import math

import numpy as np
import pytest

from tradewind.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, n string, x string, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], SCHEMA).repartition(3)


def quantised(rows):
    kept = [
        (i, [math.floor(256 * float(np.float32(c))) for c in v])
        for i, v in rows
        if v is not None and all(c is not None and math.isfinite(np.float32(c)) for c in v)
    ]
    wide = max((len(x) for _, x in kept), default=0)
    return [(i, x + [0] * (wide - len(x))) for i, x in kept]


def brute(rows, count=4):
    """Exact integer sums and a dense eigendecomposition."""
    kept = quantised(rows)
    distinct = sorted({tuple(x) for _, x in kept})
    n = len(distinct)
    sums = [sum(c) for c in zip(*distinct)]
    centred = np.array(distinct, dtype=float) - np.array([s / n for s in sums])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = values.sum()
    kept_components = [k for k in range(min(count, len(values))) if values[k] > 1e-12 * trace]
    out = {}
    for at, (i, x) in enumerate(kept):
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        y = np.array(x) - np.array([s / n for s in sums])
        for k in kept_components:
            out[at, k + 1] = (i, n, deviation, y @ vectors[:, k] / math.sqrt(values[k]), values[k] / trace)
    return out


def compare(got, want, plain=True):
    """Rows agree up to one sign per component."""
    have = sorted(((r.component, str(r.vec_id), r.n, r.deviation, round(r.explained, 9)) for r in got))
    assert have == sorted((k, str(w[0]), w[1], w[2], round(w[4], 9)) for (_, k), w in want.items())
    if plain:  # distinct eigenvalues
        for k in {k for _, k in want}:
            theirs = sorted((str(w[0]), w[2], abs(w[3])) for (_, c), w in want.items() if c == k)
            mine = sorted((str(r.vec_id), r.deviation, abs(r.whitened)) for r in got if r.component == k)
            assert np.allclose([m[2] for m in mine], [t[2] for t in theirs], atol=1e-8)
    assert len({r.identity_error for r in got}) <= 1 and all(r.identity_error < 1e-9 for r in got)


@pytest.mark.parametrize("d, n", [(1, 9), (3, 40), (16, 300), (12, 5)])
def test_equals_a_dense_eigendecomposition(spark, d, n):
    rng = np.random.default_rng(d)
    spread = np.exp(-np.arange(d) / 3)
    rows = [(i, [float(c) for c in rng.normal(size=d) * spread]) for i in range(n)]
    rows += rows[: n // 3] + [(1000 + i, rows[0][1]) for i in range(20)]  # copies count once in the fit
    compare(whitening.whiten(frame(spark, rows)).collect(), brute(rows))


def test_signs_are_the_same_for_all_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.normal(size=4) * [8, 4, 2, 1]]) for i in range(60)]
    got = {(r.vec_id, r.component): r.whitened for r in whitening.whiten(frame(spark, rows)).collect()}
    want = {(w[0], k): w[3] for (_, k), w in brute(rows).items()}
    for k in range(1, 5):
        sign = math.copysign(1, got[0, k] * want[0, k])
        assert all(abs(got[i, k] - sign * want[i, k]) < 1e-9 for i in range(60))


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, -0.25, 0.125]),
        (2, [0.5, -0.25, 0.125]),
        (2, [1.5, 2.25]),
        (3, None),
        (4, [None, 1.0, 2.0]),
        (5, [nan, 1.0, 0.0]),
        (6, [inf, 1.0, 0.0]),
        (7, []),
        (8, [0.0, 0.0, 0.0]),
        (None, [2.0, -1.0, 0.5]),
        (None, None),
    ]
    compare(whitening.whiten(frame(spark, rows)).collect(), brute(rows))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])]])
def test_no_variance_gives_no_rows(spark, rows):
    found = whitening.whiten(frame(spark, rows))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert found.count() == 0


def test_large_values_saturate(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.5, 2.0])]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r.vec_id for r in got} == {1, 2, 3} and max(r.deviation for r in got) == 2**63 - 1


def test_equal_eigenvalues(spark):
    rows = [(i, [4.0 * s if k == i % 5 else 0.0 for k in range(5)]) for i in range(10) for s in (1, -1)]
    got = whitening.whiten(frame(spark, rows)).collect()
    compare(got, brute(rows), plain=False)
    assert all(r.explained == pytest.approx(0.2) for r in got)


def test_spectra_merge_level_by_level(spark, monkeypatch):
    monkeypatch.setattr(whitening, "MERGED_TOGETHER", 2)
    rng = np.random.default_rng(3)
    x = rng.integers(-50, 50, size=(200, 6))
    table = spark.createDataFrame([(v.tolist(),) for v in x], "x array<bigint>").repartition(9)
    whole = whitening.merged_spectrum(table, 6)
    scatter = np.cov(x.T, bias=True) * len(x)
    assert whole.n == 200 and np.allclose(whole.mean, x.mean(axis=0))
    assert np.allclose(whole.vectors @ np.diag(whole.values) @ whole.vectors.T, scatter, atol=1e-8)


@pytest.mark.parametrize("trial", range(12))
def test_rank_one_updates(trial):
    rng = np.random.default_rng(trial)
    d, n = int(rng.integers(1, 20)), int(rng.integers(1, 80))
    x = rng.integers(-30, 30, size=(n, d)).astype(float)
    if trial % 3 == 0:
        x[:, ::2] = 0
    if trial % 4 == 0:
        x = x[:, :1] + np.zeros((n, d))
    if trial % 5 == 0:
        x = np.repeat(np.eye(d) * 5, 3, axis=0)
    s = whitening.Spectrum.empty(d)
    for row in x:
        s.add(row)
    scatter = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
    size = max(np.abs(scatter).max(), 1)
    assert np.abs(s.vectors @ np.diag(s.values) @ s.vectors.T - scatter).max() < 1e-11 * size
    assert np.abs(s.vectors.T @ s.vectors - np.eye(d)).max() < 1e-12
    assert np.allclose(s.values, np.linalg.eigvalsh(scatter), atol=1e-10 * size)


def test_secular_roots_interlace():
    rng = np.random.default_rng(7)
    d = np.sort(rng.normal(size=9)) * 10.0 ** rng.integers(-6, 6, 9)
    d = np.sort(d)
    z = rng.normal(size=9) * 10.0 ** rng.integers(-3, 3, 9)
    origin, x = whitening.secular_roots(d, z)
    roots = d[origin] + x
    assert (roots > d - 1e-12).all() and (roots[:-1] <= d[1:]).all()
    assert np.allclose(roots, np.linalg.eigvalsh(np.diag(d) + np.outer(z, z)), rtol=1e-9, atol=1e-9 * (z @ z))


def test_a_long_batch_equals_its_rows():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 7)) * np.exp(-np.arange(7)) + 5
    one, many = whitening.Spectrum.empty(7), whitening.Spectrum.empty(7)
    for row in x:
        one.add(row)
    many.add_all(x[:40])
    many.add_all(x[40:45])
    many.add_all(x[45:])
    assert many.n == one.n == 300 and np.allclose(many.mean, one.mean) and many.updates < 60
    for s in (one, many):
        scatter = s.vectors @ np.diag(s.values) @ s.vectors.T
        assert np.allclose(scatter, np.cov(x.T, bias=True) * 300, atol=1e-9)
