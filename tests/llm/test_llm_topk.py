from __future__ import annotations

import math

import numpy as np
import pytest

from tradewind.llm import topk

MOST = 2**63 - 1
SCHEMA = "vec_id bigint, embedding array<float>, query_id bigint, score string"


def brute(rows, every=1, k=10):
    kept = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(np.float32(x)) for x in v)
    ]
    want = []
    for row, (i, q) in enumerate(kept):
        if i % every:
            continue
        products = ((sum(a * b for a, b in zip(q, c)), j) for n, (j, c) in enumerate(kept) if n != row)
        found = sorted((-max(-MOST, min(MOST, s)), j) for s, j in products)[:k]
        want += [(i, rank, j, -s) for rank, (s, j) in enumerate(found, 1)]
    return sorted(want)


def run(spark, rows, every=1):
    frame = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)
    vectors = topk.quantised(frame).cache()
    got = topk.top_k(vectors, vectors.where(f"vec_id % {every} = 0"))
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect())


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, -0.25]),
        (2, [0.5, -0.25]),
        (3, [0.0, 0.0]),
        (4, None),
        (5, [None, 1.0]),
        (6, [nan, 1.0]),
        (7, [inf, 1.0]),
        (None, [9.0, 9.0]),
        (8, []),
        (9, [1.0, 2.0, 3.0]),
        (10, [1e30, -1e-30]),
        (11, [-1e9, 1e9]),
    ]
    assert run(spark, rows) == brute(rows)


def test_repeated_rows_each_count(spark):
    rows = [(i, [1.0, i / 8]) for i in range(4)] * 2
    got = run(spark, rows)
    assert got == brute(rows)
    assert len(got) == 8 * 7  # all rows but the query's own, the other one of its id included


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0])]) == []


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_pruning_loses_nothing(spark, monkeypatch, spread):
    monkeypatch.setattr(topk, "BLOCK", 37)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 16)
    monkeypatch.setattr(topk, "PROBE", 50)
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(6, 16))
    rows = []
    for i in range(400):
        v = centers[i % 6] + 0.3 * rng.normal(size=16)
        v = v / np.linalg.norm(v) * np.exp(spread * rng.normal())
        rows.append((i, [float(np.float32(x)) for x in v]))
    rows += [(1000 + i, rows[0][1]) for i in range(30)]  # ties
    assert run(spark, rows, every=7) == brute(rows, every=7)


def test_thresholds_prune_candidates():
    rng = np.random.default_rng(9)
    q = rng.normal(size=8) * 1000
    c = np.floor(rng.normal(size=(500, 8)) * 1000)
    norm = np.linalg.norm(c, axis=1)
    bound = 0.8 * np.linalg.norm(q) * norm.max()
    may = topk._may_reach(q, c, norm, np.linalg.norm(q), bound)
    assert may.sum() < 100 and not ((c @ q >= bound) & ~may).any()


def test_query_blocks_go_only_where_their_bounds_can_be_reached(spark, monkeypatch):
    for name, value in (("BLOCK", 20), ("BLOCKS_IN_GROUP", 2), ("QUERY_BLOCK", 8), ("PROBE", 60)):
        monkeypatch.setattr(topk, name, value)
    sent = []
    plain = topk.routed

    def spied(asked, blocks):
        out = plain(asked, blocks)
        sent.append((out.count(), asked.count() * blocks.select("group").distinct().count()))
        return out

    monkeypatch.setattr(topk, "routed", spied)
    rng = np.random.default_rng(10)
    rows = []
    for i in range(800):
        v = rng.normal(size=6)
        size = np.exp(1.5 * rng.normal())  # few long vectors, many short ones
        rows.append((i, [float(np.float32(x)) for x in v / np.linalg.norm(v) * size]))
    assert run(spark, rows, every=9) == brute(rows, every=9)
    some, all_pairs = sent[0]
    assert 0 < some < 0.7 * all_pairs
    monkeypatch.setattr(topk, "MOST_LEVELS", 3)  # coarser levels send more, and lose nothing either
    assert run(spark, rows, every=9) == brute(rows, every=9)
    assert some <= sent[1][0] <= all_pairs
