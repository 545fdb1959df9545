from __future__ import annotations

import numpy as np
import pytest
import xxhash

from awkward_rows import AWKWARD
from tradewind.llm import simhash
from tradewind.llm.common import connected_components


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, radius=3):
    """Component number of every fingerprint, by comparing all pairs."""
    prints = sorted(set(prints))
    top = {p: p for p in prints}

    def find(p):
        while top[p] != p:
            p = top[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def test_awkward_rows(awkward):
    found = simhash.near_duplicates(awkward).collect()
    assert len(found) == len(AWKWARD)
    prints = [fingerprint(r[1]) for r in AWKWARD]
    group = groups(prints)
    least = {}
    for r, p in zip(AWKWARD, prints):
        if r[0] is not None:
            least[group[p]] = min(r[0], least.get(group[p], r[0]))
    want = sorted(((r[0], p, least.get(group[p])) for r, p in zip(AWKWARD, prints)), key=str)
    assert sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in found), key=str) == want


def test_one_of_each_stays(awkward):
    kept = simhash.keep_one_of_each(awkward)
    assert kept.columns == awkward.columns
    rows = kept.collect()
    ids = [r.doc_id for r in rows]
    # Row 9 has two unrelated texts, and both stay.
    assert sorted(i for i in ids if i is not None) == [1, 3, 6, 9, 9, 10]
    assert {r.text for r in rows if r.doc_id == 9} == {"word", "other words here"}
    assert ids.count(None) == 2  # rows that cannot be named stay


def test_one_row_of_each_component_whatever_its_ids(spark):
    near = " ".join(f"w{i}" for i in range(400))
    rows = [(1, near), (1, "something else entirely"), (2, near + " x"), (2, "a third text"), (3, near), (3, near)]
    docs = spark.createDataFrame([(*r, {"k": i}) for i, r in enumerate(rows)], "doc_id int, text string, m map<string,int>")
    got = simhash.keep_one_of_each(docs).select("doc_id", "text").collect()
    assert sorted(map(tuple, got)) == [(1, "something else entirely"), (1, near), (2, "a third text")]


def test_empty(nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.keep_one_of_each(nothing).count() == 0


@pytest.mark.parametrize("radius, blocks, tile", [(0, 1, 512), (3, 4, 7), (3, 5, 512), (5, 8, 16)])
def test_links_of_near_fingerprints(spark, radius, blocks, tile):
    rng = np.random.default_rng(radius + blocks)
    centers = rng.integers(0, 1 << 64, 12, dtype=np.uint64)
    prints = {int(c) for c in centers}
    for c in centers:
        for _ in range(25):
            flip = sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 7), replace=False))
            prints.add(int(c) ^ flip)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = simhash.link_edges(spark.createDataFrame(signed, "fp bigint"), radius, blocks, tile)
    star = {r.node: r.root for r in connected_components(edges).collect()}
    want = groups(prints, radius)
    mine = {}
    for (s,) in signed:
        mine.setdefault(star.get(s, s), set()).add(s & (1 << 64) - 1)
    theirs = {}
    for p, g in want.items():
        theirs.setdefault(g, set()).add(p)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_bit_sliced_distances_match_popcount():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    prints = np.concatenate([base ^ np.uint64(1 << i) for i in range(40)] + [base])
    unit = np.sort(rng.integers(0, 3, len(prints)))
    side = np.zeros(len(prints), dtype=np.int64)
    for radius in (0, 1, 2, 3, 4, 7):
        got = {
            (int(i), int(j))
            for a, b in simhash.near_pairs(unit, side, prints, radius, most=50)
            for i, j in zip(a, b)
        }
        want = {
            (i, j)
            for i in range(len(prints))
            for j in range(i + 1, len(prints))
            if unit[i] == unit[j] and int(prints[i] ^ prints[j]).bit_count() <= radius
        }
        assert got == want


def test_components_of_a_path_and_a_hub(spark):
    rows = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    star = connected_components(spark.createDataFrame(rows, "a bigint, b bigint")).collect()
    assert {(r.node, r.root) for r in star} == {(i, 0) for i in range(1, 41)} | {
        (100 + i, 100) for i in range(1, 60)
    }
