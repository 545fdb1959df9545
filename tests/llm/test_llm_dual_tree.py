from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from awkward_rows import AWKWARD
from tradewind.llm import dual_tree

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, k=10):
    """The contract's integers over all pairs; docs and items are (id, text) rows."""
    counts = [(d, Counter(TERM.findall((t or "").translate(UPPER)))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        wanted = Counter(TERM.findall((text or "").translate(UPPER)))
        scores = []
        for d, c, n in counts:
            m = 25 + 75 * n * n_docs // n_terms
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t, times in wanted.items()
                if t in c
            )
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def run(docs, items, k=10):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in dual_tree.ranked(docs, items, k).collect()), key=str)


def frames(spark, docs, items, parts=3):
    made = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], "doc_id bigint, text string, score string, item string")
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id bigint, text string, rank int")
    return made.repartition(parts), asked


ITEMS = [
    (1, "quick brown FOX"),
    (2, None),
    (3, ""),
    (4, "word word WORD other"),
    (4, "word word WORD other"),
    (5, "no such term anywhere xyzzy"),
    (None, "éà ß 中文"),
    (6, "word1x1 word2x2 word996x996 tail"),
    (7, " !? \x00 "),
    (8, "the the the lazy-dog's"),
]


def test_awkward_rows(spark, awkward):
    _, asked = frames(spark, [], ITEMS)
    assert run(awkward, asked) == brute([(r[0], r[1]) for r in AWKWARD], ITEMS)


def test_empty(spark, nothing):
    docs, asked = frames(spark, [(1, "a b")], [])
    assert run(docs, asked) == [] and run(nothing, frames(spark, [], ITEMS)[1]) == []
    assert run(docs, frames(spark, [], [(1, None)])[1]) == []
    assert dual_tree.ranked(docs, asked).columns == ["item_id", "rank", "doc_id", "score"]


def test_terms_are_the_contract_s():
    text = "".join(map(chr, range(0x250))) + "  Ab9_é x\x85Ω中\U0001f600-Z"
    assert [t.decode() for t in dual_tree.terms(text.encode())] == TERM.findall(text.translate(UPPER))


def generated(seed, docs, words):
    rng = np.random.default_rng(seed)
    zipf = lambda n: " ".join(f"w{int(x)}" for x in np.minimum(rng.zipf(1.3, n), words))
    rows = [(int(rng.integers(0, docs)), zipf(int(rng.integers(0, 120)))) for _ in range(docs)]
    rows += [(5000 + i, rows[0][1]) for i in range(docs // 3)]  # many copies: ties
    items = [(i, zipf(int(rng.integers(1, 20)))) for i in range(45)]
    return rows, items


@pytest.mark.parametrize("small", [False, True])
def test_pruning_loses_nothing(spark, monkeypatch, small):
    if small:  # deep trees, several blocks and seeds, several passes over items
        for name, value in (("DOC_BLOCK", 40), ("DOC_LEAF", 3), ("DOC_FAN", 2), ("ITEM_LEAF", 2), ("ITEM_FAN", 2), ("ITEM_BLOCK", 20), ("LEAVES_AT_ONCE", 2)):
            monkeypatch.setattr(dual_tree, name, value)
    rows, items = generated(5, 400, 300)
    docs, asked = frames(spark, rows, items, 4)
    assert run(docs, asked) == brute(rows, items)
    assert run(docs, asked, 1) == brute(rows, items, 1)


def test_bounds_hold_and_prune():
    rows, items = generated(6, 600, 2000)
    counts = [Counter(dual_tree.terms(t.encode())) for _, t in items]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
    block = dual_tree._Block()
    for d, t in rows:
        words = dual_tree.terms(t.encode())
        block.add(d, len(words), Counter(w for w in words if w in vocabulary), vocabulary)
    row = block.row().to_pylist()[0]
    df = np.bincount(np.frombuffer(row["term"], "<u4"), minlength=len(vocabulary))
    statistics = dual_tree.Statistics.of(row["n_docs"], row["n_terms"], df)
    queries = [Counter({vocabulary[t]: c for t, c in q.items()}) for q in counts]
    tree = dual_tree.Items(list(range(len(items))), queries, statistics)
    search = dual_tree.Search(tree, statistics, 3, np.ones(len(tree.numbers), dtype=np.int64))
    search.block(row)
    docs = search.docs
    everything = np.arange(len(docs.rows.first) - 1)
    for i in range(0, len(tree.numbers), 7):
        at = slice(tree.tree.rows.first[i], tree.tree.rows.first[i + 1])
        dense = np.zeros(len(vocabulary), dtype=np.int64)
        dense[tree.tree.rows.term[at]] = tree.tree.rows.value[at]
        scores = docs.rows.products(everything, dense)
        for level, nodes in enumerate(docs.levels):
            wide = dual_tree.DOC_LEAF * dual_tree.DOC_FAN**level
            bound = nodes.products(np.arange(len(nodes.first) - 1), dense)
            assert (bound[everything // wide] >= scores).all()
    assert search.scored < 0.6 * len(everything) * len(tree.numbers)  # whole nodes were dropped
