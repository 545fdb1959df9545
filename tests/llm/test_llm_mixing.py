from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from awkward_rows import AWKWARD
from tradewind.llm import mixing


def fill(budget, children):
    """Shares by weight, none above its capacity: {name: (weight, capacity)} -> {name: share}."""
    share, left = {}, dict(children)
    while left:
        level = budget / sum(w for w, _ in left.values())
        full = [n for n, (w, c) in left.items() if c <= w * level]
        if not full:
            return share | {n: int(w * level + 1e-6) for n, (w, _) in left.items()}
        for n in full:
            share[n] = left.pop(n)[1]
            budget -= share[n]
    return share


def brute_budgets(supply, mixture):
    total = int(sum(supply.values()) * mixture.budget_percent // 100)
    nodes = {(): total}
    for depth, level in enumerate(mixing.LEVELS):
        below = {}
        for parent, budget in nodes.items():
            caps = defaultdict(int)
            for leaf, n in supply.items():
                if leaf[:depth] == parent:
                    caps[leaf[depth]] += n * mixture.max_epochs
            weights = mixture.weights.get(level, {})
            kids = {n: (weights.get(n, mixture.other), c) for n, c in caps.items()}
            below |= {(*parent, n): b for n, b in fill(budget, kids).items()}
        nodes = below
    return nodes


@pytest.mark.parametrize("percent, epochs", [(40, 1), (90, 1), (100, 2), (250, 3)])
def test_budgets_redistribute_shortages(spark, percent, epochs):
    supply = {
        ("a", "en", "s1"): 1000, ("a", "en", "s2"): 10, ("a", "de", "s1"): 50,
        ("b", "en", "s1"): 5, ("b", "fr", "s9"): 7, ("c", "en", "s3"): 3000, ("c", "en", "s4"): 0,
    }
    mixture = mixing.Mixture({"domain": {"a": 1, "b": 5}, "lang": {"en": 2}}, budget_percent=percent, max_epochs=epochs)
    frame = spark.createDataFrame([(*k, n) for k, n in supply.items()], "domain string, lang string, source string, supply bigint")
    got = {(r.domain, r.lang, r.source): r.budget for r in mixing.leaf_budgets(frame, mixture).collect()}
    want = brute_budgets(supply, mixture)
    assert got == want
    total = min(sum(supply.values()) * percent // 100, sum(supply.values()) * epochs)
    assert total - 10 <= sum(got.values()) <= total


def brute_mix(rows, mixture):
    """(doc_id, text, epoch) of (doc_id, text, lang, source) rows."""
    leaves = defaultdict(list)
    for doc_id, text, lang, source in rows:
        number = re.search(r"([0-9]+)$", source or "")
        domain = f"domain{int(number[1]) % mixing.DOMAINS if number else 0}" if source is not None else ""
        tokens = len((text or "").encode().split())
        md5 = hashlib.md5(text.encode()).hexdigest() if text is not None else ""
        key = str(doc_id) if doc_id is not None else md5
        leaves[domain, lang or "", source or ""].append((key, tokens, doc_id, text))
    budgets = brute_budgets({k: sum(d[1] for d in v) for k, v in leaves.items()}, mixture)
    out = []
    for leaf, docs in leaves.items():
        supply = sum(d[1] for d in docs)
        whole, rest = divmod(budgets[leaf], supply) if supply else (0, 0)
        out += [(d[2], d[3], e) for d in docs for e in range(whole)]
        before = 0
        for key, tokens, doc_id, text in sorted(
            docs, key=lambda d: (hashlib.md5(f"{mixture.seed}-{whole}-{d[0]}".encode()).hexdigest(), d[1])
        ):
            if before < rest:
                out.append((doc_id, text, whole))
            before += tokens
    return sorted(out, key=str)


@pytest.mark.parametrize("percent, epochs", [(30, 1), (90, 1), (180, 3)])
def test_awkward_rows(awkward, percent, epochs):
    mixture = mixing.Mixture(budget_percent=percent, max_epochs=epochs)
    got = mixing.mix(
        awkward, mixture, domain=mixing.source_domain(), tokens=mixing.word_count(), epoch="__epoch"
    )
    assert got.columns == [*awkward.columns, "__epoch"]
    rows = [(r[0], r[1], r[2], r[3]) for r in AWKWARD]
    have = sorted(((r.doc_id, r.text, r["__epoch"]) for r in got.collect()), key=str)
    assert have == brute_mix(rows, mixture)


def test_empty(nothing):
    got = mixing.mix(nothing, mixing.PRODUCTION, domain=F.lit("x"), tokens=mixing.word_count())
    assert got.count() == 0
