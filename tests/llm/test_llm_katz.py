from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import pytest

from awkward_rows import AWKWARD
from tradewind.llm import katz


class Brute:
    """The same model over Python dictionaries."""

    def __init__(self, rows):
        self.uni, self.bi, self.after, self.texts = Counter(), Counter(), defaultdict(dict), 0
        for doc_id, text in rows:
            if self.held(doc_id):
                continue
            self.texts += 1
            before = "BEGIN"
            for w in self.tokens(text):
                self.uni[w] += 1
                self.bi[before, w] += 1
                before = w
        for (h, w), c in self.bi.items():
            self.after[h][w] = c
        self.n, self.types = sum(self.uni.values()), len(self.uni)
        uni, bi = Counter(self.uni.values()), Counter(self.bi.values())
        self.du = katz.discounts([uni[r] for r in range(1, katz.K + 2)])
        self.db = katz.discounts([bi[r] for r in range(1, katz.K + 2)])
        taken = sum((1 - self.du[r]) * r * uni[r] for r in range(1, katz.K + 1))
        self.unseen = taken / self.n if taken else 1 / (self.n + 1)
        self.keep = 1.0 if taken else self.n / (self.n + 1)

    @staticmethod
    def held(doc_id):
        return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2

    @staticmethod
    def tokens(text):
        return [*(text or "").encode().lower().split(), "END"]

    @staticmethod
    def less(count, ratio):
        return count * (ratio[count] if count <= katz.K else 1)

    def word(self, w):
        return self.keep * self.less(self.uni[w], self.du) / self.n if self.uni[w] else self.unseen

    def count(self, h):
        return self.texts if h == "BEGIN" else self.uni[h]

    def backoff(self, h):
        taken = sum(c - self.less(c, self.db) for c in self.after[h].values())
        total = self.count(h)
        left, keep = (taken / total, 1.0) if taken else (1 / (total + 1), total / (total + 1))
        return keep, left / (1 - sum(self.word(w) for w in self.after[h]))

    def probability(self, h, w):
        if not self.count(h):
            return self.word(w)
        keep, weight = self.backoff(h)
        seen = self.after[h].get(w, 0)
        return keep * self.less(seen, self.db) / self.count(h) if seen else weight * self.word(w)

    def row(self, doc_id, text):
        tokens = self.tokens(text)
        base = sum(math.log10((self.uni[w] + 1) / (self.n + self.types + 1)) for w in tokens)
        score = sum(math.log10(self.probability(h, w)) for h, w in zip(["BEGIN", *tokens], tokens))
        known = sum(self.uni[w] > 0 for w in tokens)
        return doc_id, self.held(doc_id), len(tokens), known, self.n, round(base, 6), round(score, 6)


def compare(rows, got):
    brute = Brute(rows)
    want = sorted((brute.row(*r) for r in rows), key=str)
    have = sorted(
        (
            (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
            for r in got
        ),
        key=str,
    )
    assert len(want) == len(have)
    for a, b in zip(want, have):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-6, abs=2e-5)
    return brute


def test_awkward_rows(awkward):
    rows = [(r[0], r[1]) for r in AWKWARD if r[0] not in (6, 7)]
    got = katz.score_texts(awkward.where("doc_id IS NULL OR doc_id NOT IN (6, 7)")).collect()
    compare(rows, got)


def test_documents_with_salted_histories(spark, sample, monkeypatch):
    monkeypatch.setattr(katz, "PART_TOKENS", 3000)
    monkeypatch.setattr(katz, "BATCH_TOKENS", 5000)
    docs = spark.read.parquet(f"{sample}/documents.parquet").limit(60).select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    brute = compare(rows, katz.score_texts(docs).collect())
    words = [*brute.uni, "never seen"]
    for h in ["BEGIN", *[w for w, _ in brute.uni.most_common(3)], *list(brute.uni)[-3:]]:
        if h != "END":
            assert sum(brute.probability(h, w) for w in words) == pytest.approx(1, abs=1e-9)


def test_long_text(awkward):
    rows = {r.doc_id: r for r in katz.score_texts(awkward.where("doc_id IN (6, 7)")).collect()}
    assert rows[6].held_out and not rows[7].held_out
    assert rows[6].n_tokens == rows[6].n_known == 40001 and rows[7].train_tokens == 40002
    assert rows[6].score > 0.5 * rows[6].base_score


def test_nothing_to_learn_from(spark, nothing):
    assert katz.score_texts(nothing).count() == 0
    held = next(i for i in range(100) if Brute.held(i))
    row = katz.score_texts(spark.createDataFrame([(held, "a b")], "doc_id bigint, text string")).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0)
    assert row.base_score == 0 and row.score == 0


@pytest.mark.parametrize("counts", [[100, 40, 20, 12, 8, 5], [3, 0, 1, 0, 0, 0], [0] * 6, [5, 50, 5, 50, 5, 50]])
def test_discounts_are_discounts(counts):
    ratio = katz.discounts(counts)[1:]
    assert (ratio > 0).all() and (ratio < 1).all()


def test_words_that_end_in_nul_bytes_are_words_of_their_own(spark):
    texts = ["abc abc\0 abc\0\0 \0 x", "abc\0 \0\0 \0", "abc \0a a", "\0"]
    learnt = [i for i in range(100) if not Brute.held(i)][: len(texts)]
    rows = [*zip(learnt, texts), (next(i for i in range(100) if Brute.held(i)), texts[0])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    brute = compare(rows, katz.score_texts(docs).collect())
    assert brute.types == 9
