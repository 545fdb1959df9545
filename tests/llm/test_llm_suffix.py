from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from awkward_rows import AWKWARD
from tradewind.llm import suffix


def brute(rows, length=50):
    """(doc_id, n_bytes, kept) of (doc_id, text) rows."""
    texts = [(d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, b in texts:
        if d is not None:
            for i in range(len(b) - length + 1):
                s = b[i : i + length]
                first[s] = min(first.get(s, d), d)
    out = []
    for d, b in texts:
        gone = np.zeros(len(b) + 1, dtype=int)
        for i in range(len(b) - length + 1) if d is not None else ():
            if first[b[i : i + length]] < d:
                gone[i] += 1
                gone[i + length] -= 1
        keep = np.cumsum(gone[:-1]) == 0
        out.append((d, len(b), bytes(np.frombuffer(b, np.uint8)[keep])))
    return sorted(out, key=str)


def run(docs, length=50):
    found = suffix.without_repeats(docs, length).collect()
    for r in found:
        assert r.n_bytes - len(r.kept) == sum(s.end - s.start for s in r.spans)
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))
    return sorted(((r.doc_id, r.n_bytes, bytes(r.kept)) for r in found), key=str)


def test_awkward_rows(awkward):
    assert run(awkward) == brute([(r[0], r[1]) for r in AWKWARD])


def test_empty(nothing):
    assert run(nothing) == []


@pytest.mark.parametrize("small", [False, True])
def test_shared_passages(spark, monkeypatch, small):
    if small:  # several batches and partitions, nearly every anchor salted
        for name, value in (("BATCH_BYTES", 3000), ("ANCHOR_PART_BYTES", 2000), ("WINDOW_PART_BYTES", 2000), ("SALT_FROM", 2)):
            monkeypatch.setattr(suffix, name, value)
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(40)) for _ in range(4)] + ["ab" * 120, " " * 150, "x" * 300]
    rows = []
    for i in range(60):
        text = " ".join(word() for _ in range(rng.randint(0, 30)))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 60)
            text += p[a : a + rng.randint(40, 200)] + word()
        rows.append((rng.randint(0, 50), text))
    rows += rows[:5]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert run(docs) == brute(rows)


def test_documents(spark, sample):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sample}/documents.parquet").collect()]
    want = {d: (n, n - len(k), hashlib.sha256(k).hexdigest()) for d, n, k in brute(rows)}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.kept_sha256) for r in suffix.op10_suffix(spark, sample).collect()}
    assert got == want


def test_two_stage_order():
    rng = random.Random(12)
    for trial in range(200):
        letters = [b"ab", b"abcdefgh", bytes(range(256)), b"a"][trial % 4]
        text = bytes(rng.choice(letters) for _ in range(rng.randint(1, 300)))
        text = text[:17] * 9 if trial % 5 == 0 else text
        raw = np.frombuffer(text, np.uint8)
        keys = suffix.eight_bytes(raw)
        order = suffix.suffix_order(raw, keys, 48).tolist()
        assert sorted(order) == list(range(len(text)))
        cut = [text[i : i + 48] for i in order]
        assert cut == sorted(cut)
        whole = [i for i in order if i + 20 <= len(text)]
        same = suffix.common_prefix_reaches(keys, np.array(whole, dtype=np.int64), 20)
        assert same.tolist() == [
            k > 0 and text[whole[k - 1] :][:20] == text[i:][:20] for k, i in enumerate(whole)
        ]


def test_runs_cover_every_string_once():
    rng = random.Random(13)
    texts = [bytes(rng.choice(b"abc ") for _ in range(rng.randint(0, 400))) for _ in range(30)] + [b"z" * 500, b""]
    of, start, count, anchor = suffix.anchor_runs(texts)
    seen = {}
    for d, a, n, key in zip(of.tolist(), start.tolist(), count.tolist(), anchor.tolist()):
        assert n <= suffix.MOST_STARTS
        for s in range(a, a + n):
            assert seen.setdefault(texts[d][s : s + 50], key) == key
    assert int(count.sum()) == sum(max(len(t) - 49, 0) for t in texts)


def test_copies_in_a_batch_do_not_travel(spark):
    """What meets in a partition is the same for 3 and for 300 copies of a text."""
    text = "".join(random.Random(14).choice("abcdefgh ") for _ in range(400))

    def traffic(copies):
        docs = spark.createDataFrame([(i, text) for i in range(copies)], "doc_id bigint, text string")
        batched = suffix.corpus_batches(docs.coalesce(1))
        shared = suffix._shared_anchors(batched, 1, 50)
        # Rows without a partition are the places of a batch's own windows, which go back to it alone.
        rows = suffix._windows(batched, shared, 1, 1, 50).where("part IS NOT NULL").collect()
        return sum(len(v) for r in rows for v in r if isinstance(v, (bytes, bytearray)))

    assert traffic(300) == traffic(3) > 0
    rows = [(i, text) for i in range(300)]
    assert run(spark.createDataFrame(rows, "doc_id bigint, text string")) == brute(rows)
