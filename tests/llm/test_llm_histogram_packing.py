from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from awkward_rows import AWKWARD
from tradewind.llm import histogram_packing as packing


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def check_layout(rows, capacity=2048):
    """Sequences are gapless and need no padding; returns their number."""
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end and length > 0
            end += length
        assert end <= capacity and (end == capacity or end & (end - 1) == 0)
    return len(by_sequence)


def check_pieces(rows, texts, exact, end_id=1):
    """Every id of every document lies in exactly one piece."""
    want = Counter()
    for doc_id, text in texts:
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, end_id], dtype="<u4")
        want[doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    got = Counter()
    for doc_id, pieces in by_doc.items():
        # Repeated ids: pieces of one length of document in order of their start, dealt to its copies.
        pieces.sort(key=lambda r: (r.doc_tokens, r.start))
        open_docs = []
        for r in pieces:
            if r.start == 0:
                open_docs.append([r])
            else:
                next(d for d in open_docs if d[-1].doc_tokens == r.doc_tokens and d[-1].start + d[-1].length == r.start).append(r)
        for d in open_docs:
            body = b"".join(bytes(r.ids) for r in d)
            assert len(body) == 4 * d[0].doc_tokens
            got[doc_id, d[0].doc_tokens, zlib.crc32(body)] += 1
    assert got == want


def test_awkward_rows(awkward, exact):
    rows = packing.pack(packing.token_rests(awkward)).collect()
    check_layout(rows)
    check_pieces([r for r in rows if r.doc_id not in (None, 2)], [(r[0], r[1]) for r in AWKWARD if r[0] not in (None, 2)], exact)
    assert sum(r.length for r in rows if r.doc_id == 2) == 2 * len(
        exact.encode(AWKWARD[1][1], add_special_tokens=False).ids
    ) + 2


def test_empty(nothing):
    assert packing.pack(packing.token_rests(nothing)).count() == 0


def test_documents(spark, sample, exact):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    rows = packing.pack(packing.token_rests(docs)).collect()
    tokens = sum(r.length for r in rows)
    assert check_layout(rows) <= tokens // 2048 + 12
    check_pieces(rows, [(r.doc_id, r.text) for r in docs.collect()], exact)
    shown = {(r.doc_id, r.start): r.ids_crc32 for r in packing.op13_spfhp(spark, sample).collect()}
    assert sum(len(r.ids) // 4 for r in rows) == tokens and len(shown) > 0


def test_query_shows_checksums(spark, sample, exact):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sample}/documents.parquet").collect()}
    rows = packing.op13_spfhp(spark, sample).collect()
    check_layout(rows)
    for r in rows[:80]:
        ids = np.array([*exact.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


def test_ids_equal_the_tokenizer_file(exact):
    encode = packing.encoder("word_bpe_49k", "<u2")
    rng = random.Random(5)
    odd = ["'s", "'ll", "''re", "İ", "Σ", "σ ", "  ", "\x1c", "\x85", "\xa0", "é", "é", "²", "½", "1", "A", "ſ", "中文", " ", "<|endoftext|>", "\0"]
    texts = ["", *map(chr, range(0x180))]
    for _ in range(400):
        texts.append("".join(rng.choice([chr(rng.randrange(0x180)), chr(rng.randrange(0x80)), rng.choice(odd)]) for _ in range(14)))
    for text, ids in zip(texts, encode(texts)):
        assert np.frombuffer(ids, "<u2").tolist() == exact.encode(text, add_special_tokens=False).ids


def places(plan):
    """(sequence, offset, length) of every piece of every document of a plan."""
    for length, _, number, first, offset, line in plan.slots.tolist():
        for k in range(number):
            if line < 0:
                yield first + k, offset, length
            else:
                pieces = list(plan.pieces_of(line + k * length, length))
                assert [p[0] for p in pieces] == np.cumsum([0] + [p[1] for p in pieces])[:-1].tolist()
                yield from ((s, o, n) for _, n, s, o in pieces)


@pytest.mark.parametrize("capacity", [8, 16, 64, 100])
@pytest.mark.parametrize("seed", range(6))
def test_plans_fill_every_sequence(capacity, seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 300))]
    if seed == 0:
        lengths = [capacity // 2 + 1] * 50  # nothing fits beside them
    counts = Counter(lengths)
    plan = packing.plan(counts, capacity)
    ranks = defaultdict(list)
    for length, rank, number, *_ in plan.slots.tolist():
        ranks[length].append((rank, rank + number))
    assert {k: sum(b - a for a, b in v) for k, v in ranks.items()} == counts
    assert all(a[1] == b[0] for v in ranks.values() for a, b in zip(sorted(v), sorted(v)[1:]))
    filled = defaultdict(list)
    for sequence, offset, length in places(plan):
        filled[sequence].append((offset, length))
    total = 0
    for some in filled.values():
        end = 0
        for offset, length in sorted(some):
            assert offset == end
            end += length
        assert end == capacity or end & (end - 1) == 0
        total += end
    assert total == sum(lengths)


def test_the_shortest_pack_takes_the_next_length():
    slots, packs = packing.shortest_pack_first({9: 1, 7: 1, 6: 1, 3: 1}, 16)
    # 9 opens a pack, 7 fills it, 6 opens one, and 3 goes to the shorter of the two.
    assert [(s[0], s[3], s[4]) for s in slots] == [(9, 0, 0), (7, 0, 9), (6, 1, 0), (3, 1, 6)]
    assert sorted(packs) == [(0, 1, 0), (1, 1, 7)]


def test_a_length_opens_as_many_packs_as_one_by_one():
    _, packs = packing.shortest_pack_first({5: 10}, 16)
    assert sum(n for _, n, _ in packs) == 4
