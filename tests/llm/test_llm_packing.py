from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from awkward_rows import AWKWARD
from tradewind.llm import packing


def check_layout(rows, capacity=1024):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_awkward_rows_match_the_tokenizer_file(awkward):
    rows = packing.pack(packing.token_pieces(awkward)).collect()
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in AWKWARD:
        ids = np.array([*exact.encode(r[1] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(r[0], piece, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    check_layout(rows)


def test_special_strings_and_long_runs():
    encode = packing._encoder("byte_bpe_50k")
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("a <|endoftext|> b", "x" * 5000, " " * 5000 + "y", "it's  \n\n 12 ünï", "", "…!?"):
        assert list(encode(text)) == exact.encode(text, add_special_tokens=False).ids


def test_empty(nothing):
    packed = packing.pack(packing.token_pieces(nothing))
    assert packed.count() == 0 and packed.columns[-2:] == ["sequence_id", "offset"]


def sequences(counts, limits):
    """Loads of the sequences that a plan fills; every rank of every length exactly once."""
    loads, ranks = defaultdict(list), defaultdict(list)
    for length, rank, number, first, offset in packing.plan_slots(counts, limits):
        for i in range(number):
            loads[first + i].append((offset, length))
            ranks[length].append(rank + i)
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    return loads


@pytest.mark.parametrize("score", ["norm", "dot"])
@pytest.mark.parametrize("documents, attention", [(1024, 1 << 20), (3, 1 << 20), (1024, 400_000)])
def test_every_limit_holds(score, documents, attention):
    rng = np.random.default_rng(5)
    counts = dict(Counter(int(x) for x in np.minimum(rng.geometric(0.004, 3000), 600)))
    limits = packing.Limits(documents=documents, attention=attention, score=score)
    loads = sequences(counts, limits)
    for places in loads.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024 and len(places) <= documents
        assert sum(length**2 for _, length in places) <= attention
    if documents == 1024 and attention == 1 << 20:
        total = sum(k * n for k, n in counts.items())
        assert len(loads) <= 1.02 * -(-total // 1024) + 1


def test_few_sequences_on_documents(spark, sample):
    rows = packing.op3_packing(spark, sample).collect()
    used = check_layout(rows)
    assert used <= 1.01 * -(-sum(r.length for r in rows) // 1024) + 1


def test_a_piece_beyond_a_limit_is_an_error():
    with pytest.raises(ValueError):
        packing.plan_slots({10: 1}, packing.Limits(attention=50))


def test_sequences_are_built_from_the_result_alone(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet").limit(50)
    rows = packing.pack(packing.token_pieces(docs)).collect()
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_sequence = defaultdict(dict), defaultdict(dict)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        by_doc[r.doc_id][r.start] = ids
        by_sequence[r.sequence_id][r.offset] = ids
    for d in docs.collect():
        ids = [i for _, piece in sorted(by_doc[d.doc_id].items()) for i in piece]
        assert ids == [*exact.encode(d.text, add_special_tokens=False).ids, 2]
    for pieces in by_sequence.values():
        sequence = [i for _, piece in sorted(pieces.items()) for i in piece]
        assert len(sequence) <= 1024 and all(sequence[a : a + len(p)] == p for a, p in pieces.items())
