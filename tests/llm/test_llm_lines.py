from __future__ import annotations

import re

from awkward_rows import AWKWARD, TEXT
from tradewind.llm import lines

A = "one two three four five six seven eight nine."
B = "This is a rather different line with enough words"


def brute(rows):
    """Repeated units of (doc_id, text) rows as (doc_id, start, end, kept id, kept start)."""
    found = []
    for doc_id, text in rows:
        if doc_id is None:
            continue
        at = 0
        for line in (text or "").split("\n"):
            parts = [(at, line, 5)]
            pieces, inner = re.findall(r"[^.!?]+[.!?]*|[.!?]+", line), at
            if len(pieces) > 1:
                for p in pieces:
                    parts.append((inner, p, 8))
                    inner += len(p)
            for start, unit, least in parts:
                words = unit.encode().lower().split()
                if len(words) >= least:
                    found.append((b" ".join(words), doc_id, start, start + len(unit)))
            at += len(line) + 1
    first = {}
    for key, doc_id, start, _ in found:
        first[key] = min(first.get(key, (doc_id, start)), (doc_id, start))
    return sorted((d, s, e, *first[k]) for k, d, s, e in found if (d, s) != first[k])


def got(docs):
    rows = lines.repeated_units(docs).collect()
    return sorted((r.doc_id, r.start, r.end, r.kept_doc_id, r.kept_start) for r in rows)


def test_awkward_rows(awkward):
    assert got(awkward) == brute([(r[0], r[1]) for r in AWKWARD])
    assert (2, 0, len(TEXT), 1, 0) in got(awkward)


def test_lines_sentences_and_white_space(spark):
    rows = [
        (3, f"{A}\n{B}\n{A}"),
        (1, f"é {B}\n  ONE  two\tthree four five six seven eight nine."),
        (2, f"Host sentence goes first. {A} And it goes on."),
        (4, "short line\nshort line"),
        (5, None),
        (None, A),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(docs) == brute(rows) and len(got(docs)) == 3
    clean = {r.doc_id: r for r in lines.without_repeats(docs).collect()}
    assert clean[3].text == f"\n{B}\n" and clean[4].text == "short line\nshort line"
    assert clean[2].text == "Host sentence goes first. And it goes on."
    for doc_id, text in rows:
        if text:
            cut = "".join(text[s.start : s.end] for s in clean[doc_id].removed)
            assert len(cut) + len(clean[doc_id].text) == len(text)


def test_columns_and_rows_stay(awkward):
    clean = lines.without_repeats(awkward)
    assert set(clean.columns) == set(awkward.columns) and clean.count() == len(AWKWARD)


def test_empty(nothing):
    assert lines.repeated_units(nothing).count() == 0 and lines.without_repeats(nothing).count() == 0
