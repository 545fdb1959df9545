"""Suffix-array dedup: bytes covered by a long string that an earlier document holds too.

Every string of ``LENGTH`` bytes has an anchor, the smallest hash among its ``GRAM``-byte grams, so
equal strings have equal anchors. Documents are written in batches and go through three rounds:

1. A batch asks the partitions of the anchor space which of its anchors occur in several documents.
2. Texts around shared anchors (windows, each distinct one once per batch, with the batch's smallest
   doc_id that holds it) meet in one partition per anchor. Anchors of very many documents are salted
   by whole strings. The partition sorts the suffixes of its windows in two stages: suffixes smaller
   than their successors directly, the others induced by scanning the buckets of first bytes.
   Neighbours whose common prefix reaches the length are equal strings; the smallest doc_id among
   them is the answer to every batch that asked.
3. Each batch applies the answers to all places of its windows, which round 2 wrote down, and cuts.

A text is read in whole in every round, and only shared stretches travel. Copies of a window within a
batch never leave it: a string costs a partition one row's share per batch, not per document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import documents, squeezed, text_or_empty, unsqueezed, written
from tradewind.llm.features import chunks, mixed

LENGTH, GRAM = 50, 16
BATCH_BYTES, BATCH_ROWS, ANCHOR_PART_BYTES, WINDOW_PART_BYTES = 1 << 23, 1 << 18, 1 << 25, 1 << 22
MOST_STARTS = 64  # strings in a window
SALT_FROM = 4096  # documents that share an anchor, beyond which it is salted


# --- two-stage suffix sorting --------------------------------------------------------------------


def eight_bytes(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position, and the one past the last, as one number; zeros follow the end."""
    padded = np.concatenate([text, np.zeros(9, np.uint8)]).astype(np.uint64)
    key = padded[: len(text) + 1].copy()
    for k in range(1, 8):
        key <<= np.uint64(8)
        key |= padded[k : len(text) + 1 + k]
    return key


def suffix_order(
    text: np.ndarray, keys: np.ndarray, depth: int = LENGTH, wanted: np.ndarray | None = None
) -> np.ndarray:
    """Starts of the suffixes of ``text`` in order of at least their first ``depth`` bytes.

    With ``wanted`` (a mask), only of those and of the ones they are induced from.
    """
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    smaller = _smaller_than_successor(text)
    needed = np.ones(n, dtype=bool) if wanted is None else _with_sources(wanted, smaller)
    direct = _sorted_directly(keys, np.flatnonzero(smaller & needed), depth)
    first_of = np.searchsorted(text[direct], np.arange(257))
    queues: list[list[np.ndarray]] = [[] for _ in range(256)]
    if needed[n - 1]:
        queues[text[n - 1]].append(np.array([n - 1]))  # induced by the empty suffix
    order: list[np.ndarray] = []
    induced = needed & ~smaller

    def induce(entries: np.ndarray, byte: int) -> np.ndarray:
        """Hands the larger predecessors of sorted entries to their buckets; returns those of this one."""
        before = entries[entries > 0] - 1
        before = before[induced[before]]
        byte_of = text[before]
        here = byte_of == byte
        ahead, byte_of = before[~here], byte_of[~here]
        if len(ahead):
            by = np.argsort(byte_of, kind="stable")
            ahead, byte_of = ahead[by], byte_of[by]
            cuts = np.flatnonzero(np.r_[True, byte_of[1:] != byte_of[:-1]])
            for a, b in zip(cuts, np.r_[cuts[1:], len(ahead)]):
                queues[byte_of[a]].append(ahead[a:b])
        return before[here]

    for byte in range(256):
        wave = np.concatenate(queues[byte]) if queues[byte] else np.empty(0, np.int64)
        while len(wave):
            order.append(wave)
            wave = induce(wave, byte)
        own = direct[first_of[byte] : first_of[byte + 1]]
        if len(own):
            order.append(own)
            induce(own, byte)
    return np.concatenate(order) if order else np.empty(0, np.int64)


def _with_sources(wanted: np.ndarray, smaller: np.ndarray) -> np.ndarray:
    """``wanted`` and, behind its larger suffixes, all up to the next one that is sorted directly."""
    n = len(wanted)
    at = np.where(smaller, np.arange(n), n - 1)
    source = np.minimum.accumulate(at[::-1])[::-1]
    last = np.flatnonzero(wanted & ~np.r_[wanted[1:], False])
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, last, 1)
    np.add.at(step, source[last] + 1, -1)
    return wanted | (np.cumsum(step[:-1]) > 0)


def _smaller_than_successor(text: np.ndarray) -> np.ndarray:
    """Whether the suffix at each position is smaller than the next one."""
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int16), append=np.int16(-1)))
    at = np.where(step != 0, np.arange(n), n - 1)
    decides = np.minimum.accumulate(at[::-1])[::-1]  # the next position with another byte
    return step[decides] > 0


def _sorted_directly(keys: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by eight bytes at a time, further only where they are still equal.

    Most groups of equal suffixes of near copies agree in their next eight bytes too; those stay as they are.
    """
    key = keys[starts]
    order = np.argsort(key)
    starts, key = starts[order], key[order]
    same = np.r_[False, key[1:] == key[:-1]]
    for offset in range(8, depth, 8):
        at = np.flatnonzero(same | np.r_[same[1:], False])
        if not len(at):
            break
        inner = same[at]
        key = keys[np.minimum(starts[at] + offset, len(keys) - 1)]
        differs = np.r_[False, key[1:] != key[:-1]] & inner
        group = np.cumsum(~inner) - 1
        torn = np.zeros(int(group[-1]) + 1, dtype=bool)
        torn[group[differs]] = True
        sub = np.flatnonzero(torn[group])
        if not len(sub):
            continue
        by = sub[np.lexsort((key[sub], group[sub]))]
        place = at[sub]
        starts[place] = starts[at[by]]
        key = key[by]
        same[place] = np.r_[False, key[1:] == key[:-1]] & inner[sub]
    return starts


def common_prefix_reaches(keys: np.ndarray, order: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Whether each suffix in ``order`` (none shorter than ``depth``, at least 8) agrees that far with the one before."""
    same = np.ones(len(order), dtype=bool)
    same[:1] = False
    for offset in [*range(0, depth - 8, 8), depth - 8]:
        at = np.flatnonzero(same)
        same[at] = keys[order[at] + offset] == keys[order[at - 1] + offset]
    return same


# --- anchors -------------------------------------------------------------------------------------


def anchor_runs(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """(text, first start, number of starts, anchor) of runs of strings with one anchor, as arrays."""
    found = []
    for first, part in chunks(texts):
        raw = np.frombuffer(b"".join(part) + bytes(gram + 8), dtype=np.uint8)
        sizes = np.fromiter(map(len, part), dtype=np.int64, count=len(part))
        begin = np.cumsum(sizes) - sizes
        number = np.maximum(sizes - length + 1, 0)
        total = int(number.sum())
        if not total:
            continue
        smallest = _window_minima(_gram_hashes(raw, int(sizes.sum()), gram), length - gram + 1)
        of = np.repeat(np.arange(len(part)), number)
        start = np.arange(total) - np.repeat(np.cumsum(number) - number, number)
        anchor = smallest[np.repeat(begin, number) + start]
        new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1])])
        runs = np.diff(np.r_[new, total])
        pieces = -(-runs // MOST_STARTS)
        nth = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = np.repeat(new, pieces) + nth * MOST_STARTS
        count = np.minimum(np.repeat(runs, pieces) - nth * MOST_STARTS, MOST_STARTS)
        found.append((of[at] + first, start[at], count, anchor[at]))
    if not found:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(c) for c in zip(*found))


def _gram_hashes(raw: np.ndarray, n: int, gram: int) -> np.ndarray:
    """Hash of the ``gram`` (8 to 16) bytes from each of the first ``n`` positions."""
    eight = np.zeros(len(raw) - 7, dtype=np.uint64)
    for k in range(8):
        eight |= raw[k : len(raw) - 7 + k].astype(np.uint64) << np.uint64(8 * k)
    low, high = eight[:n], eight[gram - 8 : gram - 8 + n]
    return mixed(low * np.uint64(0x9E3779B97F4A7C15) ^ mixed(high * np.uint64(0xC2B2AE3D27D4EB4F)))


def _window_minima(values: np.ndarray, wide: int) -> np.ndarray:
    reach = 1
    while reach * 2 <= wide and len(values) > reach:
        values, reach = np.minimum(values[:-reach], values[reach:]), reach * 2
    rest = wide - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest and len(values) > rest else values


def _part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Equal ranges of the key space. Anchors are minima, so they are hashed again before."""
    return (((mixed(keys) >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


# --- rounds --------------------------------------------------------------------------------------


def corpus_batches(docs: DataFrame) -> DataFrame:
    """(batch, ids, sizes, text): the rows of ``docs`` in batches, written once without a shuffle.

    Rows without a doc_id stand last in their batch.
    """

    def run(batches):
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append(text.as_buffer().to_pybytes())
                size += len(texts[-1])
                if size >= BATCH_BYTES or len(ids) >= BATCH_ROWS:
                    yield _batch_row(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield _batch_row(ids, texts)

    picked = docs.select(F.col("doc_id").cast("bigint"), text_or_empty("text").alias("text"))
    rows = picked.mapInArrow(run, "ids array<bigint>, sizes binary, text binary")
    return written(rows.withColumn("batch", F.monotonically_increasing_id()), "batches")


def _batch_row(ids: list, texts: list[bytes]) -> pa.RecordBatch:
    order = sorted(range(len(ids)), key=lambda i: ids[i] is None)
    texts = [texts[i] for i in order]
    columns = [
        pa.array([[ids[i] for i in order]], pa.list_(pa.int64())),
        pa.array([np.array(list(map(len, texts)), dtype="<u4").tobytes()], pa.binary()),
        pa.array([squeezed(b"".join(texts))], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["ids", "sizes", "text"])


class _Docs:
    """The documents of a batch; those without a doc_id come last."""

    def __init__(self, row) -> None:
        self.ids = row.column("ids")[0].as_py()
        ends = np.cumsum(np.frombuffer(row.column("sizes")[0].as_py(), "<u4"), dtype=np.int64).tolist()
        body = unsqueezed(row.column("text")[0].as_py(), ends[-1] if ends else 0)
        self.texts = [body[a:b] for a, b in zip([0, *ends], ends)]
        self.ranked = sum(i is not None for i in self.ids)
        self.batch = row.column("batch")[0].as_py()

    def runs(self, length: int):
        return anchor_runs(self.texts[: self.ranked], length)


def _asked(anchor: np.ndarray, of: np.ndarray, parts: int):
    """(partition, start, end) slices, distinct anchors in order of partition, documents of each."""
    order = np.lexsort((of, anchor))
    anchor, of = anchor[order], of[order]
    new = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]]) if len(anchor) else np.empty(0, np.int64)
    docs = np.r_[True, (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1])][: len(anchor)]
    own, several = anchor[new], np.add.reduceat(docs.astype(np.int64), new) if len(new) else new
    part = _part_of(own, parts)
    by = np.argsort(part, kind="stable")
    own, several, part = own[by], several[by], part[by]
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else new
    return list(zip(part[cuts].tolist(), cuts.tolist(), np.r_[cuts[1:], len(part)].tolist())), own, several


def _rows(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.table({n: pa.array(c, kinds[t]) for (n, t), c in zip(fields, columns)})


_QUESTIONS = "part bigint, batch bigint, anchors binary, several binary"
_ANSWERS = "batch bigint, part bigint, shared binary"
_WINDOWS = "part bigint, batch bigint, starts binary, bytes binary, id binary"
_EARLIEST = "batch bigint, part bigint, differs binary, id binary"


def _shared_anchors(batched: DataFrame, parts: int, length: int) -> DataFrame:
    """Per batch and partition, for each anchor asked: 0 if one document has it, else 1 + log2 of its salts."""

    def ask(batches):
        for some in batches:
            for i in range(some.num_rows):
                own_docs = _Docs(some.slice(i, 1))
                of, _, _, anchor = own_docs.runs(length)
                slices, own, several = _asked(anchor, of, parts)
                rows = [
                    (p, own_docs.batch, own[a:b].tobytes(), several[a:b].astype("<u4").tobytes()) for p, a, b in slices
                ]
                yield from _rows(_QUESTIONS, rows).to_batches()

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        anchors = [np.frombuffer(r["anchors"], "<u8") for r in rows]
        own, place = np.unique(np.concatenate(anchors), return_inverse=True)
        several = np.concatenate([np.frombuffer(r["several"], "<u4") for r in rows])
        docs = np.bincount(place, weights=several, minlength=len(own))
        salts = np.ceil(np.log2(np.maximum(docs / SALT_FROM, 1)))
        code = np.where(docs > 1, 1 + salts, 0).astype(np.uint8)[place]
        cuts = np.cumsum([len(a) for a in anchors])[:-1]
        return _rows(
            _ANSWERS,
            [(r["batch"], r["part"], c.tobytes()) for r, c in zip(rows, np.split(code, cuts))],
        )

    asked = batched.mapInArrow(ask, _QUESTIONS)
    return asked.groupBy("part").applyInArrow(answer, _ANSWERS)


class _Found:
    """The distinct windows of a batch around shared anchors, in order of partition, and where they occur."""

    def __init__(self, docs, shared: list[dict], parts: int, window_parts: int, length: int) -> None:
        of, start, count, anchor = docs.runs(length)
        slices, own, _ = _asked(anchor, of, parts)
        answers = {r["part"]: np.frombuffer(r["shared"], np.uint8) for r in shared}
        code = np.concatenate([answers[p] for p, _, _ in slices]) if slices else np.empty(0, np.uint8)
        by = np.argsort(own)
        code_of = code[by][np.searchsorted(own[by], anchor)]
        pick = np.flatnonzero(code_of)
        number: dict[tuple[int, bytes], int] = {}
        where: list[tuple[int, int, int]] = []  # window, document, start
        for d, a, n, key, salts in zip(*(x[pick].tolist() for x in (of, start, count, anchor, code_of))):
            text = docs.texts[d]
            if salts == 1:
                where.append((number.setdefault((key, text[a : a + n + length - 1]), len(number)), d, a))
                continue
            for s in range(a, a + n):  # a salted anchor: every string by itself
                string = text[s : s + length]
                salt = xxhash.xxh64_intdigest(string) & ((1 << (salts - 1)) - 1)
                where.append((number.setdefault(((key + salt * _ODD) & _ALL, string), len(number)), d, s))
        keys = np.fromiter((k for k, _ in number), dtype=np.uint64, count=len(number))
        part = _part_of(keys, window_parts)
        order = np.argsort(part, kind="stable")
        windows = [w for _, w in number]
        self.windows = [windows[i] for i in order.tolist()]
        self.starts = np.fromiter(map(len, self.windows), dtype=np.int64, count=len(order)) - length + 1
        part = part[order]
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else order
        self.slices = list(zip(part[cuts].tolist(), cuts.tolist(), np.r_[cuts[1:], len(part)].tolist()))
        window, self.doc, self.start = np.array(where, dtype=np.int64).reshape(-1, 3).T
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.window = place[window]

    def first_ids(self, ids: list) -> np.ndarray:
        first = np.full(len(self.windows), np.iinfo(np.int64).max)
        np.minimum.at(first, self.window, np.array(ids, dtype=np.int64)[self.doc])
        return first

    def occurrences(self) -> tuple[bytes, bytes, bytes]:
        """What round 3 needs: strings per window; window, document and start of each place; slices."""
        places = b"".join(x.astype("<u4").tobytes() for x in (self.window, self.doc, self.start))
        slices = np.array([len(places), *(x for s in self.slices for x in s)], dtype="<i8")
        return self.starts.astype("u1").tobytes(), squeezed(places), slices.tobytes()


class _Places:
    """Windows and their places as round 2 found them."""

    def __init__(self, starts: bytes, places: bytes, slices: bytes, ids: list) -> None:
        self.starts = np.frombuffer(starts, "u1").astype(np.int64)
        length, *slices = np.frombuffer(slices, "<i8").tolist()
        self.window, self.doc, self.start = np.frombuffer(unsqueezed(places, length), "<u4").astype(np.int64).reshape(3, -1)
        self.slices = list(zip(slices[::3], slices[1::3], slices[2::3]))
        self.id = np.array(ids, dtype=np.int64)[self.doc]


def _windows(batched: DataFrame, shared: DataFrame, parts: int, window_parts: int, length: int) -> DataFrame:
    """The distinct windows of a batch around shared anchors with their smallest doc_id, by partition.

    One more row per batch, without a partition, holds the places of its windows.
    """

    def collect(_, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _rows(_WINDOWS, [])
        docs = _Docs(left)
        found = _Found(docs, right.to_pylist(), parts, window_parts, length)
        starts = found.starts.astype("u1")
        first = found.first_ids(docs.ids[: docs.ranked]).astype("<i8")
        return _rows(
            _WINDOWS,
            [
                (p, docs.batch, starts[a:b].tobytes(), squeezed(b"".join(found.windows[a:b])), squeezed(first[a:b].tobytes()))
                for p, a, b in found.slices
            ]
            + [(None, docs.batch, *found.occurrences())],
        )

    return batched.groupBy("batch").cogroup(shared.groupBy("batch")).applyInArrow(collect, _WINDOWS)


_ODD, _ALL = 0x9E3779B97F4A7C15, (1 << 64) - 1


def _answers(windows: DataFrame, length: int) -> DataFrame:
    """Per batch and partition, for each window asked: the earliest doc_id, of each string where they differ."""

    def sort(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        number: dict[bytes, int] = {}
        window_of = []
        for r in rows:
            ends = np.cumsum(np.frombuffer(r["starts"], "u1").astype(np.int64) + length - 1).tolist()
            text = unsqueezed(r["bytes"], ends[-1])
            window_of.append(
                np.array([number.setdefault(text[a:b], len(number)) for a, b in zip([0, *ends], ends)])
            )
        sizes = np.fromiter(map(len, number), dtype=np.int64, count=len(number))
        text = np.frombuffer(b"".join(number), dtype=np.uint8)
        first_id = np.full(len(number), np.iinfo(np.int64).max)
        for r, w in zip(rows, window_of):
            np.minimum.at(first_id, w, np.frombuffer(unsqueezed(r["id"], 8 * len(w)), "<i8"))
        starts = sizes - length + 1
        begin = np.cumsum(sizes) - sizes
        earliest = _earliest(text, begin, starts, first_id, length)
        edge = np.cumsum(starts) - starts
        differs = np.minimum.reduceat(earliest, edge) != np.maximum.reduceat(earliest, edge)
        number_of = np.where(differs, starts, 1)
        out = []
        for r, w in zip(rows, window_of):
            n = number_of[w]
            at = np.repeat(edge[w] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            out.append((r["batch"], r["part"], differs[w].astype(np.uint8).tobytes(), earliest[at].astype("<i8").tobytes()))
        return _rows(_EARLIEST, out)

    return windows.groupBy("part").applyInArrow(sort, _EARLIEST)


def _spans(found: _Places, answers: list[dict], length: int):
    """(document, start, end) of the stretches of a batch that an earlier document holds too."""
    by_part = {r["part"]: r for r in answers}
    rows = [by_part[p] for p, _, _ in found.slices]
    if not rows:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    differs = np.concatenate([np.frombuffer(r["differs"], np.uint8) for r in rows]).astype(bool)
    earliest = np.concatenate([np.frombuffer(r["id"], "<i8") for r in rows])
    number = np.where(differs, found.starts, 1)
    edge = np.cumsum(number) - number
    low, high = np.minimum.reduceat(earliest, edge), np.maximum.reduceat(earliest, edge)
    id_, w, doc, start = found.id, found.window, found.doc, found.start
    whole = np.flatnonzero(id_ > high[w])
    spans = [(doc[whole], start[whole], start[whole] + found.starts[w[whole]] - 1 + length)]
    for i in np.flatnonzero((id_ > low[w]) & (id_ <= high[w])).tolist():  # differs within the window
        x = edge[w[i]]
        hit = np.flatnonzero(earliest[x : x + number[w[i]]] < id_[i])
        spans.append((np.full(len(hit), doc[i]), start[i] + hit, start[i] + hit + length))
    return merge_spans(*(np.concatenate(c) for c in zip(*spans)))


def _earliest(text, begin, starts, first_id, length: int) -> np.ndarray:
    """Of every string of every window, the smallest doc_id that holds it."""
    offset = np.arange(int(starts.sum())) - np.repeat(np.cumsum(starts) - starts, starts)
    place = np.repeat(begin, starts) + offset
    string_at = np.full(len(text), -1)
    string_at[place] = np.arange(len(place))
    keys = eight_bytes(text)
    order = suffix_order(text, keys, length, string_at >= 0)
    order = order[string_at[order] >= 0]  # suffixes that reach into the next window start no string
    new = np.flatnonzero(~common_prefix_reaches(keys, order, length))
    number = string_at[order]
    id_ = np.repeat(first_id, starts)
    least = np.minimum.reduceat(id_[number], new)
    earliest = np.empty(len(place), np.int64)
    earliest[number] = np.repeat(least, np.diff(np.r_[new, len(order)]))
    return earliest


def merge_spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Maximal runs of the spans of each document, by document and start."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    wide = int(end.max(initial=0)) + 1
    reach = np.maximum.accumulate(doc * wide + end)
    new = np.flatnonzero(np.r_[True, doc[1:] * wide + start[1:] > reach[:-1]][: len(doc)])
    last = np.r_[new[1:], len(doc)][: len(new)] - 1
    return doc[new], start[new], reach[last] - doc[last] * wide


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, kept (remaining bytes), spans (start, end removed).

    A byte goes if a string of ``length`` (at least 16) bytes that covers it also starts in a document
    with a smaller doc_id; strings are those of the input, and never cross documents. Null text is empty. Rows
    without a doc_id have no rank: they lose nothing and count for nobody. Rows with equal doc_id do
    not count for each other.
    """
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    parts, window_parts = (max(1, -(-size // each)) for each in (ANCHOR_PART_BYTES, WINDOW_PART_BYTES))
    batched = corpus_batches(docs)
    shared = written(_shared_anchors(batched, parts, length), "anchors")
    windows = written(_windows(batched, shared, parts, window_parts, length), "windows")
    answers = _answers(windows.where("part IS NOT NULL"), length)
    # What a batch is told: one row with its own places, and the answers of the partitions.
    none = F.lit(None).cast("binary")
    told = windows.where("part IS NULL").withColumn("differs", none).unionByName(
        answers.select("part", "batch", none.alias("starts"), none.alias("bytes"), "id", "differs")
    )

    def cut(_, left: pa.Table, right: pa.Table) -> pa.Table:
        own = _Docs(left)
        rows = right.to_pylist()
        place = next(r for r in rows if r["part"] is None)
        found = _Places(place["starts"], place["bytes"], place["id"], own.ids[: own.ranked])
        spans: dict[int, list[tuple[int, int]]] = {}
        heard = [r for r in rows if r["part"] is not None]
        for d, a, b in zip(*(x.tolist() for x in _spans(found, heard, length))):
            spans.setdefault(d, []).append((a, b))
        kept, lists = [], []
        for d, body in enumerate(own.texts):
            edges = [0, *(x for span in spans.get(d, ()) for x in span), len(body)]
            kept.append(b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2])))
            lists.append([{"start": a, "end": b} for a, b in spans.get(d, ())])
        pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table(
            {
                "doc_id": pa.array(own.ids, pa.int64()),
                "n_bytes": pa.array(map(len, own.texts), pa.int64()),
                "kept": pa.array(kept, pa.binary()),
                "spans": pa.array(lists, pair),
            }
        )

    schema = "doc_id bigint, n_bytes bigint, kept binary, spans array<struct<start:bigint,end:bigint>>"
    return batched.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(cut, schema)


def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to strings of 50 bytes that an earlier one holds, and what is left."""
    return without_repeats(documents(spark, sf_dir)).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
