"""Shortest-pack-first packing over the length histogram.

A document becomes its token ids and an end id, cut into sequences of its own and a shorter rest. The
packer sees only how many rests there are of each length (fewer lengths than the capacity). It places
lengths longest first, always into the shortest pack, and keeps ranges of packs with the same pattern
of lengths as one entry whose count it updates. Rests find their pack by their rank among the rests of
their length.

Cutting is free here, so no padding has to remain: the room left in all packs amounts to some number of
packs; that many of the shortest ones are dissolved, their documents are laid end to end on a line, and
the line is cut to the rooms of the others. What is left of the line, less than one sequence, goes into
sequences whose lengths are powers of two. Only documents of dissolved packs are cut.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.llm.common import documents, once_per_worker, text_or_empty, written
from tradewind.llm.features import slices

CAPACITY, END_ID, TOKENIZER = 2048, 1, "word_bpe_49k"
LEAST_GROUPS, RANKED_TOGETHER = 256, 1 << 18  # groups a length is ranked in, and rows of all lengths per group
MOST_WORDS = 1 << 19  # words whose ids a worker remembers

# --- tokens --------------------------------------------------------------------------------------

# Code points that keep their form under canonical composition; a text with any other one is left to
# the tokenizer file, as is one with a special string of the vocabulary.
_SIMPLE = re.compile("[\x00-ſ]*")
_SPECIAL = ("<|startoftext|>", "<|endoftext|>")


def _word_pattern() -> re.Pattern:
    """The vocabulary's way to cut lower-cased text, for simple code points."""
    points = list(map(chr, range(0x180)))
    letters = "".join(c for c in points if unicodedata.category(c)[0] == "L")
    digits = "".join(c for c in points if unicodedata.category(c)[0] == "N")
    blank = " \t\n\x0b\x0c\r\x85\xa0"
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{blank}{letters}{digits}]+")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


def id_type(tokenizer: str = TOKENIZER) -> str:
    """Numbers that hold every id of the vocabulary: two bytes, or four."""
    import public_tokenizers
    from tokenizers import Tokenizer

    size = Tokenizer.from_file(public_tokenizers.path(f"{tokenizer}.json")).get_vocab_size()
    return "<u2" if size <= 1 << 16 else "<u4"


def encoder(tokenizer: str, dtype: str):
    """texts -> their token ids as bytes, equal to those of the tokenizer file.

    The vocabulary cuts texts into words before it merges, so the ids of a word are looked up once; a worker
    remembers at most ``MOST_WORDS`` words and the new ones of its last texts.
    """
    import os

    import public_tokenizers
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel units
    exact = Tokenizer.from_file(public_tokenizers.path(f"{tokenizer}.json"))
    merge, letters = exact.model.tokenize, _byte_letters()
    words, known, kind = _word_pattern(), {}, "H" if dtype == "<u2" else "I"

    def ids_of(word: str) -> bytes:
        return array(kind, [t.id for t in merge(word.encode().decode("latin-1").translate(letters))]).tobytes()

    def whole(text: str) -> bytes:
        return array(kind, exact.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(texts: list[str]) -> list[bytes]:
        plain = [_SIMPLE.fullmatch(t) and not any(s in t for s in _SPECIAL) for t in texts]
        if tokenizer != TOKENIZER or not any(plain):
            return list(map(whole, texts))
        lists = [words.findall(t.lower()) for t, p in zip(texts, plain) if p]
        if len(known) > MOST_WORDS:
            known.clear()
        for word in set().union(*lists).difference(known):
            known[word] = ids_of(word)
        fast = (b"".join(map(known.__getitem__, some)) for some in lists)
        return [next(fast) if p else whole(t) for t, p in zip(texts, plain)]

    return encode


def token_rests(
    docs: DataFrame, *, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, end_id: int = END_ID
) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids): whole texts tokenised, cut into full sequences and a rest.

    Null text is an empty one. ``ids`` are little-endian numbers of two bytes (four for large vocabularies).
    """
    dtype = id_type(tokenizer)
    end = np.array([end_id], dtype=dtype).tobytes()
    wide = len(end)
    picked = docs.select("doc_id", text_or_empty("text").alias("text"))

    def run(batches):
        encode = once_per_worker(f"words_{tokenizer}", lambda: encoder(tokenizer, dtype))
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                rows = []
                for row, ids in enumerate(encode([t.decode() for t in texts]), start=first):
                    ids += end
                    total = len(ids) // wide
                    for a in range(0, total, capacity):
                        b = min(a + capacity, total)
                        rows.append((row, a, b - a, total, ids[a * wide : b * wide]))
                of, start, length, total, ids = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(of, pa.int64())),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(total, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["doc_id", "start", "length", "doc_tokens", "ids"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, ids binary")


# --- the plan ------------------------------------------------------------------------------------


@dataclass
class Plan:
    """Where the rests of each length go.

    ``slots`` (length, first rank, number, first sequence, offset, line): ranks of a slot go to consecutive
    sequences at one offset, or with ``line`` >= 0 to consecutive places of the line. ``targets`` (first
    place, size, number, first sequence, offset): the line's places in order, ``number`` times ``size``.
    """

    slots: np.ndarray
    targets: np.ndarray

    def pieces_of(self, place: int, length: int):
        """(start, length, sequence, offset) of the pieces of a document at a place of the line."""
        first, size, _, sequence, offset = self.targets.T
        at, end = place, place + length
        while at < end:
            t = int(np.searchsorted(first, at, side="right")) - 1
            nth, inside = divmod(at - int(first[t]), int(size[t]))
            upto = min(end, at + int(size[t]) - inside)
            yield at - place, upto - at, int(sequence[t]) + nth, int(offset[t]) + inside
            at = upto


def shortest_pack_first(counts: dict[int, int], capacity: int):
    """(slots without a line, packs): packs as (first sequence, number, room) of equal patterns.

    As many packs are opened for a length as placing its documents one by one would open.
    """
    by_room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    most, sequences, slots = 0, 0, []
    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a document of {length} tokens fits no sequence")
        todo, rank = counts[length], 0
        while todo:
            while most and not by_room[most]:
                most -= 1
            if most >= length:
                first, number = by_room[most].pop()
                used, room = min(number, todo), most
                if used < number:
                    by_room[room].append((first + used, number - used))
            else:
                used, room = -(-todo // (capacity // length)), capacity
                first = sequences
                sequences += used
            slots.append((length, rank, used, first, capacity - room))
            by_room[room - length].append((first, used))
            most = max(most, room - length)
            rank, todo = rank + used, todo - used
    packs = [(first, number, room) for room, some in enumerate(by_room) for first, number in some]
    return slots, packs


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Packs without padding: every sequence is full or as long as a power of two."""
    slots, packs = shortest_pack_first(counts, capacity)
    sequences = sum(number for _, number, _ in packs)
    # Shortest first; packs that need no padding stay as they are.
    open_packs = sorted((p for p in packs if p[2] and not _power_of_two(capacity - p[2])), key=lambda p: (-p[2], p[0]))
    dissolve = -(-sum(number * room for _, number, room in open_packs) // capacity)
    gone, targets, place = [], [], 0
    for first, number, room in open_packs:
        some = min(dissolve, number)
        if some:
            gone.append((first, first + some))
            dissolve -= some
        if number > some:
            targets.append((place, room, number - some, first + some, capacity - room))
            place += room * (number - some)
    gone.sort()
    placed, line = [], 0
    for length, rank, number, first, offset in slots:
        for a, b, out in _split(first, first + number, gone):
            placed.append((length, rank + a - first, b - a, a, offset, line if out else -1))
            line += length * (b - a) if out else 0
    left = line - place
    for bit in reversed(range(left.bit_length())):
        if left >> bit & 1:
            targets.append((place, 1 << bit, 1, sequences, 0))
            place, sequences = place + (1 << bit), sequences + 1
    order = sorted(placed)
    return Plan(np.array(order, dtype=np.int64).reshape(-1, 6), np.array(targets, dtype=np.int64).reshape(-1, 5))


def _power_of_two(x: int) -> bool:
    return x > 0 and x & (x - 1) == 0


def _split(a: int, b: int, ranges: list[tuple[int, int]]):
    """(start, end, inside one of the sorted ``ranges``) parts of a..b."""
    for x, y in ranges:
        if y <= a or x >= b:
            continue
        if a < x:
            yield a, x, False
        yield max(a, x), min(b, y), True
        a = min(b, y)
    if a < b:
        yield a, b, False


# --- ranks and places ----------------------------------------------------------------------------


def pack(rests: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids, sequence_id, offset): one row per piece of a sequence.

    ``rests`` are ``token_rests``; here ``ids`` are four little-endian bytes each. Rows that fill a sequence
    alone stay where they are, only shorter ones are ranked and meet their places by row number. Repeated
    rows and rows without a doc_id are placed like any other; an empty table gives none.
    """
    rows = written(rests.withColumn("uid", F.monotonically_increasing_id()), "rests")
    short = rows.where(F.col("length") < capacity)
    groups = max(LEAST_GROUPS, -(-rows.count() // RANKED_TOGETHER))
    dealt = short.select("uid", "length", F.pmod(F.xxhash64("uid"), F.lit(groups)).alias("group"))
    sizes = dealt.groupBy("length", "group").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps = plan(counts, capacity)
    # A length has at most one size per group, so its running total is a short list.
    before = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("length").alias("l"), F.col("group").alias("g"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("below")
    )
    inside = Window.partitionBy("length", "group").orderBy("uid")
    ranked = (
        dealt.withColumn("nth", F.row_number().over(inside) - 1)
        .join(offsets, (F.col("length") == F.col("l")) & (F.col("group") == F.col("g")))
        .select(F.col("uid").alias("of"), (F.col("below") + F.col("nth")).alias("rank"))
    )
    columns = ["doc_id", "start", "length", "doc_tokens", "ids", "uid"]
    met = short.join(ranked, F.col("uid") == F.col("of")).select(*columns, "rank")
    alone = rows.where(F.col("length") == capacity).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    kind = rests.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, ids binary, sequence_id bigint, offset bigint"
    )
    place = _placer(steps, max(counts.values(), default=0) + 1)
    return met.mapInArrow(place, schema).unionAll(alone.mapInArrow(place, schema))


def _placer(steps: Plan, wide: int):
    """Batches of rows with ranks -> pieces with their sequences. Rows without a rank are sequences of their own."""
    slots = steps.slots
    first = slots[:, 0] * wide + slots[:, 1]  # ranks of a length are gapless, so a search finds the slot

    def run(batches):
        for batch in batches:
            uid, start, length, total = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("uid", "start", "length", "doc_tokens")
            )
            rank = batch.column("rank").fill_null(-1).to_numpy(zero_copy_only=False)
            sequence, offset, line = -1 - uid, np.zeros(len(uid), np.int64), np.full(len(uid), -1)
            short = np.flatnonzero(rank >= 0)
            if len(short):
                at = np.searchsorted(first, length[short] * wide + rank[short], side="right") - 1
                nth = rank[short] - slots[at, 1]
                sequence[short], offset[short] = slots[at, 3] + nth, slots[at, 4]
                line[short] = np.where(slots[at, 5] >= 0, slots[at, 5] + nth * length[short], -1)
            ids = batch.column("ids")
            whole = np.flatnonzero(line < 0)
            of, starts, lengths = whole.tolist(), start[whole].tolist(), length[whole].tolist()
            bodies = [_four_bytes(ids[i].as_buffer(), length[i]) for i in of]
            sequences, offsets = sequence[whole].tolist(), offset[whole].tolist()
            for i in np.flatnonzero(line >= 0).tolist():  # documents of dissolved packs
                body = _four_bytes(ids[i].as_buffer(), length[i])
                for a, n, s, o in steps.pieces_of(int(line[i]), int(length[i])):
                    of.append(i)
                    starts.append(int(start[i]) + a)
                    lengths.append(n)
                    bodies.append(body[4 * a : 4 * (a + n)])
                    sequences.append(s)
                    offsets.append(o)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(of, pa.int64())),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(total[of], pa.int64()),
                    pa.array(bodies, pa.binary()),
                    pa.array(sequences, pa.int64()),
                    pa.array(offsets, pa.int64()),
                ],
                names=["doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset"],
            )

    return run


def _four_bytes(ids: pa.Buffer, length: int) -> bytes:
    return np.frombuffer(ids, f"<u{len(ids) // int(length)}").astype("<u4").tobytes()


def op13_spfhp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence of at most 2048 tokens; the ids show as their checksum."""
    placed = pack(token_rests(documents(spark, sf_dir)))
    return placed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
