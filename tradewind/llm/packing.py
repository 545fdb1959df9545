"""Vector best-fit packing of token pieces into sequences.

A document becomes its token ids and an end id; longer ones than a sequence are cut so that only the
first piece is shorter. A piece loads a sequence in three dimensions: its tokens, one document, and
its attention cost (length squared). All three depend on the length alone, so the number of pieces
per length (one row per length, bounded by the sequence's capacity) is all the packer needs: it
packs lengths in decreasing order, always into the open sequences that score best under every
constraint, and treats sequences in equal states as one range. The result is a table of slots, each
a range of pieces of one length at one offset of a range of sequences. Pieces find their slot by
their rank among the pieces of their length, which is counted in groups whose number follows the
number of pieces; pieces that fill a sequence need no rank.
"""

from __future__ import annotations

import base64
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.llm.common import documents, once_per_worker, text_or_empty, written

CAPACITY, END_ID = 1024, 2
LEAST_GROUPS, RANKED_TOGETHER = 256, 1 << 18  # groups a length is ranked in, and pieces of all lengths per group
SPECIAL = {"<|endoftext|>": 50256}
_LONG_RUN = re.compile(r"\S{2000}|\s{2000}")


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence and the weights of their dimensions in the score.

    By default only the tokens bind: a sequence may hold as many documents as tokens, and the cost
    of attention may reach that of one document that fills the sequence.
    """

    tokens: int = CAPACITY
    documents: int = CAPACITY
    attention: int = CAPACITY * CAPACITY
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)
    score: str = "norm"  # smallest residual norm after placing, or "dot": largest dot-product before


# --- tokens --------------------------------------------------------------------------------------


def _encoder(name: str):
    """text -> ids of the named public byte-level BPE.

    The rank file of the same vocabulary gives the same ids several times faster; special strings
    and very long runs (quadratic there) are left to the tokenizer file itself.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{name}.tiktoken")) as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, lines)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    exact = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))

    def encode(text: str) -> list[int]:
        if any(s in text for s in SPECIAL) or _LONG_RUN.search(text):
            return exact.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def token_pieces(
    docs: DataFrame, *, capacity: int = CAPACITY, tokenizer: str = "byte_bpe_50k", end_id: int = END_ID
) -> DataFrame:
    """(doc_id, piece, start, length, ids, ids_crc32): whole texts tokenised, null text as an empty one.

    ``ids`` are the token ids of the piece, two little-endian bytes each (four if a larger vocabulary needs
    them); the checksum is that of four bytes each.
    """
    picked = docs.select("doc_id", text_or_empty("text").alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encode = once_per_worker(f"ranks_{tokenizer}", lambda: _encoder(tokenizer))
        for batch in batches:
            rows = []
            for row, text in enumerate(batch.column(1)):
                ids = np.array([*encode(text.as_py()), end_id], dtype="<u4")
                kept = ids.astype("<u2") if ids.max() < 1 << 16 else ids
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((row, piece, a, b - a, kept[a:b].tobytes(), zlib.crc32(ids[a:b].tobytes())))
            of, piece, start, length, ids, crc = zip(*rows) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(of, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids", "ids_crc32"],
            )

    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids binary, ids_crc32 bigint"
    return picked.mapInArrow(run, schema)


# --- the plan ------------------------------------------------------------------------------------


def plan_slots(counts: dict[int, int], limits: Limits = Limits()) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first rank, number, first sequence, offset) that hold ``counts[length]`` pieces each.

    Pieces of a slot go to consecutive sequences, one each.
    """
    full = np.array([limits.tokens, limits.documents, limits.attention], dtype=np.float64)
    weights = np.array(limits.weights)
    start, number = np.empty(0, np.int64), np.empty(0, np.int64)  # ranges of sequences in equal states
    left = np.empty((0, 3))
    sequences, slots = 0, []
    for length in sorted(counts, reverse=True):
        load = np.array([length, 1, length * length], dtype=np.float64)
        if (load > full).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        todo, rank = counts[length], 0
        while todo:
            fits = np.flatnonzero((left >= load).all(axis=1))
            if len(fits):
                if limits.score == "dot":
                    best = fits[np.argmax(((left[fits] / full) * (load / full) * weights).sum(axis=1))]
                else:
                    best = fits[np.argmin(((((left[fits] - load) / full) ** 2) * weights).sum(axis=1))]
                s, n, room = int(start[best]), int(number[best]), left[best].copy()
            else:
                best, s, n, room = None, sequences, todo, full.copy()
            each = int(min(room // load))  # the best fit stays the best until it is full
            bins, extra = divmod(min(todo, n * each), each)
            parts = [(s, bins, each), (s + bins, 1, extra)] if extra else [(s, bins, each)]
            used = 0
            for a, m, k in parts:
                if not m:
                    continue
                for t in range(k):
                    slots.append((length, rank, m, a, int(limits.tokens - room[0]) + t * length))
                    rank += m
                todo -= m * k
                used += m
                start, number = np.append(start, a), np.append(number, m)
                left = np.vstack([left, room - k * load])
            if best is None:
                sequences += used
            elif used < n:
                start[best], number[best] = s + used, n - used
            else:
                keep = np.arange(len(start)) != best
                start, number, left = start[keep], number[keep], left[keep]
    return slots


# --- ranks and places ----------------------------------------------------------------------------


def pack(pieces: DataFrame, limits: Limits = Limits(), groups: int | None = None) -> DataFrame:
    """``pieces`` (any columns, one of them ``length``) plus ``sequence_id`` and ``offset``.

    Every row is placed, repeated rows and rows without a doc_id like any other. Token ids travel along and
    come back as four little-endian bytes each. Pieces that fill a sequence get one of a negative number.
    """
    rows = written(pieces.withColumn("__uid", F.monotonically_increasing_id()), "pieces")
    # Only lengths are ranked; the other columns wait on disk and meet their places by row number.
    fills = F.lit(limits.tokens**2 <= limits.attention) & (F.col("length") == limits.tokens)
    groups = groups or max(LEAST_GROUPS, -(-rows.count() // RANKED_TOGETHER))
    dealt = rows.where(~fills).select("__uid", "length", F.pmod(F.xxhash64("__uid"), F.lit(groups)).alias("__group"))
    sizes = dealt.groupBy("length", F.col("__group").alias("group")).agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = np.array(plan_slots(counts, limits), dtype=np.int64).reshape(-1, 5)
    slots = slots[np.lexsort((slots[:, 1], slots[:, 0]))]
    # A length has at most one size per group, so its running total is a short list.
    before = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("length").alias("__l"),
        F.col("group").alias("__g"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__below"),
    )
    inside = Window.partitionBy("length", "__group").orderBy("__uid")
    ranked = (
        dealt.withColumn("__nth", F.row_number().over(inside) - 1)
        .join(offsets, (F.col("length") == F.col("__l")) & (F.col("__group") == F.col("__g")))
        .select(F.col("__uid").alias("__of"), (F.col("__below") + F.col("__nth")).alias("__rank"))
    )
    none = F.lit(None).cast("bigint").alias("__rank")
    ordered = rows.columns
    met = rows.where(~fills).join(ranked, F.col("__uid") == F.col("__of")).select(*ordered, "__rank")
    place = _placer(slots, max(counts.values(), default=0) + 1)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    schema += ", sequence_id bigint, offset bigint"
    alone = rows.where(fills).select(*ordered, none)
    return met.mapInArrow(place, schema).unionAll(alone.mapInArrow(place, schema))


def _placer(slots: np.ndarray, wide: int):
    """Batches of ranked rows -> the rows with their places. Rows without a rank are sequences of their own."""
    first = slots[:, 0] * wide + slots[:, 1]  # ranks of a length are gapless, so a search finds the slot

    def run(batches):
        for batch in batches:
            uid, length = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("__uid", "length"))
            rank = batch.column("__rank").fill_null(-1).to_numpy(zero_copy_only=False)
            sequence, offset = -1 - uid, np.zeros(len(uid), np.int64)
            short = np.flatnonzero(rank >= 0)
            if len(short):
                at = np.searchsorted(first, length[short] * wide + rank[short], side="right") - 1
                sequence[short], offset[short] = slots[at, 3] + rank[short] - slots[at, 1], slots[at, 4]
            out = batch.drop_columns(["__uid", "__rank"])
            at = out.schema.get_field_index("ids")
            if at >= 0 and pa.types.is_binary(out.schema.field(at).type):
                ids = [_four_bytes(v, n) for v, n in zip(out.column(at), length.tolist())]
                out = out.set_column(at, "ids", pa.array(ids, pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*out.schema.names, "sequence_id", "offset"],
            )

    return run


def _four_bytes(ids: pa.BinaryScalar, length: int) -> bytes | None:
    """Ids of two bytes each as ids of four; anything else as it is."""
    if not ids.is_valid:
        return None
    body = ids.as_buffer()
    return np.frombuffer(body, "<u2").astype("<u4").tobytes() if len(body) == 2 * length else body.to_pybytes()


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence of at most 1024 tokens and its place there.

    The ids are packed along; the query shows their checksum.
    """
    placed = pack(token_pieces(documents(spark, sf_dir)))
    return placed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
