"""SimHash near-duplicates: 64-bit fingerprints, bit-sliced comparison, linked groups.

Every fingerprint pair within ``radius`` bits agrees on at least ``blocks - radius`` of ``blocks``
bit blocks, so rows that share the masked bits of one such choice of blocks meet in a bucket.
Inside a bucket, 64 fingerprints at a time are stored as 64 bit planes (one word per bit position).
A query adds the planes in which it differs to carry-save counters, 64 distances at once, and a
block of candidates is abandoned as soon as all its distances are beyond the radius.

Equal fingerprints are compared once, whatever the number of copies. A bucket of more than ``tile``
fingerprints is cut into tiles, and every pair of tiles is a task unit of its own. What leaves a unit
is a spanning forest of its links, at most one row per fingerprint, never all pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import connected_components, documents, text_or_empty, written

SHINGLE, RADIUS, BLOCKS, TILE = 3, 3, 5, 512
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


# --- fingerprints --------------------------------------------------------------------------------


def fingerprints(
    docs: DataFrame, *, text: str = "text", shingle: int = SHINGLE, copies: bool = False
) -> DataFrame:
    """(doc_id, fp): fp as a signed long. Null text is empty; a text without words has fp 0.

    With ``copies`` a hash of the text stands beside them, which tells apart rows of one doc_id. Words are split at ASCII white space after lower-casing A-Z; every shingle of ``shingle`` words
    counts, repeats included, and a shorter text is one shingle.
    """
    picked = docs.select("doc_id", text_or_empty(text).alias("text"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp bigint"
    if copies:
        picked = picked.withColumn("copy", F.xxhash64("text"))
        schema += ", copy bigint"

    def run(batches):
        for batch in batches:
            prints = np.array(
                [_fingerprint(t.lower().split(), shingle) for t in _utf8(batch.column(1))], dtype=np.uint64
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64)), *batch.columns[2:]],
                names=["doc_id", "fp", *batch.schema.names[2:]],
            )

    return picked.mapInArrow(run, schema)


def _utf8(column):
    """The bytes of each text, one at a time."""
    return (v.as_buffer().to_pybytes() for v in column)


def _fingerprint(words: list[bytes], shingle: int) -> int:
    if not words:
        return 0
    digest, total = xxhash.xxh64_intdigest, max(1, len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, total, 65536):  # bounded memory for texts of any length
        part = words[start : start + 65536 + shingle - 1]
        shifted = [part[i:] for i in range(shingle)] if len(words) >= shingle else [[b" ".join(part)]]
        hashes = np.array([digest(b" ".join(t), 42) for t in zip(*shifted)], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


# --- candidate buckets ---------------------------------------------------------------------------


def _masks(radius: int, blocks: int) -> list[int]:
    """One mask, as a signed long, per choice of the blocks that must agree."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    parts = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    chosen = (sum(c) for c in combinations(parts, blocks - radius))
    return [m - (1 << 64) if m >= 1 << 63 else m for m in chosen]


def link_edges(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """Edges (u, v) that connect distinct fingerprints ``fp`` exactly as all links within ``radius`` do."""
    if not 0 <= radius < blocks <= 64:
        raise ValueError("blocks must exceed the radius")
    keys = [
        F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits"))
        for i, m in enumerate(_masks(radius, blocks))
    ]
    keyed = prints.select("fp", F.inline(F.array(*keys)))
    sizes = (
        keyed.groupBy("choice", "bits")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("choice").alias("c"), F.col("bits").alias("b"), F.ceil(F.col("n") / tile).alias("tiles"))
    )
    tiled = keyed.join(sizes, (F.col("choice") == F.col("c")) & (F.col("bits") == F.col("b"))).withColumn(
        "own", F.pmod(F.xxhash64("fp", "choice"), F.col("tiles"))
    )
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)).alias("other")
    units = tiled.select("fp", "choice", "bits", "own", other).select(
        F.xxhash64("choice", "bits", F.least("own", "other"), F.greatest("own", "other")).alias("unit"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "fp",
    )
    return (
        units.repartition("unit")
        .sortWithinPartitions("unit", "side", "fp")
        .mapInArrow(lambda batches: _forests(batches, radius), "u bigint, v bigint")
    )


def _forests(batches, radius: int):
    """Spanning forest of the links of each unit; units are runs of rows and may cross batches."""
    left = None
    for batch in batches:
        rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        if left is not None:
            rows = [np.concatenate(pair) for pair in zip(left, rows)]
        cut = int(np.searchsorted(rows[0], rows[0][-1])) if len(rows[0]) else 0
        left = [r[cut:] for r in rows]
        yield from _forest([r[:cut] for r in rows], radius)
    if left is not None:
        yield from _forest(left, radius)


def _forest(rows: list[np.ndarray], radius: int):
    unit, side, prints = rows
    if len(unit) < 2:
        return
    near = near_pairs(unit, side, prints.view(np.uint64), radius)
    parent = np.arange(len(unit))
    for i, j in near:
        while True:
            a, b = parent[i], parent[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            while (parent[parent] != parent).any():
                parent = parent[parent]
    linked = np.flatnonzero(parent != np.arange(len(unit)))
    if len(linked):
        yield pa.RecordBatch.from_arrays(
            [pa.array(prints[linked]), pa.array(prints[parent[linked]])], names=["u", "v"]
        )


def near_pairs(unit: np.ndarray, side: np.ndarray, prints: np.ndarray, radius: int, most: int = 1 << 19):
    """Yields (i, j) index arrays of all pairs of a unit within ``radius``; rows come sorted by unit, side.

    In a unit with two sides a pair has one row of each; otherwise i < j.
    """
    n = len(prints)
    starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
    ends = np.r_[starts[1:], n]
    of = np.repeat(np.arange(len(starts)), ends - starts)
    second = starts + np.add.reduceat((side == 0).astype(np.int64), starts)  # first row of side 1
    row = np.arange(n)
    lo = np.where(second[of] < ends[of], second[of], row + 1)
    lo = np.where(side == 1, ends[of], lo)
    hi = ends[of]
    queries = row[lo < hi]
    spans = (hi[queries] - 1) // 64 - lo[queries] // 64 + 1  # blocks of 64 lanes that a query meets
    planes = _planes(prints)
    done = 0
    total = np.cumsum(spans)
    while done < len(queries):
        upto = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + most, side="right")))
        q, k = queries[done:upto], spans[done:upto]
        rep = np.repeat(q, k)
        step = np.arange(len(rep)) - np.repeat(np.cumsum(k) - k, k)
        block = lo[rep] // 64 + step
        lanes = _lanes(lo[rep] - block * 64, hi[rep] - block * 64)
        yield _close(planes, prints, rep, block, lanes, radius)
        done = upto


def _planes(prints: np.ndarray) -> np.ndarray:
    """planes[bit, block]: bit ``lane`` of the word is that bit of fingerprint ``64 * block + lane``."""
    blocks = -(-len(prints) // 64)
    padded = np.zeros(blocks * 64, dtype="<u8")
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    across = np.ascontiguousarray(bits.reshape(blocks, 64, 64).transpose(2, 0, 1))
    return np.packbits(across, axis=2, bitorder="little").reshape(64, blocks, 8).view("<u8")[..., 0]


def _lanes(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Words with the bits [lo, hi) set, cut to 0..64."""

    def below(x):
        x = np.clip(x, 0, 64).astype(np.uint64)
        return np.where(x == 64, _FULL, (np.uint64(1) << np.minimum(x, np.uint64(63))) - np.uint64(1))

    return below(hi) & ~below(lo)


def _close(planes, prints, query, block, lanes, radius):
    """Pairs within the radius, by carry-save counters over the bit planes."""
    wide = radius.bit_length()
    offset = (1 << wide) - 1 - radius  # so that a count beyond the radius overflows the counter
    pick = np.arange(len(query))
    beyond = ~lanes
    counters = [np.where((offset >> c) & 1, _FULL, np.uint64(0)) * np.ones(len(query), np.uint64) for c in range(wide)]
    for bit in range(64):
        own = (prints[query] >> np.uint64(bit)) & np.uint64(1)
        carry = planes[bit][block] ^ (np.uint64(0) - own)
        for c in range(wide):
            counters[c], carry = counters[c] ^ carry, counters[c] & carry
        beyond |= carry
        if bit % 8 == 7:  # abandon blocks in which every lane is beyond the radius
            alive = beyond != _FULL
            if not alive.all():
                pick, query, block, beyond = pick[alive], query[alive], block[alive], beyond[alive]
                counters = [c[alive] for c in counters]
    found = np.unpackbits((~beyond).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, lane = np.nonzero(found)
    return query[at], block[at] * 64 + lane


# --- groups --------------------------------------------------------------------------------------


def near_duplicates(
    docs: DataFrame,
    *,
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    tile: int = TILE,
) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``; other columns are not looked at.

    The component is the smallest doc_id that can be reached over links of at most ``radius``
    differing bits. Rows with equal doc_id are each returned. A null doc_id links like any other but
    names no component: a group of null ids alone has a null component_id. An empty table gives none.
    """
    found = _grouped(fingerprints(docs, text=text, shingle=shingle), radius, blocks, tile)
    return found.select("doc_id", "fp", "component_id")


def _grouped(prints: DataFrame, radius: int, blocks: int, tile: int) -> DataFrame:
    """``prints`` with the smallest fingerprint (``top``) and the smallest doc_id of each row's component."""
    prints = written(prints, "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    star = connected_components(link_edges(nodes.select("fp"), radius, blocks, tile))
    rooted = (
        nodes.join(star, F.col("fp") == F.col("node"), "left")
        .select("fp", "first", F.coalesce("root", "fp").alias("top"))
    )
    firsts = rooted.groupBy("top").agg(F.min("first").alias("component_id")).withColumnRenamed("top", "t")
    groups = rooted.join(firsts, F.col("top") == F.col("t")).select(F.col("fp").alias("f"), "top", "component_id")
    return prints.join(groups, F.col("fp") == F.col("f")).drop("f")


def keep_one_of_each(
    docs: DataFrame,
    *,
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    tile: int = TILE,
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates, all columns as they are.

    One row of each group stays: that of the smallest doc_id and, where rows of that doc_id differ in
    their text, the smallest hash of it. Of rows with equal doc_id and text the one stays whose other
    columns sort first (maps, which have no order, do not count). Rows without a doc_id cannot be named
    and stay. Null text is empty, and an empty table gives none.
    """
    prints = fingerprints(docs.where("doc_id IS NOT NULL"), text=text, shingle=shingle, copies=True)
    stay = (
        _grouped(prints, radius, blocks, tile)
        .groupBy("top")
        .agg(F.min(F.struct("doc_id", "copy")).alias("one"))
        .select(F.col("one.doc_id").alias("__stays"), F.col("one.copy").alias("__as"))
    )
    rest = [f for f in docs.schema.fields if f.name not in ("doc_id", text)]
    ordered = [f.name for f in rest if "map<" not in f.dataType.simpleString()]
    other = [f.name for f in rest if f.name not in ordered]
    # Repeated rows collapse before they travel, and the join reuses their distribution.
    single = (
        docs.where("doc_id IS NOT NULL")
        .withColumn("__copy", F.xxhash64(text_or_empty(text)))
        .groupBy("doc_id", "__copy")
        .agg(
            F.first(text).alias("__text"),
            F.min(F.struct(F.lit(0).alias("__"), *ordered)).alias("__row"),
            *[F.first(c).alias(f"__map_{i}") for i, c in enumerate(other)],
        )
    )
    columns = {"doc_id": F.col("doc_id"), text: F.col("__text")}
    columns |= {c: F.col("__row")[c] for c in ordered} | {c: F.col(f"__map_{i}") for i, c in enumerate(other)}
    kept = single.join(stay, (F.col("doc_id") == F.col("__stays")) & (F.col("__copy") == F.col("__as")), "left_semi")
    return kept.select(*[columns[c].alias(c) for c in docs.columns]).unionByName(docs.where("doc_id IS NULL"))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    found = near_duplicates(documents(spark, sf_dir))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
