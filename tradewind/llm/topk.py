"""Exact top-k by inner product: norm buckets, local cosine thresholds, verified products.

Vectors are quantised to integers, ordered by length and cut into buckets of about equal length. A
first pass over the longest candidates gives every query a lower bound of its k-th score. In every
bucket that bound, divided by both lengths, is a threshold on the cosine: a bucket whose threshold is
beyond 1 holds nothing for the query; with a high threshold the query's largest coordinates prune
(their part of the product plus the Cauchy-Schwarz bound of the rest), with a low one length does.
What is left is verified with whole integer products.

The stated queries meet all candidates in blocks. Neighbouring blocks form groups, whose largest lengths
fall from group to group, so a query block is sent only to the groups before the first one that no
candidate of which can reach its weakest bound. A pair of blocks returns at most k rows per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.llm.common import written

SCALE, K, EVERY = 1024, 10, 100
BLOCK, QUERY_BLOCK, PROBE = 4096, 256, 1024  # vectors in a block, queries in a block, longest vectors tried first
BLOCKS_IN_GROUP, MOST_LEVELS = 8, 4096  # blocks in a group; levels of neighbouring groups with one largest length
FOCUS, COORDINATES_FROM = 8, 0.5  # coordinates looked at, and the cosine from which they prune
_EXACT = 2.0**53  # integers up to here, and sums of them, are exact as doubles
_MOST = 2**63 - 1


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(uid, vec_id, v, norm): components floor(scale * x) as doubles, and the vector's length.

    Rows without an id and vectors that are null or hold a null, NaN or infinite component take no part.
    """
    schema = "vec_id bigint, v array<double>, norm double"

    def run(batches):
        for batch in batches:
            ids, kept, norms = [], [], []
            for i, row in zip(batch.column(0).to_pylist(), batch.column(1)):
                if i is None or not row.is_valid or row.values.null_count:
                    continue
                v = np.floor(np.asarray(row.values.to_numpy(zero_copy_only=False), dtype=np.float64) * scale)
                if np.isfinite(v).all():
                    ids.append(i)
                    kept.append(v)
                    norms.append(float(np.linalg.norm(v)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(kept, pa.list_(pa.float64())), pa.array(norms, pa.float64())],
                names=["vec_id", "v", "norm"],
            )

    found = vectors.select(F.col("vec_id").cast("bigint"), "embedding").mapInArrow(run, schema)
    return found.withColumn("uid", F.monotonically_increasing_id())


# --- blocks --------------------------------------------------------------------------------------


def _blocks(batches, size: int, name: str):
    """Rows (uid, vec_id, v, norm), longest first, as one row per block of at most ``size``."""
    rows: list = []
    for batch in batches:
        rows += zip(*(batch.column(c).to_pylist() for c in ("uid", "vec_id", "v", "norm")))
        while len(rows) >= size:
            yield _block(rows[:size], name)
            rows = rows[size:]
    if rows:
        yield _block(rows, name)


def _block(rows: list, name: str) -> pa.RecordBatch:
    wide = max((len(r[2]) for r in rows), default=0)  # shorter vectors end in zeros
    matrix = np.zeros((len(rows), wide))
    for i, r in enumerate(rows):
        matrix[i, : len(r[2])] = r[2]
    parts = [
        np.array([r[0] for r in rows], dtype="<i8"),
        np.array([r[1] for r in rows], dtype="<i8"),
        np.array([r[3] for r in rows], dtype="<f8"),
        matrix.astype("<f8"),
    ]
    longest = pa.array([float(parts[2].max(initial=0))], pa.float64())
    return pa.RecordBatch.from_arrays(
        [*(pa.array([p.tobytes()], pa.binary()) for p in parts), longest],
        names=[f"{name}_{c}" for c in ("uid", "id", "norm", "m", "longest")],
    )


def _block_schema(name: str) -> str:
    return ", ".join(f"{name}_{c} binary" for c in ("uid", "id", "norm", "m")) + f", {name}_longest double"


def _unpack(row: dict, name: str):
    uid, ids = np.frombuffer(row[f"{name}_uid"], "<i8"), np.frombuffer(row[f"{name}_id"], "<i8")
    norm = np.frombuffer(row[f"{name}_norm"], "<f8")
    return uid, ids, norm, np.frombuffer(row[f"{name}_m"], "<f8").reshape(len(ids), -1)


def packed(vectors: DataFrame, size: int, name: str, blocks: int = 1) -> DataFrame:
    """One row per block of vectors of about equal length; partitions of ``blocks`` blocks, longest first."""
    count = vectors.count()
    ordered = vectors.repartitionByRange(max(1, -(-count // (size * blocks))), F.desc("norm"), "uid")
    return ordered.sortWithinPartitions(F.desc("norm"), "uid").mapInArrow(
        lambda batches: _blocks(batches, size, name), _block_schema(name)
    )


# --- products ------------------------------------------------------------------------------------


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products, as doubles while those are exact and as Python integers beyond."""
    wide = min(q.shape[1], c.shape[1])
    q, c = q[:, :wide], c[:, :wide]
    most = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * max(wide, 1)
    if most < _EXACT:
        return q @ c.T
    whole = [[int(x) for x in row] for row in q], [[int(x) for x in row] for row in c]
    sums = [[max(-_MOST, min(_MOST, sum(map(int.__mul__, a, b)))) for b in whole[1]] for a in whole[0]]
    return np.array(sums, dtype=object).reshape(len(q), len(c))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to the smaller id."""
    if len(scores) > k and scores.dtype != object:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= edge)
        scores, ids = scores[near], ids[near]
    order = np.lexsort((ids, -scores)) if scores.dtype != object else sorted(
        range(len(ids)), key=lambda i: (-scores[i], ids[i])
    )
    return scores[order[:k]], ids[order[:k]]


def search_block(query, block, bound: np.ndarray, k: int):
    """(query row, scores, ids) of candidates of a block that may be among a query's k best.

    ``bound`` is a score that the query's k-th best reaches; candidates are sorted by length, longest first.
    """
    query_uids, _, query_norm, q = query
    uids, ids, norm, c = block
    need = bound / np.maximum(query_norm, 1e-300)  # least length of a candidate, if the bound is positive
    slack = 1 - 1e-9
    for i in np.flatnonzero((bound <= 0) | (norm[0] >= need * slack)):
        reach = len(norm)
        if bound[i] > 0:
            reach = int(np.searchsorted(-norm, -need[i] * slack, side="right"))
        cosine = need[i] / norm[0] if norm[0] > 0 else 0.0
        pick = np.arange(reach)
        if bound[i] > 0 and cosine >= COORDINATES_FROM and reach:
            pick = np.flatnonzero(_may_reach(q[i], c[:reach], norm[:reach], query_norm[i], bound[i]))
        pick = pick[uids[pick] != query_uids[i]]
        if len(pick):
            scores = _products(q[i : i + 1], c[pick])[0]
            yield i, *_best(scores, ids[pick], k)


def _may_reach(q: np.ndarray, c: np.ndarray, norm: np.ndarray, query_norm: float, bound: float) -> np.ndarray:
    wide = min(len(q), c.shape[1])
    focus = np.argsort(-np.abs(q[:wide]))[:FOCUS]
    part = c[:, focus]
    rest = np.sqrt(np.maximum(query_norm**2 - (q[focus] ** 2).sum(), 0))
    other = np.sqrt(np.maximum(norm**2 - (part**2).sum(axis=1), 0))
    return part @ q[focus] + rest * other >= bound - 1e-9 * np.maximum(query_norm * norm, 1)


def routed(asked: DataFrame, blocks: DataFrame) -> DataFrame:
    """``asked`` once per group ``to`` that may hold a candidate long enough for one of its queries.

    ``need`` is the least length that helps a query block. Groups come longest first, so what a block needs is
    a prefix of them; its end is found among the largest lengths of at most ``MOST_LEVELS`` levels of groups.
    """
    groups = blocks.agg(F.max("group").alias("last")).first()["last"]
    if groups is None:
        return asked.select("*", F.lit(0).cast("bigint").alias("to")).where("false").drop("need")
    wide = -(-(groups + 1) // MOST_LEVELS)
    levels = blocks.groupBy(F.floor(F.col("group") / wide).alias("level")).agg(F.max("c_longest").alias("norm")).collect()
    ends = F.array(
        *[F.struct(F.lit(r["norm"]).alias("norm"), F.lit((r["level"] + 1) * wide).alias("end")) for r in levels]
    )
    reach = F.coalesce(F.array_max(F.transform(F.filter(ends, lambda e: e["norm"] >= F.col("need")), lambda e: e["end"])), F.lit(0))
    last = F.least(reach, F.lit(groups + 1)).cast("bigint")
    return asked.where(last > 0).select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last - 1)).alias("to")).drop("need")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest products, ties to the smaller vec_id.

    Both frames are ``quantised``, with the same ``uid`` for the same row. A query never meets its own row;
    other rows of its vec_id are candidates like any. Repeated query rows get a list each, repeated
    candidates each count. Vectors of fewer components end in zeros. Scores
    beyond a long are ranked and returned as the nearest long.
    """
    probe = vectors.orderBy(F.desc("norm"), "uid").limit(PROBE).select("uid", "vec_id", "v", "norm").collect()
    longest = _unpack(_block([tuple(r) for r in probe], "c").to_pylist()[0], "c") if probe else None

    def bounded(batches):
        for batch in batches:
            rows, needs = [], []
            for row in batch.to_pylist():
                query = _unpack(row, "q")
                bound = np.full(len(query[1]), -np.inf)
                for i, scores, _ in search_block(query, longest, bound, k):
                    if len(scores) >= k:
                        bound[i] = float(scores[-1]) * (1 - 1e-12 if scores[-1] > 0 else 1)
                rows.append(bound.astype("<f8").tobytes())
                least = np.where(bound > 0, bound / np.maximum(query[2], 1e-300), -np.inf) * (1 - 1e-9)
                needs.append(float(least.min(initial=np.inf)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rows, pa.binary()), pa.array(needs, pa.float64())],
                names=[*batch.schema.names, "bound", "need"],
            )

    asked = written(
        packed(queries, QUERY_BLOCK, "q").mapInArrow(bounded, _block_schema("q") + ", bound binary, need double"), "queries"
    )
    grouped = packed(vectors, BLOCK, "c", BLOCKS_IN_GROUP).withColumn("number", F.monotonically_increasing_id())
    blocks = written(grouped.select("*", F.shiftright("number", 33).alias("group")), "blocks")
    pairs = blocks.join(routed(asked, blocks), F.col("group") == F.col("to")).drop("group", "to", "number")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                query, block = _unpack(row, "q"), _unpack(row, "c")
                found = [
                    (int(query[0][i]), int(query[1][i]), int(x), int(s))
                    for i, scores, ids in search_block(query, block, np.frombuffer(row["bound"], "<f8"), k)
                    for s, x in zip(scores, ids)
                ]
                columns = zip(*found) if found else [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["uid", "query_id", "vec_id", "score"]
                )

    scored = pairs.mapInArrow(run, "uid bigint, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")  # k rows per block
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best candidates of every vector whose vec_id is divisible by 100."""
    vectors = written(quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet")), "vectors")
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


OP5_SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS uid, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.uid, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v AS q JOIN v AS c ON q.uid <> c.uid WHERE q.vec_id % {EVERY} = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
