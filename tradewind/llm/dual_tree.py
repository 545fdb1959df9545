"""Ranked lexical search by dual trees: every item's best documents, exactly.

An item is a vector of (repeats x weight) per term, a document one of saturated term frequencies, and a
score is their product. Both sides form hierarchies: rows whose heaviest term is the same lie together,
leaves hold a few rows, and every node holds the maximum of its rows in each coordinate. The product of
two nodes' maxima bounds all scores between them, so a pair of nodes whose bound is below the weakest
k-th score of its items is dropped as one.

Documents are reduced once to the terms that items ask for and written in blocks; every task grows a
tree over each of its blocks and searches it with the same item tree, keeping what it has found as its
thresholds. They start from the k-th scores of a few blocks searched before, which can only be too low.
Items are the stated query set and go to the tasks in blocks of bounded size.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.llm.common import documents, text_or_empty, written
from tradewind.llm.features import slices

K = 10
ITEM_BLOCK = 8192  # items that go to the tasks together, on average
DOC_BLOCK, BLOCK_ENTRIES = 8192, 1 << 20  # documents and coordinates in a block
DOC_LEAF, DOC_FAN, ITEM_LEAF, ITEM_FAN = 4, 4, 1, 4
SEED_BLOCKS = 4  # blocks searched first, on average
LEAVES_AT_ONCE = 64
# Terms are runs of letters, digits and whatever is not ASCII; only A-Z is lower-cased.
_TERM = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM).split()


# --- documents as coordinates --------------------------------------------------------------------

_BLOCKS = (
    "n_docs bigint, n_terms bigint, ids array<bigint>, sizes binary, lengths binary, term binary, tf binary"
)


def coordinate_blocks(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Documents in blocks: id and number of terms of those that hold a term of the vocabulary, with its counts.

    ``n_docs`` and ``n_terms`` count all documents with a term, and their terms.
    """
    picked = docs.select(F.col("doc_id").cast("bigint"), text_or_empty("text").alias("text"))

    def run(batches):
        block = _Block()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, texts in slices(batch.column(1)):
                for i, text in enumerate(texts, start=first):
                    words = terms(text)
                    block.add(ids[i], len(words), Counter(filter(vocabulary.__contains__, words)), vocabulary)
                    if block.full():
                        yield block.row()
                        block = _Block()
        if block.n_docs:
            yield block.row()

    rows = picked.mapInArrow(run, _BLOCKS)
    return written(rows.withColumn("number", F.monotonically_increasing_id()), "coordinates")


class _Block:
    def __init__(self) -> None:
        self.n_docs = self.n_terms = 0
        self.ids, self.sizes, self.lengths, self.term, self.tf = [], [], [], [], []

    def add(self, doc_id, length: int, counts: Counter, vocabulary: dict[bytes, int]) -> None:
        self.n_docs += length > 0
        self.n_terms += length
        if counts:
            self.ids.append(doc_id)
            self.sizes.append(len(counts))
            self.lengths.append(length)
            self.term.extend(map(vocabulary.__getitem__, counts))
            self.tf.extend(counts.values())

    def full(self) -> bool:
        return len(self.ids) >= DOC_BLOCK or len(self.term) >= BLOCK_ENTRIES

    def row(self) -> pa.RecordBatch:
        columns = [
            pa.array([self.n_docs], pa.int64()),
            pa.array([self.n_terms], pa.int64()),
            pa.array([self.ids], pa.list_(pa.int64())),
            *(
                pa.array([np.array(c, dtype=t).tobytes()], pa.binary())
                for c, t in ((self.sizes, "<u4"), (self.lengths, "<i8"), (self.term, "<u4"), (self.tf, "<u4"))
            ),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _BLOCKS.split(", ")])


def document_frequencies(blocks: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary."""

    def run(batches):
        seen = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for term in batch.column(0):
                seen += np.bincount(np.frombuffer(term.as_buffer(), "<u4"), minlength=size)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"term": some, "df": seen[some]})

    parts = blocks.select("term").mapInArrow(run, "term bigint, df bigint")
    found = parts.groupBy("term").agg(F.sum("df").alias("df")).collect()  # at most the vocabulary
    df = np.zeros(size, dtype=np.int64)
    for r in found:
        df[r["term"]] = r["df"]
    return df


@dataclass
class Statistics:
    docs: int  # documents with a term
    terms: int  # all their terms
    weight: np.ndarray  # of each term of the vocabulary

    @classmethod
    def of(cls, docs: int, terms: int, df: np.ndarray) -> Statistics:
        weight = [math.floor(1000 * math.log((2 * docs + 2) / (2 * d + 1))) for d in df.tolist()]
        return cls(docs, terms, np.array(weight, dtype=np.int64))

    def saturated(self, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Frequencies that grow ever less with repeats, and less in long documents."""
        if 75 * int(length.max(initial=0)) * self.docs < 2**63:
            longer = 75 * length * self.docs // self.terms
        else:
            longer = np.array([75 * n * self.docs // self.terms for n in length.tolist()], dtype=np.int64)
        return 1_000_000_000 * tf // (1000 * tf + 8 * (25 + longer))


# --- trees ---------------------------------------------------------------------------------------


@dataclass
class Rows:
    """Sparse rows: ``term`` and ``value`` of row i lie from first[i] to first[i + 1]."""

    first: np.ndarray
    term: np.ndarray
    value: np.ndarray

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions of the entries of some rows, where each of these rows begins among them)."""
        size = self.first[rows + 1] - self.first[rows]
        begin = np.cumsum(size) - size
        return np.arange(int(size.sum())) + np.repeat(self.first[rows] - begin, size), begin

    def maxima(self, fan: int) -> Rows:
        """One row per ``fan`` rows: the largest value of each coordinate."""
        row = np.repeat(np.arange(len(self.first) - 1) // fan, np.diff(self.first))
        wide = int(self.term.max()) + 1
        key = row * wide + self.term
        order = np.argsort(key)
        key = key[order]
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        row, term = np.divmod(key[new], wide)
        count = -(-(len(self.first) - 1) // fan)
        return Rows(np.searchsorted(row, np.arange(count + 1)), term, np.maximum.reduceat(self.value[order], new))

    def taken(self, order: np.ndarray) -> Rows:
        at, begin = self.entries(order)
        return Rows(np.r_[begin, len(at)], self.term[at], self.value[at])

    def products(self, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Products of some rows (none without entries) with dense columns (term x column), or with one dense vector."""
        at, begin = self.entries(rows)
        column = self.value[at] if dense.ndim == 1 else self.value[at][:, None]
        return np.add.reduceat(column * dense[self.term[at]], begin, axis=0)


class Tree:
    """Rows with entries, ordered by their heaviest coordinate, and the maxima of ever larger groups of them."""

    def __init__(self, rows: Rows, heft: np.ndarray, leaf: int, fan: int) -> None:
        """``heft`` weighs the terms when the heaviest coordinate of a row is looked for."""
        weight = rows.value * heft[rows.term]
        size = np.diff(rows.first)
        most = np.flatnonzero(weight == np.repeat(np.maximum.reduceat(weight, rows.first[:-1]), size))
        top = most[np.searchsorted(most, rows.first[:-1])]
        self.order = np.lexsort((-weight[top], rows.term[top]))
        self.rows = rows.taken(self.order)
        self.fan, self.leaf = fan, leaf
        self.levels = [self.rows.maxima(leaf)]  # of leaves first, of the root last
        while len(self.levels[-1].first) > 2:
            self.levels.append(self.levels[-1].maxima(fan))

    def children(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """Nodes of the level below, or rows below leaves."""
        fan = self.fan if level else self.leaf
        size = len((self.levels[level - 1] if level else self.rows).first) - 1
        below = (nodes[:, None] * fan + np.arange(fan)).ravel()
        return below[below < size]


class Items:
    """The tree over the items of a block, with their numbers."""

    def __init__(self, numbers: list[int], queries: list[Counter], statistics: Statistics) -> None:
        """``queries``: repeats of each term (its place in the vocabulary)."""
        live = [i for i, q in enumerate(queries) if q]
        sizes = [len(queries[i]) for i in live]
        term = np.array([t for i in live for t in queries[i]], dtype=np.int64)
        times = np.array([c for i in live for c in queries[i].values()], dtype=np.int64)
        rows = Rows(np.r_[0, np.cumsum(sizes, dtype=np.int64)].astype(np.int64), term, times * statistics.weight[term])
        self.tree = Tree(rows, np.ones(len(statistics.weight), np.int64), ITEM_LEAF, ITEM_FAN) if live else None
        self.numbers = [numbers[live[i]] for i in self.tree.order] if live else []


# --- search --------------------------------------------------------------------------------------


class Search:
    """The best documents so far of every item, over any number of blocks."""

    def __init__(self, items: Items, statistics: Statistics, k: int, least: np.ndarray) -> None:
        """``least``: scores that the k-th best of each item is known to reach, at least 1."""
        self.items, self.statistics, self.k = items, statistics, k
        self.weakest = least.copy()
        self.best: list[list[tuple]] = [[] for _ in items.numbers]  # (-score, no id, id)
        self.dense = np.zeros(len(statistics.weight), dtype=np.int64)
        self.scored = 0

    def block(self, row: dict) -> None:
        lengths = np.frombuffer(row["lengths"], "<i8")
        sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
        term, tf = (np.frombuffer(row[c], "<u4").astype(np.int64) for c in ("term", "tf"))
        if not len(sizes) or not self.items.numbers:
            return
        value = self.statistics.saturated(tf, np.repeat(lengths, sizes))
        self.docs = Tree(
            Rows(np.r_[0, np.cumsum(sizes)], term, value), self.statistics.weight, DOC_LEAF, DOC_FAN
        )
        self.ids = [row["ids"][i] for i in self.docs.order.tolist()]
        top = len(self.docs.levels) - 1
        self._pair(len(self.items.tree.levels) - 1, 0, top, np.arange(len(self.docs.levels[top].first) - 1))

    def _items_of(self, level: int, node: int) -> slice:
        wide = ITEM_LEAF * ITEM_FAN**level
        return slice(node * wide, (node + 1) * wide)

    def _pair(self, item_level: int, item_node: int, doc_level: int, doc_nodes: np.ndarray) -> None:
        """An item node against document nodes of one level: drops what cannot matter and goes down on both sides."""
        items = self.items.tree.levels[item_level]
        at = slice(items.first[item_node], items.first[item_node + 1])
        self.dense[items.term[at]] = items.value[at]
        bound = self.docs.levels[doc_level].products(doc_nodes, self.dense)
        self.dense[items.term[at]] = 0
        own = self._items_of(item_level, item_node)
        near = bound >= self.weakest[own].min()
        if not near.any():
            return
        doc_nodes, bound = doc_nodes[near], bound[near]
        if item_level == 0 and doc_level == 0:
            self._leaves(item_node, doc_nodes, bound)
            return
        below = self.docs.children(doc_level, doc_nodes) if doc_level else doc_nodes
        if item_level == 0:
            self._pair(0, item_node, doc_level - 1, below)
            return
        for child in self.items.tree.children(item_level, np.array([item_node])).tolist():
            self._pair(item_level - 1, child, max(doc_level - 1, 0), below)

    def _leaves(self, item_leaf: int, doc_leaves: np.ndarray, bound: np.ndarray) -> None:
        """Scores of the items of a leaf in document leaves, most promising first."""
        items, own = self.items.tree.rows, self._items_of(0, item_leaf)
        rows = np.arange(len(self.items.numbers))[own]
        at, begin = items.entries(rows)
        terms_here, place = np.unique(items.term[at], return_inverse=True)
        table = np.zeros((len(terms_here), len(rows)), dtype=np.int64)
        table[place, np.repeat(np.arange(len(rows)), np.diff(np.r_[begin, len(at)]))] = items.value[at]
        self.dense[terms_here] = np.arange(-len(terms_here), 0)  # rows of the table, counted from its end
        by = np.argsort(-bound, kind="stable")
        doc_leaves, bound = doc_leaves[by], bound[by]
        for a in range(0, len(doc_leaves), LEAVES_AT_ONCE):
            some = doc_leaves[a : a + LEAVES_AT_ONCE][bound[a : a + LEAVES_AT_ONCE] >= self.weakest[own].min()]
            if not len(some):
                break
            docs = self.docs.children(0, some)
            entry, first = self.docs.rows.entries(docs)
            which = self.dense[self.docs.rows.term[entry]]
            hit = np.flatnonzero(which)
            scores = np.zeros((len(docs), len(rows)), dtype=np.int64)
            if len(hit):
                of = np.searchsorted(first, hit, side="right") - 1
                new = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
                product = self.docs.rows.value[entry[hit]][:, None] * table[which[hit]]
                scores[of[new]] = np.add.reduceat(product, new, axis=0)
            self.scored += scores.size
            for i, column in zip(rows.tolist(), scores.T):
                near = np.flatnonzero(column >= self.weakest[i])
                if len(near):
                    self._found(i, column[near].tolist(), docs[near].tolist())
        self.dense[terms_here] = 0

    def _found(self, item: int, scores: list[int], docs: list[int]) -> None:
        ids = [self.ids[d] for d in docs]
        new = [(-s, d is None, d or 0) for s, d in zip(scores, ids)]
        best = self.best[item] = sorted(self.best[item] + new)[: self.k]
        if len(best) == self.k:
            self.weakest[item] = max(self.weakest[item], -best[-1][0])

    def found(self) -> pa.RecordBatch:
        rows = [
            (number, None if none else doc, -score)
            for number, best in zip(self.items.numbers, self.best)
            for score, none, doc in best
        ]
        columns = zip(*rows) if rows else [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"])


def _searched(blocks: DataFrame, items: Items, statistics: Statistics, k: int, least: np.ndarray) -> DataFrame:
    """(item, rank, doc_id, score): each item's best documents of some blocks that reach ``least``."""

    def run(batches):
        search = Search(items, statistics, k, least)
        for batch in batches:
            for i in range(batch.num_rows):
                search.block(batch.slice(i, 1).to_pylist()[0])
        yield search.found()

    found = blocks.select("ids", "sizes", "lengths", "term", "tf").mapInArrow(run, "item bigint, doc_id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of every item with the highest scores above 0.

    The whole texts count. Equal scores go by doc_id (cast to a long; rows without one come last). Repeated
    documents each count, repeated items get a list each, null and empty texts have no terms, and empty
    tables give none. Items are searched for in blocks, each with a pass over the documents.
    """
    asked = written(
        items.select("item_id", text_or_empty("text").alias("text"), F.monotonically_increasing_id().alias("item")), "items"
    )
    number = max(1, -(-asked.count() // ITEM_BLOCK))
    kind = items.schema["item_id"].dataType.simpleString()
    parts = []
    for n in range(number):
        block = asked.where(F.pmod(F.xxhash64("item"), F.lit(number)) == n)
        found = _block_of_items(docs, block.select("item", "text").collect(), k)  # about ITEM_BLOCK rows
        if found is not None:
            own = block.select(F.col("item").alias("of"), "item_id")
            parts.append(found.join(own, F.col("item") == F.col("of")).select("item_id", "rank", "doc_id", "score"))
    if not parts:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole


def _block_of_items(docs: DataFrame, rows: list, k: int) -> DataFrame | None:
    counts = [Counter(terms(r["text"].encode())) for r in rows]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
    if not vocabulary:
        return None
    blocks = coordinate_blocks(docs, vocabulary)
    total = blocks.agg(
        F.count(F.lit(1)).alias("blocks"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_docs", "n_terms")],
    ).first()
    if not total["n_terms"]:
        return None
    statistics = Statistics.of(total["n_docs"], total["n_terms"], document_frequencies(blocks, len(vocabulary)))
    queries = [Counter({vocabulary[t]: c for t, c in q.items()}) for q in counts]
    tree = Items([r["item"] for r in rows], queries, statistics)
    least = np.ones(len(tree.numbers), dtype=np.int64)
    deal = -(-total["blocks"] // SEED_BLOCKS)
    if deal > 1:
        first = blocks.where(F.pmod(F.xxhash64("number"), F.lit(deal)) == 0)
        place = {number: i for i, number in enumerate(tree.numbers)}
        for r in _searched(first, tree, statistics, k, least).where(F.col("rank") == k).collect():  # one per item
            least[place[r["item"]]] = r["score"]
    return _searched(blocks, tree, statistics, k, least)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP12_SQL = r"""
WITH doc_terms AS (
  SELECT row_number() OVER () AS uid, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), sizes AS (
  SELECT uid, doc_id, len(terms)::BIGINT AS n FROM doc_terms WHERE len(terms) > 0
), totals AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS all_terms FROM sizes
), item_terms AS (
  SELECT item, item_id, term, count(*)::BIGINT AS times FROM (
    SELECT row_number() OVER () AS item, item_id,
      unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
  ) GROUP BY item, item_id, term
), frequencies AS (
  SELECT uid, term, count(*)::BIGINT AS tf FROM (SELECT uid, unnest(terms) AS term FROM doc_terms)
  WHERE term IN (SELECT term FROM item_terms) GROUP BY uid, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM frequencies, totals GROUP BY term
), scored AS (
  SELECT i.item, i.item_id, s.uid, s.doc_id,
    sum(i.times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // all_terms))))::BIGINT AS score
  FROM item_terms AS i JOIN weights USING (term) JOIN frequencies AS f USING (term) JOIN sizes AS s USING (uid), totals
  GROUP BY i.item, i.item_id, s.uid, s.doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
