"""Katz backoff language model: Good-Turing discounted counts, exactly normalised backoff weights.

The corpus is read once into a table of batches, each with the sorted hashes of its distinct words and
its documents as numbers into them. Counting and evaluating then go through partitioned tables of
requests and answers: a batch asks each partition of the n-gram space about its own distinct n-grams,
the partition adds up the requests of all batches and answers in the order asked. So an n-gram
travels once per batch, however often it occurs, and no table is ever held as a whole.

* Unigram partitions are ranges of word hashes and answer with training counts and a number for each
  word, which is shorter than its hash.
* Bigram partitions are ranges of hashed history numbers and answer with the training count of each bigram
  and, per history, with what its backoff weight needs: how many successors were seen 1..K times
  and the unigram probability of all seen ones. A history with more than its share of the training
  tokens is salted by successor; the sums of these few histories (at most two per partition) are
  added up apart.

Each token is then evaluated recursively: a seen bigram by its discounted share, otherwise the
history's backoff weight times the unigram, which in turn gives unseen words the discounted mass.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import documents, text_or_empty, written
from tradewind.llm.features import mixed, scan, slices

K = 5  # counts up to here are discounted
BATCH_TOKENS, PART_TOKENS = 1 << 20, 1 << 20
END, LAST = np.uint64(0), np.uint64(0xFFFFFFFFFFFFFFFF)  # END is a hash that no word has
BEGIN = 0  # number of the history before a text's first token
HELD_OUT = 2


# --- numbers as bytes ----------------------------------------------------------------------------


def _counts_to_bytes(x: np.ndarray) -> bytes:
    """Non-negative integers in the narrowest type that holds them, byte by byte place, compressed."""
    most = int(x.max(initial=0))
    width = next(w for w in (1, 2, 3, 4, 8) if most < 1 << (8 * w) or w == 8)
    places = x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(places.T.tobytes())


def _counts_from_bytes(b: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:]), np.uint8).reshape(b[0], -1)
    places = np.zeros((raw.shape[1], 8), np.uint8)
    places[:, : b[0]] = raw.T
    return places.view("<i8").ravel()


def _hashes_to_bytes(x: np.ndarray) -> bytes:
    """Sorted hashes as their differences."""
    return _counts_to_bytes(np.diff(x, prepend=np.uint64(0)))


def _hashes_from_bytes(b: bytes) -> np.ndarray:
    return np.cumsum(_counts_from_bytes(b).view(np.uint64))


def _batch(names, *rows) -> pa.Table:
    return pa.table({n: pa.array(c, t) for (n, t), c in zip(names, rows)})


# --- batches -------------------------------------------------------------------------------------


def corpus_batches(docs: DataFrame) -> DataFrame:
    """(batch, doc_ids, held, sizes, vocabulary, tokens, ranks): the corpus as numbers, written once.

    Tokens are lower-cased words (A-Z, cut at ASCII white space) by 64-bit hash, then one end mark.
    """
    ident = F.crc32(F.col("doc_id").cast("string"))
    picked = docs.select(
        "doc_id", F.coalesce(ident % 7 == HELD_OUT, F.lit(False)).alias("held"), text_or_empty("text").alias("text")
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_ids array<{id_type}>, held binary, sizes binary, vocabulary binary, tokens binary, ranks binary"

    def run(batches):
        ids, held, sizes, words = [], [], [], []
        tokens = 0
        for batch in batches:
            for first, part in slices(batch.column("text")):
                s = scan(part)
                hashes = np.clip(s.hash, END + np.uint64(1), LAST)
                words.append(np.insert(hashes, s.first_word[1:], END))
                sizes.append(np.diff(s.first_word) + 1)
                ids += batch.column("doc_id")[first : first + len(part)].to_pylist()
                held += batch.column("held")[first : first + len(part)].to_pylist()
                tokens += len(words[-1])
                if tokens >= BATCH_TOKENS:
                    yield _packed(ids, held, sizes, words, batch.schema.field("doc_id").type)
                    ids, held, sizes, words, tokens = [], [], [], [], 0
                id_arrow = batch.schema.field("doc_id").type
        if ids:
            yield _packed(ids, held, sizes, words, id_arrow)

    rows = picked.mapInArrow(run, schema).withColumn("batch", F.monotonically_increasing_id())
    return written(rows, "batches")


def _packed(ids, held, sizes, words, id_type) -> pa.RecordBatch:
    vocabulary, tokens = np.unique(np.concatenate(words), return_inverse=True)
    # Frequent words get small numbers, which compress better.
    order = np.argsort(-np.bincount(tokens), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    parts = [
        _counts_to_bytes(np.array(held, dtype=np.int64)),
        _counts_to_bytes(np.concatenate(sizes)),
        _hashes_to_bytes(vocabulary),
        _counts_to_bytes(place[tokens]),
        _counts_to_bytes(order),
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array([ids], pa.list_(id_type)), *(pa.array([p], pa.binary()) for p in parts)],
        names=["doc_ids", "held", "sizes", "vocabulary", "tokens", "ranks"],
    )


@dataclass
class Batch:
    doc_ids: list
    held: np.ndarray
    sizes: np.ndarray
    vocabulary: np.ndarray
    tokens: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Batch:
        return cls(
            row["doc_ids"],
            _counts_from_bytes(row["held"]).astype(bool),
            _counts_from_bytes(row["sizes"]),
            _hashes_from_bytes(row["vocabulary"]),
            _counts_from_bytes(row["ranks"])[_counts_from_bytes(row["tokens"])],
        )

    @property
    def training(self) -> np.ndarray:
        """Of each token: whether its document is learnt from."""
        return np.repeat(~self.held, self.sizes)

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(history, successor, number of each token's pair); history ``len(vocabulary)`` begins a text."""
        wide = len(self.vocabulary) + 1
        history = np.r_[0, self.tokens[:-1]]
        history[np.cumsum(self.sizes) - self.sizes] = wide - 1
        pairs, place = np.unique(history * wide + self.tokens, return_inverse=True)
        return pairs // wide, pairs % wide, place


def _ranges(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Partition of each hash: equal ranges, so sorted hashes have sorted partitions."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _slices(part: np.ndarray):
    """(partition, start, end) of the runs of a sorted array."""
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.empty(0, np.int64)
    return zip(part[cuts].tolist(), cuts.tolist(), np.r_[cuts[1:], len(part)].tolist() if len(cuts) else [])


# --- unigrams ------------------------------------------------------------------------------------

_WORDS = "part bigint, batch bigint, words binary, counts binary"
_WORD_ANSWERS = (
    "part bigint, batch bigint, counts binary, numbers binary, types bigint, tokens bigint, " + ", ".join(f"n{r} bigint" for r in range(1, K + 2))
)


def word_answers(batches: DataFrame, parts: int) -> DataFrame:
    """Training counts and numbers (as differences) of every batch's words, by batch and partition.

    Each partition also has a row without a batch: its types, tokens and counts of counts.
    """

    def ask(rows):
        for got in rows:
            for row in got.to_pylist():
                b = Batch.of(row)
                counts = np.bincount(b.tokens[b.training], minlength=len(b.vocabulary))
                asked = [
                    (part, row["batch"], _hashes_to_bytes(b.vocabulary[x:y]), _counts_to_bytes(counts[x:y]))
                    for part, x, y in _slices(_ranges(b.vocabulary, parts))
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*asked), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                    names=["part", "batch", "words", "counts"],
                )

    names = [(f.split()[0], pa.binary() if f.split()[1] == "binary" else pa.int64()) for f in _WORD_ANSWERS.split(", ")]

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        words = [_hashes_from_bytes(r["words"]) for r in rows]
        own, place = np.unique(np.concatenate(words), return_inverse=True)
        counts = np.concatenate([_counts_from_bytes(r["counts"]) for r in rows])
        total = np.bincount(place, weights=counts, minlength=len(own)).astype(np.int64)
        cuts = np.cumsum([len(w) for w in words])[:-1]
        part, blank = rows[0]["part"], [None] * (K + 3)
        out = [
            (part, r["batch"], _counts_to_bytes(total[p]), _counts_to_bytes(np.diff(p, prepend=0)), *blank)
            for r, p in zip(rows, np.split(place, cuts))
        ]
        by_count = np.bincount(np.minimum(total, K + 2), minlength=K + 3)
        out.append((part, None, None, None, int((total > 0).sum()), int(total.sum()), *by_count[1 : K + 2].tolist()))
        return _batch(names, *zip(*out))

    return batches.mapInArrow(ask, _WORDS).groupBy("part").applyInArrow(answer, _WORD_ANSWERS)


# --- the model -----------------------------------------------------------------------------------


def discounts(counts_of_counts: list[int]) -> np.ndarray:
    """Katz's discount ratios for counts 1..K (index 0 is unused), from the numbers of n-grams seen 1..K+1 times.

    Where the plain Good-Turing estimates are no discounts (small or odd corpora), the numbers are first
    smoothed by a line through their logarithms, and if that does not help either, an absolute
    discount of n1 / (n1 + 2 n2) takes their place.
    """
    n = np.array([0, *counts_of_counts], dtype=np.float64)
    ratio = np.ones(K + 1)
    r = np.arange(1, K + 2)
    smooth = n.copy()
    if (n[1:] > 0).sum() > 1:
        slope, level = np.polyfit(np.log(r[n[1:] > 0]), np.log(n[1:][n[1:] > 0]), 1)
        smooth[1:] = np.exp(level + slope * np.log(r))
    for own in (n, smooth):
        if own[1:].all():
            top = (K + 1) * own[K + 1] / own[1]
            good = (r[1:] * own[2:] / (own[1:-1] * r[:-1]) - top) / (1 - top) if top < 1 else np.zeros(K)
            if (good > 0).all() and (good < 1).all():
                ratio[1:] = good
                return ratio
    take = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    ratio[1:] = 1 - take / r[:-1]
    return ratio


def _discounted(counts: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    return counts * np.where(counts <= K, ratio[np.minimum(counts, K)], 1.0)


@dataclass
class Unigrams:
    """Discounted unigrams; the mass taken from them is that of all unseen words."""

    types: int
    tokens: int
    ratio: np.ndarray
    unseen: float
    keep: float  # factor of the seen words, below 1 only if no count is small enough to be discounted

    @classmethod
    def of(cls, types: int, tokens: int, counts_of_counts: list[int]) -> Unigrams:
        ratio = discounts(counts_of_counts)
        taken = sum((1 - ratio[r]) * r * counts_of_counts[r - 1] for r in range(1, K + 1))
        if taken > 0:
            return cls(types, tokens, ratio, taken / tokens, 1.0)
        return cls(types, tokens, ratio, 1 / (tokens + 1), tokens / (tokens + 1))

    def probability(self, counts: np.ndarray) -> np.ndarray:
        seen = self.keep * _discounted(counts, self.ratio) / max(self.tokens, 1)
        return np.where(counts > 0, seen, self.unseen)


# --- bigrams -------------------------------------------------------------------------------------

_PAIRS = (
    "part bigint, batch bigint, histories binary, runs binary, successors binary, counts binary, "
    "history_counts binary, word_counts binary"
)
_PAIR_ANSWERS = (
    "part bigint, batch bigint, counts binary, once binary, mass binary, history bigint, "
    + ", ".join(f"n{r} bigint" for r in range(1, K + 2))
    + ", sum double"
)


_SEED = np.uint64(0x9E3779B97F4A7C15)


def _pair_parts(numbers, first: np.ndarray, second: np.ndarray, counts: np.ndarray, share: float, parts: int):
    """Partition of each bigram: the history's, or for a hot history one of as many as it fills."""
    hashed = mixed(numbers.astype(np.uint64) + _SEED)
    salts = np.maximum(np.ceil(counts[first] / share), 1).astype(np.int64)
    salt = (hashed[second] % salts.astype(np.uint64)).astype(np.int64)
    return (_ranges(hashed, parts)[first] + salt) % parts, salts > 1


def pair_answers(batches: DataFrame, words: DataFrame, unigrams: Unigrams, texts: int, parts: int) -> DataFrame:
    """Training counts of every batch's bigrams with the sums of their histories, by batch and partition.

    Rows without a batch have a history's sums if it is salted, and the partition's counts of counts
    (history null).
    """
    share = max(unigrams.tokens / parts, 1.0)

    def ask(_, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            b = Batch.of(row)
            counts, numbers = _word_counts(right, parts)
            counts, numbers = np.append(counts, texts), np.append(numbers, BEGIN)
            first, second, place = b.bigrams()
            seen = np.bincount(place[b.training], minlength=len(first))
            part, _hot = _pair_parts(numbers, first, second, counts, share, parts)
            order = np.argsort(part, kind="stable")
            for p, x, y in _slices(part[order]):
                own = order[x:y]
                starts = np.flatnonzero(np.r_[True, first[own][1:] != first[own][:-1]])
                history = first[own][starts]
                out.append(
                    (
                        p,
                        row["batch"],
                        _counts_to_bytes(numbers[history]),
                        _counts_to_bytes(np.diff(np.r_[starts, y - x])),
                        _counts_to_bytes(numbers[second[own]]),
                        _counts_to_bytes(seen[own]),
                        _counts_to_bytes(counts[history]),
                        _counts_to_bytes(counts[second[own]]),
                    )
                )
        return _batch(asked, *zip(*out)) if out else pa.table({n: pa.array([], t) for n, t in asked})

    kinds = {"bigint": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    asked = [(f.split()[0], kinds[f.split()[1]]) for f in _PAIRS.split(", ")]
    names = [(f.split()[0], kinds[f.split()[1]]) for f in _PAIR_ANSWERS.split(", ")]

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        histories = [_counts_from_bytes(r["histories"]) for r in rows]
        runs = [_counts_from_bytes(r["runs"]) for r in rows]
        first = np.concatenate([np.repeat(h, n) for h, n in zip(histories, runs)])
        second = np.concatenate([_counts_from_bytes(r["successors"]) for r in rows])
        seen = np.concatenate([_counts_from_bytes(r["counts"]) for r in rows])
        word = np.concatenate([_counts_from_bytes(r["word_counts"]) for r in rows])
        # Number the bigrams of the partition, then its histories.
        order = np.lexsort((second, first))
        f, s = first[order], second[order]
        new = np.r_[True, (f[1:] != f[:-1]) | (s[1:] != s[:-1])]
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        total = np.bincount(number, weights=seen).astype(np.int64)
        top = order[new]  # one place of each bigram
        own, of = np.unique(first[top], return_inverse=True)
        known = total > 0
        mass = np.bincount(of[known], weights=unigrams.probability(word[top][known]), minlength=len(own))
        once = np.stack(
            [np.bincount(of[total == r], minlength=len(own)) for r in range(1, K + 1)], axis=1
        )
        out, at = [], 0
        blank = [None] * (K + 3)
        for row, h, n in zip(rows, histories, runs):
            size = int(n.sum())
            pick = np.searchsorted(own, h)
            out.append(
                (
                    row["part"],
                    row["batch"],
                    _counts_to_bytes(total[number[at : at + size]]),
                    _counts_to_bytes(once[pick].ravel()),
                    mass[pick].astype("<f8").tobytes(),
                    *blank,
                )
            )
            at += size
        by_count = np.bincount(np.minimum(total, K + 2), minlength=K + 3)[1 : K + 2].tolist()
        part = rows[0]["part"]
        out.append((part, None, None, None, None, None, *by_count, None))
        count_of = np.zeros(len(own), np.int64)
        for row, h in zip(rows, histories):
            count_of[np.searchsorted(own, h)] = _counts_from_bytes(row["history_counts"])
        for i in np.flatnonzero(count_of > share):  # salted: this partition has a part of its successors
            out.append((part, None, None, None, None, int(own[i]), *once[i].tolist(), 0, float(mass[i])))
        return _batch(names, *zip(*out))

    requests = (
        batches.groupBy("batch").cogroup(words.groupBy("batch")).applyInArrow(ask, _PAIRS)
    )
    return requests.groupBy("part").applyInArrow(answer, _PAIR_ANSWERS)


def _word_counts(table: pa.Table, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts and numbers of a batch's words, from the answers of all its partitions."""
    rows = sorted(table.select(["part", "counts", "numbers"]).to_pylist(), key=lambda r: r["part"])
    numbers = [np.cumsum(_counts_from_bytes(r["numbers"])) * parts + r["part"] + 1 for r in rows]
    return np.concatenate([_counts_from_bytes(r["counts"]) for r in rows]), np.concatenate(numbers)


# --- scoring -------------------------------------------------------------------------------------


@dataclass
class Model:
    unigrams: Unigrams
    ratio: np.ndarray  # of bigrams
    texts: int  # learnt from
    parts: int
    hot: dict[int, tuple[list[int], float]]  # number of a salted history -> its successors by count, their mass

    def history_mass(self, counts: np.ndarray, once: np.ndarray, mass: np.ndarray):
        """(factor of seen successors, backoff weight) per history, so that all successors add up to one."""
        taken = once @ ((1 - self.ratio[1:]) * np.arange(1, K + 1))
        total = np.maximum(counts, 1)
        left = np.where(taken > 0, taken / total, 1 / (total + 1))
        keep = np.where(taken > 0, 1.0, total / (total + 1))
        return keep, left / np.maximum(1 - mass, 1e-300)

    def pair_probability(self, total, count, word_probability, keep, weight) -> np.ndarray:
        """P(successor | history): ``total`` of the bigram, ``count`` of the history."""
        seen = keep * _discounted(total, self.ratio) / np.maximum(count, 1)
        return np.where(count > 0, np.where(total > 0, seen, weight * word_probability), word_probability)


def _score(b: Batch, word_rows: pa.Table, pair_rows: list[dict], model: Model):
    words, numbers = _word_counts(word_rows, model.parts)
    counts, numbers = np.append(words, model.texts), np.append(numbers, BEGIN)
    share = max(model.unigrams.tokens / model.parts, 1.0)
    first, second, place = b.bigrams()
    part, hot = _pair_parts(numbers, first, second, counts, share, model.parts)
    order = np.argsort(part, kind="stable")
    total, once = np.empty(len(first), np.int64), np.zeros((len(first), K), np.int64)
    mass = np.empty(len(first))
    answers = {r["part"]: r for r in pair_rows}
    for p, x, y in _slices(part[order]):
        own, row = order[x:y], answers[p]
        total[own] = _counts_from_bytes(row["counts"])
        run = np.cumsum(np.r_[False, first[own][1:] != first[own][:-1]])
        once[own] = _counts_from_bytes(row["once"]).reshape(-1, K)[run]
        mass[own] = np.frombuffer(row["mass"], "<f8")[run]
    for h in np.unique(first[hot]):
        at = slice(*np.searchsorted(first, [h, h + 1]))
        once[at], mass[at] = model.hot[int(numbers[h])]
    keep, weight = model.history_mass(counts[first], once, mass)
    word_p = model.unigrams.probability(words)
    pair_p = model.pair_probability(total, counts[first], word_p[second], keep, weight)
    starts = np.cumsum(b.sizes) - b.sizes
    base = np.log10((words + 1) / (model.unigrams.tokens + model.unigrams.types + 1))
    return (
        np.add.reduceat((words > 0).astype(np.int64)[b.tokens], starts),
        np.add.reduceat(base[b.tokens], starts),
        np.add.reduceat(np.log10(pair_p)[place], starts),
    )


def score_texts(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the documents whose crc32(doc_id) modulo 7 is not 2 and scores all. Null text is empty
    (its only token is the end); rows without a doc_id are learnt from. ``base_score`` is the add-one
    unigram log10 probability, ``score`` that of the backoff model. Without training texts every word
    is unseen and has probability one.
    """
    batches = corpus_batches(docs)

    def tally(rows):
        for got in rows:
            for row in got.to_pylist():
                b = Batch.of(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(b.training.sum())]), pa.array([int((~b.held).sum())]), pa.array([len(b.tokens)])],
                    names=["trained", "texts", "tokens"],
                )

    sums = batches.mapInArrow(tally, "trained bigint, texts bigint, tokens bigint").agg(
        F.coalesce(F.sum("texts"), F.lit(0)).alias("texts"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")
    ).first()
    parts = max(1, -(-sums["tokens"] // PART_TOKENS))
    words = written(word_answers(batches, parts), "words")
    names = [f"n{r}" for r in range(1, K + 2)]
    total = (
        words.where("batch IS NULL")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("types", "tokens", *names)])
        .first()
    )
    unigrams = Unigrams.of(total["types"], total["tokens"], [total[n] for n in names])
    asked = words.where("batch IS NOT NULL").select("part", "batch", "counts", "numbers")
    pairs = written(pair_answers(batches, asked, unigrams, sums["texts"], parts), "pairs")
    apart = pairs.where("batch IS NULL")
    found = apart.where("history IS NULL").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).first()
    # At most two rows per partition: the shares of salted histories add up to the number of partitions.
    salted = apart.where("history IS NOT NULL").groupBy("history").agg(
        *[F.sum(n).alias(n) for n in names], F.sum("sum").alias("sum")
    )
    hot = {r["history"]: ([r[n] for n in names[:K]], r["sum"]) for r in salted.collect()}
    model = Model(unigrams, discounts([found[n] for n in names]), sums["texts"], parts, hot)
    blank = [F.lit(None).cast("binary").alias(c) for c in ("once", "mass")]
    answers = asked.select("part", "batch", "counts", "numbers", *blank, F.lit(True).alias("of_words")).unionAll(
        pairs.where("batch IS NOT NULL").select(
            "part", "batch", "counts", F.lit(None).cast("binary"), "once", "mass", F.lit(False)
        )
    )
    id_type = docs.schema["doc_id"].dataType

    def score(_, left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.to_pylist()
        if not rows:
            return empty
        b = Batch.of(rows[0])
        of_words = right.column("of_words")
        got = _score(b, right.filter(of_words), right.filter(pa.compute.invert(of_words)).to_pylist(), model)
        arrays = [pa.array(b.doc_ids, arrow_id), pa.array(b.held), pa.array(b.sizes), *map(pa.array, got)]
        return pa.table(dict(zip(empty.schema.names, arrays)))

    import pyarrow.compute  # noqa: F401
    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(id_type)
    empty = pa.schema(
        [
            ("doc_id", arrow_id),
            ("held_out", pa.bool_()),
            ("n_tokens", pa.int64()),
            ("n_known", pa.int64()),
            ("base_score", pa.float64()),
            ("score", pa.float64()),
        ]
    ).empty_table()
    schema = (
        f"doc_id {id_type.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint,"
        " base_score double, score double"
    )
    scored = batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(score, schema)
    return scored.withColumn("train_tokens", F.lit(total["tokens"]).cast("bigint"))


def op4_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backoff and baseline scores of every document."""
    return score_texts(documents(spark, sf_dir)).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
