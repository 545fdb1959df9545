"""Exact substring dedup by hashing normalised units: lines, and the sentences of longer lines.

A unit is normalised (A-Z lower-cased, ASCII white space collapsed) and hashed to 128 bits. All units
of all documents are grouped by digest, and of each group the occurrence of the smallest (doc_id,
start) stays. Finding it is a partial aggregate; handing it back is a join with one row per digest on
one side, so a line that a third of all documents share is split by adaptive execution.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradewind.llm.common import documents, text_or_empty, written

LINE_WORDS, SENTENCE_WORDS = 5, 8  # shorter units are too common to tell anything
_SENTENCE = re.compile(r"[^.!?]+[.!?]*|[.!?]+")
_MASK = (1 << 64) - 1


def units(docs: DataFrame, line_words: int = LINE_WORDS, sentence_words: int = SENTENCE_WORDS) -> DataFrame:
    """(doc_id, copy, start, end, n_words, h1, h2) of the units of every whole text.

    ``start`` and ``end`` (exclusive) are code points of the original text. ``copy`` is a hash of the
    text; with the doc_id it names a row, so that rows with equal ids are told apart. A line's parts
    are units of their own if it has several. Null text has none; rows without a doc_id have no rank
    and give no units.
    """
    picked = docs.where("doc_id IS NOT NULL").select(
        "doc_id", F.xxhash64("text").alias("copy"), text_or_empty("text").alias("text")
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column("text")):
                own = _units(text.as_py(), line_words, sentence_words)
                found += own
                rows += [row] * len(own)
            start, end, words, h1, h2 = zip(*found) if found else ((),) * 5
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at),
                    batch.column("copy").take(at),
                    *(pa.array(c, pa.int64()) for c in (start, end, words, h1, h2)),
                ],
                names=["doc_id", "copy", "start", "end", "n_words", "h1", "h2"],
            )

    return picked.mapInArrow(
        run,
        f"doc_id {id_type}, copy bigint, start bigint, end bigint, n_words bigint, h1 bigint, h2 bigint",
    )


def _units(text: str, line_words: int, sentence_words: int) -> list[tuple[int, int, int, int, int]]:
    found, at = [], 0
    for line in text.split("\n"):
        _unit(found, line, at, line_words)
        parts = _SENTENCE.findall(line)
        if len(parts) > 1:
            inner = at
            for part in parts:
                _unit(found, part, inner, sentence_words)
                inner += len(part)
        at += len(line) + 1
    return found


def _unit(found: list, unit: str, at: int, least: int) -> None:
    words = unit.encode().lower().split()
    if len(words) >= least:
        digest = xxhash.xxh3_128_intdigest(b" ".join(words))
        found.append((at, at + len(unit), len(words), _signed(digest >> 64), _signed(digest & _MASK)))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def repeated_units(docs: DataFrame, **sizes: int) -> DataFrame:
    """Every unit but the first of its digest: doc_id, copy, start, end, n_words, kept_doc_id, kept_start.

    A repeat within one document counts like one across documents. Rows that repeat a whole document,
    ids included, have the same rank: they lose what any of them loses.
    """
    rows = written(units(docs, **sizes), "units")
    firsts = (
        rows.groupBy("h1", "h2")
        .agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "first.*")
        .select("k1", "k2", F.col("doc_id").alias("kept_doc_id"), F.col("start").alias("kept_start"))
    )
    return (
        rows.join(firsts, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")))
        .where("doc_id != kept_doc_id OR start != kept_start")
        .select("doc_id", "copy", "start", "end", "n_words", "kept_doc_id", "kept_start")
    )


def without_repeats(docs: DataFrame, **sizes: int) -> DataFrame:
    """``docs`` with the repeated units cut out of ``text``, plus ``removed``: their merged [start, end) spans.

    Text around the cuts is untouched, so the spans lead back to the original.
    """
    spans = (
        repeated_units(docs, **sizes)
        .groupBy("doc_id", "copy")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("removed"))
        .select(F.col("doc_id").alias("__id"), F.col("copy").alias("__copy"), "removed")
    )
    joined = docs.drop("removed").join(
        spans, (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__copy")), "left"
    )
    joined = joined.select(*[c for c in docs.columns if c != "removed"], "removed")
    text = joined.columns.index("text")

    def run(batches):
        for batch in batches:
            texts, spans = [], []
            for value, cuts in zip(batch.column(text).to_pylist(), batch.column("removed").to_pylist()):
                merged = _merged([(c["start"], c["end"]) for c in cuts or ()])
                texts.append(_cut(value, merged))
                spans.append([{"start": a, "end": b} for a, b in merged])
            arrays = list(batch.columns)
            arrays[text] = pa.array(texts, batch.schema.field(text).type)
            arrays[-1] = pa.array(spans, batch.schema.field(len(arrays) - 1).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return joined.mapInArrow(run, StructType(list(joined.schema.fields)))


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _cut(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    if not spans or text is None:
        return text
    edges = [0, *(x for span in spans for x in span), len(text)]
    return "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every repeated unit of all documents, with its place and the place of the occurrence that stays."""
    return repeated_units(documents(spark, sf_dir)).select(
        "doc_id", "start", "end", "n_words", "kept_doc_id", "kept_start"
    )


SPACE_CLASS = "[\\x20\\x09-\\x0D]+"
OP7_SQL = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS n
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), placed AS (
  SELECT doc_id, line, n, (sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY n) - length(line) - 1)::BIGINT AS start
  FROM lines
), parts AS (
  SELECT doc_id, n, start AS line_start, unnest(regexp_extract_all(line, '[^.!?]+[.!?]*|[.!?]+')) AS part,
         generate_subscripts(regexp_extract_all(line, '[^.!?]+[.!?]*|[.!?]+'), 1) AS k,
         len(regexp_extract_all(line, '[^.!?]+[.!?]*|[.!?]+')) AS parts
  FROM placed
), sentences AS (
  SELECT doc_id, part AS unit, parts,
         (line_start + sum(length(part)) OVER (PARTITION BY doc_id, n ORDER BY k) - length(part))::BIGINT AS start
  FROM parts
), units AS (
  SELECT doc_id, line AS unit, start, {LINE_WORDS} AS least FROM placed
  UNION ALL
  SELECT doc_id, unit, start, {SENTENCE_WORDS} FROM sentences WHERE parts > 1
), words AS (
  SELECT doc_id, start, start + length(unit) AS "end", least,
         list_filter(string_split_regex(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '{SPACE_CLASS}'), lambda w: w <> '') AS words
  FROM units
), ranked AS (
  SELECT doc_id, start, "end", len(words) AS n_words,
         first_value(doc_id) OVER same AS kept_doc_id, first_value(start) OVER same AS kept_start
  FROM words WHERE len(words) >= least
  WINDOW same AS (PARTITION BY array_to_string(words, ' ') ORDER BY doc_id, start)
)
SELECT doc_id, start, "end", n_words::BIGINT AS n_words, kept_doc_id, kept_start
FROM ranked WHERE doc_id <> kept_doc_id OR start <> kept_start
"""
