"""Secret scans over a trigram inverted index.

Each rule's regular expression is read once on the driver and turned into a Boolean trigram query: a
choice of sets of trigrams, one of which every match must hold completely. The index lists, for each
trigram that some rule asks for, the documents that hold it; intersecting these lists gives a rule's
candidates, and only their texts are matched. A rule without mandatory trigrams scans every text.
All of it is built-in SQL functions; offsets come from the lengths of matches and of the gaps between.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import documents, text_or_empty, written


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has at least ``least`` code points."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1


# Base kinds. For runs of one class of characters, asking for the least length inside the pattern
# gives the same spans as matching any run and dropping the short ones.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
    ),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[sr]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
    # Up to the END line; without one, up to the last line of base64.
    Rule(
        "private_key",
        r"""-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"""
        r"""(?:[A-Za-z0-9+/=\s\\:,"'-]*?-----END [A-Z ]{0,20}PRIVATE KEY-----"""
        r"""|(?:\s*Proc-Type:[^\n]*\s+DEK-Info:[^\n]*)?[\x20\t]*[A-Za-z0-9+/=\r\n\\]*(?![^\r\n"']))?""",
    ),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]+:[^\s/@]{3,}@"),
)
RULES = BASE + MORE
MASK = "[secret]"


# --- trigram queries -----------------------------------------------------------------------------

_MOST_CHOICES, _MOST_SET = 48, 5


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Sets of lower-case trigrams, one of which every match holds; None if a match may hold none."""
    done = _closed(_walk(sre_parser.parse(pattern), [(frozenset(), "")]))
    sets = {grams for grams, _ in done}
    if frozenset() in sets:
        return None
    return sorted((s for s in sets if not any(o < s for o in sets)), key=sorted)


def _closed(choices):
    """The literal run at the end of each choice cannot grow further: it becomes trigrams."""
    return list(
        dict.fromkeys((grams | {run[i : i + 3] for i in range(len(run) - 2)}, "") for grams, run in choices)
    )


def _walk(items, choices):
    """Choices (trigrams so far, literal run at the end) after the items of a parsed expression."""
    for op, value in items:
        if op is sre.LITERAL:
            choices = [(grams, run + chr(value).lower()) for grams, run in choices]
        elif op is sre.IN and (letters := _letters(value)):
            choices = _either(choices, [[(sre.LITERAL, ord(c))] for c in letters])
        elif op is sre.BRANCH:
            choices = _either(choices, value[1])
        elif op is sre.SUBPATTERN:
            choices = _walk(value[3], choices)
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, body = value
            if (low, high) == (0, 1):
                choices = _either(choices, [[], body])
            elif low and all(o is sre.LITERAL for o, _ in body):
                choices = _walk(list(body) * min(low, 8), choices)
                choices = choices if low == high <= 8 else _closed(choices)
            else:
                choices = _closed(_walk(body, choices)) if low else _closed(choices)
        elif op is not sre.AT:
            choices = _closed(choices)
        if len(choices) > _MOST_CHOICES:
            choices = _closed(choices)
    return choices


def _either(choices, branches):
    return list(dict.fromkeys(c for b in branches for c in _walk(b, choices)))


def _letters(members) -> list[str]:
    """The letters of a small set of single characters."""
    if len(members) > _MOST_SET or any(op is not sre.LITERAL for op, _ in members):
        return []
    return [chr(value) for _, value in members]


# --- the index -----------------------------------------------------------------------------------


def build_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc_id): which documents hold which of the trigrams that rules ask for."""
    wanted = F.array(*[F.lit(t) for t in trigrams])
    held = F.filter(wanted, lambda t: F.contains(F.col("lowered"), t))
    return (
        docs.where("doc_id IS NOT NULL")
        .select("doc_id", F.lower("text").alias("lowered"))
        .select("doc_id", F.explode(held).alias("trigram"))
    )


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(doc_id, rules): the rules for which a document holds all trigrams of some choice."""
    asked = [
        (rule, choice, trigram, 1 << bit, (1 << len(grams)) - 1)
        for rule, sets in queries.items()
        for choice, grams in enumerate(sets)
        for bit, trigram in enumerate(sorted(grams))
    ]
    table = index.sparkSession.createDataFrame(
        asked, "rule string, choice int, asked string, bit bigint, every bigint"
    )
    return (
        index.join(F.broadcast(table), F.col("trigram") == F.col("asked"))  # a few rows per rule
        .groupBy("doc_id", "rule", "choice", "every")
        .agg(F.bit_or("bit").alias("held"))
        .where("held = every")
        .groupBy("doc_id")
        .agg(F.collect_set("rule").alias("rules"))
    )


# --- matching ------------------------------------------------------------------------------------


def spans_of(text: Column, rule: Rule, number: int) -> Column:
    """Array of (start, number, kind, end) of a rule's matches, in code points, end exclusive."""
    pattern = F.lit(rule.pattern)
    both = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"),
        F.split(text, rule.pattern, -1).alias("gap"),  # one more than matches
    )
    empty = "array<struct<start:bigint,number:int,kind:string,end:bigint>>"
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(empty).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["found"]), F.lit(0))
        span = F.struct(
            begin.alias("start"), F.lit(number).alias("number"), F.lit(rule.name).alias("kind"), end.alias("end")
        )
        good = F.coalesce(F.length(x["part"]) >= rule.least, F.lit(False))
        return F.struct(
            end.alias("at"), F.when(good, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans")
        )

    return F.aggregate(both, start, step, lambda acc: acc["spans"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, name: str = "spans") -> DataFrame:
    """``docs`` with a column ``name``: all matches of all rules, by start, then in the order of the rules.

    Null text is empty. Rows without a doc_id are not in the index and are matched directly; rows with
    equal ids share their candidates, and each is matched by its own text.
    """
    queries = {r.name: q for r in rules if (q := trigram_query(r.pattern)) is not None}
    trigrams = sorted({t for q in queries.values() for s in q for t in s})
    own = [c for c in docs.columns if c != name]
    if trigrams:
        index = written(build_index(docs, trigrams), "trigrams")
        found = candidates(index, queries).select(F.col("doc_id").alias("__id"), F.col("rules").alias("__rules"))
        joined = docs.join(found, F.col("doc_id") == F.col("__id"), "left")
    else:
        joined = docs.withColumn("__rules", F.array().cast("array<string>"))
    text = text_or_empty("text")
    none = F.array().cast("array<struct<start:bigint,number:int,kind:string,end:bigint>>")
    parts = []
    for number, rule in enumerate(rules):
        likely = F.col("doc_id").isNull() | F.coalesce(F.array_contains("__rules", rule.name), F.lit(False))
        likely = likely if rule.name in queries else F.lit(True)
        hit = likely & text.rlike(rule.pattern)
        parts.append(F.when(hit, spans_of(text, rule, number)).otherwise(none))
    return joined.withColumn(name, F.array_sort(F.concat(*parts))).select(*own, name)


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def _count(number: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["number"] == number)).cast("bigint")


def masked(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` with every match in ``text`` replaced by a mark; ``n_chars``, if there, follows.

    Texts without a match stay as they are, null text too.
    """
    found = scan(docs, rules, "__spans")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.col("text").substr((acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        inside = s["start"] < acc["at"]  # overlaps the match before
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], gap, F.lit(MASK))).alias("out"),
        )

    def rest(acc: Column) -> Column:
        return F.concat(acc["out"], F.col("text").substr((acc["at"] + 1).cast("int"), F.length("text")))

    hit = F.size("__spans") > 0
    done = found.withColumn("__masked", F.when(hit, F.aggregate("__spans", start, step, rest)).otherwise(F.col("text")))
    changed = {"text": F.col("__masked")}
    if "n_chars" in docs.columns:
        length = F.length("__masked").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(hit, length).otherwise(F.col("n_chars"))
    return done.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns])


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    found = scan(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["number"] < len(BASE))
    counts = [_count(number).alias(f"n_{rule.name}") for number, rule in enumerate(BASE)]
    return found.select(
        "doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans")
    )
