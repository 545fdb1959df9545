"""Mixing sources to target weights: hierarchical budgets and seeded token prefixes.

A token budget goes down a tree of domains, languages and sources. At each node the children share
it by weight, none beyond what its subtree can supply (its tokens times the allowed epochs); what
one cannot use its siblings take, and only what no sibling can use is left to the other branches.
Each leaf then reads its documents in a seeded order, anew for every epoch, until its budget is met.

The order is a hash, and its first three hex digits cut a leaf into 4,096 buckets whose token totals
tell which buckets are read whole, so only the one bucket in which a leaf's prefix ends is sorted.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.llm.common import WORD, documents, text_or_empty, written

LEVELS = ("domain", "lang", "source")


@dataclass(frozen=True)
class Mixture:
    """Integer weights by name (others have ``other``), the budget as a share of all tokens, epochs, seed."""

    weights: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    other: int = 1
    budget_percent: int = 60
    max_epochs: int = 3
    seed: int = 42


DOMAINS = 4
# Production weights. Domains are told by the number of a source, as the tables have no such column.
PRODUCTION = Mixture(
    weights={
        "domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
        "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
    }
)


def source_domain(source: str = "source") -> Column:
    number = F.coalesce(F.regexp_extract(source, "([0-9]+)$", 1).try_cast("bigint"), F.lit(0))
    return F.concat(F.lit("domain"), (number % DOMAINS).cast("string"))


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("bigint")


def _weight(level: str, mixture: Mixture) -> Column:
    known = mixture.weights.get(level, {})
    chosen = F.lit(mixture.other)
    for name, weight in known.items():
        chosen = F.when(F.col(level) == name, F.lit(weight)).otherwise(chosen)
    return chosen.cast("bigint")


def _share(nodes: DataFrame, parents: tuple[str, ...], level: str, mixture: Mixture) -> DataFrame:
    """``nodes`` (one per child, with capacity and the parent's ``budget``) with the child's own budget.

    Sorted by capacity over weight, the children that cannot use their share come first. The level up
    to which all others fill is the largest of the levels computed before each child.
    """
    weighted = nodes.withColumn("w", _weight(level, mixture))
    # One row per child: a window holds the names below one parent, not documents.
    group = Window.partitionBy(*parents)
    order = group.orderBy(F.try_divide("capacity", "w").asc_nulls_last(), level)
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    filled = weighted.withColumn("level", F.try_divide((F.col("budget") - before).cast("double"), rest.cast("double")))
    top = F.max("level").over(group)
    own = F.least("capacity", F.floor(F.col("w") * top + F.lit(1e-6)).cast("bigint"))
    return filled.withColumn("own", F.greatest(F.coalesce(own, F.lit(0)), F.lit(0)).cast("bigint")).drop(
        "w", "level", "budget"
    ).withColumnRenamed("own", "budget")


def leaf_budgets(supply: DataFrame, mixture: Mixture) -> DataFrame:
    """(domain, lang, source, supply, budget) from one row per leaf with its ``supply`` of tokens."""
    leaves = supply.withColumn("capacity", F.col("supply") * mixture.max_epochs)
    total = supply.agg(
        F.floor(F.coalesce(F.sum("supply"), F.lit(0)) * mixture.budget_percent / 100).cast("bigint").alias("budget")
    )
    budgets, parents = total, ()
    for depth, level in enumerate(LEVELS):
        names = LEVELS[: depth + 1]
        nodes = leaves.groupBy(*names).agg(F.sum("capacity").alias("capacity"), F.sum("supply").alias("supply"))
        if parents:
            above = budgets.select(*[F.col(p).alias(f"p_{p}") for p in parents], "budget")
            same = [F.col(p) == F.col(f"p_{p}") for p in parents]
            nodes = nodes.join(above, same).select(*nodes.columns, "budget")
        else:
            nodes = nodes.crossJoin(F.broadcast(budgets))  # one row
        budgets = _share(nodes, parents, level, mixture)
        parents = names
    return budgets.select(*LEVELS, "supply", "budget")


def _order(epoch: Column, mixture: Mixture) -> Column:
    return F.md5(F.concat_ws("-", F.lit(str(mixture.seed)), epoch.cast("string"), F.col("__key")))


def mix(
    docs: DataFrame, mixture: Mixture, *, domain: Column, tokens: Column, epoch: str = "epoch"
) -> DataFrame:
    """The chosen rows of ``docs``, all columns, plus ``epoch`` (from 0; a row may appear in several).

    A row is read while the tokens before it in its leaf's order are fewer than the leaf's budget, so a
    leaf overshoots by less than one document. Null languages and sources are a name of their own
    (empty); rows without a doc_id are ordered by the hash of their text (or together, without that
    column), and equal rows follow each other. An empty table gives none.
    """
    spare = F.md5("text") if "text" in docs.columns else F.lit("")
    placed = docs.drop(epoch).withColumns(
        {
            "__domain": F.coalesce(domain, F.lit("")),
            "__lang": F.coalesce("lang", F.lit("")),
            "__source": F.coalesce("source", F.lit("")),
            "__key": F.coalesce(F.col("doc_id").cast("string"), spare, F.lit("")),
            "__tokens": tokens,
        }
    )
    leaf = [F.col(f"__{level}").alias(level) for level in LEVELS]
    narrow = written(placed.select(*leaf, "__key", F.col("__tokens").alias("n")), "mixing")
    supply = narrow.groupBy(*LEVELS).agg(F.sum("n").alias("supply"))
    full = F.coalesce(F.floor(F.try_divide("budget", "supply")), F.lit(0)).cast("bigint")
    budgets = written(
        leaf_budgets(supply, mixture)
        .withColumn("whole", full)
        .withColumn("rest", F.col("budget") - F.col("whole") * F.col("supply")),
        "budgets",
    )
    # One row per leaf, written so that the planner knows its size: while that is small, no text is shuffled.
    cuts = written(
        _cuts(narrow, budgets, mixture).select(
            *[F.col(level).alias(f"__c_{level}") for level in LEVELS],
            *[F.col(c).alias(f"__{c}") for c in ("whole", "rest", "cut", "below")],
        ),
        "cuts",
    )
    same = [F.col(f"__{level}") == F.col(f"__c_{level}") for level in LEVELS]
    ranked = placed.join(cuts, same).withColumn("__order", _order(F.col("__whole"), mixture))
    bucket = F.substring("__order", 1, 3)
    names = [c for c in docs.columns if c != epoch]
    none = F.array().cast("array<bigint>")
    all_read = F.when(F.col("__whole") > 0, F.sequence(F.lit(0).cast("bigint"), F.col("__whole") - 1)).otherwise(none)
    in_prefix = (F.col("__rest") > 0) & (F.col("__cut").isNull() | (bucket < F.col("__cut")))
    last_read = F.when(in_prefix, F.array("__whole")).otherwise(none)
    certain = ranked.select(*names, F.explode(F.concat(all_read, last_read)).alias(epoch))
    order = (
        Window.partitionBy("__domain", "__lang", "__source")
        .orderBy("__order", "__tokens")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    at_cut = (
        ranked.where((F.col("__rest") > 0) & (bucket == F.col("__cut")))  # one bucket of a leaf
        .withColumn("__before", F.col("__below") + F.coalesce(F.sum("__tokens").over(order), F.lit(0)))
        .where("__before < __rest")
    )
    return certain.unionAll(at_cut.select(*names, F.col("__whole").alias(epoch)))


def _cuts(narrow: DataFrame, budgets: DataFrame, mixture: Mixture) -> DataFrame:
    """``budgets`` with the bucket in which the last epoch's prefix ends, and the tokens below it."""
    right = budgets.select(*[F.col(level).alias(f"b_{level}") for level in LEVELS], "whole", "rest")
    totals = (
        narrow.join(right, [F.col(level) == F.col(f"b_{level}") for level in LEVELS])
        .where("rest > 0")
        .withColumn("cut", F.substring(_order(F.col("whole"), mixture), 1, 3))
        .groupBy(*LEVELS, "rest", "cut")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy(*LEVELS).orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        totals.withColumn("below", F.coalesce(F.sum("n").over(order), F.lit(0)))
        .where((F.col("below") < F.col("rest")) & (F.col("below") + F.col("n") >= F.col("rest")))
        .select(*[F.col(level).alias(f"e_{level}") for level in LEVELS], "cut", "below")
    )
    return budgets.join(ends, [F.col(level) == F.col(f"e_{level}") for level in LEVELS], "left").select(
        *budgets.columns, "cut", "below"
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen documents of every leaf with the epoch that reads them, by the production weights."""
    counted = documents(spark, sf_dir).select("doc_id", "lang", "source", word_count().alias("n_tokens"))
    narrow = written(counted, "tokens")
    return mix(narrow, PRODUCTION, domain=source_domain(), tokens=F.col("n_tokens"))


def _weight_sql(level: str) -> str:
    known = "".join(f" WHEN {level} = '{k}' THEN {v}" for k, v in PRODUCTION.weights.get(level, {}).items())
    return f"CASE{known} ELSE {PRODUCTION.other} END" if known else str(PRODUCTION.other)


def _level_sql(level: str, parents: tuple[str, ...], above: str) -> str:
    names = ", ".join((*parents, level))
    by = f"PARTITION BY {', '.join(parents)} " if parents else ""
    join = f"JOIN {above} USING ({', '.join(parents)})" if parents else f"CROSS JOIN {above}"
    return f"""
  nodes_{level} AS (
    SELECT n.*, budget, {_weight_sql(level)} AS w
    FROM (SELECT {names}, sum(supply * {PRODUCTION.max_epochs})::BIGINT AS capacity, sum(supply)::BIGINT AS supply
          FROM leaves GROUP BY {names}) AS n {join}
  ), levels_{level} AS (
    SELECT *, (budget - coalesce(sum(capacity) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
              / (sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
    FROM nodes_{level} WINDOW o AS ({by}ORDER BY capacity / w, {level})
  ), top_{level} AS (
    SELECT *, max(level) OVER ({by}) AS top FROM levels_{level}
  ), budget_{level} AS (
    SELECT {names}, supply, greatest(least(capacity, floor(w * top + 1e-6)::BIGINT), 0) AS budget FROM top_{level}
  )"""


OP8_SQL = f"""
WITH counted AS (
  SELECT doc_id, lang, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n_tokens,
         'domain' || (coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT), 0) % {DOMAINS}) AS domain
  FROM documents
), leaves AS (
  SELECT domain, lang, source, sum(n_tokens)::BIGINT AS supply FROM counted GROUP BY ALL
), total AS (
  SELECT floor(sum(supply) * {PRODUCTION.budget_percent} / 100)::BIGINT AS budget FROM leaves
), {_level_sql("domain", (), "total")}, {_level_sql("lang", ("domain",), "budget_domain")
    .replace("n.*, budget", "n.*, budget_domain.budget")}, {_level_sql("source", ("domain", "lang"), "budget_lang")
    .replace("n.*, budget", "n.*, budget_lang.budget")}, epochs AS (
  SELECT c.*, budget // l.supply AS whole, budget % l.supply AS rest
  FROM counted AS c JOIN budget_source AS l USING (domain, lang, source) WHERE l.supply > 0
), ordered AS (
  SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source
                     ORDER BY md5('{PRODUCTION.seed}-' || whole || '-' || doc_id), n_tokens
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM epochs
)
SELECT doc_id, lang, source, n_tokens::BIGINT AS n_tokens, unnest(range(whole))::BIGINT AS epoch FROM ordered
UNION ALL
SELECT doc_id, lang, source, n_tokens::BIGINT, whole::BIGINT FROM ordered WHERE before < rest
"""
