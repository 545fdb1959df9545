"""The operators' registered queries and, where SQL can express one, its DuckDB counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradewind.llm import (
    dual_tree,
    histogram_packing,
    katz,
    lines,
    mixing,
    packing,
    quality,
    secret_scan,
    simhash,
    suffix,
    topk,
    toxicity,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": simhash.op1_simhash,
    "op2_quality": quality.op2_quality,
    "op3_packing": packing.op3_packing,
    "op4_katz": katz.op4_katz,
    "op5_topk": topk.op5_topk,
    "op6_secrets": secret_scan.op6_secrets,
    "op7_lines": lines.op7_lines,
    "op8_mixing": mixing.op8_mixing,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_suffix": suffix.op10_suffix,
    "op11_whitening": whitening.op11_whitening,
    "op12_ranked_search": dual_tree.op12_ranked_search,
    "op13_spfhp": histogram_packing.op13_spfhp,
}
ORACLE_SQL: dict[str, str] = {
    "op5_topk": topk.OP5_SQL,
    "op7_lines": lines.OP7_SQL,
    "op8_mixing": mixing.OP8_SQL,
    "op12_ranked_search": dual_tree.OP12_SQL,
}
