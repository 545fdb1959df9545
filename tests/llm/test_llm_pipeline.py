from __future__ import annotations

import inspect

import corpus_pipeline
import pytest

from awkward_rows import AWKWARD
from tradewind.llm import toxicity


def test_stages_call_their_operators():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "secrets", "mixing", "packing",
    ]
    assert all(len(inspect.signature(f).parameters) == 3 for _, f in corpus_pipeline.STAGES)


def test_each_stage_works_on_what_the_one_before_kept(spark, sample, tmp_path):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    columns, kept = docs.columns, {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sample).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        assert name == "packing" or docs.columns == columns
    assert kept["near_duplicates"] < kept["toxicity"]
    assert kept["secrets"] == kept["near_duplicates"]
    assert kept["mixing"] < kept["secrets"] and kept["packing"] == kept["mixing"]


def test_run_gives_every_kept_document(spark, sample):
    rows = corpus_pipeline.run(spark, sample).collect()
    assert {"doc_id", "piece", "sequence_id", "offset"} <= rows[0].asDict().keys()
    assert max(r.offset + r.length for r in rows) <= 1024


@pytest.mark.parametrize("number", range(5))
def test_awkward_rows_and_empty_tables(spark, awkward, nothing, sample, number, monkeypatch):
    monkeypatch.setattr(toxicity, "fit", lambda docs, labels: toxicity.Model())
    _, stage = corpus_pipeline.STAGES[number]
    done = stage(spark, awkward, sample)
    assert done.count() >= (5 if number in (1, 3) else len(AWKWARD))
    assert number == 4 or done.columns == awkward.columns
    assert stage(spark, nothing, sample).count() == 0
