"""Corpus pipeline: documents to packed training sequences, one operator per stage.

Every stage reads all rows its predecessor kept. All but the last return the columns of documents;
the last returns the token pieces, their ids included, with their sequences.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tradewind.llm import mixing, packing, secret_scan, simhash, toxicity
from tradewind.llm.common import small_batches
from tradewind.session import shared_folder

# Equal weights at every level, nothing read twice: only branches with more than their share of nine
# tenths of the tokens are cut, all others stay whole.
MIXTURE = mixing.Mixture(budget_percent=90, max_epochs=1)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents judged toxic go; the model is fitted on the labelled ones."""
    docs = small_batches(docs)
    return toxicity.without_toxic(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, by the production shingle length and distance."""
    return simhash.keep_one_of_each(small_batches(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Matches of every rule are masked in the text; all documents stay."""
    return secret_scan.masked(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources that exceed their share of the budget are cut to it."""
    mixed = mixing.mix(
        docs, MIXTURE, domain=mixing.source_domain(), tokens=mixing.word_count(), epoch="__epoch"
    )
    return mixed.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of every document, token ids included, with their sequence and offset."""
    return packing.pack(packing.token_pieces(small_batches(docs)))


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixture),
    ("packing", packed),
]
# Fitted models, fingerprints and token ids have no SQL form; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        done = stage(spark, docs, sf_dir)
        done.write.parquet(path)
        docs = spark.read.schema(done.schema).parquet(path)
    return docs
