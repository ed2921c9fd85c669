"""From documents to packed training sequences, in stages.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before kept, and
returns a table that is written as Parquet and read again for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from streamsync.llm import language, mixing, ngram_join, packing, toxicity
from streamsync.llm.common import ship_package
from streamsync.scratch import work_dir

#: No source is repeated more than so often as the one that the mix passes over once.
REPETITIONS = 1.25


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a recognised language; a null text, one without letters, or one that scores
    less than right predictions of held-out rows do goes."""
    return language.keep_identified(docs, least=None)


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that are not judged toxic."""
    return toxicity.keep_civil(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return ngram_join.keep_first(docs)


def balanced(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their weights: every document once, those of small sources also again."""
    return mixing.mixed_documents(docs, repetitions=REPETITIONS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' pieces in sequences of 1024 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


def _shipped(stage):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language", _shipped(identified)),
    ("toxicity", _shipped(civil)),
    ("near duplicates", _shipped(unique)),
    ("mixing", _shipped(balanced)),
    ("packing", _shipped(sequences)),
]

#: A classifier's decisions are no SQL; the tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{work_dir(spark, 'stage')}/{name.replace(' ', '-')}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
