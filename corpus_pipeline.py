"""From documents to packed sequences: language, toxicity, near copies, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows the stage before kept; its result is
written as Parquet and read again. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from alertloom.llm import langid, minhash, mixing, packing, toxicity
from alertloom.llm.common import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of the learned languages; drops those without a letter, and those the network cannot tell."""
    return langid.accepted(docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the lexicon, learned from the labelled ones that are left, calls toxic."""
    lexicon = toxicity.lexicon_from(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.with_toxicity(docs, lexicon).filter("predicted = 0").select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least doc_id of each group of near copies."""
    return minhash.one_of_each(docs).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and cuts sources to their targets; a row per copy taken."""
    return mixing.mix_documents(docs).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place."""
    return packing.pack(docs)


STAGES = [
    ("language ID", language),
    ("toxicity", toxic),
    ("MinHash near-dedup", near_copies),
    ("mixing sources to target weights", mix),
    ("packing", pack),
]

#: Fitted models and sketches cannot be stated in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
