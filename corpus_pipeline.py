"""A corpus from raw documents: toxicity, exact and near duplicates, source mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostgrain.llm.bin_slack import pack_documents
from hostgrain.llm.exact_dedup import keep_one_copy
from hostgrain.llm.parity_join import keep_one_of_each
from hostgrain.llm.source_mix import mixed_documents
from hostgrain.llm.storage import table, written
from hostgrain.llm.toxic_chain import toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier chain doesn't reject."""
    judged = toxicity(docs, table(spark, sf_dir, "labels"), keep=docs.columns)
    return judged.where(~F.col("rejected")).select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id."""
    return keep_one_copy(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar sets of five-word shingles, the one with the smallest doc_id."""
    return keep_one_of_each(docs, k=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's share of the mix takes it: not at all, once or twice."""
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 2048 tokens."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("source_mix", mix),
    ("packing", pack),
]

#: A trained classifier and a tokenizer can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in sf_dir, each result stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
