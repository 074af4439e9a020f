"""From documents to packed training sequences: each stage takes what the one before
kept, written as Parquet and read again.

Null and empty texts pass toxicity, the join (they are in no group), redaction and the mix
(size 0, copies by its rule) and are packed as their end id. Rows that repeat an id are
documents of their own throughout, those that repeat id and text are one after the join;
null ids stay null. An empty table gives an empty table at every stage. Further columns,
whatever their names, stay until packing, which returns pieces."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tableprep.llm import mixing, packing, pii, simjoin, toxicity
from tableprep.llm.common import documents
from tableprep.session import scratch_dir


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't reject."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, documents(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of the n-gram Jaccard join: stages on word shingles
    take five words and a similarity of 0.8 or more."""
    return simjoin.keep_one(docs, n=5, num=80, den=100)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by marks."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 2048 ids."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 1)


STAGES = [("toxicity", toxic), ("ngram_jaccard_join", near_duplicates), ("pii", personal_data), ("mixing", mix), ("packing", pack)]

#: No SQL: the chain's training, the byte-pair encoding and the column generation have none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    folder = scratch_dir(spark, f"pipeline-{uuid.uuid4().hex[:12]}")
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
