"""A corpus pipeline: five stages from raw documents to token ids.

Each stage takes all documents its predecessor kept and returns the columns of
``documents``; the last returns token ids. Stages are written as Parquet under
the shared scratch folder and read again, which cuts their lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.llm import bpe, decontam, pii, simhash, toxicity
from trolley.llm.queries import VOCABULARY, table
from trolley.sources.store import Store


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being toxic is below the limit."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest
    doc_id."""
    return simhash.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages of any weight."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pseudonymize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, private values replaced by pseudonyms."""
    return pii.pseudonymize(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, with digests of the ids and of the bytes
    they decode to."""
    ranks = bpe.read_ranks(VOCABULARY)
    return bpe.decode(bpe.encode(docs, ranks), ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", pseudonymize),
    ("byte_bpe", encode),
]

# Hashed models and byte-pair merges have no SQL; the tests compare with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store.put(stage(spark, docs, sf_dir), name)
    return docs
