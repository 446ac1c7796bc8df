"""The operators applied to the test tables: one query each, whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, licenses, merkle, minhash, pii, quality, simhash, spelling, substring, suffix_tree, topk, toxicity
from .queries_sql import SQL as SQL

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), bpe.read_ranks(VOCABULARY))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymize(rows, kinds_col="kinds").select(
        "doc_id",
        "text",
        F.size("kinds").cast("long").alias("n_private"),
        F.array_join(F.array_sort(F.array_distinct("kinds")), ",").alias("kinds"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.report(table(spark, sf_dir, "embeddings"))


def op8_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.report(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.report(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.report(table(spark, sf_dir, "documents"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.report(table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_licenses": op3_licenses,
    "op4_quality": op4_quality,
    "op5_pii": op5_pii,
    "op6_toxicity": op6_toxicity,
    "op7_topk": op7_topk,
    "op8_suffix_tree": op8_suffix_tree,
    "op9_decontamination": op9_decontamination,
    "op10_substring": op10_substring,
    "op11_spelling": op11_spelling,
    "op12_minhash": op12_minhash,
    "op13_merkle": op13_merkle,
}
