"""The manifest against a plain tree, on awkward rows and against its SQL."""

import plain
import pytest
from pyspark.sql import functions as F

from trolley.llm import merkle

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "height", "verified"]
ODD = [
    *plain.EDGES,
    (None, "no id", "en", "a", 1),
    (None, None, None, None, None),
    (9020, "Grüße AN Æ", "de", "é", 3),
    *[(9100 + i, f"Row {i}", "en", "hot", i) for i in range(300)],
    *[(9500, "SAME row", "en", "hot", 1)] * 40,
    (9600, "alone", "en", "lonely", 5),
]


def given(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def shown(docs):
    return sorted(map(tuple, merkle.report(docs).select(COLUMNS).collect()), key=str)


def test_plain_version(spark):
    docs = plain.documents(spark, ODD)
    for name in ("tree", "pos", "run", "key", "group", "digest", "path", "up", "members", "at"):
        docs = docs.withColumn(name, F.lit("x"))
    got = shown(docs)
    assert got == plain.merkle(given(docs))
    assert {row[-1] for row in got} == {True, False}


@pytest.mark.parametrize("n", [1, 15, 16, 17, 256, 257])
def test_sizes_of_a_single_source(spark, n):
    docs = spark.createDataFrame([(i, f"T{i}", "en", "s", 1) for i in range(n)], plain.SCHEMA)
    assert shown(docs) == plain.merkle(given(docs))


def test_many_sources(spark):
    docs = spark.createDataFrame([(i, f"T{i}", "en", f"s{i % 40}", 1) for i in range(90)], plain.SCHEMA)
    assert shown(docs) == plain.merkle(given(docs))


def test_empty_table(spark):
    assert shown(spark.createDataFrame([], plain.SCHEMA)) == []


def test_paths_lead_any_row_to_the_root_and_no_other(spark):
    docs = spark.createDataFrame([(i, f"T{i}", "en", "s", 1) for i in range(300)], plain.SCHEMA)
    found = merkle.manifest(docs, F.sha2(F.col("text"), 256), fanout=4)
    genuine = merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")
    forged = merkle.fold(F.col("presented"), F.col("path")) == F.col("root")
    assert found.filter(genuine).count() == 300
    assert found.filter(forged).count() == 0
    assert found.agg(F.countDistinct("position")).first()[0] == 300
