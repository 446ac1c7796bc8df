"""Spelling variants against all pairs of words."""

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from trolley.llm import spelling

ODD = [
    *plain.EDGES,
    (None, "Grüßendes GRÜßendes grüßendes STRASSENBAHN strassenbahn", "de", "a", 1),
    (9030, "tarpaulin " * 40 + "tarpulin tarpulin tarpaulins tarpaulins tarpaullin tarpaullin", "en", "a", 1),
    (9031, "aaaaaaa aaaaaaa aaaaaaaa aaaaaaaa aaaaaaaaa aaaaaaaaa aaabaaa aaabaaa", "en", "a", 1),
    (9032, "x" * 300 + " " + "x" * 301 + " " + "x" * 300 + " " + "x" * 301, "en", "a", 1),
]


def shown(frame):
    return sorted(map(tuple, frame.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_words_and_forms_of_documents(spark):
    docs = plain.documents(spark, ODD)
    counts = plain.words_of([(r.doc_id, r.text or "") for r in docs.collect()])
    for name in ("word", "n", "key", "side", "block", "run", "doc", "h"):
        docs = docs.withColumn(name, F.lit("x"))
    assert shown(spelling.report(docs)) == plain.spelling(counts)


def cloud(seed, letters, lengths, n):
    """Words of few letters, so that most have near ones at every place."""
    rng = np.random.default_rng(seed)
    words = {"".join(rng.choice(list(letters), int(rng.integers(*lengths)))) for _ in range(n)}
    return {w: int(10 ** rng.uniform(0.4, 5)) for w in sorted(words)}


@pytest.mark.parametrize("block_words", [1 << 15, 64])
@pytest.mark.parametrize("letters, lengths", [("ab", (1, 9)), ("abcé", (5, 9)), ("abcdefghij", (7, 9))])
def test_dense_vocabularies(spark, letters, lengths, block_words):
    counts = cloud(3, letters, lengths, 900)
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert shown(spelling.variants(frame, block_words=block_words)) == plain.spelling(counts)


def test_a_prefix_that_fills_many_blocks(spark):
    counts = {"internationally" + w: n for w, n in cloud(5, "abc", (1, 7), 700).items()}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert shown(spelling.variants(frame, block_words=64)) == plain.spelling(counts)


def test_chains_of_forms(spark):
    chain = [("w" * 7 + "abcdefgh"[:i], 2 * 10**i) for i in range(9)]
    frame = spark.createDataFrame(chain, "word string, n long")
    assert {r.root for r in spelling.variants(frame).collect()} == {chain[-1][0]}


def test_empty_table(spark):
    assert spelling.report(spark.createDataFrame([], plain.SCHEMA)).collect() == []


def test_scan_skips_ranges_out_of_reach():
    words = sorted(f"{a}{b}{c}xyzuvw" for a in "abc" for b in "abc" for c in "abc")
    got = {w: sorted(near) for w, near in spelling.scan(words, ["abcaxyzuvw"[:4] + "xyzuvw"])}
    assert got == {}
    assert dict(spelling.scan(["abcdefg", "abcdefh"], ["abcdefg"])) == {"abcdefh": ["abcdefg"]}
