"""MinHash near-duplicates against all pairs of texts."""

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from trolley.llm import minhash

ODD = [
    *plain.EDGES,
    (None, "same words here and here again, " * 30, "en", "a", 1),
    (None, None, None, None, None),
    (9040, "one", "en", "a", 1),
    (9041, "ONE\n", "en", "a", 1),
    (9042, "unlike texts", "en", "a", 1),
    (9042, "of a single id", "en", "a", 1),
]


def shown(docs):
    got = minhash.report(docs)
    return sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def copies(seed, n, words, edits):
    """Texts that differ from a common one, or from one another, in a few words."""
    rng = np.random.default_rng(seed)
    texts = [[f"w{x}" for x in rng.integers(0, 5000, words)]]
    while len(texts) < n:
        text = list(texts[int(rng.integers(0, min(len(texts), 12)))])
        for at in rng.integers(0, words, int(rng.integers(0, edits))).tolist():
            text[at] = f"x{rng.integers(0, 10**6)}"
        texts.append(text)
    return [(i, " ".join(t), "en", "a", 1) for i, t in enumerate(texts)]


def test_documents_and_odd_rows(spark):
    docs = plain.documents(spark, ODD)
    for name in ("id", "row", "n", "d1", "node", "key", "component", "bands", "members", "first"):
        docs = docs.withColumn(name, F.lit("x"))
    assert shown(docs) == plain.minhash([(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("seed, words, edits", [(1, 60, 9), (2, 200, 30), (3, 12, 3)])
def test_groups_around_the_limit(spark, seed, words, edits):
    rows = copies(seed, 250, words, edits)
    expected = plain.minhash([(doc, text) for doc, text, *_ in rows])
    assert shown(spark.createDataFrame(rows, plain.SCHEMA)) == expected
    assert 1 < len({row[2] for row in expected}) < len(rows)


def test_empty_table(spark):
    assert shown(spark.createDataFrame([], plain.SCHEMA)) == []


def test_limits_keep_similar_pairs_and_drop_others():
    rng = np.random.default_rng(0)
    limits = minhash.allowed(0.8)
    assert len(limits) == minhash.BATCHES
    kept = {}
    for s in (0.3, 0.8, 0.9):
        differing = (rng.random((20_000, minhash.BATCHES, minhash.BATCH)) < (1 - s) / 2).sum(2).cumsum(1)
        kept[s] = (differing <= limits).all(1).mean()
    assert kept[0.9] == kept[0.8] == 1
    assert kept[0.3] < 0.01


def test_parities_differ_in_no_more_bits_than_sets_in_shingles():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (40, 300, 3000)]
    sets += [np.unique(np.concatenate([s[5:], rng.integers(0, 1 << 63, 7, dtype=np.uint64)])) for s in sets]
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    words = minhash._signatures(np.concatenate(sets), first)[1][:, minhash.BATCHES :].astype(np.int64).view(np.uint64)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            flipped = sum(int(x ^ y).bit_count() for x, y in zip(words[i].tolist(), words[j].tolist()))
            assert flipped <= len(np.setxor1d(a, b))
            assert flipped == 0 if i == j else flipped > 0


def test_many_short_texts(spark):
    rows = [(i, f"t{i % 5000}", "en", "a", 1) for i in range(9000)]
    got = minhash.report(spark.createDataFrame(rows, plain.SCHEMA)).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(i, i % 5000) for i in range(9000)}


def test_posterior_falls_with_each_differing_bit():
    chances = [minhash.posterior(64, d, 0.8) for d in range(65)]
    assert chances == sorted(chances, reverse=True)
    assert 0 < chances[-1] < 1e-9 < 0.99 < chances[0] <= 1
