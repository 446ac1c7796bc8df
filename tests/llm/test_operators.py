"""Each operator against its plain version, on given and on awkward rows."""

import base64
import math

import numpy as np
import plain
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from trolley.llm import bpe, decontam, licenses, pii, simhash, substring, suffix_tree, text, topk

EMPTY = []


@pytest.fixture(scope="module")
def docs(spark):
    return plain.documents(spark)


@pytest.fixture(scope="module")
def items(spark):
    given = spark.read.parquet(f"{plain.DATA}/benchmark.parquet")
    odd = [(901, None), (902, ""), (903, "TWO"), (904, "the of"), (None, "One"), (905, "here AGAIN same"), (905, "one")]
    return given.unionByName(spark.createDataFrame(odd, "item_id long, text string"))


def clash(docs):
    """Further columns with the names that operators use inside."""
    for name in ("id", "block", "shard", "data", "term", "fp", "node", "row", "component"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs


def listed(frame, *columns):
    return sorted(map(tuple, frame.select(*columns).collect()), key=str)


@pytest.mark.parametrize("hot", [64, 1])
def test_simhash(docs, hot, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", hot)
    prints, roots = plain.simhash(plain.rows(docs))
    got = simhash.report(clash(docs)).collect()
    assert len(got) == docs.count()
    for row in got:
        assert row.fingerprint == f"{prints[row.doc_id]:016x}"
        assert row.component_id == roots[row.doc_id]


@pytest.mark.parametrize("hot", [64, 2])
@pytest.mark.parametrize("distance", [0, 1, 2])
def test_simhash_links_connect_a_dense_cloud(spark, hot, distance, monkeypatch):
    from trolley.llm.components import connected
    from trolley.sources import Store

    monkeypatch.setattr(simhash, "HOT", hot)
    rng = np.random.default_rng(5)
    prints = {0: 0}
    while len(prints) < 250:
        value = list(prints.values())[int(rng.integers(len(prints)))]
        for bit in rng.integers(0, 64, int(rng.integers(1, 4))).tolist():
            value ^= 1 << bit
        if value not in prints.values():
            prints[len(prints)] = value
    signed = [(v - (1 << 64) if v >> 63 else v, n) for n, v in prints.items()]
    store = Store(spark)
    nodes = store.put(spark.createDataFrame(signed, "fp long, node long"), "nodes")
    found = dict(map(tuple, connected(simhash.links(nodes, store, distance), store).collect()))
    roots = plain.components(prints, distance)
    assert {n: found.get(n, n) for n in prints} == roots


def test_representatives(spark, docs):
    kept = simhash.representatives(clash(docs))
    _, roots = plain.simhash(plain.rows(docs))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots.values()))
    assert kept.columns == clash(docs).columns
    lost = spark.createDataFrame([(None, "a", "", "", 1), (None, "a", "", "", 1)], plain.SCHEMA)
    assert simhash.representatives(lost).count() == 2


def test_pieces_are_those_of_the_pattern():
    import pyarrow as pa
    import regex

    rng = np.random.default_rng(3)
    marks = list("ab'  \n\t's're llvd 12!?é漢 mdtv\x1c.　")
    texts = ["".join(rng.choice(marks, int(n))) for n in rng.integers(0, 40, 5000)]
    values, first = text.pieces(pa.chunked_array([texts]))
    spelt = [v.decode() for v in values.to_pylist()]
    pattern = regex.compile(public_tokenizers.PATTERN)
    for i, t in enumerate(texts):
        assert spelt[first[i] : first[i + 1]] == pattern.findall(t)


def test_bpe_is_tiktoken_and_decodes_to_the_text(docs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for doc, t in plain.rows(docs):
        ids = library.encode_ordinary(t)
        expected.append((doc, len(ids), plain.sha(",".join(map(str, ids)).encode()), plain.sha(t.encode())))
    got = bpe.digests(clash(docs), bpe.read_ranks(path))
    assert listed(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=str)


def test_decode_of_any_ids(spark):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    table = {v: k for k, v in bpe._tokens(ranks).items()}
    rows = spark.createDataFrame([(1, [5, 0, 50_000]), (2, []), (3, None)], "doc_id long, ids array<int>")
    got = {r.doc_id: bytes(r.decoded) for r in bpe.decode(rows, ranks).collect()}
    assert got == {1: table[5] + table[0] + table[50_000], 2: b"", 3: b""}


def test_licenses(docs):
    got = licenses.report(clash(docs))
    columns = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert listed(got, *columns) == sorted(plain.licenses(plain.rows(docs)), key=str)
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[9010].labels == "cc-by,mit,reserved" and by_id[9010].score == 1
    assert by_id[9011].labels == "apache-2.0,gpl"
    for row in by_id.values():
        assert 0 <= row.score <= 1 and set(row.base_labels.split(",")) <= {*row.labels.split(","), ""}


def test_license_with_words_put_in_and_left_out(spark):
    notice = "redistribution and use in source or any binary forms with or without modification are permitted"
    rows = spark.createDataFrame([(1, notice), (2, "use in source and binary"), (2, "")], "doc_id long, text string")
    got = {(r.doc_id, r.labels) for r in licenses.report(rows).collect()}
    assert got == {(1, "bsd"), (2, "")}


def test_license_split_over_diagonals(spark):
    """No diagonal holds half of the notice's 20 words, or the longest is at the edge."""
    words = licenses.NOTICES[3][1].split()
    assert len(words) == 20
    put_in = [*words[:7], "so", *words[7:14], "so", *words[14:]]
    left_out = [*words[:7], *words[8:14], *words[15:]]
    apart = [*words[:5], "so", "so", *words[5:12], "so", "so", *words[12:]]
    texts = [put_in, left_out, apart, words, words[:7]]
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.report(rows).collect()}
    assert got == {0: ("mit", 1.0), 1: ("mit", 0.9), 2: ("mit", 1.0), 3: ("mit", 1.0), 4: ("", 0.0)}
    spans = {r.doc_id: [(s.template, s["first"]) for s in r.spans] for r in licenses.scan(rows).collect()}
    assert spans == {0: [(6, 0)], 1: [(6, 0)], 2: [(6, 2)], 3: [(6, 0)], 4: []}


@pytest.mark.parametrize("rows_a_block", [3, 256])
def test_topk(spark, rows_a_block, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", rows_a_block)
    monkeypatch.setattr(topk, "GROUP_ROWS", 150)
    monkeypatch.setattr(topk, "CHUNK_QUERIES", 2)
    given = spark.read.parquet(f"{plain.DATA}/embeddings.parquet").select("vec_id", "embedding")
    some = given.filter("vec_id = 3").first().embedding
    odd = [(700, some), (701, some), (800, None), (900, [None, *some[1:]]), (1000, [math.nan, *some[1:]])]
    odd += [(1100, [math.inf, *some[1:]]), (1200, some[:5]), (1300, []), (1301, [100.0] * 64), (None, some)]
    vectors = given.unionByName(spark.createDataFrame(odd, "vec_id long, embedding array<float>"))
    held = [(r.vec_id, r.embedding) for r in vectors.collect() if r.vec_id is not None]
    got = topk.report(vectors.withColumn("id", F.lit(1)))
    assert listed(got, "query_id", "rank", "vec_id", "score") == sorted(plain.topk(held), key=str)
    few = vectors.filter("vec_id in (0, 1, 2)")
    assert topk.report(few).count() == 2


def test_suffix_tree_base(docs):
    got = suffix_tree.report(clash(docs)).collect()
    expected = plain.base_scores(plain.rows(docs))
    assert len(got) == len(expected)
    key = lambda r: (r[0], r[2])
    for row, want in zip(sorted(map(tuple, got), key=key), sorted(expected, key=key)):
        assert row[:5] == want[:5]
        assert row[5] == pytest.approx(want[5], rel=1e-9)


def test_longer_contexts_predict_held_out_texts_better(docs):
    held = F.col("doc_id") % 7 == 2
    scores = []
    for depth in (0, 1, 5):
        scored = suffix_tree.train_and_score(docs.filter("doc_id < 9000"), held, depth)
        scores.append(scored.filter("held_out").agg(F.sum("score")).first()[0])
    assert scores[0] < scores[1] < scores[2]


def test_suffix_tree_is_a_distribution(spark, docs):
    """In every state the probabilities of all symbols add up to one."""
    from trolley.sources import Store

    store = Store(spark)
    corpus = suffix_tree.pack(docs, F.lit(False), store)
    grams, _, _ = suffix_tree.count_pairs(corpus, store)
    tree = suffix_tree.learn(grams, store, least_share=1e-3)
    assert sum(len(c) for c in tree.contexts[1:]) > 10
    for length, contexts in enumerate(tree.contexts):
        for context in contexts.tolist()[:50]:
            pairs = np.array([context << 8 | s for s in range(256)])
            logs = tree.score(pairs, np.full(256, length))
            assert (10.0**logs).sum() == pytest.approx(1, abs=1e-9)


def test_suffix_tree_keeps_rare_contexts_of_a_large_corpus(spark):
    """A context seen 300 times is a state whatever else the corpus holds."""
    from trolley.sources import Store

    spell = lambda t: int.from_bytes(t.encode())
    for bulk in (10**3, 10**9):
        rows = [(spell("abcdef"), 5, 300), (spell("uvwxyz"), 5, bulk), (spell("uvwxyf"), 5, bulk)]
        tree = suffix_tree.learn(spark.createDataFrame(rows, "pair long, length int, n long"), Store(spark))
        assert spell("e") in tree.contexts[1].tolist()


def test_suffix_tree_joined_scores_are_those_of_the_whole_tree(spark, docs):
    from trolley.sources import Store

    store = Store(spark)
    corpus = suffix_tree.pack(docs, F.col("doc_id") % 7 == 2, store)
    grams, _, _ = suffix_tree.count_pairs(corpus, store)
    tree = suffix_tree.learn(grams, store)
    found = suffix_tree.chances(suffix_tree.states(grams, store)).toArrow()
    pairs = found["pair"].to_numpy()
    assert sorted(pairs) == sorted(r.pair for r in grams.collect())
    want = tree.score(pairs, np.full(len(pairs), suffix_tree.DEPTH))
    assert np.log10(found["chance"].to_numpy()) == pytest.approx(want, abs=1e-9)


def test_suffix_tree_first_pass_counts_pairs_without_a_table(spark, monkeypatch):
    """Pairs of held-out texts are known with no count; a bundle's blocks add up."""
    from collections import Counter

    from trolley.sources import Store

    def forbidden(*args, **kwargs):
        raise AssertionError("the first pass built a table of the symbols")

    monkeypatch.setattr(suffix_tree, "_piece", forbidden)
    monkeypatch.setattr(text.blocks, "__defaults__", (20,))
    texts = ["Ab ab  abc", "ab \u00e9\u00e9 ab", "", None, "zz held zz", "ab ab ab ab"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    corpus = suffix_tree.pack(rows, F.col("doc_id") == 4, Store(spark), depth=2)
    grams, tokens, _ = suffix_tree.count_pairs(corpus, Store(spark))
    want = Counter()
    for i, x in enumerate(texts):
        spelt = b"\n\n" + b"".join(w.encode() + b" " for w in (x or "").lower().split()) + b"\n"
        for at in range(2, len(spelt)):
            want[int.from_bytes(spelt[at - 2 : at + 1])] += i != 4
    assert {r.pair: r.n for r in grams.collect()} == dict(want)
    assert tokens == sum(len((x or "").split()) + 1 for i, x in enumerate(texts) if i != 4)


def test_suffix_tree_scores_do_not_depend_on_blocks(docs, monkeypatch):
    one = listed(suffix_tree.report(docs), "doc_id", "n_tokens", "n_known", "score")
    monkeypatch.setattr(text.blocks, "__defaults__", (5_000,))
    many = listed(suffix_tree.report(docs), "doc_id", "n_tokens", "n_known", "score")
    assert [r[:3] for r in one] == [r[:3] for r in many]
    assert [r[3] for r in one] == pytest.approx([r[3] for r in many], rel=1e-6)


def test_suffix_tree_tells_a_text_from_its_words_shuffled(spark):
    rows = [(i, "a b c d e f g h") for i in range(50)] + [(100, "a b c d e f g h"), (101, "h c a f d b g e")]
    scored = suffix_tree.train_and_score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") >= 100)
    by_id = {r.doc_id: r for r in scored.filter("held_out").collect()}
    assert by_id[100].base_score == pytest.approx(by_id[101].base_score)
    assert by_id[100].score > by_id[101].score + 1


def test_decontamination(docs, items):
    got = decontam.report(clash(docs), clash(items))
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    held = [(r.item_id, r.text or "") for r in items.collect()]
    assert listed(got, *columns) == sorted(plain.contamination(plain.rows(docs), held), key=str)


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon"
    texts = [item, "alpha beta x gamma delta y epsilon", "alpha one two three beta gamma delta epsilon", "epsilon"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_near) for r in decontam.report(docs, items).collect()}
    assert got == {0: (5, 1), 1: (0, 1), 2: (0, 0), 3: (0, 0)}


def test_clean_keeps_clean_documents(docs, items):
    held = [(r.item_id, r.text or "") for r in items.collect()]
    bad = {r[0] for r in plain.contamination(plain.rows(docs), held) if r[5]}
    kept = decontam.clean(clash(docs), items)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in plain.rows(docs) if d not in bad)


@pytest.mark.parametrize("block", [text.BLOCK_BYTES, 5_000])
def test_substring(docs, block, monkeypatch):
    monkeypatch.setattr(text.blocks, "__defaults__", (block,))
    got = substring.report(clash(docs))
    columns = ("doc_id", "n_words", "n_removed", "kept_sha256")
    assert listed(got, *columns) == sorted(plain.removed(plain.rows(docs)), key=str)


def test_substring_overlaps_and_ties(spark):
    rng = np.random.default_rng(2)
    long = " ".join(f"w{i}" for i in range(60))
    pieces = [" ".join(f"w{i}" for i in range(a, a + 25)) for a in (0, 5, 30)]
    rows = [(i, " ".join([f"v{i}", pieces[int(rng.integers(3))], f"u{i}", pieces[int(rng.integers(3))]])) for i in range(40)]
    rows += [(5, long), (5, long), (50, "z " * 45), (51, "z " * 20), (52, "z " * 19)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring.report(docs)
    assert listed(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(plain.removed(rows), key=str)


def test_empty_tables(spark):
    docs = spark.createDataFrame(EMPTY, plain.SCHEMA)
    items = spark.createDataFrame(EMPTY, "item_id long, text string")
    vectors = spark.createDataFrame(EMPTY, "vec_id long, embedding array<float>")
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    frames = [
        simhash.report(docs),
        simhash.representatives(docs),
        bpe.digests(docs, ranks),
        licenses.report(docs),
        pii.pseudonymize(docs),
        topk.report(vectors),
        suffix_tree.report(docs),
        decontam.report(docs, items),
        decontam.clean(docs, items),
        substring.report(docs),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)


def test_decontamination_without_items(spark, docs):
    items = spark.createDataFrame(EMPTY, "item_id long, text string")
    got = decontam.report(docs, items)
    assert got.filter("contaminated or n_hit > 0 or n_items > 0").count() == 0
    assert got.count() == docs.count()


def test_rows_without_an_id(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, None), (1, "a b c d"), (2**60 + 1, "x")], "doc_id long, text string")
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    items = spark.createDataFrame([(1, "b c")], "item_id long, text string")
    for frame in (
        bpe.digests(docs, ranks),
        simhash.report(docs),
        licenses.report(docs),
        suffix_tree.report(docs),
        decontam.report(docs, items),
        substring.report(docs),
    ):
        ids = sorted((r.doc_id for r in frame.collect()), key=str)
        assert ids == [1, 2**60 + 1, None, None]
    by_id = {r.doc_id: r.component_id for r in simhash.report(docs).collect()}
    assert by_id[1] == 1 and by_id[None] is None
