"""MinHash near-duplicates with sequential Bayesian verification.

A text's set are its distinct shingles of ``shingle`` words, A-Z lower-cased, cut
by white space; the whole sequence where it has fewer words. Two texts are linked
if the Jaccard similarity of their sets is ``percent`` or more, and a component
is what links connect, named by its smallest doc_id. A text without words has an
empty set, is linked with nothing and is a component by itself.

Candidates. Rows with equal sets collapse to one node. A node's signature has
``BANDS`` bands of ``ROWS`` minima; nodes that agree on a whole band share its
bucket. At the least similarity, 0.8, two nodes miss each other in all 40 bands of 5
with a probability of 1.3e-7, at 0.85 of 7e-11.

Verification. One bit of each minimum agrees with probability (1 + s) / 2 at
similarity s. Bits are compared in batches of 64: after each, a pair is
dropped if, given the bits so far and a uniform prior, the posterior
probability that s reaches the limit is below ``MISS``. A parity sketch, one bit per
shingle flipped at its hash, then bounds the sets' difference: it differs in no
more bits than the sets in shingles, so that what it rules out is no link for
certain. What survives is verified on the full sets (64-bit hashes of the
shingles).

Large buckets. Links only matter between components. First the members of each
bucket are compared with two members of it, stars instead of all pairs, and
nodes take the label of the smallest node that they are linked to: equal labels
are in one component, and most of a group of near copies has one, whatever its size.
Last, members of a bucket that have different labels are compared with one another,
the batches being part of the join's condition, so that only survivors become rows and a
large bucket is split by the skew join. No bucket is capped and no link between
components is left out.

Null texts count as empty. Rows without an id are linked like others and keep a
null component, ``kept`` false. Repeated rows give repeated results; rows of one
id with unlike texts are judged each by its text. Ids must cast to long. Further
columns are of no account. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.store import Store
from .components import connected, follow
from .text import SOLID, blocks, bound_batches, mix, numbered, rolled, words

BANDS, ROWS = 40, 5
BATCH, BATCHES = 64, 4
MINIMA = BATCH * BATCHES  # the bands use the first of them
PARITIES = 8  # words of the parity sketch
TEXTS = 2048  # whose signatures are made at once
MISS = 1e-7
SHINGLE = 2
PERCENT = 80
SEED = 42
BITS = [f"s{i}" for i in range(BATCHES)]
FLIPS = [f"p{i}" for i in range(PARITIES)]


@lru_cache(1)
def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(SEED)
    factors = draw.integers(1 << 31, dtype=np.uint32, size=MINIMA) * np.uint32(2) + np.uint32(1)
    return factors, draw.integers(1 << 32, dtype=np.uint32, size=MINIMA)


def _sets(texts: pa.ChunkedArray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of all texts, sorted in each text, and
    each text's first, the end included."""
    found = words(texts, SOLID, lower=True)
    names, which = numbered(found.values())
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(w, SEED) for w in names.to_pylist()), np.uint64, len(names))
    each, counts = hashed[which], np.diff(found.first)
    runs = np.maximum(counts - shingle + 1, 0)
    owner = np.repeat(np.arange(len(counts)), runs)
    begins = np.cumsum(runs) - runs
    at = np.arange(len(owner)) + np.repeat(found.first[:-1] - begins, runs)
    shingles = [rolled(each, shingle, SEED)[at]]
    owners = [owner]
    for size in range(1, shingle):  # whole sequences of fewer words
        short = np.flatnonzero(counts == size)
        shingles.append(rolled(each, size, SEED + 2 * size)[found.first[short]] if len(short) else np.zeros(0, np.uint64))
        owners.append(short)
    hashes, owner = np.concatenate(shingles), np.concatenate(owners)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[fresh], owner[fresh]
    return hashes, np.searchsorted(owner, np.arange(len(counts) + 1))


def _digests(hashes: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Two sums over each set that tell unequal sets apart."""
    full = np.flatnonzero(np.diff(first))
    result = []
    for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        sums = np.zeros(len(first) - 1, np.uint64)
        if len(full):
            sums[full] = np.add.reduceat(mix(hashes ^ np.uint64(salt)), first[full])
        result.append(sums.view(np.int64))
    return result


def _signatures(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts, BANDS) keys of the bands, and (texts, BATCHES + PARITIES) words of
    bits and parities."""
    texts = len(first) - 1
    full = np.flatnonzero(np.diff(first))
    minima = np.zeros((MINIMA, texts), np.uint32)
    if len(full):
        short, at = (hashes >> np.uint64(32)).astype(np.uint32), first[full] - first[0]
        for i, (factor, shift) in enumerate(zip(*_multipliers())):
            minima[i, full] = np.minimum.reduceat(short * factor + shift, at)
    keys = np.zeros((texts, BANDS), np.uint64)
    bits = np.zeros((texts, MINIMA), np.uint8)
    with np.errstate(over="ignore"):
        for row in range(MINIMA):
            bits[:, row] = mix(minima[row] + (np.uint64(row + 1) << np.uint64(32))) & np.uint64(1)
        for band in range(BANDS):
            key = np.full(texts, band + 1, np.uint64)
            for row in range(band * ROWS, (band + 1) * ROWS):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + minima[row])
            keys[:, band] = key
    width = 64 * PARITIES
    place = np.repeat(np.arange(texts), np.diff(first)) * width + (hashes % np.uint64(width)).astype(np.int64)
    flips = (np.bincount(place, minlength=texts * width) & 1).astype(np.uint8).reshape(texts, width)
    words_ = [np.packbits(part, axis=1).view(np.int64) for part in (bits, flips)]
    return keys.view(np.int64), np.ascontiguousarray(np.concatenate(words_, axis=1))


def sketches(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, d1, d2, bits, parities, bands) of each row: size and digests of its
    set, words of its sketches, band keys of its signature."""
    bound_batches(docs.sparkSession)
    numbers = ["id", "n", "d1", "d2", *BITS, *FLIPS]
    schema = pa.schema([*((c, pa.int64()) for c in numbers), ("bands", pa.list_(pa.int64()))])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches, "text"):
            hashes, first = _sets(rows["text"], shingle)
            ids, sizes, digests = rows["id"].combine_chunks(), np.diff(first), _digests(hashes, first)
            for a in range(0, len(sizes), TEXTS):
                some = slice(a, a + TEXTS)
                edges = first[a : a + TEXTS + 1]
                keys, marks = _signatures(hashes[edges[0] : edges[-1]], edges)
                held = sizes[some] > 0
                ends = np.concatenate([[0], np.cumsum(held * BANDS)]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[held].ravel()))
                columns = [ids[some], pa.array(sizes[some]), *(pa.array(d[some]) for d in digests)]
                columns += [pa.array(np.ascontiguousarray(marks[:, i])) for i in range(marks.shape[1])]
                yield pa.RecordBatch.from_arrays([*columns, bands], schema=schema)

    kinds = ", ".join(f"{c} long" for c in numbers) + ", bands array<long>"
    return _given(docs, id_col, text_col).mapInArrow(sketch, kinds)


def full_sets(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(n, d1, d2, members) of the rows with words, equal sets of a partition once;
    ``members`` is the sorted set."""
    bound_batches(docs.sparkSession)
    schema = pa.schema([*((c, pa.int64()) for c in ("n", "d1", "d2")), ("members", pa.list_(pa.int64()))])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for rows in blocks(batches, "text"):
            hashes, first = _sets(rows["text"], shingle)
            digests = _digests(hashes, first)
            members = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(hashes.view(np.int64)))
            fresh = []
            for at, both in enumerate(zip(*(d.tolist() for d in digests))):
                if first[at] < first[at + 1] and both not in seen:
                    seen.add(both)
                    fresh.append(at)
            whole = pa.RecordBatch.from_arrays([*map(pa.array, (np.diff(first), *digests)), members], schema=schema)
            yield whole.take(pa.array(fresh, pa.int64()))

    return _given(docs, id_col, text_col).mapInArrow(listed, "n long, d1 long, d2 long, members array<long>")


def _given(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def posterior(bits: int, differing: int, similarity: float) -> float:
    """Probability that two sets reach ``similarity``, if ``differing`` of ``bits``
    signature bits differ and all similarities were equally likely before."""

    def above(share: float) -> float:  # of the beta distribution of the agreeing bits' share
        agree = bits - differing
        return sum(comb(bits + 1, k) * share**k * (1 - share) ** (bits + 1 - k) for k in range(agree + 1))

    return above((1 + similarity) / 2) / above(0.5)


@lru_cache(8)
def allowed(similarity: float, miss: float = MISS) -> list[int]:
    """After each batch, the most differing bits with which a pair stays."""
    limits = []
    for batch in range(1, BATCHES + 1):
        bits = batch * BATCH
        limits.append(max(d for d in range(bits + 1) if posterior(bits, d, similarity) >= miss))
    return limits


def _differing(a: str, b: str, columns: list[str]) -> list[Column]:
    return [F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in columns]


def _may_link(a: str, b: str, percent: int, miss: float) -> Column:
    """Sizes fit, no batch of bits rules the pair out, nor does the number of
    shingles that differ at least: a similarity of p percent leaves at most
    (100 - p) / (100 + p) of both sizes."""
    n = F.col(f"{a}.n"), F.col(f"{b}.n")
    tests = [100 * F.least(*n) >= percent * F.greatest(*n)]
    differing = F.lit(0)
    for batch, limit in zip(_differing(a, b, BITS), allowed(percent / 100, miss)):
        differing = differing + batch
        tests.append(differing <= limit)
    least = sum(_differing(a, b, FLIPS)[1:], _differing(a, b, FLIPS)[0])
    tests.append((100 + percent) * least <= (100 - percent) * (n[0] + n[1]))
    return reduce(Column.__and__, tests)


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    miss: float = MISS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_shingles, component) of each row."""
    store = Store(docs.sparkSession)
    sketched = sketches(docs, shingle, id_col, text_col)
    marked = store.put(sketched.withColumn("row", F.monotonically_increasing_id()), "sketches")
    same = ["n", "d1", "d2"]
    classes = marked.filter("n > 0").groupBy(*same).agg(F.min("row").alias("node"), F.min("id").alias("first"))
    classes = store.put(classes, "classes")
    nodes = marked.join(classes.select(F.col("node").alias("row")), "row", "left_semi")
    nodes = store.put(nodes.select(F.col("row").alias("node"), "n", *BITS, *FLIPS, "bands"), "nodes")
    marks = nodes.select("node", "n", *BITS, *FLIPS)

    in_band = nodes.select("node", F.explode("bands").alias("key"))
    shared = in_band.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    shared = store.put(shared.filter("low < high"), "buckets")
    members = store.put(in_band.join(shared, "key"), "members")
    full = _candidate_sets(docs, members, classes, shingle, id_col, text_col, store)

    def likely(pairs: DataFrame) -> DataFrame:
        both = pairs.join(marks.alias("x"), F.col("a") == F.col("x.node")).join(marks.alias("y"), F.col("b") == F.col("y.node"))
        return both.filter(_may_link("x", "y", percent, miss)).select("a", "b")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """The pairs whose full sets reach the limit."""
        left = full.select(F.col("node").alias("a"), F.col("members").alias("ours"))
        right = full.select(F.col("node").alias("b"), F.col("members").alias("theirs"))
        both = store.put(pairs, name).join(left, "a").join(right, "b")
        common = F.size(F.array_intersect("ours", "theirs"))
        union = F.size("ours") + F.size("theirs") - common
        return store.put(both.filter(100 * common >= percent * union).select("a", "b"), f"{name}_links")

    # each node with the smallest and the largest member of its buckets
    ends = members.select(F.col("node").alias("a"), F.explode(F.array("low", "high")).alias("b"))
    links = verified(likely(ends.filter("a <> b").distinct()), "ends")
    # the label of a node is the smallest it is linked with, and where that leads;
    # once more for labels
    down = lambda edges: edges.groupBy("a").agg(F.min("b").alias("b"))
    labels = follow(down(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))), store)
    labels = _relabelled(labels, follow(down(_contracted(links, labels)), store), store)
    # all members of a bucket that have different labels still
    placed = members.select("key", "node").join(labels, "node", "left")
    placed = store.put(placed.select("key", "node", F.coalesce("label", "node").alias("label")), "placed")
    mixed = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = store.put(mixed.filter("low < high").select("key"), "mixed")
    rest = store.put(placed.join(mixed, "key").join(marks, "node"), "rest")
    pairs = rest.alias("x").join(
        rest.alias("y"),
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.node") < F.col("y.node"))
        & (F.col("x.label") != F.col("y.label"))
        & _may_link("x", "y", percent, miss),
    )
    pairs = pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    links = links.unionByName(verified(pairs, "rest"))
    moves = connected(_contracted(links, labels), store).select("node", F.col("component").alias("label"))
    labels = _relabelled(labels, moves, store)

    ended = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    ended = store.put(ended, "ended")
    least = store.put(ended.groupBy("label").agg(F.min("first").alias("least")), "least")
    named = ended.join(least, "label").select(*same, "least")
    result = marked.select("id", *same).join(named, same, "left")
    label = F.when(F.col("id").isNotNull(), F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("least")))
    return result.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), label.alias("component"))


def _contracted(links: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b), a > b: the different labels that the links connect."""
    ours = labels.select(F.col("node").alias("a"), F.col("label").alias("of_a"))
    theirs = labels.select(F.col("node").alias("b"), F.col("label").alias("of_b"))
    both = links.join(ours, "a", "left").join(theirs, "b", "left")
    both = both.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")).filter("a <> b")
    return both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _relabelled(labels: DataFrame, moves: DataFrame, store: Store) -> DataFrame:
    """``labels`` (node, label) after labels have ``moves`` (node, label) themselves.
    A label that moves is no labelled node so far."""
    ahead = moves.select(F.col("node").alias("label"), F.col("label").alias("next"))
    moved = labels.join(ahead, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    return store.put(moved.unionByName(moves), "labels")


def _candidate_sets(
    docs: DataFrame, members: DataFrame, classes: DataFrame, shingle: int, id_col: str, text_col: str, store: Store
) -> DataFrame:
    """(node, members) of the nodes that share a bucket: their texts are read
    again, which moves fewer bytes than keeping the sets of all. Their number
    grows with the table's, so the join is one by shuffle at every size. Sets
    repeat, for rows that repeat, at most once in each partition."""
    wanted = store.put(members.select("node").distinct(), "wanted")
    wanted = store.put(classes.join(wanted, "node"), "wanted_classes")
    ids = wanted.select(F.col("first").alias("_first")).distinct()
    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    chosen = chosen.join(ids.hint("merge"), F.col("id").eqNullSafe(F.col("_first")), "left_semi")
    found = full_sets(chosen, shingle, "id", "text").join(wanted.select("n", "d1", "d2", "node"), ["n", "d1", "d2"])
    return store.put(found.select("node", "members"), "sets")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    found = near_duplicates(docs)
    same = F.coalesce(F.col("doc_id") == F.col("component"), F.lit(False))
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"), same.alias("kept"))
