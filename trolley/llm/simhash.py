"""SimHash near-duplicates by multi-index hashing.

Texts with A-Z lower-cased are cut into words by white space and into shingles
of ``shingle`` words, repeats included (the whole text where it has fewer
words). A fingerprint bit is set if it is set in more than half of the
shingles' XXH64 hashes with seed 42; a text without words has fingerprint 0,
which links like any other.

Search. Equal fingerprints collapse to one row first. A fingerprint has two
segments of 32 bits; two fingerprints at most ``max_distance`` apart are near
in one of them, so each probes the tables of both segments with a small Hamming
ball and the full distance of what it meets is checked. In a bucket with over
``HOT`` fingerprints pairs would grow with the square of its size; those who
meet such a bucket enumerate the ball of radius 1 around the whole fingerprint
instead: two of them share a key exactly if they are at most 2 apart, and one
link to the key's smallest holder keeps them connected. No link is lost.

Null texts count as empty. Rows without an id get a fingerprint but no
component. Repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import Store
from .components import connected
from .text import SOLID, blocks, bound_batches, output, words

HOT = 64
SEGMENT = 32


def fingerprints(
    docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, fp long) of each row; fp holds the 64 bits as a signed number."""
    bound_batches(docs.sparkSession)
    result = pa.schema([("id", pa.int64()), ("fp", pa.int64())])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches, "text"):
            yield output(result, id=rows["id"].combine_chunks(), fp=_sketches(rows["text"], shingle).view(np.int64))

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        sketch, "id long, fp long"
    )


def _sketches(texts: pa.ChunkedArray, shingle: int) -> np.ndarray:
    found = words(texts, SOLID, lower=True)
    data, offsets = found.spaced()
    counts = np.diff(found.first)
    shingles = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    begins = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(shingles, out=begins[1:])
    left = np.arange(begins[-1]) + np.repeat(found.first[:-1] - begins[:-1], shingles)
    right = left + np.repeat(np.minimum(counts, shingle), shingles)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(data[a:b], 42) for a, b in zip(offsets[left].tolist(), (offsets[right] - 1).tolist())),
        np.uint64,
        len(left),
    )
    fps = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(shingles)
    if len(full):
        at = begins[:-1][full]
        for bit in range(64):
            ones = np.add.reduceat((hashes >> np.uint64(bit)) & np.uint64(1), at)
            fps[full] |= (2 * ones > shingles[full].astype(np.uint64)).astype(np.uint64) << np.uint64(bit)
    return fps


def _balls(max_distance: int) -> list[int]:
    """Radius of the ball for each of the two segments, or -1 for none: if the
    first segment differs in more than its radius and the second too, the whole
    differs in more than ``max_distance``."""
    radius, spare = divmod(max_distance, 2)
    return [radius, radius if spare else radius - 1]


def links(fps: DataFrame, store: Store, max_distance: int = 2) -> DataFrame:
    """(a, b): links that connect the nodes of all fingerprints at most
    ``max_distance`` (0, 1 or 2) bits apart. ``fps`` has distinct ``fp`` and a
    ``node`` for each."""
    if max_distance not in (0, 1, 2):
        raise ValueError("max_distance must be 0, 1 or 2")
    if max_distance == 0:
        return fps.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    low = F.col("fp").bitwiseAND(F.lit((1 << SEGMENT) - 1))
    segments = [F.shiftrightunsigned("fp", SEGMENT), low]
    probes = []
    for number, (segment, radius) in enumerate(zip(segments, _balls(max_distance))):
        flips = [0] * (radius >= 0) + [1 << bit for bit in range(SEGMENT)] * (radius >= 1)
        if flips:
            ball = F.transform(F.array(*map(F.lit, flips)).cast("array<long>"), segment.bitwiseXOR)
            probes.append(fps.select("fp", "node", F.lit(number).alias("segment"), F.explode(ball).alias("value")))
    probes = probes[0] if len(probes) == 1 else probes[0].unionByName(probes[1])
    table = fps.select(
        F.col("fp").alias("other"),
        F.col("node").alias("other_node"),
        F.explode(F.array(*[F.struct(F.lit(n).alias("segment"), s.alias("value")) for n, s in enumerate(segments)])).alias("slot"),
    ).select("other", "other_node", "slot.*")
    hot = table.groupBy("segment", "value").count().filter(F.col("count") > HOT).select("segment", "value")
    hot = store.put(hot, "hot_buckets")

    cold = table.join(hot, ["segment", "value"], "left_anti")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_distance
    pairs = probes.join(cold, ["segment", "value"]).filter((F.col("fp") != F.col("other")) & near)
    pairs = pairs.select(F.col("node").alias("a"), F.col("other_node").alias("b"))

    crowd = probes.join(hot, ["segment", "value"]).select("fp", "node").distinct()
    whole = [1 << bit for bit in range(63)] + [-(1 << 63)]
    masks = F.array(*map(F.lit, whole)).cast("array<long>")
    if max_distance == 2:  # share a point that is 1 away from both
        key = F.concat(F.array(F.col("fp")), F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m)))
        keys = crowd.select("node", F.explode(key).alias("key"), F.lit(0).cast("long").alias("bit"))
    else:  # equal but for one bit
        key = F.transform(masks, lambda m: F.struct(F.col("fp").bitwiseAND(F.bitwise_not(m)).alias("key"), m.alias("bit")))
        keys = crowd.select("node", F.explode(key).alias("k")).select("node", "k.*")
    least = keys.groupBy("key", "bit").agg(F.min("node").alias("b"))
    stars = keys.join(least, ["key", "bit"]).filter("node <> b").select(F.col("node").alias("a"), "b").distinct()
    return pairs.unionByName(stars)


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    max_distance: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, fp, component) of each row; component is the smallest id that the
    row's fingerprint reaches over links."""
    store = Store(docs.sparkSession)
    marked = store.put(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = store.put(
        marked.filter("id is not null").groupBy("fp").agg(F.min("id").alias("node")), "nodes"
    )
    roots = connected(links(nodes, store, max_distance), store)
    labels = nodes.join(roots, "node", "left").select("fp", F.coalesce("component", "node").alias("label"))
    return marked.join(labels, "fp", "left").select(
        F.col("id").alias(id_col), "fp", F.when(F.col("id").isNotNull(), F.col("label")).alias("component")
    )


def representatives(docs: DataFrame, shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """``docs`` with the row of each component's smallest doc_id, once; rows
    without an id stay."""
    store = Store(docs.sparkSession)
    found = near_duplicates(docs.select("doc_id", "text"), shingle, max_distance)
    gone = store.put(found.filter("component <> doc_id").select("doc_id").distinct(), "copies")
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    again = store.put(
        kept.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated"
    )
    once = kept.join(again, "doc_id", "left_anti").select(*docs.columns)
    first = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns)
    return once.unionByName(first)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint in hexadecimal digits, component_id."""
    return near_duplicates(docs).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
