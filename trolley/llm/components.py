"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import Store

MAX_ROUNDS = 60  # far beyond log2 of any table; running out is an error


def connected(links: DataFrame, store: Store) -> DataFrame:
    """(node, component) of every linked node; ``links`` has the long columns
    ``a`` and ``b``, the component is its smallest node.

    Large-star and small-star steps alternate until every node points at its
    root. Each round is written, which cuts its lineage; minima combine
    map-side, and the joins are plain ones, so that a hub's links are split by
    the skew join. Loops and links with a null are of no account."""
    edges = store.put(_oriented(links.filter("a is not null and b is not null")).distinct(), "links")
    seen = _state(edges)
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _oriented(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = store.put(large.distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = _oriented(small.unionByName(least.select("a", F.col("m").alias("b"))))
        edges = store.put(small.distinct(), "links")
        state = _state(edges)
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = state
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def follow(pointers: DataFrame, store: Store) -> DataFrame:
    """(node, label) of each row of ``pointers`` (a, b), one for each ``a`` and ``b``
    below ``a``: where its chain of pointers ends. Each round a pointer
    becomes that of the node it points at."""
    chains = store.put(pointers.select(F.col("a").alias("node"), F.col("b").alias("label")), "chains")
    for _ in range(MAX_ROUNDS):
        ahead = chains.select(F.col("node").alias("label"), F.col("label").alias("next"))
        longer = chains.join(ahead, "label", "left")
        moved = F.col("next").isNotNull().alias("moved")
        chains = store.put(longer.select("node", F.coalesce("next", "label").alias("label"), moved), "chains")
        if chains.filter("moved").isEmpty():
            return chains.select("node", "label")
    raise RuntimeError(f"pointers did not end in {MAX_ROUNDS} rounds")


def _oriented(links: DataFrame) -> DataFrame:
    return links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
