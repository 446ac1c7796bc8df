"""Benchmark decontamination with a distributed positional inverted index.

Index. Training texts, A-Z lower-cased, are cut into words of letters and
digits. A block of documents numbers its words consecutively, with one number
left out between documents so that no phrase crosses two; for every distinct
term of a block the index stores the term, the block and the positions. A
common term is one posting list per block, so it is spread over the blocks.

Query. A benchmark text is cut into windows of ``size`` consecutive words (a
shorter text is one window). Summed posting lengths give each term's frequency;
a window with a term that never occurs is done. The others go to the blocks
that hold their rarest term, where lists, shifted by the terms' offsets, are
intersected from the rarest on. What is left are the window's exact places; a
tolerance of ``slop`` words for each term gives its proximity places.

A null text has no words; an item without words has no windows. Rows that
repeat give repeated results; items that share an id count once; an item
without an id taints but is not named. Empty tables give no hits or no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import Store
from .packing import block_numbers
from .text import ALNUM, blocks, bound_batches, numbered, output, words

WINDOW = 13
SLOP = 2


@dataclass
class Index:
    """postings(block, term, n, at) and documents(block, first, ids): for each
    block its documents' ids and first positions, the end included."""

    postings: DataFrame
    documents: DataFrame


def build_index(docs: DataFrame, store: Store, id_col: str = "doc_id", text_col: str = "text") -> Index:
    bound_batches(docs.sparkSession)
    schema = "block long, term string, n long, at array<int>, ids array<long>"
    result = pa.schema(
        [
            ("block", pa.int64()),
            ("term", pa.string()),
            ("n", pa.int64()),
            ("at", pa.list_(pa.int32())),
            ("ids", pa.list_(pa.int64())),
        ]
    )

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = block_numbers()
        for rows in blocks(batches, "text"):
            block = next(numbers)
            found = words(rows["text"], ALNUM, lower=True)
            yield output(
                result,
                block=[block],
                term=[None],
                n=[len(found)],
                at=[(found.first + np.arange(len(found.first))).astype(np.int32)],
                ids=[rows["id"].to_pylist()],
            )
            if not len(found):
                continue
            distinct, codes = numbered(found.values())
            order = np.argsort(codes, kind="stable")
            places = (np.arange(len(found)) + found.owner())[order].astype(np.int32)
            counts = np.bincount(codes, minlength=len(distinct))
            edges = np.append(0, np.cumsum(counts)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(distinct), block)),
                    distinct.cast(pa.large_string()).cast(pa.string()),
                    pa.array(counts),
                    pa.ListArray.from_arrays(edges, pa.array(places)),
                    pa.nulls(len(distinct), pa.list_(pa.int64())),
                ],
                schema=result,
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    stored = store.put(rows.mapInArrow(invert, schema), "index")
    return Index(
        stored.filter("term is not null").select("block", "term", "n", "at"),
        stored.filter("term is null").select("block", F.col("at").alias("first"), "ids"),
    )


def windows(items: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, terms array<string>): the distinct windows of each item."""
    bound_batches(items.sparkSession)
    result = pa.schema([("item", pa.int64()), ("terms", pa.list_(pa.string()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches, "text", 1 << 18):
            found = words(rows["text"], ALNUM, lower=True)
            terms = found.values().cast(pa.large_string()).to_pylist()
            ids, runs = [], []
            for item, a, b in zip(rows["id"].to_pylist(), found.first.tolist(), found.first[1:].tolist()):
                for s in range(a, max(b - size, a if b > a else a - 1) + 1):
                    ids.append(item)
                    runs.append(terms[s : min(s + size, b)])
            yield output(result, item=ids, terms=runs)

    return (
        items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        .mapInArrow(cut, "item long, terms array<string>")
        .distinct()
    )


def matches(index: Index, phrases: DataFrame, store: Store, slop: int = SLOP) -> DataFrame:
    """(block, doc, n_hit, items, n_near) of the documents that hold a window
    of ``phrases``(item, terms): words inside exact places, the items of these
    places, and the number of proximity places. ``doc`` is the document's place
    in its block."""
    spots = phrases.select("item", "terms", F.posexplode("terms").alias("offset", "term"))
    wanted = spots.select("term").distinct()
    frequency = index.postings.select("term", "n").join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n"))
    live = (
        spots.join(frequency, "term", "left")
        .groupBy("item", "terms")
        .agg(
            F.count("n").alias("known"),
            F.array_sort(F.collect_list(F.struct("n", "offset"))).alias("rarest_first"),
        )
        .filter(F.col("known") == F.size("terms"))
    )
    live = live.select(
        "item",
        "terms",
        F.transform("rarest_first", lambda x: x["offset"]).alias("offsets"),
        F.element_at("terms", F.col("rarest_first")[0]["offset"] + 1).alias("rarest"),
    )
    live = store.put(live, "live_windows")
    called = live.join(
        index.postings.select("block", F.col("term").alias("rarest")), "rarest"
    ).select(F.col("block").alias("called"), "item", "terms", "offsets")
    needed = live.select(F.explode("terms").alias("term")).distinct()
    lists = index.postings.join(needed, "term", "left_semi").select(
        "block", "term", "at", F.lit(None).cast("array<long>").alias("ids")
    )
    lists = lists.unionByName(index.documents.select("block", F.lit(None).cast("string").alias("term"), F.col("first").alias("at"), "ids"))
    result = pa.schema(
        [
            ("block", pa.int64()),
            ("doc", pa.int32()),
            ("n_hit", pa.int64()),
            ("items", pa.list_(pa.int64())),
            ("n_near", pa.int64()),
        ]
    )

    def intersect(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return result.empty_table()
        terms = held["term"].to_pylist()
        at = held["at"].combine_chunks()
        edges, flat = at.offsets.to_numpy(), at.values.to_numpy()
        place = {term: flat[edges[i] : edges[i + 1]] for i, term in enumerate(terms)}
        first = place.pop(None)
        cover = np.zeros(int(first[-1]) + 1, np.int32)
        tainted: dict[int, set] = {}
        near_in: dict[int, int] = {}
        for item, phrase, offsets in zip(*(asked[c].to_pylist() for c in ("item", "terms", "offsets"))):
            exact = near = place.get(phrase[offsets[0]], flat[:0]) - offsets[0]
            for offset in offsets[1:]:
                if not len(near):
                    break
                other = place.get(phrase[offset])
                if other is None:
                    exact = near = near[:0]
                    break
                near = near[_within(near + offset, other, slop)]
                exact = exact[_within(exact + offset, other, 0)]
            doc = np.searchsorted(first, near, side="right") - 1
            last = np.searchsorted(first, near + len(phrase) - 1, side="right") - 1
            for d in doc[(doc == last) & (near >= 0)].tolist():
                near_in[d] = near_in.get(d, 0) + 1
            np.add.at(cover, exact, 1)
            np.add.at(cover, exact + len(phrase), -1)
            for d in (np.searchsorted(first, exact, side="right") - 1).tolist():
                tainted.setdefault(d, set()).add(item)
        hit = np.append(0, np.cumsum(np.cumsum(cover) > 0))
        docs = sorted(tainted.keys() | near_in.keys())
        return pa.table(
            [
                pa.array([asked["called"][0].as_py()] * len(docs), pa.int64()),
                pa.array(docs, pa.int32()),
                pa.array([int(hit[first[d + 1] - 1] - hit[first[d]]) for d in docs], pa.int64()),
                pa.array([sorted(tainted.get(d, set()) - {None}) for d in docs], pa.list_(pa.int64())),
                pa.array([near_in.get(d, 0) for d in docs], pa.int64()),
            ],
            schema=result,
        )

    return called.groupBy("called").cogroup(lists.groupBy("block")).applyInArrow(
        intersect, "block long, doc int, n_hit long, items array<long>, n_near long"
    )


def _within(wanted: np.ndarray, held: np.ndarray, slop: int) -> np.ndarray:
    """Which of ``wanted`` have a position in sorted ``held`` at most ``slop`` away."""
    at = np.minimum(np.searchsorted(held, wanted - slop), len(held) - 1)
    return (held[at] >= wanted - slop) & (held[at] <= wanted + slop)


def screen(
    docs: DataFrame, items: DataFrame, size: int = WINDOW, slop: int = SLOP, share: int = 20
) -> DataFrame:
    """(doc_id, n_words, n_hit, items, n_near, contaminated) of each document:
    contaminated if at least one in ``share`` of its words is hit."""
    store = Store(docs.sparkSession)
    index = build_index(docs, store)
    phrases = store.put(windows(items, size), "windows")
    found = store.put(matches(index, phrases, store, slop), "matches")
    every = index.documents.select(
        "block", "first", F.posexplode("ids").alias("doc", "doc_id")
    ).select(
        "block",
        "doc",
        "doc_id",
        (F.element_at("first", F.col("doc") + 2) - F.element_at("first", F.col("doc") + 1) - 1).cast("long").alias("n_words"),
    )
    hit = F.coalesce("n_hit", F.lit(0))
    return every.join(found, ["block", "doc"], "left").select(
        "doc_id",
        "n_words",
        hit.cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        ((hit > 0) & (share * hit >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without contaminated rows. Rows that share a doc_id share their
    fate; rows without one stay."""
    store = Store(docs.sparkSession)
    found = screen(docs.select("doc_id", "text"), items)
    bad = store.put(found.filter("contaminated").select("doc_id").distinct(), "contaminated")
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = screen(docs, items)
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        "contaminated",
        "n_near",
    )
