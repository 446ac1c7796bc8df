"""Language-model scoring with a probabilistic suffix tree.

A text, A-Z lower-cased, is its words between white space and one end. The
tree's symbols are bytes: a word is spelt out and closed by a space, the text
by a line feed. A context is the last up to ``depth`` symbols of the text so
far, whatever words they belong to; line feeds stand before the first of them.

Learning. Bundles of blocks send their distinct context-and-symbol pairs with their counts
in the training documents to shards, which add them up. A context is retained
if it was seen ``LEAST`` times and its next-symbol distribution diverges from
that of the context one symbol shorter: the bits saved over the corpus must
exceed the cost of its parameters. The suffixes of a retained context are
retained too, so that the longest retained suffix of any history is a state of
the tree. The tree grows with the corpus; it is a stored table, one folder for
each length of context, and never leaves the executors.

Smoothing. A state's counts are interpolated with its parent's distribution,
which weighs as many observations as the state has different symbols; the root
is interpolated with equal shares of all 256 bytes.

Scoring. The tree is joined, length by length, to every pair that some bundle
holds; shards return the log10 probabilities to the bundles, which add them up
along the symbols of each document.

Null counts as an empty text; a document without an id is a training document.
Every row gives one row; without training documents the tree is the root alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import batched

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import Store
from .packing import (
    BODY,
    PACKED,
    PACKED_ARROW,
    block_numbers,
    by_block,
    dealt,
    freeze,
    freeze_words,
    key_array,
    keys,
    opened,
    shard_count,
    small,
    thaw,
    thaw_words,
)
from .text import SOLID, binary_array, blocks, bound_batches, numbered, output, words

DEPTH = 5  # symbols of a context, at most 6
LEAST = 2  # times that a retained context was seen
SPACE, END = 0x20, 0x0A
SPREAD = 1_000_003  # a prime: deals pairs out to shards
BUNDLE = 6  # blocks that ask together: most of their pairs are the same


@dataclass
class Tree:
    """A tree small enough to be looked at as a whole. By context length: the
    retained contexts, ascending, the log10 weight of their parents; the context-and-symbol pairs seen, ascending, and their
    log10 probability. A pair is context * 256 + symbol."""

    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    pairs: list[np.ndarray]
    logs: list[np.ndarray]

    def score(self, pairs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log10 P(symbol | longest retained suffix); ``lengths`` are the
        lengths of the contexts."""
        total = np.zeros(len(pairs))
        rest = np.arange(len(pairs))
        for length in range(len(self.contexts) - 1, -1, -1):
            here = rest[lengths[rest] >= length]
            if not len(here):
                continue
            suffix = pairs[here] & _mask(length + 1)
            at, found = _find(self.pairs[length], suffix)
            total[here[found]] += self.logs[length][at[found]]
            unseen = here[~found]
            at, state = _find(self.contexts[length], suffix[~found] >> 8)
            total[unseen[state]] += self.weights[length][at[state]]
            done = np.zeros(len(pairs), bool)
            done[here[found]] = True
            rest = rest[~done[rest]]
        total[rest] += np.log10(1 / 256)
        return total


def _mask(symbols: int) -> np.int64:
    return np.int64((1 << 8 * symbols) - 1)


def _find(held: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(held):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
    return at, held[at] == wanted


def spelt(data: bytes, lengths: np.ndarray, depth: int) -> np.ndarray:
    """Every symbol of the texts with its context: pairs, each text's end
    included. ``data`` holds the texts' words, each with a space after it."""
    pad = max(depth, 1)
    begins = pad + np.append(0, np.cumsum(lengths + pad))
    row = np.full(int(begins[-1]), END, np.uint8)
    edge = np.zeros(len(row) + 1, np.int8)
    edge[begins[:-1]] = 1
    edge[begins[:-1] + lengths] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    row[inside] = np.frombuffer(data, np.uint8)
    inside[begins[:-1] + lengths] = True
    pairs = row.astype(np.int64)
    for back in range(1, depth + 1):
        pairs[back:] |= row[:-back].astype(np.int64) << (8 * back)
    return pairs[inside]


def states(grams: DataFrame, store: Store, depth: int = DEPTH, least_share: float = 0.0) -> DataFrame:
    """The stored table (length, pair, n, total, kinds, state) of the counts
    ``grams``(pair long, n long): every suffix of every pair, pairs that no
    training document has (n = 0) included, and whether its context is a state.
    ``least_share`` asks that a state make up a share of all symbols."""
    masks = F.array(*[F.lit(int(_mask(level + 1))) for level in range(depth + 1)])
    counts = (
        grams.select(F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("length"), "pair", "n")
        .select("length", F.col("pair").bitwiseAND(F.get(masks, F.col("length"))).alias("pair"), "n")
        .groupBy("length", "pair")
        .agg(F.sum("n").alias("n"))
        .withColumn("context", F.shiftright("pair", 8))
    )
    symbols = grams.agg(F.sum("n")).first()[0] or 0
    least = max(LEAST, int(np.ceil(least_share * symbols)))
    context = ["length", "context"]
    # A context has at most 256 pairs.
    totals = counts.groupBy(*context).agg(F.sum("n").alias("total"), F.count_if(F.col("n") > 0).alias("kinds"))
    counts = store.put(counts.join(totals, context), "context_counts")

    # Bits saved against the context that is one symbol shorter.
    shorter = F.get(masks, F.col("length") - 1)
    seen = counts.filter("n > 0")
    own = seen.filter((F.col("length") > 0) & (F.col("total") >= least)).select(
        *context, "n", "total", "kinds", (F.col("length") - 1).alias("up"), F.col("pair").bitwiseAND(shorter).alias("up_pair")
    )
    parent = seen.select(
        F.col("length").alias("up"), F.col("pair").alias("up_pair"), (F.col("n") / F.col("total")).alias("up_share")
    )
    saved = F.sum(F.col("n") * F.log2(F.col("n") / F.col("total") / F.col("up_share")))
    cost = F.max("kinds") * F.log2(F.lit(float(max(symbols, 2)))) / 2
    kept = own.join(parent, ["up", "up_pair"]).groupBy(*context).agg((saved - cost).alias("gain")).filter("gain > 0")
    suffixes = kept.select(F.explode(F.sequence(F.lit(1), F.col("length"))).alias("length"), F.col("context"))
    bound = F.get(masks, F.col("length") - 1)
    retained = suffixes.select("length", F.col("context").bitwiseAND(bound).alias("context")).distinct()
    rows = counts.join(retained.withColumn("kept", F.lit(True)), context, "left").select(
        "length", "pair", "n", "total", "kinds", ((F.col("length") == 0) | F.col("kept").isNotNull()).alias("state")
    )
    path = store.path("tree")
    rows.write.partitionBy("length").parquet(path)
    return grams.sparkSession.read.schema(rows.schema).parquet(path)  # an empty tree has no files to tell


def chances(tree: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(pair, chance): P(symbol | longest retained suffix) of each pair at the
    full depth."""
    flat = F.lit(1 / 256)
    found = tree.filter("length = 0").select(
        "pair",
        F.when(F.col("total") > 0, (F.col("n") + F.col("kinds") * flat) / (F.col("total") + F.col("kinds")))
        .otherwise(flat)
        .alias("chance"),
    )
    for length in range(1, depth + 1):
        up = found.select(F.col("pair").alias("up"), F.col("chance").alias("up_chance"))
        own = (F.col("n") + F.col("kinds") * F.col("up_chance")) / (F.col("total") + F.col("kinds"))
        found = (
            tree.filter(F.col("length") == length)
            .withColumn("up", F.col("pair").bitwiseAND(F.lit(int(_mask(length)))))
            .join(up, "up")
            .select("pair", F.when(F.col("state"), own).otherwise(F.col("up_chance")).alias("chance"))
        )
    return found


def learn(grams: DataFrame, store: Store, depth: int = DEPTH, least_share: float = 0.0) -> Tree:
    """The tree as a whole, for small corpora; ``states`` is that of any."""
    rows = states(grams, store, depth, least_share).filter("state and n > 0")
    return _tree(rows.select("length", "pair", "n", "total", "kinds").toArrow(), depth)


def _tree(rows: pa.Table, depth: int) -> Tree:
    columns = {name: rows[name].to_numpy() for name in rows.column_names}
    tree = Tree([], [], [], [])
    for length in range(depth + 1):
        here = np.flatnonzero(columns["length"] == length)
        here = here[np.argsort(columns["pair"][here])]
        pair, n, total, kinds = (columns[name][here] for name in ("pair", "n", "total", "kinds"))
        if length:
            up = tree.score(pair, np.full(len(pair), length - 1))
        else:
            up = np.full(len(pair), np.log10(1 / 256))
        context, lead = np.unique(pair >> 8, return_index=True)
        tree.contexts.append(context)
        tree.weights.append(np.log10(kinds[lead] / (total[lead] + kinds[lead])))
        tree.pairs.append(pair)
        tree.logs.append(np.log10((n + kinds * 10.0**up) / (total + kinds)))
    return tree


@dataclass
class Corpus:
    """Documents packed into bundles that know which of them train. Shards below
    ``shards`` hold words, those from there on pairs."""

    packed: DataFrame
    train_docs: int
    shards: int
    depth: int

    def asked(self, pairs: bool) -> DataFrame:
        wanted = F.col("shard") >= self.shards if pairs else F.col("shard").between(0, self.shards - 1)
        return self.packed.filter(wanted)


@dataclass
class Piece:
    """A block's distinct words and pairs, the number of each word and symbol
    among them, and how many of these each text has."""

    words: pa.LargeBinaryArray
    codes: np.ndarray
    pairs: np.ndarray
    symbols: np.ndarray
    n_words: np.ndarray
    n_symbols: np.ndarray


def _taken(data: bytes, n_words: np.ndarray) -> tuple[pa.LargeBinaryArray, np.ndarray, np.ndarray]:
    """A block's distinct words, the number of each word among them, and the
    bytes of each text. ``data`` holds words, each with a space after it."""
    raw = np.frombuffer(data, np.uint8)
    spaces = raw == SPACE
    ends = np.append(0, np.flatnonzero(spaces) + 1)  # of the words with their spaces
    distinct, codes = numbered(binary_array(ends - np.arange(len(ends)), raw[~spaces]))
    return distinct, codes, np.diff(ends[np.append(0, np.cumsum(n_words, dtype=np.int64))])


def _piece(data: bytes, n_words: np.ndarray, depth: int) -> Piece:
    distinct, codes, lengths = _taken(data, n_words)
    coded = pa.array(spelt(data, lengths, depth)).dictionary_encode()
    return Piece(distinct, codes, coded.dictionary.to_numpy(), coded.indices.to_numpy(), n_words, lengths + 1)


def _tallied(pairs: np.ndarray, trains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs, ascending, and how many of each are marked. Sorted in
    place with the mark as last bit: a table of them would take six times as long."""
    pairs <<= 1
    pairs |= trains
    pairs.sort()
    begins = _begins(pairs, 1)
    distinct = pairs[begins] >> 1
    pairs &= 1
    return distinct, np.add.reduceat(pairs, begins)


def _begins(ascending: np.ndarray, bits: int = 0) -> np.ndarray:
    """Where each different value begins, its last ``bits`` aside."""
    begins = np.ones(len(ascending), bool)
    begins[1:] = ascending[1:] ^ ascending[:-1] >= 1 << bits
    return np.flatnonzero(begins)


@dataclass
class Questions:
    """The distinct words or pairs of a bundle, by shard, and the number among
    them of those of each piece."""

    keys: pa.LargeBinaryArray | np.ndarray
    homes: np.ndarray
    at: list[np.ndarray]


def _word_questions(words: list[pa.LargeBinaryArray], shards: int) -> Questions:
    distinct, word = numbered(pa.chunked_array(words).combine_chunks())
    homes = np.fromiter((xxhash.xxh32_intdigest(x) for x in distinct.to_pylist()), np.uint32, len(distinct)) % shards
    order = pc.sort_indices(pa.table({"shard": homes, "word": distinct}), [("shard", "ascending"), ("word", "ascending")]).to_numpy()
    at = np.split(_places(order)[word], np.cumsum([len(w) for w in words])[:-1])
    return Questions(distinct.take(pa.array(order)), homes[order], at)


def _pair_order(pairs: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of ascending pairs by shard, and their shards in it."""
    homes = (pairs % SPREAD % shards).astype(np.int32)
    order = np.argsort(homes, kind="stable")
    return order, homes[order]


def _pair_questions(pieces: list[Piece], shards: int) -> Questions:
    pairs, pair = np.unique(np.concatenate([p.pairs for p in pieces]), return_inverse=True)
    order, homes = _pair_order(pairs, shards)
    at = np.split(_places(order)[pair], np.cumsum([len(p.pairs) for p in pieces])[:-1])
    return Questions(pairs[order], homes, at)


def _added(counts: list[np.ndarray], at: list[np.ndarray], size: int) -> np.ndarray:
    # A sum of whole numbers below 2^53 is exact.
    return np.bincount(np.concatenate(at), np.concatenate(counts), minlength=size).astype(np.int64)


def _places(order: np.ndarray) -> np.ndarray:
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    return place


def pack(
    docs: DataFrame, held_out, store: Store, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH
) -> Corpus:
    """``held_out`` is a condition; a row where it is null trains."""
    spark = docs.sparkSession
    bound_batches(spark)
    shards = shard_count(spark)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held"),
    )

    def cut(batches):
        for number, bundle in zip(block_numbers(), batched(blocks(batches, "text"), BUNDLE)):
            distinct, texts, lines, counts, seen = [], [], [], [], []
            for table in bundle:
                found = words(table["text"], SOLID, lower=True)
                texts.append(found.spaced()[0])
                lines.append(np.diff(found.first))
                own, codes, lengths = _taken(texts[-1], lines[-1])
                trains = ~table["held"].to_numpy().astype(bool)
                distinct.append(own)
                counts.append(np.bincount(codes[np.repeat(trains, lines[-1])], minlength=len(own)))
                seen.append(_tallied(spelt(texts[-1], lengths, depth), np.repeat(trains, lengths + 1)))
            asked = _word_questions(distinct, shards)
            n = _added(counts, asked.at, len(asked.keys))
            pairs, n_pairs = _summed(*zip(*seen))
            order, pair_homes = _pair_order(pairs, shards)
            pairs, n_pairs = pairs[order], n_pairs[order]
            rows = pa.concat_tables(bundle)
            body = freeze(
                **keys(rows["id"]),
                held=rows["held"].to_numpy().astype(np.uint8),
                n_words=[small(x) for x in lines],
                texts=texts,
            )
            names, begin = dealt(asked.homes)
            data = [
                freeze_words(asked.keys.slice(a, b - a), counts=small(n[a:b]))
                for a, b in zip(begin, np.append(begin[1:], len(n)))
            ]
            pair_names, begin = dealt(pair_homes)
            # Ascending pairs as their steps.
            data += [
                freeze(steps=small(np.diff(pairs[a:b], prepend=0)), counts=small(n_pairs[a:b]))
                for a, b in zip(begin, np.append(begin[1:], len(n_pairs)))
            ]
            shard = [BODY, *names.tolist(), *(pair_names + shards).tolist()]
            yield output(PACKED_ARROW, block=[number] * len(shard), shard=shard, data=[body, *data])

    packed = store.put(rows.mapInArrow(cut, PACKED), "words")
    return Corpus(packed, rows.filter("not held").count(), shards, depth)


def _shard(table: pa.Table) -> tuple[pa.LargeBinaryArray, np.ndarray, list[np.ndarray]]:
    """A shard's distinct words, their counts, and each row's words among them."""
    parts = [thaw(x) for x in table["data"].to_pylist()]
    arrays = [thaw_words(p) for p in parts]
    distinct, codes = numbered(pa.chunked_array(arrays).combine_chunks())
    counts = np.bincount(codes, np.concatenate([p["counts"] for p in parts]), minlength=len(distinct)).astype(np.int64)
    return distinct, counts, np.split(codes, np.cumsum([len(a) for a in arrays])[:-1])


def _pairs(part: dict) -> np.ndarray:
    return np.cumsum(part["steps"], dtype=np.int64)


def count_pairs(corpus: Corpus, store: Store) -> tuple[DataFrame, int, int]:
    """(pair, n) of every pair, n summed over the training documents; the number
    of training tokens and of different ones."""

    def tokens(table: pa.Table) -> pa.Table:
        _, counts, _ = _shard(table)
        return pa.table({"tokens": [int(counts.sum())], "words": [int(np.count_nonzero(counts))]})

    def add(table: pa.Table) -> pa.Table:
        held = np.zeros(0, np.int64)
        n = np.zeros(0, np.int64)
        late: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        rows = table["data"]
        for i in range(len(rows)):
            part = thaw(rows[i].as_py())
            late.append((_pairs(part), part["counts"].astype(np.int64)))
            size += len(late[-1][0])
            # What is held at once is at most twice the distinct pairs and some.
            if size > max(len(held), 1 << 20) or i == len(rows) - 1:
                held, n = _summed([held, *[p for p, _ in late]], [n, *[c for _, c in late]])
                late, size = [], 0
        return pa.table({"pair": held, "n": n})

    sums = (
        corpus.asked(pairs=False).groupBy("shard").applyInArrow(tokens, "tokens long, words long").agg(F.sum("tokens"), F.sum("words")).first()
    )
    grams = store.put(corpus.asked(pairs=True).groupBy("shard").applyInArrow(add, "pair long, n long"), "pairs")
    return grams, (sums[0] or 0) + corpus.train_docs, (sums[1] or 0) + (corpus.train_docs > 0)


def _summed(pairs: Sequence[np.ndarray], counts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs, ascending, and the sums of their counts."""
    every = np.concatenate(pairs)
    order = np.argsort(every)
    every = every[order]
    begins = _begins(every)
    return every[begins], np.add.reduceat(np.concatenate(counts)[order], begins)


def score(corpus: Corpus, found: DataFrame, tokens: int, distinct: int) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each
    document; ``found`` are the ``chances`` of all pairs."""
    shards, depth, train_docs = corpus.shards, corpus.depth, corpus.train_docs

    def known(table: pa.Table) -> pa.Table:
        _, counts, members = _shard(table)
        data = [freeze(answers=small(counts[m])) for m in members]
        return pa.table([table["block"], table["shard"], pa.array(data, pa.binary())], schema=PACKED_ARROW)

    def answer(asked: pa.Table, table: pa.Table) -> pa.Table:
        pairs, logs = table["pair"].to_numpy(), np.log10(table["chance"].to_numpy()).astype(np.float32)
        order = np.argsort(pairs)
        pairs, logs = pairs[order], logs[order]
        data = []
        for x in asked["data"]:
            wanted = _pairs(thaw(x.as_py()))
            at, there = _find(pairs, wanted)
            if not there.all():
                raise ValueError("a pair without a probability")
            data.append(freeze(answers=logs[at]))
        return pa.table([asked["block"], asked["shard"], pa.array(data, pa.binary())], schema=PACKED_ARROW)

    floor = tokens + distinct + 1
    end_base = float(np.log10((train_docs + 1) / floor))
    result = pa.schema(
        [
            ("id", pa.int64()),
            ("held_out", pa.bool_()),
            ("n_tokens", pa.int64()),
            ("n_known", pa.int64()),
            ("train_tokens", pa.int64()),
            ("base_score", pa.float64()),
            ("score", pa.float64()),
        ]
    )

    def add(table: pa.Table) -> pa.Table:
        _, body, answers = opened(table)
        pieces = [_piece(text, n.astype(np.int64), depth) for text, n in zip(body["texts"], body["n_words"])]
        asked, asked_pairs = _word_questions([p.words for p in pieces], shards), _pair_questions(pieces, shards)
        given = [a["answers"] for a in answers]
        n = len(np.unique(asked.homes))
        counts = np.concatenate(given[:n]) if n else np.zeros(0)
        logs = np.concatenate(given[n:]).astype(np.float64)
        if len(counts) != len(asked.keys) or len(logs) != len(asked_pairs.keys):
            raise ValueError("answers that do not match their block")
        base = np.log10((counts.astype(np.float64) + 1) / floor)
        total = lambda values, at, codes, sizes: np.bincount(
            np.repeat(np.arange(len(sizes)), sizes), values[at][codes], minlength=len(sizes)
        )
        known = [total(counts > 0, at, p.codes, p.n_words) for p, at in zip(pieces, asked.at)]
        bases = [total(base, at, p.codes, p.n_words) for p, at in zip(pieces, asked.at)]
        scores = [total(logs, at, p.symbols, p.n_symbols) for p, at in zip(pieces, asked_pairs.at)]
        return pa.table(
            [
                key_array(body),
                pa.array(body["held"].astype(bool)),
                pa.array(np.concatenate([p.n_words for p in pieces]) + 1),
                pa.array(np.concatenate(known).astype(np.int64) + (train_docs > 0)),
                pa.array(np.full(len(body["ids"]), tokens)),
                pa.array(np.concatenate(bases) + end_base),
                pa.array(np.concatenate(scores)),
            ],
            schema=result,
        )

    body = corpus.packed.filter(F.col("shard") == BODY)
    home = (F.col("pair") % SPREAD % shards + shards).cast("int").alias("shard")
    answers = (
        corpus.asked(pairs=True)
        .groupBy("shard")
        .cogroup(found.select(home, "pair", "chance").groupBy("shard"))
        .applyInArrow(answer, PACKED)
        .unionByName(corpus.asked(pairs=False).groupBy("shard").applyInArrow(known, PACKED))
    )
    return by_block(body, answers).applyInArrow(
        add,
        "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def train_and_score(
    docs: DataFrame,
    held_out,
    depth: int = DEPTH,
    least_share: float = 0.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Learn from the rows that ``held_out`` leaves and score all rows."""
    store = Store(docs.sparkSession)
    corpus = pack(docs, held_out, store, id_col, text_col, depth)
    grams, tokens, distinct = count_pairs(corpus, store)
    tree = states(grams, store, depth, least_share)
    return score(corpus, chances(tree, depth), tokens, distinct).withColumnRenamed("id", id_col)


def report(docs: DataFrame) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return train_and_score(docs, held_out)
