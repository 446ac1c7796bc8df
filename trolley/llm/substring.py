"""Substring deduplication with repeated-phrase automata.

Words are separated by white space and kept as they are. A window is ``size``
consecutive words of one document; a word goes if a window over it has the
same words as a window that starts earlier, in a document with a smaller id or
before it in the same document.

1. Each window names its anchor, the phrase of ``phrase`` words in it with the
   smallest hash; equal windows have equal anchors. Blocks send their distinct
   anchors to shards, which answer which of them recur in the corpus.
2. Each block compiles the recurring phrases it holds into an Aho-Corasick
   automaton, its shard of the automaton of all recurring phrases, and streams
   its documents through it to locate every occurrence. A window whose anchor
   is found this way may recur.
3. The distinct candidate windows of each block go to shards by 96 bits of two
   independent hashes, with their first place in the block; shards answer
   whether that place is the first in the corpus.
4. Each block streams its documents again, and removes the words of all
   windows that are not the first of their kind.

Documents are ordered by id, nulls last, then by block and place, so that of
repeated ids one counts as the earlier. Null texts have no words. Every row
gives one row; other columns are not read.
"""

from __future__ import annotations

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
from .text import SOLID, blocks, bound_batches, numbered, output, rolled, words

WINDOW = 20
PHRASE = 8
_BASE, _SECOND = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def _slid(values: np.ndarray, width: int, of=np.minimum) -> np.ndarray:
    """The extreme of each run of ``width`` values."""
    reach = 1
    while 2 * reach <= width:
        values = of(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return of(values[: len(values) - rest], values[rest:]) if rest else values


class _Block:
    """A block's words as hashes, its windows and their anchors."""

    def __init__(self, distinct: pa.LargeBinaryArray, codes: np.ndarray, counts: np.ndarray, size: int, phrase: int):
        self.codes, self.size, self.phrase = codes, size, phrase
        halves = np.frombuffer(b"".join(xxhash.xxh3_128_digest(w) for w in distinct.to_pylist()), np.uint64).reshape(-1, 2)
        self.first_hash, self.second_hash = halves[:, 0], halves[:, 1]
        self.first = np.append(0, np.cumsum(counts.astype(np.int64)))
        n = len(codes)
        owner = np.repeat(np.arange(len(counts)), counts)
        if n < size:
            self.phrases = self.least = np.zeros(0, np.uint64)
            self.window = np.zeros(0, bool)
            return
        hashes = self.first_hash[codes]
        self.phrases = np.maximum(rolled(hashes, phrase, _BASE), np.uint64(1))
        self.least = _slid(self.phrases, size - phrase + 1)  # of each window's phrases
        self.window = owner[: n - size + 1] == owner[size - 1 :]

    def anchors(self) -> np.ndarray:
        """Where a phrase is the anchor of a window over it."""
        width = self.size - self.phrase + 1
        least = np.where(self.window, self.least, 0).astype(np.uint64)
        if not len(least):
            return np.zeros(0, np.int64)
        padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
        return np.flatnonzero(_slid(padded, width, np.maximum) == self.phrases)

    def anchor_shards(self, shards: int):
        """Distinct anchors by shard: their hashes, an example place, whether
        they occur twice in the block, and the shards' names and beginnings."""
        at = self.anchors()
        hashes, example, count = np.unique(self.phrases[at], return_index=True, return_counts=True)
        home = (hashes % np.uint64(shards)).astype(np.int32)
        order = np.argsort(home, kind="stable")
        return hashes[order], at[example[order]], (count > 1)[order], *dealt(home[order])

    def occurrences(self, example: np.ndarray) -> np.ndarray:
        """Where the phrases that stand at ``example`` occur, located by an
        Aho-Corasick automaton over the block's words, three symbols a word."""
        import ahocorasick

        marked = np.zeros(len(self.phrases), bool)
        if not len(example):
            return marked
        radix = 16
        while radix**3 <= int(self.codes.max()):
            radix *= 2
        symbols = np.empty((len(self.codes), 3), np.uint32)
        symbols[:, 0] = 256 + self.codes // radix**2  # only a word's first symbol is of this range
        symbols[:, 1] = 4096 + self.codes // radix % radix
        symbols[:, 2] = 4096 + self.codes % radix
        stream = symbols.tobytes().decode("utf-32-le")
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for i in example.tolist():
            automaton.add_word(stream[3 * i : 3 * (i + self.phrase)])
        automaton.make_automaton()
        ends = np.fromiter((end for end, _ in automaton.iter(stream)), np.int64)
        marked[(ends + 1) // 3 - self.phrase] = True
        return marked

    def candidates(self, recurs: np.ndarray, example: np.ndarray):
        """Windows whose anchor recurs: their places, two hashes, and the place
        of each distinct one's first and each one's number among these."""
        found = self.occurrences(example[recurs])
        if not found.any():
            none = np.zeros(0, np.int64)
            return none, none.astype(np.uint64), none.astype(np.uint32), none, none
        there = np.where(found, self.phrases, np.uint64(0xFFFFFFFFFFFFFFFF))
        at = np.flatnonzero(self.window & (_slid(there, self.size - self.phrase + 1) == self.least))
        one = rolled(self.first_hash[self.codes], self.size, _SECOND)[at]
        two = (rolled(self.second_hash[self.codes], self.size, _BASE)[at] >> np.uint64(32)).astype(np.uint32)
        _, lead, number = np.unique(one, return_index=True, return_inverse=True)
        if not (two[lead][number] == two).all():  # equal in 64 bits, not in 96
            both = np.empty(len(one), [("one", np.uint64), ("two", np.uint32)])
            both["one"], both["two"] = one, two
            _, lead, number = np.unique(both, return_index=True, return_inverse=True)
        return at, one, two, lead, number

    def owner(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, places, side="right") - 1


def _body_block(body: dict, size: int, phrase: int) -> tuple[_Block, pa.LargeBinaryArray]:
    distinct = thaw_words(body)
    return _Block(distinct, body["codes"].astype(np.int64), body["counts"], size, phrase), distinct


def _recurring(block: _Block, answers: list[dict], shards: int):
    """The anchors' answers, in the order in which they were asked."""
    _, example, _, names, begin = block.anchor_shards(shards)
    bits = [np.unpackbits(a["recurs"], count=a["n"]).astype(bool) for a in answers]
    recurs = np.concatenate(bits) if bits else np.zeros(0, bool)
    if len(recurs) != len(example):
        raise ValueError("answers do not fit the block's anchors")
    return recurs, example


def deduplicate(
    docs: DataFrame,
    size: int = WINDOW,
    phrase: int = PHRASE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_words, n_removed, kept): the words left of each row's text, one
    space between them."""
    spark = docs.sparkSession
    bound_batches(spark)
    shards = shard_count(spark)
    store = Store(spark)

    def pack(batches):
        for number, rows in zip(block_numbers(), blocks(batches, "text")):
            rows = rows.take(pc.sort_indices(rows["id"], null_placement="at_end"))
            found = words(rows["text"], SOLID)
            distinct, codes = numbered(found.values())
            order = pc.sort_indices(distinct).to_numpy()
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            distinct, codes, counts = distinct.take(pa.array(order)), place[codes], np.diff(found.first)
            block = _Block(distinct, codes.astype(np.int64), counts, size, phrase)
            hashes, _, twice, names, begin = block.anchor_shards(shards)
            ends = np.append(begin[1:], len(hashes))
            body = freeze_words(distinct, **keys(rows["id"]), counts=small(counts), codes=codes)
            asked = [freeze(hashes=hashes[a:b], twice=np.packbits(twice[a:b])) for a, b in zip(begin, ends)]
            yield output(PACKED_ARROW, block=[number] * (len(names) + 1), shard=[BODY, *names.tolist()], data=[body, *asked])

    def count_anchors(table: pa.Table) -> pa.Table:
        parts = [thaw(x) for x in table["data"].to_pylist()]
        hashes = np.concatenate([p["hashes"] for p in parts])
        times = np.concatenate([1 + np.unpackbits(p["twice"], count=len(p["hashes"])) for p in parts])
        _, number = np.unique(hashes, return_inverse=True)
        recurs = np.bincount(number, times)[number] > 1
        answers, at = [], 0
        for p in parts:
            n = len(p["hashes"])
            answers.append(freeze(recurs=np.packbits(recurs[at : at + n]), n=n))
            at += n
        return pa.table([table["block"], table["shard"], pa.array(answers, pa.binary())], schema=PACKED_ARROW)

    def ask_windows(table: pa.Table) -> pa.Table:
        number, body, answers = opened(table)
        block, _ = _body_block(body, size, phrase)
        at, one, two, lead, _ = block.candidates(*_recurring(block, answers, shards))
        lead, names, begin = _window_shards(one, lead, shards)
        ids, known = body["ids"][block.owner(at[lead])], body["known"][block.owner(at[lead])]
        ends = np.append(begin[1:], len(lead))
        data = [
            freeze(one=one[x], two=two[x], at=at[x].astype(np.int32), ids=ids[a:b], known=np.packbits(known[a:b]))
            for a, b in zip(begin, ends)
            for x in [lead[a:b]]
        ]
        return pa.table(
            [pa.array([number] * len(data), pa.int64()), pa.array(names, pa.int32()), pa.array(data, pa.binary())],
            schema=PACKED_ARROW,
        )

    def first_windows(table: pa.Table) -> pa.Table:
        parts = [thaw(x) for x in table["data"].to_pylist()]
        sizes = [len(p["one"]) for p in parts]
        block = np.repeat(table["block"].to_numpy(), sizes)
        one, two, at, ids = (np.concatenate([p[name] for p in parts]) for name in ("one", "two", "at", "ids"))
        unknown = np.concatenate([1 - np.unpackbits(p["known"], count=n) for p, n in zip(parts, sizes)])
        order = np.lexsort((at, block, ids, unknown, two, one))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
        first = np.zeros(len(order), bool)
        first[order] = new
        edges = np.append(0, np.cumsum(sizes))
        answers = [freeze(first=np.packbits(first[a:b]), n=int(b - a)) for a, b in zip(edges[:-1], edges[1:])]
        behind = pa.array(table["shard"].to_numpy() + shards, pa.int32())  # behind the anchors' answers
        return pa.table([table["block"], behind, pa.array(answers, pa.binary())], schema=PACKED_ARROW)

    result = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def remove(table: pa.Table) -> pa.Table:
        _, body, answers = opened(table)
        block, distinct = _body_block(body, size, phrase)
        recurs, example = _recurring(block, [a for a in answers if "recurs" in a], shards)
        at, one, _, lead, number = block.candidates(recurs, example)
        sorted_lead, _, _ = _window_shards(one, lead, shards)
        bits = [np.unpackbits(a["first"], count=a["n"]).astype(bool) for a in answers if "first" in a]
        bits = np.concatenate(bits) if bits else np.zeros(0, bool)
        if len(bits) != len(lead):
            raise ValueError("answers do not fit the block's windows")
        gone = np.ones(len(at), bool)  # the places of windows that start elsewhere first
        gone[sorted_lead[bits]] = False
        n = len(block.codes)
        edge = np.zeros(n + 1, np.int32)
        edge[at[gone]] += 1
        np.add.at(edge, at[gone] + size, -1)
        left = np.cumsum(edge[:-1]) <= 0
        before = np.append(0, np.cumsum(left))[block.first]
        lengths, data = _spaced(distinct.take(pa.array(block.codes[left])))
        starts = np.append(0, np.cumsum(lengths))[before]
        counts = np.diff(before)
        texts = [data[a : b - 1].decode() if c else "" for a, b, c in zip(starts, starts[1:], counts)]
        total = np.diff(block.first)
        return pa.table([key_array(body), pa.array(total), pa.array(total - counts), pa.array(texts, pa.string())], schema=result)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    packed = store.put(rows.mapInArrow(pack, PACKED), "packed")
    body, asked = packed.filter(F.col("shard") == BODY), packed.filter(F.col("shard") != BODY)
    anchors = store.put(asked.groupBy("shard").applyInArrow(count_anchors, PACKED), "anchors")
    called = by_block(body, anchors).applyInArrow(ask_windows, PACKED)
    firsts = called.groupBy("shard").applyInArrow(first_windows, PACKED)
    return (
        by_block(body, anchors.unionByName(firsts))
        .applyInArrow(remove, "id long, n_words long, n_removed long, kept string")
        .withColumnRenamed("id", id_col)
    )


def _window_shards(one: np.ndarray, lead: np.ndarray, shards: int):
    """The leads by shard and place, the shards' names and beginnings."""
    home = (one[lead] % np.uint64(shards)).astype(np.int32)
    order = np.lexsort((lead, home))
    return lead[order], *dealt(home[order])


def _spaced(values: pa.LargeBinaryArray) -> tuple[np.ndarray, bytes]:
    """Lengths and bytes of the words, each with a space behind it."""
    spaced = pc.binary_join_element_wise(values, pa.scalar(b"", pa.large_binary()), pa.scalar(b" ", pa.large_binary()))
    if not len(spaced):
        return np.zeros(0, np.int64), b""
    offsets = np.frombuffer(spaced.buffers()[1], np.int64)[spaced.offset : spaced.offset + len(spaced) + 1]
    return np.diff(offsets), bytes(memoryview(spaced.buffers()[2])[offsets[0] : offsets[-1]])


def report(docs: DataFrame) -> DataFrame:
    return deduplicate(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
