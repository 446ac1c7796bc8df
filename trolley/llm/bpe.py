"""Byte-level byte-pair encoding and decoding with a public vocabulary.

Global distinct-word shuffle. Every text is cut into pieces; a block of
documents keeps its pieces as positions over its own dictionary, and the
dictionary goes, shard by shard, to the tasks that encode each distinct piece
once. The ids come back to the block and are put together by position.
Decoding joins ids to the table of token bytes.

The texts are cut twice, once for the dictionaries and once for the positions,
which moves half of what storing the cut texts would. A block's number is its
place in the input, so both passes must read the same rows in the same order,
as from a stored table; dictionaries carry a digest, and a difference is an
error.

Null and empty texts have no tokens. Repeated rows, repeated and null ids are
kept as they are, one result per row; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

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
    partitions,
    shard_count,
    small,
    thaw,
    thaw_words,
    word_bytes,
)
from .text import binary_array, blocks, bound_batches, numbered, output, pieces

KNOWN_PIECES = 250_000  # encoded pieces a task remembers at once


def read_ranks(path: str) -> bytes:
    """A vocabulary file: one base64 token and its rank per line. It is read on
    the driver; its size is the vocabulary's, whatever the corpus."""
    with open(path, "rb") as file:
        return file.read()


@lru_cache(2)
def _tokens(ranks: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}


@lru_cache(2)
def _encoder(ranks: bytes):
    import tiktoken

    # Only single pieces are encoded, so the pattern is of no account.
    return tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=_tokens(ranks), special_tokens={})


@lru_cache(2)
def _token_bytes(ranks: bytes) -> pa.LargeBinaryArray:
    tokens = _tokens(ranks)
    table = [b""] * (max(tokens.values()) + 1)
    for token, rank in tokens.items():
        table[rank] = token
    return pa.array(table, pa.large_binary())


def encode(docs: DataFrame, ranks: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of each row."""
    spark = docs.sparkSession
    bound_batches(spark)
    shards = shard_count(spark)
    shared = spark.sparkContext.broadcast(ranks)

    def cut(batches: Iterator[pa.RecordBatch]):
        for block, rows in zip(block_numbers(), blocks(batches, "text")):
            values, first = pieces(rows["text"])
            distinct, codes = numbered(values)
            home = np.fromiter((xxhash.xxh32_intdigest(x) for x in distinct.to_pylist()), np.uint32, len(distinct)) % shards
            order = pc.sort_indices(
                pa.table({"shard": home, "word": distinct}), [("shard", "ascending"), ("word", "ascending")]
            ).to_numpy()
            distinct = distinct.take(pa.array(order))
            yield block, rows, first, codes, order, distinct, home[order], xxhash.xxh3_64_intdigest(word_bytes(distinct)[1])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, _, _, _, distinct, home, digest in cut(batches):
            names, begin = dealt(home)
            data = [
                freeze_words(distinct.slice(a, b - a), digest=digest)
                for a, b in zip(begin, np.append(begin[1:], len(distinct)))
            ]
            yield output(PACKED_ARROW, block=[block] * len(names), shard=names, data=data)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows, first, codes, order, _, _, digest in cut(batches):
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            body = freeze(**keys(rows["id"]), first=small(np.diff(first)), codes=place[codes], digest=digest)
            yield output(PACKED_ARROW, block=[block], shard=[BODY], data=[body])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            answers = []
            for data in batch["data"].to_pylist():
                if len(known) > KNOWN_PIECES:
                    known.clear()
                found = []
                parts = thaw(data)
                for piece in thaw_words(parts).to_pylist():
                    ids = known.get(piece)
                    if ids is None:
                        ids = known[piece] = encoder._encode_single_piece(piece)
                    found.append(ids)
                flat = np.fromiter((i for ids in found for i in ids), np.int32)
                lengths = small(np.array([len(x) for x in found]))
                answers.append(freeze(lengths=lengths, ids=small(flat), digest=parts["digest"]))
            yield output(PACKED_ARROW, block=batch["block"], shard=batch["shard"], data=answers)

    result = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def place(table: pa.Table) -> pa.Table:
        block, body, answers = opened(table)
        if any(x["digest"] != body["digest"] for x in answers) or sum(len(x["lengths"]) for x in answers) <= body["codes"].max(initial=-1):
            raise ValueError(f"block {block} was read differently the second time; store the input first")
        lengths = np.concatenate([x["lengths"] for x in answers]) if answers else np.zeros(0, np.int64)
        ids = np.concatenate([x["ids"] for x in answers]) if answers else np.zeros(0, np.int64)
        offsets = np.zeros(len(lengths) + 1, np.int64)
        np.cumsum(lengths, out=offsets[1:])
        words = pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
        placed = words.take(pa.array(body["codes"]))
        at = np.zeros(len(body["first"]) + 1, np.int64)
        np.cumsum(body["first"], out=at[1:])
        edges = placed.offsets.to_numpy()[at].astype(np.int32)
        rows = pa.ListArray.from_arrays(pa.array(edges), placed.values)
        return pa.table([key_array(body), rows], schema=result)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    asked = rows.mapInArrow(ask, PACKED).repartition(partitions(spark), "shard")
    return (
        by_block(rows.mapInArrow(keep, PACKED), asked.mapInArrow(merge, PACKED))
        .applyInArrow(place, "id long, ids array<int>")
        .withColumnRenamed("id", id_col)
    )


def decode(encoded: DataFrame, ranks: bytes, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """The same rows with the bytes that the ids stand for; a null list gives
    no bytes."""
    spark = encoded.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(ranks)
    at = encoded.columns.index(ids_col)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _token_bytes(shared.value)
        for batch in batches:
            lists = batch.column(at)
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            edges = np.zeros(len(lists) + 1, np.int64)
            np.cumsum(lengths, out=edges[1:])
            spelt = table.take(lists.flatten())
            offsets = np.frombuffer(spelt.buffers()[1], np.int64)[: len(spelt) + 1] if len(spelt) else np.zeros(1, np.int64)
            data = spelt.buffers()[2] if len(spelt) else b""
            decoded = binary_array(offsets[edges], data).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*batch.schema.names, out_col])

    schema = T.StructType([*encoded.schema.fields, T.StructField(out_col, T.BinaryType())])
    return encoded.mapInArrow(spell, schema)


def digests(docs: DataFrame, ranks: bytes) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    coded = decode(encode(docs, ranks), ranks)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
