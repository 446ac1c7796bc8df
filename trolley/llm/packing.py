"""Blocks of documents that ask the whole corpus about their words.

Many corpus-wide questions are about distinct words or phrases: how does this
word encode, how often does it occur, does this phrase recur? Moving every
occurrence would shuffle several times the corpus. Here a block of documents
is dictionary-encoded where it is read; only its distinct keys travel, packed
into one row per block and key shard. A shard, holding every block's keys of
that shard, works out the answers, which travel back to the blocks:

    (block, shard, data)  --by shard-->  answers  --by block-->  documents

A row with shard ``BODY`` is the block itself: its documents as numbers of its
own dictionary. A hot word is one entry per block, so no task gets more than
its share, and a block's size bounds the memory of its group.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .text import binary_array

BODY = -1
PACKED = "block long, shard int, data binary"
PACKED_ARROW = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("data", pa.binary())])
SHARDS_PER_PARTITION = 4


def shard_count(spark: SparkSession) -> int:
    """Follows the shuffle partitions, which follow the size of the data."""
    return SHARDS_PER_PARTITION * partitions(spark)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def block_numbers():
    """Numbers for the blocks of this task, unlike those of any other."""
    number = TaskContext.get().partitionId() << 32
    while True:
        yield number
        number += 1


def freeze(**parts) -> bytes:
    """Arrays and other values as compressed bytes. Arrays of numbers are
    stored byte plane by byte plane, which compresses better."""
    stored = {}
    for name, value in parts.items():
        if isinstance(value, np.ndarray) and value.ndim == 1 and value.itemsize > 1:
            planes = np.ascontiguousarray(value.view(np.uint8).reshape(-1, value.itemsize).T)
            stored[name] = (value.dtype.str, planes.tobytes())
        else:
            stored[name] = value
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(stored, protocol=5))


def thaw(data: bytes) -> dict:
    parts = pickle.loads(zstandard.ZstdDecompressor().decompress(data))
    for name, value in parts.items():
        if isinstance(value, tuple):
            kind = np.dtype(value[0])
            planes = np.frombuffer(value[1], np.uint8).reshape(kind.itemsize, -1)
            parts[name] = np.ascontiguousarray(planes.T).view(kind).reshape(-1)
    return parts


def small(values: np.ndarray) -> np.ndarray:
    """Counts and lengths in the smallest unsigned type that holds them."""
    top = int(values.max(initial=0))
    return values.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def freeze_words(values: pa.LargeBinaryArray, **more) -> bytes:
    """Words as lengths and bytes, sorted words compressing best."""
    lengths, data = word_bytes(values)
    return freeze(lengths=small(lengths), data=data, **more)


def word_bytes(values: pa.LargeBinaryArray) -> tuple[np.ndarray, bytes]:
    if not len(values):
        return np.zeros(0, np.int64), b""
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    return np.diff(offsets), bytes(memoryview(values.buffers()[2])[offsets[0] : offsets[-1]])


def thaw_words(parts: dict) -> pa.LargeBinaryArray:
    offsets = np.zeros(len(parts["lengths"]) + 1, np.int64)
    np.cumsum(parts["lengths"], out=offsets[1:])
    return binary_array(offsets, parts["data"])


def dealt(shards: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shard numbers that occur and where each begins in sorted ``shards``."""
    return np.unique(shards, return_index=True)


def by_block(body: DataFrame, answers: DataFrame) -> DataFrame:
    """Bodies and answers of each block together, one group per block."""
    return body.select("block", "shard", "data").unionByName(answers.select("block", "shard", "data")).groupBy("block")


def opened(table: pa.Table) -> tuple[int, dict, list[dict]]:
    """Of a block's group: its number, its body, its answers by shard."""
    shards = table["shard"].to_numpy()
    data = table["data"]
    order = np.argsort(shards, kind="stable")
    if not len(order) or shards[order[0]] != BODY:
        raise ValueError("answers for a block that has no body")
    parts = [thaw(data[int(i)].as_py()) for i in order]
    return table["block"][0].as_py(), parts[0], parts[1:]


def keys(column: pa.ChunkedArray) -> dict[str, np.ndarray]:
    """Row ids for a body: the values, and which are not null."""
    column = column.combine_chunks()
    return {
        "ids": column.fill_null(0).to_numpy(zero_copy_only=False),
        "known": column.is_valid().to_numpy(zero_copy_only=False).view(np.uint8),
    }


def key_array(body: dict) -> pa.Array:
    return pa.array(body["ids"], pa.int64(), mask=body["known"] == 0)
