"""Words and pieces of whole texts, found with array operations.

A block of texts is one byte buffer with a line feed after each text, so that
no word crosses two texts. Nulls count as empty texts.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

BLOCK_BYTES = 5 << 19  # of text in one block; a longer text is a block by itself


def _return_memory() -> None:
    """Give arrays of a quarter MB and more back to the system as soon as they
    are freed: a Python worker serves many blocks beside the executor's heap."""
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        ctypes.CDLL("libc.so.6").mallopt(-3, 1 << 18)  # M_MMAP_THRESHOLD
    except (OSError, AttributeError):
        pass  # another C library keeps its own rules


_return_memory()

_BYTES = np.arange(256)
#: Words between white space: [^\x20\x09-\x0D]+
SOLID = (_BYTES != 32) & ((_BYTES < 9) | (_BYTES > 13))
#: Letters and digits, anything beyond ASCII included: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
#: once A-Z are lower-cased.
ALNUM = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)


def bound_batches(spark: SparkSession) -> None:
    """Let no Arrow batch exceed a block, whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BLOCK_BYTES))


def blocks(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES
) -> Iterator[pa.Table]:
    """Rows in input order, dealt into tables of about ``limit`` bytes of
    ``column`` and at least one row."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        start = 0
        while start < batch.num_rows:
            done = int(ends[start - 1]) if start else 0
            stop = int(np.searchsorted(ends, done + limit - size, side="right"))
            if stop <= start:
                if held:
                    yield pa.Table.from_batches(held)
                    held, size = [], 0
                    continue
                stop = start + 1
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1]) - done
            start = stop
    if held:
        yield pa.Table.from_batches(held)


def joined(column: pa.ChunkedArray | pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The block's buffer and the texts' offsets in it, the end included."""
    texts = [t if t is not None else b"" for t in pc.cast(column, pa.binary()).to_pylist()]
    buffer = np.frombuffer(b"\n".join(texts) + b"\n" * bool(texts), np.uint8)
    if lower:
        buffer = _LOWER[buffer]
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    return buffer, offsets


@dataclass
class Words:
    """Words of a block. Text i has the words first[i] to first[i + 1]."""

    buffer: np.ndarray
    inside: np.ndarray  # of the buffer's bytes: part of a word?
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def values(self) -> pa.LargeBinaryArray:
        offsets = np.zeros(len(self) + 1, np.int64)
        np.cumsum(self.ends - self.starts, out=offsets[1:])
        return binary_array(offsets, self.buffer[self.inside])

    def spaced(self) -> tuple[bytes, np.ndarray]:
        """All words with one space after each, and their offsets."""
        kept = self.inside.copy()
        kept[1:] |= self.inside[:-1]
        offsets = np.zeros(len(self) + 1, np.int64)
        np.cumsum(self.ends - self.starts + 1, out=offsets[1:])
        return np.where(self.inside, self.buffer, 32).astype(np.uint8)[kept].tobytes(), offsets

    def owner(self) -> np.ndarray:
        """Each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(column: pa.ChunkedArray | pa.Array, kind: np.ndarray, lower: bool = False) -> Words:
    buffer, offsets = joined(column, lower)
    inside = kind[buffer]
    step = np.diff(inside.view(np.int8), prepend=np.int8(0))
    starts = np.flatnonzero(step == 1)
    return Words(buffer, inside, starts, np.flatnonzero(step == -1), np.searchsorted(starts, offsets))


def binary_array(offsets: np.ndarray, data: np.ndarray | bytes) -> pa.LargeBinaryArray:
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    )


def numbered(values: pa.LargeBinaryArray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The distinct values and each value's number among them."""
    coded = values.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def rolled(hashes: np.ndarray, length: int, base: int) -> np.ndarray:
    """A hash of each run of ``length`` consecutive hashes; shorter than the
    input by ``length - 1``."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    factor = np.uint64(base | 1)
    with np.errstate(over="ignore"):
        for k in range(length):
            out *= factor
            out += hashes[k : k + n]
    return mix(out)


# The pieces into which byte-pair encoding cuts a text before merging.

_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
#: The code points with the Unicode property White_Space.
_WHITE = [*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of each code point, from the regular-expression library's tables."""
    import regex

    classes = np.full(0x110000, _OTHER, np.uint8)
    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)]).astype(np.uint32)
    every = points.tobytes().decode("utf-32-le")
    for pattern, kind in ((r"\p{L}+", _LETTER), (r"\p{N}+", _NUMBER)):
        for found in regex.finditer(pattern, every):
            classes[points[found.start() : found.end()]] = kind
    classes[_WHITE] = _SPACE
    return classes


def pieces(column: pa.ChunkedArray | pa.Array) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The pieces of each text under the pattern

        's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

    and each text's first piece, the end included. Pieces begin where the class
    of character changes, with three corrections: white space before something
    else gives up its last character; if that is a space, it opens the next
    piece; a lone apostrophe takes the ending after it.
    """
    texts = [t if t is not None else b"" for t in pc.cast(column, pa.binary()).to_pylist()]
    data = b"".join(texts)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    if not data:
        return binary_array(np.zeros(1, np.int64), b""), np.zeros(len(offsets), np.int64)
    raw = np.frombuffer(data, np.uint8)
    leads = np.flatnonzero((raw & 0xC0) != 0x80)
    points = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
    kinds = _classes()[points]
    n = len(points)

    opens = np.zeros(n + 1, bool)  # of the code points and the end: a text begins here
    opens[np.searchsorted(leads, offsets)] = True
    begins = opens[:-1].copy()
    begins[1:] |= kinds[1:] != kinds[:-1]
    runs = begins.copy()
    after = np.flatnonzero(begins[1:] & ~opens[1:-1] & (kinds[1:] != _SPACE) & (kinds[:-1] == _SPACE)) + 1
    begins[after - 1] = True
    begins[after[points[after - 1] == 32]] = False

    ahead = np.pad(points, (0, 3))
    ends = np.pad(opens, (0, 3), constant_values=True)  # ends[i]: i opens a text or is behind all
    quote = np.flatnonzero((points == ord("'")) & begins & runs)
    quote = quote[~ends[quote + 1]]
    one = quote[np.isin(ahead[quote + 1], [ord(c) for c in "stmd"])]
    pair = ahead[quote + 1].astype(np.uint64) << np.uint64(32) | ahead[quote + 2]
    two = quote[
        np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")]) & ~ends[quote + 2]
    ]
    for at, length in ((one, 2), (two, 3)):
        begins[at + 1] = False
        rest = at[~ends[at + length]] + length
        begins[rest[kinds[rest] == _LETTER]] = True

    starts = leads[np.flatnonzero(begins)]
    return binary_array(np.append(starts, len(raw)), raw), np.searchsorted(starts, offsets)


def output(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
