"""Hashed text features for the ordinal models.

Each function maps texts to (row, feature, value), every pair of row and
feature once. ``useful``, if given, tells the features that count; the others
are left out early.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash

from .ordinal import DIMENSIONS
from .text import ALNUM, SOLID, numbered, words

PREFIXES = (4, 5, 6)  # bytes


def _hashed(values: list[bytes], seed: int) -> np.ndarray:
    digest = xxhash.xxh32_intdigest
    return np.fromiter((digest(v, seed) for v in values), np.int64, len(values)) % DIMENSIONS


def _present(row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pair = np.unique(row * DIMENSIONS + feature)
    return pair // DIMENSIONS, pair % DIMENSIONS


def vocabulary(texts: pa.ChunkedArray, useful: np.ndarray | None = None):
    """Which words a text has, and which beginnings of words."""
    found = words(texts, ALNUM, lower=True)
    distinct, codes = numbered(found.values())
    spelt = distinct.to_pylist()
    owner = found.owner()
    rows, features = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for seed, length in enumerate((0, *PREFIXES), start=1):
        keys = _hashed([w[:length] for w in spelt] if length else spelt, seed)
        wanted = np.ones(len(spelt), bool) if useful is None else useful[keys]
        if length:
            wanted &= np.fromiter((len(w) >= length for w in spelt), bool, len(spelt))
        at = np.flatnonzero(wanted[codes])
        rows.append(owner[at])
        features.append(keys[codes[at]])
    row, feature = _present(np.concatenate(rows), np.concatenate(features))
    return row, feature, np.ones(len(row))


_RUNS = [
    (re.compile(pattern), mark)
    for pattern, mark in ((rb"[A-Z]?[a-z\x80-\xff]+", b"a"), (rb"[A-Z]{2,}", b"A"), (rb"[0-9]+", b"0"))
]
LEVELS = (1 / 32, 1 / 8, 1 / 2)


def _shape(word: bytes) -> bytes:
    for pattern, mark in _RUNS:
        word = pattern.sub(mark, word)
    return word[:12]


def style(texts: pa.ChunkedArray, useful: np.ndarray | None = None):
    """Which words and beginnings a text has; and of each shape of token, such
    as upper case with exclamation marks or the token before once more, whether
    it makes up a 32nd, an 8th, a half of the tokens."""
    row, feature, _ = vocabulary(texts, useful)
    found = words(texts, SOLID)
    distinct, codes = numbered(found.values())
    spelt = distinct.to_pylist()
    shapes = {shape: i for i, shape in enumerate(dict.fromkeys(map(_shape, spelt)))}
    kind = np.fromiter((shapes[_shape(w)] for w in spelt), np.int64, len(spelt))
    owner, lengths = found.owner(), np.diff(found.first)
    again = np.flatnonzero((codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])) + 1
    width = len(shapes) + 1  # the last for a repeated token
    pair, count = np.unique(
        np.concatenate([owner * width + kind[codes], owner[again] * width + len(shapes)]), return_counts=True
    )
    share = count / np.maximum(lengths[pair // width], 1)
    names = [*shapes, b"\n"]
    rows, features = [row], [feature]
    for number, level in enumerate(LEVELS):
        keys = _hashed(names, 100 + number)
        at = np.flatnonzero(share >= level)
        rows.append(pair[at] // width)
        features.append(keys[pair[at] % width])
    row, feature = _present(np.concatenate(rows), np.concatenate(features))
    return row, feature, np.ones(len(row))
