"""Vectorised word hashing over Arrow text columns.

Words are maximal runs of the bytes that a 256-entry table marks. A word's hash
is a polynomial in its bytes modulo 2**64, read off prefix sums and mixed, so
that equal words have equal hashes in every document, batch and task.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Text bytes hashed at once; a longer document is a chunk of its own.
CHUNK_BYTES = 1 << 20

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Words are anything but ASCII white space.
NOT_SPACE = ~WHITE
#: Words are ASCII letters, digits and all non-ASCII characters.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE, _INVERSE = 0x9E3779B97F4A7C15 | 1, pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64)
_random = np.random.default_rng(20240229)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.int64).astype(U64)
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, base in enumerate((_BASE, _INVERSE)):
            factors = np.full(size, base, U64)
            factors[0] = 1
            _powers[k] = np.multiply.accumulate(factors)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of width values."""
    n = len(values)
    rows = np.concatenate([values, np.full(-n % width, np.iinfo(np.uint64).max, U64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, inverse powers): (sums[j] - sums[i]) * inverse[i] depends on data[i:j] alone."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE[data] * up[:-1], out=sums[1:])
    return sums, down


class Words(NamedTuple):
    """Words of a run of documents: hashes in order, and where each document's begin."""

    first: int
    hashes: np.ndarray
    offsets: np.ndarray


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a text column; null texts are empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    return offsets, np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of documents of at most limit bytes together, or one longer document."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


def words(column: pa.Array, is_word: np.ndarray, lower: bool) -> Iterator[Words]:
    """Word hashes of a text column, a run of documents at a time."""
    offsets, data = text_buffers(column)
    for i, j in chunks(offsets):
        begin, end = int(offsets[i]), int(offsets[j])
        text = data[begin:end]
        if lower:
            text = LOWER[text]
        inside = np.zeros(len(text) + 2, np.int8)
        inside[1:-1] = is_word[text]
        # a document boundary separates words
        bounds = offsets[i : j + 1] - begin
        change = np.diff(inside)
        starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        cut = bounds[1:-1]
        cut = np.unique(cut[(cut > 0) & (cut < len(text))])
        if len(cut):
            cut = cut[(inside[cut] == 1) & (inside[cut + 1] == 1)]
            starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
        sums, down = prefix_sums(text)
        hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))
        yield Words(i, hashes, np.searchsorted(starts, bounds))
