"""Words of whole batches of texts as numpy arrays."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

_U = np.uint64
#: An odd multiplier and its inverse modulo 2**64, for rolling hashes over bytes.
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the SplitMix64 finaliser)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


class Words(NamedTuple):
    data: np.ndarray  # bytes of the batch, A-Z lower-cased
    start: np.ndarray  # byte offsets of the words
    end: np.ndarray
    doc: np.ndarray  # row of each word in the batch
    hash: np.ndarray  # 64-bit hash of each word
    first: np.ndarray  # index of each row's first word, with the number of words at the end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the rows' offsets in them; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split_words(column: pa.Array) -> Words:
    """Maximal runs of bytes other than space and 09-0D, with A-Z lower-cased."""
    data, offsets = text_bytes(column)
    upper = (data >= 65) & (data <= 90)
    data = np.where(upper, data + np.uint8(32), data)
    inside = np.zeros(len(data) + 2, np.bool_)
    inside[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[1:-1][edges]  # a row boundary also ends a word
    ends[edges - 1] = inside[1:-1][edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * _power(_BASE, len(data)), out=sums[1:])
    code = (sums[end] - sums[start]) * _power(_INVERSE, len(data) + 1)[start]
    return Words(data, start, end, doc, mix(code + (end - start).astype(np.uint64)), first)


def shingle_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of k words within one row, and the index of its first word."""
    n = len(words.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    code = np.zeros(n, np.uint64)
    for i in range(k):
        code = mix(code * _U(_BASE) + words.hash[i : i + n])
    at = np.flatnonzero(words.doc[:n] == words.doc[k - 1 :])
    return code[at], at
