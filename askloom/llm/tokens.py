"""Words and word shingles of Arrow text batches, as numpy arrays.

Texts stay in the one buffer Arrow hands over; words are found and hashed for many
documents at once.  Work arrays are bounded: a batch is taken in slices of at most
``SLICE`` bytes (or one document, if that is longer).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
WIDTH = 5
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: An odd multiplier and its inverse modulo 2**64, for hashes of substrings.
STEP = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(int(STEP), -1, 1 << 64))
PLACE = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values so that every bit depends on every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of a multiplier, kept for the longest slice seen."""

    def __init__(self, base: np.uint64):
        self.base, self.kept = base, np.ones(1, np.uint64)

    def __reduce__(self):
        return _Powers, (self.base,)  # a function sent to tasks does not carry the table

    def upto(self, n: int) -> np.ndarray:
        if len(self.kept) < n:
            grown = np.full(max(n, SLICE + 1), self.base, np.uint64)
            grown[0] = 1
            self.kept = np.multiply.accumulate(grown)
        return self.kept[:n]


_UP, _DOWN = _Powers(STEP), _Powers(BACK)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its n + 1 offsets; nulls are empty."""
    column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64) \
        if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets from 0) of pieces of about ``size`` bytes."""
    data, offsets = buffers(column)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


@dataclass
class Words:
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte after it
    doc: np.ndarray  # document of each word
    first: np.ndarray  # first word of each document, n + 1 places
    hash: np.ndarray


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running sums from which ``span_hashes`` takes the hash of any substring."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _DOWN.upto(len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mixed((sums[end] - sums[start]) * _UP.upto(len(sums))[start] + (end - start).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> Words:
    """Words of documents, lower-cased (A-Z) unless told not to; documents do not run into each other."""
    if lower:
        data = LOWER[data]
    n, docs = len(data), len(offsets) - 1
    solid = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    opens = solid.copy()
    opens[1:] &= ~solid[:-1] | edge[1:n]
    closes = solid.copy()
    closes[:-1] &= ~solid[1:] | edge[1:n]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    first = np.zeros(docs + 1, np.int64)
    np.cumsum(np.bincount(doc, minlength=docs), out=first[1:])
    return Words(start, end, doc, first, span_hashes(prefix_hashes(data), start, end))


def shingles(w: Words, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each shingle of ``width`` words, its document and its first word.

    A document with fewer words has its whole sequence as its one shingle.
    """
    count = np.diff(w.first)
    n = len(w.hash)
    if n >= width:
        acc = np.zeros(n - width + 1, np.uint64)
        for k in range(width):
            acc += mixed(w.hash[k:n - width + 1 + k] + PLACE[k % len(PLACE)])
        whole = w.doc[:n - width + 1] == w.doc[width - 1:]
        at = np.flatnonzero(whole)
        value, doc = mixed(acc[at]), w.doc[at]
    else:
        value, doc, at = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    few = np.flatnonzero((count > 0) & (count < width))
    if len(few):
        extra = np.array([_short(w.hash[w.first[d]:w.first[d + 1]]) for d in few], np.uint64)
        value, doc, at = np.concatenate([value, extra]), np.concatenate([doc, few]), np.concatenate([at, w.first[few]])
        order = np.argsort(doc, kind="stable")
        value, doc, at = value[order], doc[order], at[order]
    return value, doc, at


def _short(hashes: np.ndarray) -> int:
    acc = np.uint64(len(hashes))
    with np.errstate(over="ignore"):
        for k, h in enumerate(hashes):
            acc = mixed(np.array([acc + h * PLACE[k]], np.uint64))[0]
    return int(acc)


def distinct(value: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each document, one after another, and the n + 1 places of the documents."""
    bounds = np.searchsorted(doc, np.arange(docs + 1))
    parts = [np.unique(value[bounds[d]:bounds[d + 1]]) for d in range(docs)]
    first = np.zeros(docs + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=first[1:])
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), first
