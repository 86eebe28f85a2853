"""Whole-text primitives over Arrow string batches, vectorised with numpy.

Everything here works on the raw UTF-8 bytes of a column of texts.  A batch is
cut into slices of a few megabytes (never inside a document), so the memory of
a task depends on the slice size and on its longest text, not on its input.
A null text counts as an empty one.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
BLOCK_BYTES = 1 << 20
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: ASCII white space 0x20 and 0x09-0x0D.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_P, _P_INV)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[i] = np.cumprod(p)
    return _powers[0][:n], _powers[1][:n]


def buffer_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls have length 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    if col.null_count:
        col = col.fill_null("")
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    _, off, data = col.buffers()
    n = len(col)
    if n == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(off, np.int64)[col.offset : col.offset + n + 1]
    base = int(offsets[0])
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[base : int(offsets[-1])], offsets - base


def give_back() -> None:
    """Returns freed memory to the system: a worker lives on after a batch of large texts."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, or one row where that is longer."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n, lo + 65536)
        yield lo, hi
        lo = hi
    give_back()


def spans(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of word bytes, and for each document the
    index of its first word (one entry more than documents)."""
    w = is_word[buf]
    n = len(w)
    if n == 0:
        e = np.zeros(0, np.int64)
        return e, e, np.zeros(len(offsets), np.int64)
    prev = np.zeros(n, bool)
    prev[1:] = w[:-1]
    cut = offsets[:-1]
    cut = cut[cut < n]
    prev[cut] = False
    starts = np.flatnonzero(w & ~prev)
    nxt = np.zeros(n, bool)
    nxt[:-1] = w[1:]
    last = offsets[1:] - 1
    nxt[last[last >= 0]] = False
    ends = np.flatnonzero(w & ~nxt) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, equal for equal bytes."""
    out = np.empty(len(starts), np.uint64)
    i, n = 0, len(starts)
    while i < n:
        lo = int(starts[i])
        j = max(int(np.searchsorted(ends, lo + BLOCK_BYTES, "right")), i + 1)
        block = buf[lo : int(ends[j - 1])]
        pw, inv = power_tables(max(len(block) + 1, BLOCK_BYTES + 1))
        acc = np.zeros(len(block) + 1, np.uint64)
        np.cumsum((block.astype(np.uint64) + np.uint64(1)) * pw[: len(block)], out=acc[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (acc[e] - acc[s]) * inv[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        i = j
    return mix(out)


def doc_of(first: np.ndarray) -> np.ndarray:
    """The document index of each item, from each document's first item."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def shingles(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words, in order, and each document's first one.
    A document of 1 to k-1 words has its whole sequence as its only shingle."""
    n_words = np.diff(first)
    counts = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(np.int64))
    out_first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    doc = doc_of(out_first)
    at = first[doc] + (np.arange(len(doc)) - out_first[doc])
    length = np.minimum(n_words, k)[doc]
    acc = length.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    if len(at):
        for j in range(k):
            step = np.uint64(pow(0xE7037ED1A0B428DB, j + 1, 1 << 64))
            here = words[np.minimum(at + j, len(words) - 1)] * step
            acc += here if int(length.min()) > j else np.where(length > j, here, np.uint64(0))
    return mix(acc), out_first


def distinct(first: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each document's distinct values, sorted, and each document's first one."""
    v = value.copy()
    bounds = first.tolist()
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a > 1:
            v[a:b].sort()
    keep = np.ones(len(v), bool)
    keep[1:] = v[1:] != v[:-1]
    head = first[:-1][np.diff(first) > 0]
    keep[head] = True
    return v[keep], np.concatenate([[0], np.cumsum(keep)])[first]
