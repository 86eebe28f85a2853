"""Moves of pieces of different sizes between byte arrays."""

from __future__ import annotations

import numpy as np


def copy_pieces(dst: np.ndarray, dst_at: np.ndarray, src: np.ndarray, src_at: np.ndarray, size: np.ndarray) -> None:
    """dst[dst_at[i] : +size[i]] = src[src_at[i] : +size[i]] for all i."""
    total = int(size.sum())
    if total:
        inner = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
        dst[np.repeat(dst_at, size) + inner] = src[np.repeat(src_at, size) + inner]


def fixed(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` bytes at each place, one row each."""
    return data[at[:, None] + np.arange(width)]


def little(cells: np.ndarray) -> np.ndarray:
    out = np.zeros(len(cells), np.uint64)
    for i in range(cells.shape[1]):
        out |= cells[:, i].astype(np.uint64) << np.uint64(8 * i)
    return out


def big(cells: np.ndarray) -> np.ndarray:
    return little(cells[:, ::-1])


def to_little(values: np.ndarray, width: int) -> np.ndarray:
    v = values.astype(np.int64).view(np.uint64) if values.dtype != np.uint64 else values
    return np.stack([(v >> np.uint64(8 * i) & np.uint64(255)).astype(np.uint8) for i in range(width)], axis=1) if len(v) else np.zeros((0, width), np.uint8)


def to_big(values: np.ndarray, width: int) -> np.ndarray:
    return np.ascontiguousarray(to_little(values, width)[:, ::-1])
