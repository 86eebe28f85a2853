"""Row images of rows events: from bytes to columns and back.

Scanning only finds where values stand: a row's null bitmap chooses a layout in
which everything between two values of varying size is at fixed distances.  All
values of a column are then decoded together.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from ..functions.names import UPDATE_ROWS, WRITE_ROWS
from .cursor import Cursor, Truncated, bit, packed
from .ragged import copy_pieces
from .tablemap import Column, TableMap
from .values import arrow_type, decode_values, encode_values, width_of

DUMMY_TABLE = 0x00FFFFFF


@dataclass
class RowsHeader:
    table_id: int
    flags: int
    present: tuple[int, ...]
    present_after: tuple[int, ...] | None  # of updates with two images
    start: int


def version_of(event_type: int) -> int:
    return (event_type - 0x14) // 3 if event_type < 0x1A else 2


def decode_rows_header(data, pos: int, end: int, event_type: int, post_header: int = 10) -> RowsHeader:
    """``post_header`` 6: table ids of four bytes."""
    c = Cursor(data, pos, end)
    table_id = c.uint(4 if post_header == 6 else 6)
    flags = c.uint(2)
    version = version_of(event_type)
    if version == 2:
        c.skip(c.uint(2) - 2)
    if table_id == DUMMY_TABLE:
        return RowsHeader(table_id, flags, (), None, end)
    count = c.packed()
    two = event_type in UPDATE_ROWS and version > 0

    def bits() -> tuple[int, ...]:
        raw = c.take((count + 7) // 8)
        return tuple(i for i in range(count) if bit(raw, i))

    first = bits()
    return RowsHeader(table_id, flags, first, bits() if two else None, c.pos)


class _Layout:
    """Where the values of rows with one null bitmap stand."""

    def __init__(self, columns: list[Column], nulls: bytes):
        self.fixed: list[tuple[int, int, int]] = []  # column, anchor, distance
        self.sized: list[tuple[int, int, int, int]] = []  # column, anchor, distance, bytes of length
        anchor = distance = 0
        for i, col in enumerate(columns):
            if bit(nulls, i):
                continue
            width, is_length = width_of(col)
            if is_length:
                self.sized.append((i, anchor, distance, width))
                anchor, distance = anchor + 1, 0
            else:
                self.fixed.append((i, anchor, distance))
                distance += width
        self.tail = distance
        self.steps = [(d, w) for _, _, d, w in self.sized]


class ImageScanner:
    """Collects the places of row images of one kind, and decodes them by column."""

    def __init__(self, columns: list[Column]):
        self.columns = columns
        self.null_bytes = (len(columns) + 7) // 8
        self.layouts: dict[bytes, _Layout] = {}
        self.clear()

    def clear(self) -> None:
        self.count = 0
        self.rows: dict[bytes, list[int]] = {}
        self.anchors: dict[bytes, list[int]] = {}

    def scan(self, data, pos: int, end: int) -> int:
        """Takes in the image at ``pos``; where it ends."""
        p = pos + self.null_bytes
        nulls = bytes(data[pos:p])
        layout = self.layouts.get(nulls)
        if layout is None:
            layout = self.layouts[nulls] = _Layout(self.columns, nulls)
        if nulls not in self.rows:
            self.rows[nulls], self.anchors[nulls] = [], []
        out = self.anchors[nulls]
        out.append(p)
        for distance, width in layout.steps:
            q = p + distance
            p = q + width + (data[q] if width == 1 else int.from_bytes(data[q : q + width], "little"))
            if p > end:
                raise Truncated("a value ends after its event")
            out.append(p)
        p += layout.tail
        if p > end:
            raise Truncated("a row ends after its event")
        self.rows[nulls].append(self.count)
        self.count += 1
        return p

    def columns_of(self, data: np.ndarray) -> list[pa.Array]:
        """The collected images by column, in the order of scanning."""
        parts: list[list[pa.Array]] = [[] for _ in self.columns]
        order = []
        for nulls, rows in self.rows.items():
            layout = self.layouts[nulls]
            places = np.array(self.anchors[nulls], np.int64).reshape(len(rows), -1)
            order += rows
            done = set()
            for i, anchor, distance in layout.fixed:
                parts[i].append(decode_values(self.columns[i], data, places[:, anchor] + distance))
                done.add(i)
            for i, anchor, distance, width in layout.sized:
                at = places[:, anchor] + distance + width
                parts[i].append(decode_values(self.columns[i], data, at, places[:, anchor + 1] - at))
                done.add(i)
            for i, col in enumerate(self.columns):
                if i not in done:
                    parts[i].append(pa.nulls(len(rows), arrow_type(col)))
        if len(self.rows) == 1:
            return [p[0] for p in parts]
        back = pa.array(np.argsort(np.array(order, np.int64), kind="stable"))
        return [pa.concat_arrays(p).take(back) if p else pa.nulls(0, arrow_type(c)) for p, c in zip(parts, self.columns)]


def encode_images(columns: list[Column], arrays: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """Row images of the given columns, one after the other, and their sizes."""
    n = len(arrays[0]) if arrays else 0
    null_bytes = (len(columns) + 7) // 8
    bitmap = np.zeros((n, null_bytes), np.uint8)
    cells = []
    size = np.full(n, null_bytes, np.int64)
    for i, (col, values) in enumerate(zip(columns, arrays)):
        if isinstance(values, pa.ChunkedArray):
            values = values.combine_chunks()
        there = np.flatnonzero(~np.asarray(values.is_null()))
        missing = np.ones(n, bool)
        missing[there] = False
        bitmap[missing, i >> 3] |= 1 << (i & 7)
        raw, sizes = encode_values(col, values.drop_null())
        cells.append((there, raw, sizes))
        size[there] += raw.shape[1] if sizes is None and raw.ndim == 2 else sizes if sizes is not None else 0
    start = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint8)
    out[start[:, None] + np.arange(null_bytes)] = bitmap
    at = start + null_bytes
    for there, raw, sizes in cells:
        if sizes is None:
            w = raw.shape[1]
            out[at[there][:, None] + np.arange(w)] = raw
            at[there] += w
        else:
            copy_pieces(out, at[there], raw, np.cumsum(sizes) - sizes, sizes)
            at[there] += sizes
    return out, size


def encode_rows_header(t: TableMap, event_type: int, present: list[int] | None = None, after: list[int] | None = None) -> bytes:
    count = len(t.columns)

    def bits(chosen) -> bytes:
        raw = bytearray((count + 7) // 8)
        for i in range(count) if chosen is None else chosen:
            raw[i >> 3] |= 1 << (i & 7)
        return bytes(raw)

    out = t.table_id.to_bytes(6, "little") + (1).to_bytes(2, "little")
    if version_of(event_type) == 2:
        out += (2).to_bytes(2, "little")
    out += packed(count) + bits(present)
    if event_type in UPDATE_ROWS and version_of(event_type) > 0:
        out += bits(after)
    return out


def is_insert(event_type: int) -> bool:
    return event_type in WRITE_ROWS
