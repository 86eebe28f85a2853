"""Scans of one range of a log file as Arrow batches: events, rows, or one table."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa

from ..functions.names import DELETE_ROWS, ROWS, UPDATE_ROWS, event_name, op_name
from ..plans.planner import FIRST, Range, file_format, settled
from .events import FORMAT, TABLE_MAP, Format, Header, checksum_ok, decode_format, describe, iterate, read_header
from .files import Folder
from .rows import DUMMY_TABLE, ImageScanner, decode_rows_header, version_of
from .tablemap import Column, TableMap, decode_table_map
from .values import arrow_type, as_text

BATCH_ROWS = 16384
#: Bytes of a range that a task holds at a time, or one event where that is larger.
WINDOW = 32 << 20

EVENT_FIELDS = [
    ("log_file", pa.string()), ("file_seq", pa.int32()), ("start_pos", pa.int64()), ("next_pos", pa.int64()), ("event_time", pa.timestamp("us", "UTC")), ("event_type", pa.int32()),
    ("event_name", pa.string()), ("server_id", pa.int64()), ("event_size", pa.int64()), ("flags", pa.int32()), ("crc_ok", pa.bool_()),
]
EVENTS_SCHEMA = pa.schema([*EVENT_FIELDS, ("detail", pa.string()), ("body", pa.binary())])
_MAP = pa.map_(pa.string(), pa.string())
ROWS_SCHEMA = pa.schema(
    [*EVENT_FIELDS, ("row_no", pa.int32()), ("op", pa.string()), ("schema_name", pa.string()), ("table_name", pa.string()), ("table_id", pa.int64()), ("schema_fp", pa.int64()), ("before", _MAP), ("after", _MAP)]
)
CORRUPT_SCHEMA = pa.schema(
    [("log_file", pa.string()), ("file_seq", pa.int32()), ("start_pos", pa.int64()), ("event_type", pa.int32()), ("event_name", pa.string()), ("event_size", pa.int64()), ("reason", pa.string())]
)
TABLE_FIELDS = [("log_file", pa.string()), ("file_seq", pa.int32()), ("start_pos", pa.int64()), ("row_no", pa.int32()), ("event_time", pa.timestamp("us", "UTC")), ("op", pa.string())]


class CorruptLog(ValueError):
    pass


def image_type(columns: tuple[Column, ...]) -> pa.DataType:
    return pa.struct([(c.label, arrow_type(c)) for c in columns])


def table_schema(columns: tuple[Column, ...]) -> pa.Schema:
    t = image_type(columns)
    return pa.schema([*TABLE_FIELDS, ("before", t), ("after", t)])


class RangeScan:
    """The events of a range, each checked against its checksum before use.  The range is read in windows of
    whole events: ``data`` and ``range`` are those of the open one."""

    def __init__(self, folder: Folder, r: Range, verify: bool = True, lookback: bool = False, window: int = WINDOW, permissive: bool = False):
        self.folder, self.whole, self.verify, self.window, self.permissive = folder, settled(folder, r), verify, window, permissive
        self.careful = False  # one event at a time, after some event of the window couldn't be decoded
        self.bad: dict[int, tuple[Header, str]] = {}
        self.format: Format = file_format(folder, r.file)
        self.data, self.range = b"", self.whole
        self.maps: dict[int, TableMap] = {}
        if lookback and self.whole.start > FIRST:
            for _ in self.windows(replace(self.whole, start=FIRST, end=self.whole.start)):
                for pos, h in iterate(self.data, 0, len(self.data), self.format.version):
                    if h.type == TABLE_MAP:
                        self._map(self.data, pos, h)

    def windows(self, r: Range | None = None) -> Iterator[RangeScan]:
        """This scan, with one window after the other open."""
        r = r or self.whole
        at, size = r.start, self.window
        while at < r.end:
            data = self.folder.read(r.file, at, min(size, r.end - at))
            whole, need = 0, 0
            for pos, h in iterate(data, 0, len(data), self.format.version):
                whole = pos + h.size
            if not whole:
                if len(data) >= self.head:
                    need = read_header(data, 0, self.format.version).size
                if len(data) < size or need <= size or at + need > r.end:
                    return  # a torn tail
                size = need
                continue
            self.data, self.range, size = data[:whole], replace(r, start=at, end=at + whole), self.window
            yield self
            at += whole

    def fail(self, pos: int, h: Header, reason: str) -> None:
        """Stops at an event, or notes it where the scan is permissive."""
        if not self.permissive:
            raise CorruptLog(f"{self.range.file}: {reason} at {self.range.start + pos}")
        self.bad.setdefault(self.range.start + pos, (h, reason))

    def tolerant(self, batches) -> Iterator[pa.RecordBatch]:
        """The batches of a window; where an event can't be decoded, those of all others, event by event."""
        try:
            found = list(batches(self))
        except Exception:
            found, self.careful = None, True
        yield from batches(self) if found is None else found
        self.careful = False

    @property
    def head(self) -> int:
        return 19 if self.format.version > 1 else 13

    def _tail(self, h: Header) -> int:
        return 4 if h.type == FORMAT and self.format.checksum else self.format.checksum

    def _map(self, data, pos: int, h: Header) -> TableMap:
        t = decode_table_map(memoryview(data)[pos + self.head : pos + h.size - self._tail(h)])
        self.maps[t.table_id] = t
        return t

    def events(self) -> Iterator[tuple[int, Header, bool | None]]:
        """(offset in data, header, whether its checksum holds; None without one)."""
        for pos, h in iterate(self.data, 0, len(self.data), self.format.version):
            ok = checksum_ok(self.data, pos, h.size) if self.format.checksum and h.size >= 23 else None
            if ok is False and self.verify:
                self.fail(pos, h, "wrong checksum of the event")
            elif h.type == TABLE_MAP:
                try:
                    self._map(self.data, pos, h)
                except (ValueError, IndexError) as e:
                    if not self.permissive:
                        raise
                    self.fail(pos, h, f"table map that can't be read ({e})")
            elif h.type == FORMAT and self.range.start + pos > FIRST:
                self.format = decode_format(memoryview(self.data)[pos + self.head : pos + h.size])
            yield pos, h, ok

    def rows_events(self):
        """(offset, header, ok, table, rows header) of rows events with a table."""
        for pos, h, ok in self.events():
            if h.type not in ROWS or ok is False and self.verify:
                continue
            end = pos + h.size - self._tail(h)
            try:
                head = decode_rows_header(self.data, pos + self.head, end, h.type, self.format.post_header(h.type, 10))
            except (ValueError, IndexError) as e:
                if not self.permissive:
                    raise
                self.fail(pos, h, f"rows that can't be read ({e})")
                continue
            if head.table_id == DUMMY_TABLE or not head.present and not head.present_after:
                continue
            t = self.maps.get(head.table_id)
            if t is None:
                self.fail(pos, h, "rows with no table map (start earlier, or set lookback)")
                continue
            if max(head.present + (head.present_after or ())) >= len(t.columns):
                self.fail(pos, h, "rows of more columns than their table has")
                continue
            yield pos, h, ok, t, head, end


def _event_arrays(scan: RangeScan, heads: list[tuple[int, Header, bool | None]]) -> list[pa.Array]:
    r = scan.range
    return [
        pa.array([r.file] * len(heads), pa.string()), pa.array([r.seq] * len(heads), pa.int32()), pa.array([r.start + p for p, _, _ in heads], pa.int64()),
        pa.array([h.next_pos or None for _, h, _ in heads], pa.int64()), pa.array([h.time * 1_000_000 for _, h, _ in heads], pa.timestamp("us", "UTC")),
        pa.array([h.type for _, h, _ in heads], pa.int32()), pa.array([event_name(h.type) for _, h, _ in heads], pa.string()), pa.array([h.server for _, h, _ in heads], pa.int64()),
        pa.array([h.size for _, h, _ in heads], pa.int64()), pa.array([h.flags for _, h, _ in heads], pa.int32()), pa.array([ok for _, _, ok in heads], pa.bool_()),
    ]


def scan_events(scan: RangeScan, types: set[int] | None = None, payload: bool = True) -> Iterator[pa.RecordBatch]:
    heads: list = []
    details, bodies, size = [], [], 0

    def flush():
        return pa.RecordBatch.from_arrays([*_event_arrays(scan, heads), pa.array(details, pa.string()), pa.array(bodies, pa.binary())], schema=EVENTS_SCHEMA)

    for pos, h, ok in scan.events():
        if types is not None and h.type not in types:
            continue
        heads.append((pos, h, ok))
        body = scan.data[pos + scan.head : pos + h.size - (0 if h.type == FORMAT else scan._tail(h))] if payload else None
        details.append(_detail(scan, pos, h, body, ok) if payload else None)
        bodies.append(body)
        size += h.size
        if len(heads) >= BATCH_ROWS or size > 8 << 20:
            yield flush()
            heads, details, bodies, size = [], [], [], 0
    if heads:
        yield flush()


def _detail(scan: RangeScan, pos: int, h: Header, body: bytes, ok: bool | None) -> str | None:
    if not scan.permissive:
        return describe(h.type, body)
    if ok is False:
        return None
    try:
        return describe(h.type, body)
    except Exception as e:
        scan.fail(pos, h, f"event that can't be read ({e})")
        return None


class _Images:
    """Images of one table, kind of event and choice of columns, until a batch is full."""

    def __init__(self, table: TableMap, op: str, first: tuple[int, ...], second: tuple[int, ...] | None):
        self.table, self.op = table, op
        self.first = ImageScanner([table.columns[i] for i in first])
        self.second = ImageScanner([table.columns[i] for i in second]) if second is not None else None
        self.heads: list[tuple[int, Header, bool | None]] = []
        self.repeat: list[int] = []

    def take(self, data, pos: int, h: Header, ok, start: int, end: int) -> None:
        before = self.first.count
        while start < end:
            start = self.first.scan(data, start, end)
            if self.second is not None:
                start = self.second.scan(data, start, end)
        self.heads.append((pos, h, ok))
        self.repeat.append(self.first.count - before)

    def sides(self, data: np.ndarray):
        """(before, after), each as (columns, arrays) or None."""
        first = (self.first.columns, self.first.columns_of(data))
        if self.second is not None:
            return first, (self.second.columns, self.second.columns_of(data))
        return (first, None) if self.op == "delete" else (None, first)

    def clear(self) -> None:
        self.first.clear()
        if self.second is not None:
            self.second.clear()
        self.heads, self.repeat = [], []


def scan_images(scan: RangeScan, wanted=None) -> Iterator[_Images]:
    """Groups of images whenever one is full, and at the end."""
    groups: dict[tuple, _Images] = {}
    for pos, h, ok, t, head, end in scan.rows_events():
        if wanted is not None and not wanted(t, h):
            continue
        key = (t, h.type in UPDATE_ROWS, h.type in DELETE_ROWS, head.present, head.present_after, version_of(h.type) > 0)
        if scan.careful:
            alone = _Images(t, op_name(h.type), head.present, head.present_after)
            try:
                alone.take(scan.data, pos, h, ok, head.start, end)
            except Exception as e:
                scan.fail(pos, h, f"rows that can't be read ({e})")
                continue
            yield alone
            continue
        g = groups.get(key)
        if g is None:
            g = groups[key] = _Images(t, op_name(h.type), head.present, head.present_after)
        g.take(scan.data, pos, h, ok, head.start, end)
        if g.first.count >= BATCH_ROWS:
            yield g
            g.clear()
    for g in groups.values():
        if g.first.count:
            yield g


def _row_numbers(repeat: list[int]) -> tuple[np.ndarray, np.ndarray]:
    n = np.array(repeat, np.int64)
    return np.repeat(np.arange(len(n)), n), np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def _maps(side, n: int) -> pa.Array:
    if side is None:
        return pa.nulls(n, _MAP)
    columns, arrays = side
    k = len(columns)
    keys = pa.array([c.label for c in columns]).take(pa.array(np.tile(np.arange(k), n)))
    values = pa.concat_arrays([as_text(a) for a in arrays]).take(pa.array((np.arange(n)[:, None] + np.arange(k) * n).reshape(-1)))
    return pa.MapArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), keys, values)


def _decoded(scan: RangeScan, groups: Iterator[_Images], convert) -> Iterator[pa.RecordBatch]:
    for g in groups:
        try:
            batch = convert(g)
        except Exception as e:
            if not scan.careful:
                raise
            pos, h, _ = g.heads[0]
            scan.fail(pos, h, f"rows that can't be read ({e})")
            continue
        yield batch


def scan_rows(scan: RangeScan, wanted=None) -> Iterator[pa.RecordBatch]:
    data = np.frombuffer(scan.data, np.uint8)

    def convert(g: _Images) -> pa.RecordBatch:
        at, row_no = _row_numbers(g.repeat)
        n = len(at)
        index = pa.array(at)
        heads = [a.take(index) for a in _event_arrays(scan, g.heads)]
        before, after = g.sides(data)
        t = g.table
        return pa.RecordBatch.from_arrays(
            [*heads, pa.array(row_no.astype(np.int32)), pa.array([g.op] * n), pa.array([t.schema] * n), pa.array([t.table] * n), pa.array([t.table_id] * n, pa.int64()), pa.array([t.fingerprint] * n, pa.int64()), _maps(before, n), _maps(after, n)],
            schema=ROWS_SCHEMA,
        )

    yield from _decoded(scan, scan_images(scan, wanted), convert)


def scan_corrupt(scan: RangeScan) -> Iterator[pa.RecordBatch]:
    """The events of a window that a permissive scan leaves out, and why."""
    scan.bad = {}
    for pos, h, ok in scan.events():
        if h.type not in ROWS:
            _detail(scan, pos, h, scan.data[pos + scan.head : pos + h.size - (0 if h.type == FORMAT else scan._tail(h))], ok)
    for _ in scan.tolerant(scan_rows):
        pass
    if scan.bad:
        r, places = scan.range, sorted(scan.bad)
        found = [scan.bad[p] for p in places]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r.file] * len(found), pa.string()), pa.array([r.seq] * len(found), pa.int32()), pa.array(places, pa.int64()), pa.array([h.type for h, _ in found], pa.int32()),
                pa.array([event_name(h.type) for h, _ in found], pa.string()), pa.array([h.size for h, _ in found], pa.int64()), pa.array([why for _, why in found], pa.string()),
            ],
            schema=CORRUPT_SCHEMA,
        )


def _struct(side, target: pa.StructType, n: int) -> pa.Array:
    """An image with the target's fields: by name, null where the image has none."""
    if side is None:
        return pa.nulls(n, target)
    have = {c.label: a for c, a in zip(*side)}
    arrays = []
    for f in target:
        a = have.get(f.name)
        arrays.append(pa.nulls(n, f.type) if a is None else a if a.type == f.type else a.cast(f.type))
    return pa.StructArray.from_arrays(arrays, fields=list(target))


def scan_table(scan: RangeScan, name: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of one table; schemas that change are matched by column name and widened."""
    data = np.frombuffer(scan.data, np.uint8)
    image = schema.field("after").type

    def convert(g: _Images) -> pa.RecordBatch:
        at, row_no = _row_numbers(g.repeat)
        n = len(at)
        index = pa.array(at)
        heads = dict(zip([f for f, _ in EVENT_FIELDS], _event_arrays(scan, g.heads)))
        before, after = g.sides(data)
        fixed = [heads[c].take(index) for c in ("log_file", "file_seq", "start_pos")]
        return pa.RecordBatch.from_arrays(
            [*fixed, pa.array(row_no.astype(np.int32)), heads["event_time"].take(index), pa.array([g.op] * n), _struct(before, image, n), _struct(after, image, n)], schema=schema
        )

    yield from _decoded(scan, scan_images(scan, lambda t, h: f"{t.schema}.{t.table}" == name), convert)


def first_table_map(folder: Folder, ranges: list[Range], name: str) -> TableMap | None:
    """The first definition of a table, by hopping over headers."""
    from ..plans.planner import hop

    for r in ranges:
        fmt = file_format(folder, r.file)
        for pos, kind, size in hop(folder, r.file, r.start):
            if pos >= r.end:
                break
            if kind == TABLE_MAP:
                t = decode_table_map(folder.read(r.file, pos + 19, size - 19 - fmt.checksum))
                if f"{t.schema}.{t.table}" == name:
                    return t
    return None
