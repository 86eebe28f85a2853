"""Log files from rows: the inverse of the scans, for tests, copies of tables and
change streams.

Rows come as Arrow batches.  Columns named ``op``, ``before`` and ``after`` (images
as structs) make a batch of changes; any other batch is inserts of its columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa

from ..functions.names import EVENT, TYPE
from .events import LogBuilder
from .rows import encode_images, encode_rows_header
from .tablemap import Column, TableMap, encode_table_map

UTF8 = 255
_CODES = {"insert": EVENT["writeRowsV2"], "update": EVENT["updateRowsV2"], "delete": EVENT["deleteRowsV2"]}
_INTS = {"tinyint": "tiny", "smallint": "short", "mediumint": "int24", "int": "long", "bigint": "longLong"}
_SPEC = re.compile(r"^(unsigned\s+)?([a-z]+)\s*(?:\((.*)\))?(?:\s+charset\s+(\d+))?$", re.S)


def column_of(ordinal: int, name: str, spec: str, nullable: bool = True) -> Column:
    """A column by a declaration such as ``unsigned int``, ``decimal(15,2)``, ``time(6)``,
    ``enum('a','b')``, ``varchar(300)`` or ``char(10) charset 63``."""
    m = _SPEC.match(spec.strip().lower() if "'" not in spec else spec.strip())
    if not m:
        raise ValueError(f"type {spec!r}")
    unsigned, kind, args, charset = bool(m[1]), m[2], m[3], int(m[4] or UTF8)
    col = Column(ordinal, 0, nullable=nullable, unsigned=unsigned, name=name)
    if kind in _INTS:
        return replace(col, type=TYPE[_INTS[kind]])
    if kind in ("float", "double"):
        return replace(col, type=TYPE[kind], meta=4 if kind == "float" else 8)
    if kind in ("decimal", "numeric"):
        p, s = (int(x) for x in (args or "10,0").split(",")) if "," in (args or "10,0") else (int(args), 0)
        return replace(col, type=TYPE["newDecimal"], meta=p | s << 8)
    if kind in ("varchar", "varbinary"):
        return replace(col, type=TYPE["varchar"], meta=int(args or 65535), charset=63 if kind == "varbinary" else charset)
    if kind in ("char", "binary"):
        return replace(col, type=TYPE["string"], meta=int(args or 255), charset=63 if kind == "binary" else charset)
    for i, size in enumerate(("tiny", "", "medium", "long"), 1):
        if kind in (f"{size}text", f"{size}blob"):
            return replace(col, type=TYPE["blob"], meta=i, charset=63 if kind.endswith("blob") else charset)
    if kind in ("enum", "set"):
        values = tuple(v.replace("''", "'") for v in re.findall(r"'((?:[^']|'')*)'", args or ""))
        width = (1 if len(values) < 256 else 2) if kind == "enum" else min(8, 1 << max(0, (max(len(values), 1) - 1) // 8).bit_length())
        return replace(col, type=TYPE[kind], meta=width, charset=charset, values=values)
    if kind == "bit":
        n = int(args or 1)
        return replace(col, type=TYPE["bit"], meta=n // 8 << 8 | n % 8)
    if kind == "json":
        return replace(col, type=TYPE["json"], meta=4)
    if kind == "geometry":
        return replace(col, type=TYPE["geometry"], meta=4)
    if kind in ("date", "year"):
        return replace(col, type=TYPE[kind])
    if kind in ("datetime", "timestamp", "time"):
        return replace(col, type=TYPE[{"datetime": "dateTime2", "timestamp": "timestamp2", "time": "time2"}[kind]], meta=int(args or 0))
    raise ValueError(f"type {spec!r}")


def default_spec(t: pa.DataType) -> str:
    if pa.types.is_boolean(t) or t == pa.int8():
        return "tinyint"
    for kind, spec in ((pa.int16(), "smallint"), (pa.int32(), "int"), (pa.int64(), "bigint"), (pa.float32(), "float"), (pa.float64(), "double"), (pa.date32(), "date")):
        if t == kind:
            return spec
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "longtext"
    if pa.types.is_binary(t) or pa.types.is_large_binary(t):
        return "longblob"
    if pa.types.is_timestamp(t):
        return "datetime(6)"
    if pa.types.is_duration(t):
        return "time(6)"
    if pa.types.is_decimal(t):
        return f"decimal({t.precision},{t.scale})"
    raise ValueError(f"no column type for {t}")


def table_of(database: str, table: str, fields, types: dict[str, str], key: list[str] = (), table_id: int = 100) -> TableMap:
    columns = tuple(column_of(i, f.name, types.get(f.name) or default_spec(f.type), f.nullable) for i, f in enumerate(fields))
    names = [c.name for c in columns]
    return TableMap(table_id, 1, database, table, columns, tuple(names.index(k) for k in key))


def _image(values: pa.Array, t: TableMap, present: list[int]) -> tuple[np.ndarray, np.ndarray]:
    columns, names = [t.columns[i] for i in present], [f.name for f in values.type]
    return encode_images(columns, [values.field(c.name) if c.name in names else pa.nulls(len(values)) for c in columns])


def _struct_of(batch: pa.RecordBatch) -> pa.StructArray:
    return pa.StructArray.from_arrays(batch.columns, fields=list(batch.schema))


class LogWriter:
    """Transactions of one table, appended to one file.  Rows wait until they fill a transaction, so where
    batches end makes no difference; shorter ones come only where the kind of change changes and at the end."""

    def __init__(self, t: TableMap, rows_per_event: int = 256, events_per_transaction: int = 8, checksum: bool = True, full: bool = True, time: int = 0, server_id: int = 1, images: list[str] = ()):
        self.present = [i for i, c in enumerate(t.columns) if not images or c.name in images]
        self.table, self.rows, self.events, self.time = t, rows_per_event, events_per_transaction, time
        self.log = LogBuilder(server_id, checksum, created=time)
        self.map_body = encode_table_map(t, full)
        self.xid = 0
        self.kind, self.held = "", []  # rows that wait: (first, second images)

    def _transaction(self, bodies: Iterator[tuple[int, bytes]]) -> None:
        """Events in groups, each a transaction with a table map in front of its rows."""
        group: list[tuple[int, bytes]] = []

        def flush():
            self.xid += 1
            self.log.begin(self.time)
            for code, body in group:
                self.log.add(EVENT["tableMap"], self.map_body, self.time)
                self.log.add(code, body, self.time)
            self.log.commit(self.xid, self.time)
            group.clear()

        for item in bodies:
            group.append(item)
            if len(group) >= self.events:
                flush()
        if group:
            flush()

    def _events(self, op: str, first: pa.StructArray, second: pa.StructArray | None):
        code = _CODES[op]
        head = encode_rows_header(self.table, code, self.present, self.present)
        raw, size = _image(first, self.table, self.present)
        ends = np.cumsum(size)
        raw2, ends2 = (None, None)
        if second is not None:
            raw2, size2 = _image(second, self.table, self.present)
            ends2 = np.cumsum(size2)
        for a in range(0, len(first), self.rows):
            b = min(a + self.rows, len(first))
            if second is None:
                yield code, head + raw[ends[a - 1] if a else 0 : ends[b - 1]].tobytes()
                continue
            parts = [head]
            for i in range(a, b):
                parts.append(raw[ends[i - 1] if i else 0 : ends[i]].tobytes())
                parts.append(raw2[ends2[i - 1] if i else 0 : ends2[i]].tobytes())
            yield code, b"".join(parts)

    def _put(self, whole: bool) -> None:
        """Writes the rows that fill transactions, or all that wait."""
        n, size = sum(len(first) for first, _ in self.held), self.rows * self.events
        n -= 0 if whole else n % size
        if not n:
            return
        first, second = (None if c[0] is None else c[0] if len(c) == 1 else pa.concat_arrays(c) for c in zip(*self.held))
        self._transaction(self._events(self.kind, first.slice(0, n), None if second is None else second.slice(0, n)))
        self.held = [(first.slice(n), None if second is None else second.slice(n))] if n < len(first) else []

    def _hold(self, kind: str, first: pa.StructArray, second: pa.StructArray | None) -> None:
        if kind != self.kind:
            self._put(True)
            self.kind = kind
        self.held.append((first, second))
        self._put(False)

    def size(self) -> int:
        """Bytes of the file so far and, about, of the rows that wait."""
        return self.log.pos + sum(c.nbytes for pair in self.held for c in pair if c is not None)

    def close(self) -> None:
        """Writes the rows that still wait."""
        self._put(True)

    def add(self, batch: pa.RecordBatch) -> None:
        """All rows of a batch and those that wait."""
        self.extend(batch)
        self.close()

    def extend(self, batch: pa.RecordBatch) -> None:
        """The rows of a batch; the last ones may wait."""
        names = batch.schema.names
        if {"op", "before", "after"} <= set(names):
            op = batch.column(names.index("op"))
            before, after = (batch.column(names.index(c)) for c in ("before", "after"))
            codes = np.array(op.to_pylist())
            cuts = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), len(codes)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if b > a:
                    kind, n = str(codes[a]), b - a
                    one, two = before.slice(a, n), after.slice(a, n)
                    self._hold(kind, two if kind == "insert" else one, two if kind == "update" else None)
            return
        if batch.num_rows:
            self._hold("insert", _struct_of(batch), None)
