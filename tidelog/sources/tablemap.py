"""Table definitions in the log: columns, their types, and optional metadata."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field, replace

from ..functions.names import LABEL_TYPES, NUMERIC_TYPES, STRING_TYPES, TYPE
from .cursor import Cursor, bit, bitmap_of, packed

_ONE = {TYPE[n] for n in ("blob", "double", "float", "geometry", "json", "time2", "dateTime2", "timestamp2")}
_TWO = {TYPE[n] for n in ("varchar", "bit", "decimal", "newDecimal", "set", "enum", "varString")}
_STRING = TYPE["string"]


@dataclass(frozen=True)
class Column:
    ordinal: int
    type: int
    meta: int = 0
    nullable: bool = True
    unsigned: bool = False
    charset: int = 0
    name: str = ""
    values: tuple[str, ...] = ()

    @property
    def label(self) -> str:
        """Its name, or @ and its number where the log has no names."""
        return self.name or f"@{self.ordinal}"


@dataclass(frozen=True)
class TableMap:
    table_id: int
    flags: int
    schema: str
    table: str
    columns: tuple[Column, ...] = field(default=())
    key: tuple[int, ...] = ()

    @property
    def fingerprint(self) -> int:
        """A 63-bit number of the columns, for telling versions of a schema apart."""
        text = repr([(c.type, c.meta, c.unsigned, c.charset, c.name, c.values) for c in self.columns])
        return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big") >> 1


def _type_and_meta(c: Cursor, code: int) -> tuple[int, int]:
    if code in _ONE:
        return code, c.uint(1)
    if code in _TWO:
        return code, c.uint(2)
    if code != _STRING:
        return code, 0
    high, low = c.take(2)
    if high == 0:
        return code, low
    # The real type hides in the high byte; two of its bits may hold more of the length.
    extra = high & 0x30 ^ 0x30
    return high | 0x30, low | extra << 4


def _default_charsets(c: Cursor, columns: list[Column], kind: frozenset[int]) -> None:
    """A default and exceptions, which are numbered by the whole list of columns."""
    default = c.packed()
    special = {}
    while c.more():
        at = c.packed()
        special[at] = c.packed()
    for i, col in enumerate(columns):
        if i in special:
            columns[i] = replace(col, charset=special[i])
        elif col.type in kind and not col.charset:
            columns[i] = replace(col, charset=default)


def decode_table_map(body) -> TableMap:
    c = Cursor(body)
    table_id, flags = c.uint(6), c.uint(2)
    c.skip(1)
    schema = c.until_null().decode("utf-8", "replace")
    c.skip(1)
    table = c.until_null().decode("utf-8", "replace")
    count = c.packed()
    codes = c.take(count)
    metas = Cursor(c.sized())
    columns = []
    for i, code in enumerate(codes):
        kind, meta = _type_and_meta(metas, code)
        columns.append(Column(i, kind, meta))
    nulls = c.take((count + 7) // 8)
    columns = [replace(col, nullable=bit(nulls, i)) for i, col in enumerate(columns)]
    key: tuple[int, ...] = ()
    while c.more():
        tag = c.uint(1)
        part = Cursor(c.sized())
        if tag == 1:
            bits, numeric = part.rest(), [i for i, col in enumerate(columns) if col.type in NUMERIC_TYPES]
            for n, i in enumerate(numeric):
                columns[i] = replace(columns[i], unsigned=bool(bits[n >> 3] & 0x80 >> (n & 7)))
        elif tag in (2, 10):
            _default_charsets(part, columns, STRING_TYPES if tag == 2 else LABEL_TYPES)
        elif tag in (3, 11):
            for i, col in enumerate(columns):
                if col.type in (STRING_TYPES if tag == 3 else LABEL_TYPES):
                    columns[i] = replace(col, charset=part.packed())
        elif tag == 4:
            columns = [replace(col, name=part.sized().decode("utf-8", "replace")) for col in columns]
        elif tag in (5, 6):
            for i, col in enumerate(columns):
                if col.type == TYPE["set" if tag == 5 else "enum"] and part.more():
                    columns[i] = replace(col, values=tuple(part.sized().decode("utf-8", "replace") for _ in range(part.packed())))
        elif tag in (8, 9):
            found = []
            while part.more():
                found.append(part.packed())
                if tag == 9:
                    part.packed()
            key = tuple(found)
    return TableMap(table_id, flags, schema, table, tuple(columns), key)


def encode_table_map(t: TableMap, full: bool = True) -> bytes:
    """``full``: with signedness, charsets, names, labels and the key."""
    codes, metas = bytearray(), bytearray()
    for col in t.columns:
        hidden = col.type in LABEL_TYPES
        codes.append(_STRING if hidden else col.type)
        if hidden:
            metas += bytes((col.type, col.meta))
        elif col.type == _STRING:
            high = _STRING ^ (col.meta >> 4 & 0x30)
            metas += bytes((high if col.meta > 255 else 0, col.meta & 0xFF))
        elif col.type in _ONE:
            metas.append(col.meta)
        elif col.type in _TWO:
            metas += col.meta.to_bytes(2, "little")
    schema, table = t.schema.encode(), t.table.encode()
    out = t.table_id.to_bytes(6, "little") + t.flags.to_bytes(2, "little")
    out += bytes([len(schema)]) + schema + b"\0" + bytes([len(table)]) + table + b"\0"
    out += packed(len(codes)) + bytes(codes) + packed(len(metas)) + bytes(metas) + bitmap_of(c.nullable for c in t.columns)

    def tlv(tag: int, value: bytes) -> bytes:
        return bytes([tag]) + packed(len(value)) + value if value else b""

    numeric = [c.unsigned for c in t.columns if c.type in NUMERIC_TYPES]
    signs = bytearray((len(numeric) + 7) // 8)
    for i, on in enumerate(numeric):
        signs[i >> 3] |= 0x80 >> (i & 7) if on else 0
    out += tlv(1, bytes(signs))
    out += tlv(3, b"".join(packed(c.charset) for c in t.columns if c.type in STRING_TYPES))
    if full:
        out += tlv(4, b"".join(packed(len(c.name.encode())) + c.name.encode() for c in t.columns))
        for tag, kind in ((5, "set"), (6, "enum")):
            out += tlv(tag, b"".join(packed(len(c.values)) + b"".join(packed(len(v.encode())) + v.encode() for v in c.values) for c in t.columns if c.type == TYPE[kind]))
        out += tlv(8, b"".join(packed(i) for i in t.key))
        out += tlv(11, b"".join(packed(c.charset) for c in t.columns if c.type in LABEL_TYPES))
    return out
