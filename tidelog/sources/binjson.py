"""Binary JSON values of the log: decoding to Python values and canonical text,
and encoding of what ``json.loads`` gives.

Canonical text is compact, with sorted keys; of equal keys the last one counts.
Exact decimals keep their digits, times are nanoseconds, dates and times of day
are strings.
"""

from __future__ import annotations

import json
import struct
from datetime import datetime, timezone
from decimal import Decimal

from ..functions.names import TYPE
from .cursor import Truncated
from .decimals import decode_decimal

# Type bytes of the format.
SMALL_OBJECT, LARGE_OBJECT, SMALL_ARRAY, LARGE_ARRAY, LITERAL = 0, 1, 2, 3, 4
INT16, UINT16, INT32, UINT32, INT64, UINT64, DOUBLE, STRING, OPAQUE = 5, 6, 7, 8, 9, 10, 11, 12, 15
_SCALARS = {INT16: "<h", UINT16: "<H", INT32: "<i", UINT32: "<I", INT64: "<q", UINT64: "<Q", DOUBLE: "<d"}
_LITERALS = (None, True, False)


def _length(data: bytes, at: int) -> tuple[int, int]:
    """A length of seven bits a byte, and where it ends."""
    size = 0
    for i in range(5):
        if at + i >= len(data):
            raise Truncated("a length ends early")
        size |= (data[at + i] & 0x7F) << 7 * i
        if data[at + i] < 0x80:
            return size, at + i + 1
    raise ValueError("a length of more than five bytes")


def decode(data: bytes):
    """The value of a whole document; an empty one is null."""
    data = bytes(data)
    return _value(data[0], data, 1) if data else None


def _value(kind: int, data: bytes, at: int):
    if kind in (SMALL_OBJECT, LARGE_OBJECT, SMALL_ARRAY, LARGE_ARRAY):
        return _container(kind, data, at)
    if kind == LITERAL:
        if at >= len(data) or data[at] > 2:
            raise ValueError("not a literal")
        return _LITERALS[data[at]]
    if kind in _SCALARS:
        form = _SCALARS[kind]
        if at + struct.calcsize(form) > len(data):
            raise Truncated("a number ends early")
        return struct.unpack_from(form, data, at)[0]
    if kind == STRING:
        size, at = _length(data, at)
        if at + size > len(data):
            raise Truncated("a string ends early")
        return data[at : at + size].decode("utf-8", "replace")
    if kind == OPAQUE:
        size, body = _length(data, at + 1)
        if body + size > len(data):
            raise Truncated("an opaque value ends early")
        return _opaque(data[at], data[body : body + size])
    raise ValueError(f"unknown kind {kind}")


def _container(kind: int, data: bytes, base: int):
    large, is_object = kind in (LARGE_OBJECT, LARGE_ARRAY), kind in (SMALL_OBJECT, LARGE_OBJECT)
    width = 4 if large else 2

    def number(at: int) -> int:
        if at + width > len(data):
            raise Truncated("a container ends early")
        return int.from_bytes(data[at : at + width], "little")

    count, size = number(base), number(base + width)
    if base + size > len(data):
        raise Truncated("a container ends early")
    at, keys = base + 2 * width, []
    if is_object:
        for _ in range(count):
            start = base + number(at)
            n = int.from_bytes(data[at + width : at + width + 2], "little")
            if start + n > len(data):
                raise Truncated("a key ends early")
            keys.append(data[start : start + n].decode("utf-8", "replace"))
            at += width + 2
    inline = {LITERAL, INT16, UINT16} | ({INT32, UINT32} if large else set())
    values = []
    for _ in range(count):
        if at >= len(data):
            raise Truncated("a container ends early")
        values.append(_value(data[at], data, at + 1 if data[at] in inline else base + number(at + 1)))
        at += 1 + width
    return dict(zip(keys, values)) if is_object else values


def _opaque(kind: int, body: bytes):
    if kind == TYPE["newDecimal"]:
        return Decimal(decode_decimal(body[2:], body[0], body[1]))
    if kind in (TYPE["time"], TYPE["date"], TYPE["dateTime"], TYPE["timestamp"]):
        if len(body) < 8:
            raise Truncated("a time ends early")
        v = int.from_bytes(body[:8], "little", signed=True)
        micros, whole = abs(v) & 0xFFFFFF, abs(v) >> 24
        hms = whole & 0x1FFFF
        h, m, s = hms >> 12, hms >> 6 & 63, hms & 63
        if kind == TYPE["time"]:
            total = ((((whole >> 12 & 0x3FF) * 60 + m) * 60 + s) * 1_000_000 + micros) * 1000
            return -total if v < 0 else total
        year, month, day = (whole >> 22) // 13, (whole >> 22) % 13, whole >> 17 & 31
        try:
            at = datetime(year, month, day, h, m, s, tzinfo=timezone.utc)
        except ValueError:  # a zero date, or a day that isn't in the calendar: null, as in a column
            return None
        return at.strftime("%Y-%m-%dT%H:%M:%S") + (f".{micros:06d}".rstrip("0") if micros else "") + "Z"
    return body.decode("utf-8", "replace")


class _Exact(float):
    """A number that is written with its own digits."""

    def __new__(cls, text: str):
        out = super().__new__(cls, text)
        out.text = text
        return out

    def __repr__(self) -> str:
        return self.text


def canonical(value) -> str:
    def exact(v):
        if isinstance(v, Decimal):
            return _Exact(str(v))
        if isinstance(v, float) and v.is_integer() and abs(v) < 1e21:
            return int(v)
        if isinstance(v, dict):
            return {k: exact(x) for k, x in v.items()}
        return [exact(x) for x in v] if isinstance(v, list) else v

    return json.dumps(exact(value), ensure_ascii=False, separators=(",", ":"), sort_keys=True)


def encode(value) -> bytes:
    kind, body = _encode(value)
    return bytes([kind]) + body


def _sized(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out) + bytes([n])


def _encode(value) -> tuple[int, bytes]:
    if value is None or isinstance(value, bool):
        return LITERAL, bytes([_LITERALS.index(value)])
    if isinstance(value, int):
        for kind, low, high in ((INT16, -(1 << 15), 1 << 15), (INT32, -(1 << 31), 1 << 31), (INT64, -(1 << 63), 1 << 63), (UINT64, 0, 1 << 64)):
            if low <= value < high:
                return kind, struct.pack(_SCALARS[kind], value)
        raise ValueError("an integer of more than 64 bits")
    if isinstance(value, float):
        return DOUBLE, struct.pack("<d", value)
    if isinstance(value, str):
        raw = value.encode()
        return STRING, _sized(len(raw)) + raw
    for large in (False, True):
        body = _encode_container(value, large)
        if large or len(body) < 1 << 16:
            return (0 if isinstance(value, dict) else 2) + large, body
    raise AssertionError


def _encode_container(value, large: bool) -> bytes:
    width = 4 if large else 2
    is_object = isinstance(value, dict)
    keys = [k.encode() for k in sorted(value, key=lambda k: (len(k.encode()), k))] if is_object else []
    items = [value[k.decode()] for k in keys] if is_object else list(value)
    head = 2 * width + len(keys) * (width + 2) + len(items) * (1 + width)
    top = (1 << 8 * width) - 1
    key_part, at = bytearray(), head
    for k in keys:
        key_part += min(at, top).to_bytes(width, "little") + len(k).to_bytes(2, "little")
        at += len(k)
    values, tail = bytearray(), bytearray()
    inline = {LITERAL, INT16, UINT16} | ({INT32, UINT32} if large else set())
    for v in items:
        kind, body = _encode(v)
        if kind in inline:
            values += bytes([kind]) + body.ljust(width, b"\0")
        else:
            values += bytes([kind]) + min(at + len(tail), top).to_bytes(width, "little")
            tail += body
    size = at + len(tail)
    return min(len(items), top).to_bytes(width, "little") + min(size, top).to_bytes(width, "little") + bytes(key_part) + bytes(values) + b"".join(keys) + bytes(tail)
