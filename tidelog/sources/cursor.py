"""A bounds-checked reader of little-endian fields over bytes, and its inverse."""

from __future__ import annotations


class Truncated(ValueError):
    """The bytes end before the field does."""


class Cursor:
    """Reads fields one after the other from ``data[pos:end]``."""

    __slots__ = ("data", "pos", "end")

    def __init__(self, data, pos: int = 0, end: int | None = None):
        self.data, self.pos, self.end = data, pos, len(data) if end is None else end

    def more(self) -> bool:
        return self.pos < self.end

    def take(self, n: int) -> bytes:
        if n < 0 or self.pos + n > self.end:
            raise Truncated(f"{n} bytes wanted at {self.pos}, the end is {self.end}")
        self.pos += n
        return bytes(self.data[self.pos - n : self.pos])

    def uint(self, n: int) -> int:
        return int.from_bytes(self.take(n), "little")

    def sint(self, n: int) -> int:
        return int.from_bytes(self.take(n), "little", signed=True)

    def packed(self) -> int:
        """A packed integer: one byte below 0xfc, or a marker and 2, 3 or 8 bytes."""
        first = self.uint(1)
        width = {0xFC: 2, 0xFD: 3, 0xFE: 8}.get(first)
        return first if width is None else self.uint(width)

    def until_null(self) -> bytes:
        at = bytes(self.data[self.pos : self.end]).find(b"\0")
        if at < 0:
            raise Truncated("a string has no end")
        out = self.take(at)
        self.pos += 1
        return out

    def sized(self) -> bytes:
        return self.take(self.packed())

    def rest(self) -> bytes:
        return self.take(self.end - self.pos)

    def skip(self, n: int) -> None:
        self.take(n)


def packed(n: int) -> bytes:
    for top, mark, width in ((0xFB, b"", 1), (0x10000, b"\xfc", 2), (0x1000000, b"\xfd", 3)):
        if n < top:
            return mark + n.to_bytes(width, "little")
    return b"\xfe" + n.to_bytes(8, "little")


def bit(bitmap: bytes, i: int) -> bool:
    """Bit i of a bitmap whose bits run upwards in every byte."""
    return bool(bitmap[i >> 3] >> (i & 7) & 1)


def bitmap_of(flags) -> bytes:
    flags = list(flags)
    out = bytearray((len(flags) + 7) // 8)
    for i, on in enumerate(flags):
        if on:
            out[i >> 3] |= 1 << (i & 7)
    return bytes(out)
