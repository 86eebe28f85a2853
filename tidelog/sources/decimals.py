"""Packed decimals: groups of nine digits in four bytes, big-endian.

A group of fewer digits takes just the bytes that it needs; the sign is the first
bit, inverted, and all bytes of negative numbers are complemented.
"""

from __future__ import annotations

from .cursor import Truncated

GROUP = 9
# Bytes of a group of 0 to 9 digits.
GROUP_BYTES = (0, 1, 1, 2, 2, 3, 3, 4, 4, 4)


def groups(precision: int, scale: int) -> list[int]:
    """Digits of each group: the first may be short before the point, the last after it."""
    if not 0 <= scale <= precision or precision < 1:
        raise ValueError(f"decimal({precision},{scale})")
    whole = precision - scale
    out = [whole % GROUP] if whole % GROUP else []
    out += [GROUP] * (whole // GROUP) + [GROUP] * (scale // GROUP)
    return out + ([scale % GROUP] if scale % GROUP else [])


def decimal_size(precision: int, scale: int) -> int:
    return sum(GROUP_BYTES[n] for n in groups(precision, scale))


def unscaled(data: bytes, precision: int, scale: int) -> int:
    size = decimal_size(precision, scale)
    if len(data) < size:
        raise Truncated("a decimal ends early")
    raw = bytearray(data[:size])
    negative = raw[0] < 0x80
    raw[0] ^= 0x80
    if negative:
        raw = bytearray(b ^ 0xFF for b in raw)
    at, value = 0, 0
    for n in groups(precision, scale):
        width = GROUP_BYTES[n]
        value = value * 10**n + int.from_bytes(raw[at : at + width], "big")
        at += width
    return -value if negative else value


def decode_decimal(data: bytes, precision: int, scale: int) -> str:
    """Exact text with ``scale`` digits after the point, and no point for scale 0."""
    v = unscaled(data, precision, scale)
    digits = str(abs(v)).rjust(scale + 1, "0")
    text = digits if not scale else digits[:-scale] + "." + digits[-scale:]
    return "-" + text if v < 0 else text


def encode_decimal(value: int, precision: int, scale: int) -> bytes:
    """Of an unscaled integer."""
    rest, parts = abs(value), []
    for n in reversed(groups(precision, scale)):
        rest, part = divmod(rest, 10**n)
        parts.append(part.to_bytes(GROUP_BYTES[n], "big"))
    if rest:
        raise ValueError("too many digits")
    raw = bytearray(b"".join(reversed(parts)))
    if value < 0:
        raw = bytearray(b ^ 0xFF for b in raw)
    raw[0] ^= 0x80
    return bytes(raw)
