"""Expressions over log columns that stay in Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import DELETE_ROWS, EVENT_NAMES, TYPE_NAMES, UPDATE_ROWS, WRITE_ROWS


def le_uint(data: Column, offset: int, n: int) -> Column:
    """The unsigned little-endian integer of n bytes at an offset (from 0) of a binary."""
    digits = F.concat(*[F.hex(F.substring(data, offset + i + 1, 1)) for i in reversed(range(n))])
    return F.conv(digits, 16, 10).cast("decimal(20,0)")


def _named(code: Column, names: dict[int, str]) -> Column:
    table = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(table, code.cast("int")), F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(code.cast("int"))), 2, "0")))


def event_type_name(code: Column) -> Column:
    return _named(code, EVENT_NAMES)


def column_type_name(code: Column) -> Column:
    return _named(code, TYPE_NAMES)


def op_of(code: Column) -> Column:
    return F.when(code.isin(*WRITE_ROWS), "insert").when(code.isin(*UPDATE_ROWS), "update").when(code.isin(*DELETE_ROWS), "delete")


def crc_matches(event: Column) -> Column:
    """Whether the last four bytes of a whole event are the checksum of the others."""
    n = F.octet_length(event)
    stored = F.conv(F.concat(*[F.hex(F.substring(event, n - i, F.lit(1))) for i in range(4)]), 16, 10).cast("long")
    return F.crc32(F.substring(event, F.lit(1), n - 4)) == stored


def log_version(server: Column) -> Column:
    """The log version of a server's version text; null where it isn't three numbers."""
    parts = F.split(F.regexp_extract(server, r"^([^-+]*)", 1), r"\.")
    num = [F.try_element_at(parts, F.lit(i)).try_cast("int") for i in (1, 2, 3)]
    ok = (F.size(parts) == 3) & num[0].isNotNull() & num[1].isNotNull() & num[2].isNotNull()
    value = num[0] * 1_000_000 + num[1] * 1000 + num[2]
    return F.when(ok, F.when(value < 4_000_000, 1).when(value < 4_000_002, 2).when(value < 5_000_000, 3).otherwise(4))


def sign_extend_24(value: Column) -> Column:
    return F.when(value >= 0x800000, value - 0x1000000).otherwise(value)


def set_members(bits: Column, labels: Column) -> Column:
    return F.filter(labels, lambda x, i: F.pmod(F.floor(bits / F.pow(F.lit(2.0), i)), F.lit(2)) == 1)


def enum_label(index: Column, labels: Column) -> Column:
    return F.when(index == 0, "").otherwise(F.try_element_at(labels, index.cast("int")))


def year_value(byte: Column) -> Column:
    return F.when(byte == 0, 0).otherwise(byte + 1900)


def sql_literal(value: Column, kind: str) -> Column:
    """A value as an SQL literal: NULL, x"hex" of binaries, quoted texts and times, plain numbers."""
    if kind == "binary":
        text = F.concat(F.lit('x"'), F.lower(F.hex(value)), F.lit('"'))
    elif kind in ("string", "timestamp", "json", "enum", "set"):
        quoted = F.replace(F.replace(value.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
        text = F.concat(F.lit('"'), quoted, F.lit('"'))
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit("NULL"))
