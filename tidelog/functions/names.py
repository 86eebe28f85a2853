"""Codes and names of the change-log format."""

from __future__ import annotations

# Event type codes and their display names.
EVENT_NAMES = {
    0x00: "unknown",
    0x01: "startV3",
    0x02: "query",
    0x03: "stop",
    0x04: "rotate",
    0x05: "inVar",
    0x06: "load",
    0x07: "slave",
    0x08: "createFile",
    0x09: "appendBlock",
    0x0A: "execLoad",
    0x0B: "deleteFile",
    0x0C: "newLoad",
    0x0D: "rand",
    0x0E: "userVar",
    0x0F: "formatDescription",
    0x10: "xid",
    0x11: "beginLoadQuery",
    0x12: "executeLoadQuery",
    0x13: "tableMap",
    0x14: "writeRowsV0",
    0x15: "updateRowsV0",
    0x16: "deleteRowsV0",
    0x17: "writeRowsV1",
    0x18: "updateRowsV1",
    0x19: "deleteRowsV1",
    0x1A: "incident",
    0x1B: "heartbeat",
    0x1C: "ignorable",
    0x1D: "rowsQuery",
    0x1E: "writeRowsV2",
    0x1F: "updateRowsV2",
    0x20: "deleteRowsV2",
    0x21: "gtid",
    0x22: "anonymousGTID",
    0x23: "previousGTID",
}

# Column type codes and their display names.
TYPE_NAMES = {
    0x00: "decimal",
    0x01: "tiny",
    0x02: "short",
    0x03: "long",
    0x04: "float",
    0x05: "double",
    0x06: "null",
    0x07: "timestamp",
    0x08: "longLong",
    0x09: "int24",
    0x0A: "date",
    0x0B: "time",
    0x0C: "dateTime",
    0x0D: "year",
    0x0E: "newDate",
    0x0F: "varchar",
    0x10: "bit",
    0x11: "timestamp2",
    0x12: "dateTime2",
    0x13: "time2",
    0xF5: "json",
    0xF6: "newDecimal",
    0xF7: "enum",
    0xF8: "set",
    0xF9: "tinyBlob",
    0xFA: "mediumBlob",
    0xFB: "longBlob",
    0xFC: "blob",
    0xFD: "varString",
    0xFE: "string",
    0xFF: "geometry",
}

EVENT = {name: code for code, name in EVENT_NAMES.items()}
TYPE = {name: code for code, name in TYPE_NAMES.items()}

WRITE_ROWS = (0x14, 0x17, 0x1E)
UPDATE_ROWS = (0x15, 0x18, 0x1F)
DELETE_ROWS = (0x16, 0x19, 0x20)
ROWS = WRITE_ROWS + UPDATE_ROWS + DELETE_ROWS

NUMERIC_TYPES = frozenset(TYPE[n] for n in ("tiny", "short", "int24", "long", "longLong", "float", "double", "decimal", "newDecimal"))
STRING_TYPES = frozenset(TYPE[n] for n in ("varchar", "blob", "varString", "string"))
LABEL_TYPES = frozenset(TYPE[n] for n in ("enum", "set"))

BINARY_CHARSET = 63
# Charset ids whose bytes are not UTF-8, by Python's codec names.
CHARSET_CODECS = {5: "cp1252", 8: "cp1252", 15: "cp1252", 31: "cp1252", 47: "cp1252", 48: "cp1252", 49: "cp1252", 94: "cp1252", 35: "utf-16-be", 90: "utf-16-be", 54: "utf-16-be", 55: "utf-16-be", 60: "utf-32-be", 61: "utf-32-be", 28: "gbk", 87: "gbk", 1: "big5", 84: "big5", 13: "shift_jis", 88: "shift_jis", 19: "euc_kr", 85: "euc_kr", 51: "cp1251", 50: "cp1251"}


def event_name(code: int) -> str:
    return EVENT_NAMES.get(code, f"0x{code:02x}")


def type_name(code: int) -> str:
    return TYPE_NAMES.get(code, f"0x{code:02x}")


def op_name(code: int) -> str | None:
    return "insert" if code in WRITE_ROWS else "update" if code in UPDATE_ROWS else "delete" if code in DELETE_ROWS else None
