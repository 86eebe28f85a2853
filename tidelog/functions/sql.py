"""Decoders as functions of SQL.

``register`` makes them known to a session; all but the last two stay in Catalyst.

    tidelog_event_name(code), tidelog_column_type(code)   the name, or 0x and two digits
    tidelog_op(code)                                       insert, update, delete or null
    tidelog_uint(data)                                     the unsigned little-endian integer of up to 8 bytes
    tidelog_crc_matches(event)                             whether a whole event's checksum holds
    tidelog_sign24(value), tidelog_year(byte)
    tidelog_decimal(data, precision, scale)                exact text of a packed decimal
    tidelog_json(data)                                     text of a binary JSON document

Of null, each gives null; the last two give null, too, of bytes that aren't of their format.
"""

from __future__ import annotations

import importlib

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .names import DELETE_ROWS, EVENT_NAMES, TYPE_NAMES, UPDATE_ROWS, WRITE_ROWS


def _named(names: dict[int, str]) -> str:
    table = ", ".join(f"{k}, '{v}'" for k, v in names.items())
    return f"coalesce(try_element_at(map({table}), code), concat('0x', lpad(lower(hex(code)), 2, '0')))"


def _op() -> str:
    kinds = {"insert": WRITE_ROWS, "update": UPDATE_ROWS, "delete": DELETE_ROWS}
    return "CASE " + " ".join(f"WHEN code IN ({', '.join(map(str, sorted(c)))}) THEN '{op}'" for op, c in kinds.items()) + " END"


def _uint(data: str) -> str:
    digits = f"concat_ws('', reverse(transform(sequence(1, octet_length({data})), i -> hex(substring({data}, i, 1)))))"
    return f"CAST(CASE WHEN octet_length({data}) > 0 THEN conv({digits}, 16, 10) WHEN {data} IS NOT NULL THEN '0' END AS DECIMAL(20, 0))"


_FUNCTIONS = [
    ("tidelog_event_name(code INT)", "STRING", _named(EVENT_NAMES)),
    ("tidelog_column_type(code INT)", "STRING", _named(TYPE_NAMES)),
    ("tidelog_op(code INT)", "STRING", _op()),
    ("tidelog_uint(data BINARY)", "DECIMAL(20, 0)", _uint("data")),
    ("tidelog_crc_matches(event BINARY)", "BOOLEAN", f"crc32(substring(event, 1, octet_length(event) - 4)) = {_uint('substring(event, octet_length(event) - 3, 4)')}"),
    ("tidelog_sign24(value INT)", "INT", "CASE WHEN value >= 8388608 THEN value - 16777216 ELSE value END"),
    ("tidelog_year(byte INT)", "INT", "CASE WHEN byte = 0 THEN 0 ELSE byte + 1900 END"),
]


def _each(decode):
    """``decode`` over columns of values; null of nulls and of what it can't read."""

    def run(*columns: pd.Series) -> pd.Series:
        out = []
        for cells in zip(*columns):
            try:
                out.append(None if any(c is None or c != c for c in cells) else decode(*cells))
            except (ValueError, IndexError, KeyError, ArithmeticError):
                out.append(None)
        return pd.Series(out, dtype=object)

    return run


def register(spark: SparkSession) -> None:
    from ..sources import binjson, decimals

    for name in ("functions", "sources"):
        cloudpickle.register_pickle_by_value(importlib.import_module(f"..{name}", __package__))
    for head, kind, body in _FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
    decimal = _each(lambda data, precision, scale: decimals.decode_decimal(bytes(data), int(precision), int(scale)))
    text = _each(lambda data: binjson.canonical(binjson.decode(bytes(data))))

    def decimal_of(data: pd.Series, precision: pd.Series, scale: pd.Series) -> pd.Series:
        return decimal(data, precision, scale)

    def json_of(data: pd.Series) -> pd.Series:
        return text(data)

    spark.udf.register("tidelog_decimal", F.pandas_udf(decimal_of, "string"))
    spark.udf.register("tidelog_json", F.pandas_udf(json_of, "string"))
