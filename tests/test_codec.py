"""Codec units: values, table maps, rows, events, against independent expectations."""

from __future__ import annotations

import json
import random
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.functions.names import EVENT, TYPE, event_name, op_name, type_name
from tidelog.sources import binjson, events
from tidelog.sources.cursor import Cursor, Truncated, packed
from tidelog.sources.decimals import decimal_size, decode_decimal, encode_decimal
from tidelog.sources.encoder import column_of
from tidelog.sources.rows import ImageScanner, RowsHeader, decode_rows_header, encode_images, encode_rows_header
from tidelog.sources.tablemap import TableMap, decode_table_map, encode_table_map
from tidelog.sources.values import Unsupported, as_text, arrow_type, decode_values, encode_values, width_of

UTC = timezone.utc


def us(h, m=0, s=0, micros=0):
    return timedelta(hours=h, minutes=m, seconds=s, microseconds=micros)


# One column, one value: declaration, value written, value expected.
CASES = [
    *[(t, v, v) for t, bits in (("tinyint", 8), ("smallint", 16), ("mediumint", 24), ("int", 32), ("bigint", 64)) for v in (1, -1, -(1 << bits - 1), (1 << bits - 1) - 1)],
    *[(f"unsigned {t}", v, v) for t, bits in (("tinyint", 8), ("smallint", 16), ("mediumint", 24), ("int", 32)) for v in (1, 0, (1 << bits) - 1)],
    *[("unsigned bigint", v, Decimal(v)) for v in (1, 0, (1 << 64) - 1)],
    ("float", 1.5, 1.5), ("double", 1.2345, 1.2345), ("double", -1.2345, -1.2345),
    ("decimal(10,3)", "123.4", Decimal("123.400")), ("decimal(5,0)", "-12", Decimal("-12")), ("decimal(30,20)", "0.12345678901234567890", Decimal("0.12345678901234567890")),
    ("decimal(30,20)", "-1234567890.5", Decimal("-1234567890.50000000000000000000")), ("decimal(65,30)", "-1.5", "-1." + "5".ljust(30, "0")), ("decimal(18,18)", "-0.000000000000000001", Decimal("-1E-18")),
    ("bit(5)", 11, 11), ("bit(5)", 31, 31), ("bit(64)", (1 << 64) - 1, Decimal((1 << 64) - 1)), ("bit(64)", 0, Decimal(0)),
    ("char(10)", "abc", "abc"), ("varchar(300)", "", ""), ("varchar(300)", "x" * 280, "x" * 280), ("varchar(62)", "é" * 31, "é" * 31), ("char(255)", "q" * 62, "q" * 62),
    ("varbinary(10)", b"\xff\x00", b"\xff\x00"), ("char(9) charset 8", "Zürich", "Zürich"),
    ("tinyblob", b"fourteen bytes", b"fourteen bytes"), ("longblob", b"", b""), ("text", "fourteen chars", "fourteen chars"), ("longtext", "y" * 70000, "y" * 70000),
    ("enum('a','b')", "a", {"idx": 1, "label": "a"}), ("enum('a','b')", "z", {"idx": 0, "label": ""}), ("enum(%s)" % ",".join(f"'v{i}'" for i in range(300)), "v299", {"idx": 300, "label": "v299"}),
    ("set('a','b','c')", "c,a", {"bits": Decimal(5), "members": ["a", "c"]}), ("set('a','b','c')", "", {"bits": Decimal(0), "members": []}), ("set('a','b','c')", "x,b", {"bits": Decimal(2), "members": ["b"]}),
    *[("year", v, v) for v in (0, 2001, 1999, 1901, 2155)],
    *[("date", d, d) for d in (date(2021, 2, 14), date(1000, 1, 1), date(9999, 12, 31), date(2020, 2, 29))],
    ("datetime(3)", datetime(2021, 2, 14, 20, 37, 12, 123000), datetime(2021, 2, 14, 20, 37, 12, 123000)), ("datetime(6)", datetime(1000, 1, 1), datetime(1000, 1, 1)),
    ("datetime(6)", datetime(9999, 12, 31, 23, 59, 59, 999999), datetime(9999, 12, 31, 23, 59, 59, 999999)), ("datetime", datetime(2021, 12, 1, 1, 2, 3), datetime(2021, 12, 1, 1, 2, 3)),
    ("timestamp(6)", datetime(2038, 1, 19, 3, 14, 7, 999999, UTC), datetime(2038, 1, 19, 3, 14, 7, 999999, UTC)), ("timestamp(3)", datetime(1970, 1, 1, 0, 0, 1, 0, UTC), datetime(1970, 1, 1, 0, 0, 1, 0, UTC)),
    *[(f"time({f})", v, v) for f, v in ((0, us(838, 59, 59)), (0, -us(838, 59, 59)), (1, us(838, 51, 58, 100000)), (2, -us(838, 51, 58, 120000)), (3, us(1, 2, 3, 123000)), (6, -us(838, 51, 58, 123456)))],
    *[("time", v, v) for v in (-us(0, 1), -us(1), -us(12, 30))], ("time(1)", -us(0, 0, 0, 500000), -us(0, 0, 0, 500000)),
]


def _array(spec, value):
    if value is None:
        return pa.array([None])
    if spec.startswith(("decimal", "unsigned bigint", "bit")):
        return pa.array([str(value)]) if spec.startswith("decimal") else pa.array([Decimal(value)])
    return pa.array([value])


def roundtrip(spec, value):
    col = column_of(0, "value", spec)
    t = TableMap(7, 1, "test", "t", (col,))
    col = decode_table_map(encode_table_map(t)).columns[0]
    assert col == t.columns[0]
    raw, size = encode_images([col], [_array(spec, value)])
    s = ImageScanner([col])
    assert s.scan(raw.tobytes(), 0, len(raw)) == len(raw) == int(size[0])
    got = s.columns_of(raw)[0]
    assert got.type == arrow_type(col)
    return got.to_pylist()[0]


@pytest.mark.parametrize("spec,value,expected", CASES, ids=[f"{c[0][:20]}-{i}" for i, c in enumerate(CASES)])
def test_column_types(spec, value, expected):
    assert roundtrip(spec, value) == expected


JSON_CASES = ["null", "true", "false", "1", "-1", "65535", "-2147483648", "9223372036854775807", "-9223372036854775808", "18446744073709551615", "123.45", '"value"', '"' + "long" * 60 + '"', '{"key":"value"}', '{"key1":"value1","key2":"value2"}', "[]", "{}", '[1,[2,{"a":null}],"x"]', '{"a":{"b":[true,false,70000]},"é":"ü\\n"}']


@pytest.mark.parametrize("text", JSON_CASES)
def test_json_documents(text):
    assert roundtrip("json", text) == binjson.canonical(json.loads(text))


def test_json_opaque_values():
    def doc(kind, body):
        return bytes([binjson.OPAQUE, kind]) + bytes([len(body)]) + body

    packed_time = ((12 << 12 | 51 << 6 | 58) << 24) + 123456
    assert binjson.decode(doc(TYPE["time"], packed_time.to_bytes(8, "little"))) == (12 * 3600 + 51 * 60 + 58) * 10**9 + 123456000
    assert binjson.decode(doc(TYPE["time"], (-packed_time).to_bytes(8, "little", signed=True))) == -((12 * 3600 + 51 * 60 + 58) * 10**9 + 123456000)
    day = ((2021 * 13 + 2) << 5 | 14) << 17
    assert binjson.decode(doc(TYPE["date"], (day << 24).to_bytes(8, "little"))) == "2021-02-14T00:00:00Z"
    full = ((day | 20 << 12 | 37 << 6 | 12) << 24) + 123000
    assert binjson.decode(doc(TYPE["dateTime"], full.to_bytes(8, "little"))) == "2021-02-14T20:37:12.123Z"
    assert binjson.canonical(binjson.decode(doc(TYPE["newDecimal"], bytes([5, 2]) + encode_decimal(12345, 5, 2)))) == "123.45"
    # An opaque text ends where its length says, also inside of a container.
    inner = bytes([TYPE["varchar"], 5]) + b"hello"
    head = (2).to_bytes(2, "little") + (4 + 6 + len(inner)).to_bytes(2, "little")
    array = bytes([binjson.SMALL_ARRAY]) + head + bytes([binjson.OPAQUE]) + (10).to_bytes(2, "little") + bytes([binjson.INT16]) + (7).to_bytes(2, "little") + inner
    assert binjson.decode(array) == ["hello", 7]


def test_json_large_container_and_bad_offsets():
    value = {f"key{i:05d}": i for i in range(9000)}
    raw = binjson.encode(value)
    assert raw[0] == binjson.LARGE_OBJECT and binjson.decode(raw) == value
    for cut in (1, 5, 11):
        with pytest.raises((ValueError, IndexError)):
            binjson.decode(binjson.encode({"a": "bcd"})[:cut] + b"")


@settings(max_examples=150, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers(-(1 << 63), (1 << 64) - 1) | st.text(max_size=20), lambda x: st.lists(x, max_size=5) | st.dictionaries(st.text(max_size=8), x, max_size=5), max_leaves=20))
def test_json_any_document(value):
    assert binjson.decode(binjson.encode(value)) == value


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 65).flatmap(lambda p: st.tuples(st.just(p), st.integers(0, min(p, 30)), st.integers(-(10**p) + 1, 10**p - 1))))
def test_decimals(case):
    p, s, v = case
    raw = encode_decimal(v, p, s)
    assert len(raw) == decimal_size(p, s)
    assert Decimal(decode_decimal(raw, p, s)) == Decimal(v).scaleb(-s) if p <= 28 else int(decode_decimal(raw, p, s).replace(".", "")) == v
    assert decode_decimal(raw, p, s).count(".") == (s > 0)


def test_zero_dates_are_null():
    for spec, width in (("date", 3), ("datetime", 5), ("timestamp", 4)):
        col = column_of(0, "d", spec)
        raw = np.zeros(width, np.uint8)
        if spec == "datetime":
            raw[0] = 0x80
        assert decode_values(col, raw, np.array([0])).to_pylist() == [None]


def test_unsupported_and_corrupt_values():
    with pytest.raises(Unsupported):
        width_of(column_of(0, "x", "int").__class__(0, TYPE["newDate"]))
    col = column_of(0, "e", "enum('a')")
    with pytest.raises(ValueError):
        decode_values(col, np.array([9], np.uint8), np.array([0]))
    with pytest.raises(Truncated):
        ImageScanner([column_of(0, "s", "varchar(10)")]).scan(b"\x00\x09ab", 0, 4)


def test_nulls_across_bytes():
    cols = [column_of(i, f"c{i}", "int" if i % 2 else "varchar(20)") for i in range(11)]
    rng = random.Random(5)
    rows = [[None if rng.random() < 0.4 else (r * i if i % 2 else f"v{r}-{i}") for i in range(11)] for r in range(50)]
    arrays = [pa.array([row[i] for row in rows], pa.int32() if i % 2 else pa.string()) for i in range(11)]
    raw, _ = encode_images(cols, arrays)
    s, at = ImageScanner(cols), 0
    while at < len(raw):
        at = s.scan(raw.tobytes(), at, len(raw))
    assert list(map(list, zip(*[a.to_pylist() for a in s.columns_of(raw)]))) == rows


@pytest.mark.parametrize("version", [0, 1, 2])
@pytest.mark.parametrize("kind", ["writeRows", "updateRows", "deleteRows"])
def test_rows_headers(version, kind):
    code = EVENT[f"{kind}V{version}"]
    t = TableMap(0x010203040506, 1, "s", "t", tuple(column_of(i, f"c{i}", "int") for i in range(10)))
    raw = encode_rows_header(t, code, [1, 3], [0, 9])
    h = decode_rows_header(raw, 0, len(raw), code)
    assert h == RowsHeader(t.table_id, 1, (1, 3), (0, 9) if kind == "updateRows" and version else None, len(raw))
    assert op_name(code) == {"writeRows": "insert", "updateRows": "update", "deleteRows": "delete"}[kind]


def test_dummy_rows():
    raw = (0x00FFFFFF).to_bytes(6, "little") + b"\1\0"
    assert decode_rows_header(raw, 0, len(raw), EVENT["writeRowsV1"]).present == ()


def test_table_map_metadata():
    specs = ["unsigned int", "varchar(300)", "char(255)", "decimal(12,3)", "enum('x','y''z')", "set('p','q')", "json", "time(3)", "bit(12)", "tinyblob", "double", "unsigned bigint", "geometry"]
    t = TableMap(42, 1, "shop", "many", tuple(column_of(i, f"n{i}", s, nullable=i % 3 == 0) for i, s in enumerate(specs)), (0, 3))
    assert decode_table_map(encode_table_map(t)) == t
    bare = decode_table_map(encode_table_map(t, full=False))
    assert [c.label for c in bare.columns] == [f"@{i}" for i in range(len(specs))] and bare.columns[0].unsigned and not bare.columns[4].values
    assert t.fingerprint != bare.fingerprint


def test_default_charsets_with_exceptions():
    t = TableMap(1, 0, "s", "t", tuple(column_of(i, "", "varchar(9)") for i in range(3)))
    body = encode_table_map(t, full=False)
    at = body.find(b"\x03" + packed(9) + packed(255) * 3)
    assert at > 0
    body = body[:at] + bytes([2]) + packed(len(packed(45) + packed(1) + packed(63))) + packed(45) + packed(1) + packed(63)
    assert [c.charset for c in decode_table_map(body).columns] == [45, 63, 45]


def test_long_char_hides_its_length():
    col = column_of(0, "c", "char(255)")
    wide = col.__class__(0, TYPE["string"], 1020, charset=255, name="c")
    got = decode_table_map(encode_table_map(TableMap(1, 0, "s", "t", (wide,)))).columns[0]
    assert (got.type, got.meta) == (TYPE["string"], 1020) and width_of(got) == (2, True)


def test_cursor():
    c = Cursor(b"one\0two\0three")
    assert c.until_null() == b"one" and c.until_null() == b"two"
    with pytest.raises(Truncated):
        c.until_null()
    for n in (0, 250, 251, 65535, 65536, 1 << 24, (1 << 64) - 1):
        assert Cursor(packed(n)).packed() == n
    with pytest.raises(Truncated):
        Cursor(b"\1\2").uint(3)


def test_event_bodies():
    q = (3).to_bytes(4, "little") + (9).to_bytes(4, "little") + bytes([4]) + (0).to_bytes(2, "little") + (2).to_bytes(2, "little") + b"xx" + b"shop\0" + b"select 1"
    assert events.decode_query(q) == {"proxy_id": 3, "exec_seconds": 9, "error": 0, "schema": "shop", "query": "select 1"}
    assert events.decode_rotate((4).to_bytes(8, "little") + b"log.000002") == {"position": 4, "next_file": "log.000002"}
    assert events.decode_int_var(b"\2" + (77).to_bytes(8, "little")) == {"kind": "insertId", "value": 77}
    assert events.decode_rand(bytes(8) + b"\1" + bytes(7)) == {"seed1": 0, "seed2": 1}
    assert events.decode_incident((1).to_bytes(2, "little") + b"\4lost") == {"kind": 1, "message": "lost"}
    assert events.decode_rows_query(b"\x05select") == {"query": "select"}
    name = (1).to_bytes(4, "little") + b"v"
    assert events.decode_user_var(name + b"\0") == {"name": "v", "is_null": True}
    got = events.decode_user_var(name + b"\1" + b"\x08" + (63).to_bytes(4, "little") + (1).to_bytes(4, "little") + b"\7" + b"\0")
    assert got == {"name": "v", "is_null": False, "type": 8, "charset": 63, "value": "07", "unsigned": False}


def test_format_and_checksum_forms():
    for checksum in (True, False):
        log = events.LogBuilder(checksum=checksum).bytes()
        h = events.read_header(log, 4)
        body = log[23 : 4 + h.size]
        f = events.decode_format(body)
        assert (f.version, f.server, f.checksum, h.next_pos) == (4, "8.0.27", 4 if checksum else 0, len(log))
        if checksum:
            assert events.checksum_ok(log, 4, h.size)
    old = (4).to_bytes(2, "little") + b"5.1.0".ljust(50, b"\0") + bytes(4) + bytes([19]) + bytes(27)
    assert events.decode_format(old).checksum == 0 and len(events.decode_format(old).post_headers) == 27


def test_versions_and_names():
    assert [events.log_version_of_server(v) for v in ("3.23.58", "4.0.1-x", "4.1.0", "5.0.0+y", "8.0.27")] == [1, 2, 3, 4, 4]
    with pytest.raises(ValueError):
        events.log_version_of_server("8.0")
    assert (events.detect_version(0x0F, 103), events.detect_version(1, 60), events.detect_version(1, 80), events.detect_version(2, 40)) == (4, 1, 3, 3)
    assert (event_name(0x1E), event_name(0x30), type_name(0xF6), type_name(0x77)) == ("writeRowsV2", "0x30", "newDecimal", "0x77")


def test_text_of_values():
    assert as_text(pa.array([b"ab", None])).to_pylist() == ["YWI=", None]
    assert as_text(pa.array([us(-1)], pa.duration("us"))).to_pylist() == ["-3600000000"]
    assert as_text(pa.array([1.5, None])).to_pylist() == ["1.5", None]


def test_encode_refuses_too_long_values():
    with pytest.raises(ValueError):
        encode_values(column_of(0, "c", "varchar(9)"), pa.array(["x" * 300]))
