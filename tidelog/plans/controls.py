"""Queries on control events, on damaged logs, and with the functions of SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sql
from ..functions.names import EVENT
from ..operators import frames, maintenance
from ..sources import binjson, decimals
from ..sources.events import LogBuilder
from ..sources.files import Folder
from .queries import _COUNTS, ROWS_PER_EVENT, cached, one_log, query

CHUNK = 8 << 20


def _control_log(path: str) -> None:
    """One event of each kind that holds no rows; every field has a value of its own."""
    log = LogBuilder(created=1_600_000_000)
    bodies = [
        ("inVar", b"\1" + (5).to_bytes(8, "little")),
        ("inVar", b"\2" + (6).to_bytes(8, "little")),
        ("rand", (7).to_bytes(8, "little") + (8).to_bytes(8, "little")),
        ("userVar", (1).to_bytes(4, "little") + b"v" + b"\0" + b"\0" + (33).to_bytes(4, "little") + (2).to_bytes(4, "little") + b"ab"),
        ("rowsQuery", b"\x00insert into t"),
        ("incident", (1).to_bytes(2, "little") + b"\4lost"),
        ("query", (9).to_bytes(4, "little") + (2).to_bytes(4, "little") + b"\4" + bytes(2) + bytes(2) + b"shop\0DROP TABLE x"),
        ("rotate", (4).to_bytes(8, "little") + b"log.000002"),
    ]
    for i, (name, body) in enumerate(bodies):
        log.add(EVENT[name], body, 1_600_000_001 + i)
    folder = Folder(path)
    folder.write("log.000001", log.bytes())
    folder.write(".next", b"log.000001")


_CONTROL = [
    ("inVar", "kind", "lastInsertId"), ("inVar", "value", "5"), ("inVar", "kind", "insertId"), ("inVar", "value", "6"), ("rand", "seed1", "7"), ("rand", "seed2", "8"),
    ("userVar", "name", "v"), ("userVar", "is_null", "false"), ("userVar", "type", "0"), ("userVar", "charset", "33"), ("userVar", "value", "6162"), ("userVar", "unsigned", "false"),
    ("rowsQuery", "query", "insert into t"), ("incident", "kind", "1"), ("incident", "message", "lost"),
    ("query", "proxy_id", "9"), ("query", "exec_seconds", "2"), ("query", "error", "0"), ("query", "schema", "shop"), ("query", "query", "DROP TABLE x"),
    ("rotate", "position", "4"), ("rotate", "next_file", "log.000002"),
]


@query(f"SELECT * FROM (VALUES {', '.join(map(str, _CONTROL))}) v(event_name, field, value)")
def control_events(spark, sf_dir):
    """Fields of every kind of control event."""
    log = frames.events(spark, cached(spark, sf_dir, "control", _control_log)).where("event_name <> 'formatDescription'")
    return log.select("event_name", F.explode(F.from_json("detail", "map<string,string>")).alias("field", "value"))


def _damaged(spark, sf_dir) -> str:
    """Orders in one file, with one bit of the first rows event wrong."""

    def build(path: str) -> None:
        source = one_log(spark, sf_dir)
        at = frames.events(spark, source, payload=False).where("event_name = 'writeRowsV2'").agg(F.min(F.struct("start_pos", "log_file", "event_size"))).first()[0]
        maintenance.copy_log(spark, source, path)
        name, bad, whole = at["log_file"], at["start_pos"] + at["event_size"] // 2, Folder(source)
        size = whole.size(name)
        with Folder(path).stream(name) as f:
            for begin in range(0, size, CHUNK):
                data = bytearray(whole.read(name, begin, min(CHUNK, size - begin)))
                if begin <= bad < begin + len(data):
                    data[bad - begin] ^= 1
                f.write(bytes(data))

    return cached(spark, sf_dir, "orders-damaged", build)


@query(f"SELECT CAST(greatest(count(*) - {ROWS_PER_EVENT}, 0) AS BIGINT) AS n FROM orders")
def permissive_rows(spark, sf_dir):
    """All rows but those of the damaged event."""
    return frames.table(spark, _damaged(spark, sf_dir), "shop.orders", errors="permissive").agg(F.count("*").alias("n"))


@query("SELECT 'log.000001' AS log_file, 'writeRowsV2' AS event_name, 'wrong checksum of the event' AS reason")
def corrupt_events(spark, sf_dir):
    return frames.corrupt(spark, _damaged(spark, sf_dir)).select("log_file", "event_name", "reason")


@query(
    f"SELECT unnest(['formatDescription', 'anonymousGTID', 'query', 'tableMap', 'writeRowsV2', 'xid']) AS name, unnest([NULL, NULL, NULL, NULL, 'insert', NULL]) AS op, "
    f"unnest([1, t, t, e, e, t]) AS n FROM {_COUNTS}"
)
def sql_functions(spark, sf_dir):
    """Names and kinds of events by functions of SQL."""
    sql.register(spark)
    frames.events(spark, one_log(spark, sf_dir), payload=False).createOrReplaceTempView("tidelog_log")
    return spark.sql("SELECT tidelog_event_name(event_type) AS name, tidelog_op(event_type) AS op, count(*) AS n FROM tidelog_log GROUP BY ALL")


@query(
    "SELECT * FROM (VALUES ('decimal', '-1234.56'), ('json', '{\"a\":[1,null]}'), ('bad decimal', NULL), ('uint', '513'), ('sign24', '-1'), ('year', '2021'), ('type', 'json')) v(name, value)"
)
def sql_decoders(spark, sf_dir):
    """Values decoded by functions of SQL."""
    sql.register(spark)
    packed = decimals.encode_decimal(-123456, 10, 2)
    kind, body = binjson._encode({"a": [1, None]})
    cells = [("decimal", packed), ("json", bytes([kind]) + body), ("bad decimal", b"\1"), ("uint", b"\1\2")]
    spark.createDataFrame(cells, "name string, data binary").createOrReplaceTempView("tidelog_cells")
    return spark.sql(
        "SELECT name, CASE WHEN name = 'json' THEN tidelog_json(data) WHEN name = 'uint' THEN CAST(tidelog_uint(data) AS STRING) ELSE tidelog_decimal(data, 10, 2) END AS value FROM tidelog_cells "
        "UNION ALL SELECT 'sign24', CAST(tidelog_sign24(16777215) AS STRING) UNION ALL SELECT 'year', CAST(tidelog_year(121) AS STRING) UNION ALL SELECT 'type', tidelog_column_type(245)"
    )
