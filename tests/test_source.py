"""The data source end to end: chains, positions, damage, streams, sinks."""

from __future__ import annotations

import os
import zlib

import pytest
from pyspark.sql import functions as F

from tidelog.functions import exprs, sql
from tidelog.operators import frames, maintenance
from tidelog.plans import planner
from tidelog.sources.events import LogBuilder
from tidelog.sources.files import Folder
from tidelog.functions.names import EVENT


@pytest.fixture
def rows(spark):
    return spark.range(0, 1000, numPartitions=2).select(F.col("id"), (F.col("id") * 2).cast("int").alias("n"), F.concat(F.lit("name-"), "id").alias("s"))


def keys(df):
    return sorted(r[0] for r in df.select("after.id").collect())


def test_chain_and_positions(spark, rows, tmp_path):
    path = str(tmp_path / "log")
    frames.write_log(rows, path, "db.t")
    frames.write_log(rows.where("id < 10").coalesce(1), path, "db.t")
    folder = Folder(path)
    assert planner.list_files(folder) == ["log.000001", "log.000002", "log.000003"]
    name, end = planner.end_position(folder)
    assert (name, end) == ("log.000003", folder.size("log.000003"))
    assert planner.resolve(folder, None) == ("log.000001", 4) and planner.resolve(folder, "latest") == (name, end)
    assert planner.resolve(folder, "log.000002:0x10") == ("log.000002", 16)
    t = frames.table(spark, path, "db.t")
    assert t.count() == 1010 and t.select("after.*").schema.simpleString() == "struct<id:bigint,n:int,s:string>"
    assert keys(frames.table(spark, path, "db.t", startingPosition="log.000003")) == list(range(10))
    assert frames.table(spark, path, "db.t", startingPosition="latest").count() == 0
    os.remove(f"{path}/log.000002.next")
    assert planner.list_files(folder) == ["log.000001", "log.000002"]
    with pytest.raises(NotADirectoryError):
        planner.list_files(Folder(f"{path}/none"))


def test_one_range_equals_many(spark, rows, tmp_path):
    path = str(tmp_path / "log")
    frames.write_log(rows.coalesce(1), path, "db.t", rowsPerEvent=16, eventsPerTransaction=2)
    assert len(planner.plan(Folder(path), None, None, 2000)) > 5
    a, b = frames.rows(spark, path), frames.rows(spark, path, rangeBytes=2000)
    cols = [c for c in a.columns if c not in ("before", "after")] + ["x"]
    a, b = (d.withColumn("x", F.map_entries("after")).select(*cols) for d in (a, b))
    assert a.count() == 1000 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_torn_tail_and_bad_files(spark, rows, tmp_path):
    path = str(tmp_path / "log")
    frames.write_log(rows.coalesce(1), path, "db.t", rowsPerEvent=100, eventsPerTransaction=1)
    file = f"{path}/log.000001"
    data = open(file, "rb").read()
    for lost, left in ((1, 1000), (30, 1000), (60, 900)):  # the last event of 31 bytes ends the transaction
        open(file, "wb").write(data[:-lost])
        assert planner.end_position(Folder(path))[1] < len(data) - lost + 1
        assert frames.table(spark, path, "db.t").count() == left
    open(file, "wb").write(data + b"\x01\x02")
    assert planner.end_position(Folder(path))[1] == len(data)
    open(file, "wb").write(b"none" + data[4:])
    with pytest.raises(Exception, match="no log file"):
        frames.events(spark, path).count()


def test_checksums(spark, rows, tmp_path):
    path = str(tmp_path / "log")
    frames.write_log(rows.coalesce(1), path, "db.t")
    file = f"{path}/log.000001"
    data = bytearray(open(file, "rb").read())
    data[-100] ^= 1
    open(file, "wb").write(data)
    with pytest.raises(Exception, match="wrong checksum"):
        frames.table(spark, path, "db.t").count()
    assert frames.events(spark, path, verify=False).where("NOT crc_ok").count() == 1
    bare = str(tmp_path / "bare")
    frames.write_log(rows.coalesce(1), bare, "db.t", checksum=False)
    assert frames.events(spark, bare).where("crc_ok IS NULL").count() == frames.events(spark, bare).count()
    assert frames.table(spark, bare, "db.t").count() == 1000


def test_permissive(spark, rows, tmp_path):
    path = str(tmp_path / "log")
    frames.write_log(rows.coalesce(1), path, "db.t", rowsPerEvent=100)
    file = f"{path}/log.000001"
    heads = frames.events(spark, path).where("event_name = 'writeRowsV2'").orderBy("start_pos").collect()
    data = bytearray(open(file, "rb").read())
    data[heads[2]["start_pos"] + 60] ^= 1
    end = heads[5]["start_pos"] + heads[5]["event_size"]  # a good checksum of rows that end too late
    data[end - 10] = 0xFF
    data[end - 11] = 0xFF
    body = heads[5]["start_pos"]
    for i in range(body + 45, end - 4):
        data[i] = 0xFE
    data[end - 4 : end] = zlib.crc32(bytes(data[body : end - 4])).to_bytes(4, "little")
    open(file, "wb").write(data)
    with pytest.raises(Exception):
        frames.table(spark, path, "db.t").count()
    for lost in (frames.table(spark, path, "db.t", errors="permissive"), frames.rows(spark, path, errors="permissive"), frames.table(spark, path, "db.t", errors="permissive", windowBytes=2000)):
        assert lost.count() == 800
    bad = frames.corrupt(spark, path).orderBy("start_pos").collect()
    assert [r["start_pos"] for r in bad] == [heads[2]["start_pos"], heads[5]["start_pos"]]
    assert "wrong checksum" in bad[0]["reason"] and "can't be read" in bad[1]["reason"]
    assert frames.events(spark, path, errors="permissive").where("NOT crc_ok AND detail IS NULL").count() == 1


def test_sql_functions(spark):
    sql.register(spark)
    got = spark.sql("SELECT tidelog_event_name(250), tidelog_event_name(CAST(NULL AS INT)), tidelog_op(2), tidelog_uint(X''), tidelog_uint(X'FFFFFFFFFFFFFFFF'), tidelog_crc_matches(X'6162636461626364'), tidelog_json(X'FF')").first()
    assert got[0] == "0xfa" and got[1] is None and got[2] is None and got[3] == 0 and int(got[4]) == 2**64 - 1 and got[5] is False and got[6] is None


def test_start_between_table_map_and_rows(spark, rows, tmp_path):
    path = str(tmp_path / "log")
    frames.write_log(rows.coalesce(1), path, "db.t", rowsPerEvent=500)
    at = frames.events(spark, path).where("event_name = 'writeRowsV2'").agg(F.max("start_pos")).first()[0]
    with pytest.raises(Exception, match="no table map"):
        frames.rows(spark, path, startingPosition=f"log.000001:{at}").count()
    assert frames.rows(spark, path, startingPosition=f"log.000001:{at}", lookback=True).count() == 500


def test_control_events(spark, tmp_path):
    log = LogBuilder(created=1_600_000_000)
    log.add(EVENT["inVar"], b"\1" + (5).to_bytes(8, "little"), 1_600_000_001)
    log.add(EVENT["rowsQuery"], b"\x00insert into t", 1_600_000_002)
    log.add(0x77, b"??", 1_600_000_003)
    log.add(EVENT["previousGTID"], bytes(8))
    log.add(EVENT["rotate"], (4).to_bytes(8, "little") + b"log.000002")
    folder = Folder(str(tmp_path / "log"))
    folder.write("log.000001", log.bytes())
    folder.write(".next", b"log.000001")
    got = frames.with_query(frames.events(spark, folder.path)).orderBy("start_pos").collect()
    assert [r["event_name"] for r in got] == ["formatDescription", "inVar", "rowsQuery", "0x77", "previousGTID", "rotate"]
    assert got[1]["detail"] == '{"kind": "lastInsertId", "value": 5}' and got[3]["statement"] == "insert into t" and got[3]["body"] == b"??"
    assert '"next_file": "log.000002"' in got[5]["detail"]


def test_schema_changes_by_name(spark, tmp_path):
    path = str(tmp_path / "log")
    one = spark.createDataFrame([(1, "a")], "id int, s string")
    two = spark.createDataFrame([(7, 2)], "more int, id int")
    frames.write_log(one.coalesce(1), path, "db.t")
    frames.write_log(two.coalesce(1), path, "db.t")
    t = frames.table(spark, path, "db.t")
    assert sorted(map(tuple, t.select("after.*").collect())) == [(1, "a"), (2, None)]
    assert frames.rows(spark, path).select("schema_fp").distinct().count() == 2
    with pytest.raises(Exception, match="give a schema"):
        frames.table(spark, path, "db.none").count()


def test_pushed_filters(spark, rows, tmp_path):
    path = str(tmp_path / "log")
    frames.write_log(rows.coalesce(1), path, "db.t")
    frames.write_log(rows.where("id < 5").coalesce(1), path, "db.u")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        log = frames.rows(spark, path)
        assert log.where("table_name = 'u'").count() == 5 and log.where("log_file = 'log.000002' AND event_type IN (30, 31)").count() == 5
        assert log.where("schema_name = 'x'").count() == 0 and frames.events(spark, path).where("event_type = 19").count() > 1
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_stream_follows_and_resumes(spark, rows, tmp_path):
    path, out = str(tmp_path / "log"), str(tmp_path / "out")
    frames.write_log(rows.where("id < 300").coalesce(1), path, "db.t")

    def drain():
        t = frames.table(spark, path, "db.t", stream=True).select("after.id")
        q = t.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start()
        q.awaitTermination()
        return sorted(r[0] for r in spark.read.schema("id long").parquet(out).collect())

    assert drain() == list(range(300))
    assert drain() == list(range(300))
    frames.write_log(rows.where("id >= 300").coalesce(1), path, "db.t")
    assert drain() == list(range(1000))
    file = f"{path}/log.000002"
    data = open(file, "rb").read()
    extra = LogBuilder(created=0)
    extra.pos = len(data)
    extra.parts = []
    extra.begin()
    open(file, "ab").write(extra.bytes())  # an open transaction waits
    assert planner.safe_end(Folder(path), "log.000002") == len(data)


def test_latest_state_and_key_changes(spark, tmp_path):
    path = str(tmp_path / "log")
    image = "struct<id:int,v:string>"
    steps = [
        ("insert", None, (1, "a")), ("insert", None, (2, "b")), ("insert", None, (3, "c")), ("update", (1, "a"), (1, "x")), ("update", (2, "b"), (9, "b")), ("delete", (3, "c"), None), ("insert", None, (3, "again")),
    ]
    frames.write_log(spark.createDataFrame(steps, f"op string, before {image}, after {image}").coalesce(1), path, "db.t")
    t = frames.table(spark, path, "db.t")
    assert sorted(map(tuple, frames.latest_state(t, ["id"]).collect())) == [(1, "x"), (3, "again"), (9, "b")]
    order = t.orderBy(*frames.ORDER).select("op").collect()
    assert [r[0] for r in order] == [s[0] for s in steps]
    cut = t.where("op = 'delete'").select("file_seq", "start_pos").first()
    assert frames.changes_between(t, end=tuple(cut)).count() == 5 and frames.changes_between(t, start=tuple(cut)).count() == 2


def test_copy_resume_and_prune(spark, rows, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    frames.write_log(rows, src, "db.t")
    maintenance.copy_log(spark, src, dst)
    frames.write_log(rows.where("id < 3").coalesce(1), src, "db.t")
    with open(f"{dst}/log.000002", "ab") as f:
        f.write(b"torn")
    maintenance.copy_log(spark, src, dst)
    for name in planner.list_files(Folder(src)):
        assert open(f"{src}/{name}", "rb").read() == open(f"{dst}/{name}", "rb").read()
    assert planner.list_files(Folder(dst)) == planner.list_files(Folder(src))
    assert maintenance.prune_first(dst) == "log.000001" and planner.list_files(Folder(dst)) == ["log.000002", "log.000003"]
    maintenance.prune_first(dst)
    with pytest.raises(ValueError):
        maintenance.prune_first(dst)


def test_view(spark, tmp_path):
    path = str(tmp_path / "log")
    image = "struct<id:int,v:string>"
    frames.write_log(spark.createDataFrame([("update", (1, "a"), (1, None)), ("delete", (1, "b"), None)], f"op string, before {image}, after {image}").coalesce(1), path, "db.t")
    lines = [r["line"] for r in maintenance.view(spark, path).orderBy("file_seq", "start_pos", "line_no").collect()]
    assert lines[0].startswith("1970-01-01 00:00:00 log.000001:0x") and lines[0].endswith("  v4 8.0.27")
    at = lines.index('   SET: {"id":"1","v":null}')
    assert lines[at + 1] == ' WHERE: {"id":"1","v":"a"}' and lines[at - 1].endswith("updateRowsV2     db.t")
    assert lines.count(' WHERE: {"id":"1","v":"b"}') == 1


def test_expressions(spark):
    df = spark.sql("SELECT X'0102030405' AS b, X'61626364' AS t")
    assert df.select(exprs.le_uint(F.col("b"), 1, 3)).first()[0] == 0x040302
    whole = LogBuilder().bytes()[4:]
    assert spark.createDataFrame([(bytearray(whole),)], "e binary").select(exprs.crc_matches(F.col("e"))).first()[0]
    got = spark.range(1).select(
        exprs.sign_extend_24(F.lit(0xFFFFFF)), exprs.set_members(F.lit(5), F.array(F.lit("a"), F.lit("b"), F.lit("c"))), exprs.enum_label(F.lit(2), F.array(F.lit("a"), F.lit("b"))),
        exprs.year_value(F.lit(121)), exprs.column_type_name(F.lit(0xF6)), exprs.event_type_name(F.lit(0x99)), exprs.sql_literal(F.lit('a"b'), "string"), exprs.sql_literal(F.lit(None).cast("int"), "int"),
    ).first()
    assert list(got) == [-1, ["a", "c"], "b", 2021, "newDecimal", "0x99", '"a\\"b"', "NULL"]


def test_empty_folder(spark, tmp_path):
    path = str(tmp_path / "log")
    frames.write_log(spark.createDataFrame([], "id int"), path, "db.t")
    assert planner.end_position(Folder(path)) == ("", 0) and frames.rows(spark, path).count() == 0


def _plain_log(folder, transactions, gtids, rows=8, blob=200, name="log.000001"):
    """A file of inserts in transactions, with or without GTIDs."""
    import pyarrow as pa

    from tidelog.sources.encoder import LogWriter, table_of

    schema = pa.schema([("id", pa.int64()), ("s", pa.string())])
    w = LogWriter(table_of("db", "t", schema, {}, []), rows_per_event=4, events_per_transaction=2)
    if not gtids:
        w.log.begin = lambda time=0: w.log.add(EVENT["query"], bytes(8) + b"\0" + bytes(4) + b"\0" + b"BEGIN", time)
    for i in range(transactions):
        ids = list(range(i * rows, (i + 1) * rows))
        w.add(pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([f"{k:04d}" * (blob // 4) for k in ids])], schema=schema))
    folder.write(name, w.log.bytes())
    return transactions * rows


@pytest.mark.parametrize("gtids", [True, False])
def test_ranges_are_settled_in_tasks(spark, tmp_path, gtids):
    """Whatever a file's size and kind, planning reads little of it, and ranges hold all transactions once."""
    folder = Folder(str(tmp_path / "log"))
    n = _plain_log(folder, 300, gtids)
    folder.write(".next", b"log.000001")
    read = []

    class Counting(Folder):
        def read(self, name, start=0, size=None):
            got = super().read(name, start, size)
            read.append(len(got))
            return got

    found = planner.plan(Counting(folder.path), None, None, 20_000)
    assert len(found) > 20 and sum(read) < 500
    exact = [planner.settled(folder, r) for r in found]
    assert exact[0].start == 4 and exact[-1].end == folder.size("log.000001")
    assert all(a.end == b.start for a, b in zip(exact, exact[1:]))
    t = frames.table(spark, folder.path, "db.t", rangeBytes=20_000)
    assert keys(t) == list(range(n)) and keys(frames.table(spark, folder.path, "db.t", rangeBytes=20_000, windowBytes=700)) == list(range(n))
    assert keys(frames.table(spark, folder.path, "db.t", windowBytes=64)) == list(range(n))


def test_many_files_and_a_large_one(spark, tmp_path):
    folder = Folder(str(tmp_path / "log"))
    total, last = 0, ""
    for i in range(300):
        name = f"log.{i:06d}"
        total += _plain_log(folder, 200 if i == 150 else 1, i % 2 == 0, name=name)
        folder.write(f"{last}.next", name.encode())
        last = name
    found = planner.plan(folder, None, None, 20_000)
    assert len(found) > 310 and len([r for r in found if r.file == "log.000150"]) > 10
    assert frames.table(spark, folder.path, "db.t", rangeBytes=20_000).count() == total


def test_events_are_full_over_batches(tmp_path):
    import pyarrow as pa

    from tidelog.sources.encoder import LogWriter, table_of

    image = pa.struct([pa.field("id", pa.int64())])
    w = LogWriter(table_of("db", "t", image, {}, []), rows_per_event=4, events_per_transaction=2)

    def changes(op, ids):
        none, some = pa.nulls(len(ids), image), pa.array([{"id": i} for i in ids], image)
        return pa.RecordBatch.from_arrays([pa.array([op] * len(ids)), none if op == "insert" else some, none if op == "delete" else some], names=["op", "before", "after"])

    for a in range(0, 21, 3):
        w.extend(changes("insert", range(a, a + 3)))
    w.extend(changes("update", [1]))
    w.extend(changes("update", [2]))
    w.extend(changes("delete", [3]))
    w.close()
    assert not w.held
    Folder(str(tmp_path)).write("log.000001", w.log.drain())
    assert w.log.bytes() == b""
    sizes = [n for _, kind, n in planner.hop(Folder(str(tmp_path)), "log.000001") if kind == EVENT["writeRowsV2"]]
    assert len(sizes) == 6 and len(set(sizes[:5])) == 1  # 4 rows each, and 1
    kinds = [kind for _, kind, _ in planner.hop(Folder(str(tmp_path)), "log.000001")]
    assert kinds.count(EVENT["xid"]) == 5 and kinds.count(EVENT["updateRowsV2"]) == kinds.count(EVENT["deleteRowsV2"]) == 1


def test_files_of_bounded_size_and_overwrite(spark, rows, tmp_path):
    path = str(tmp_path / "log")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        frames.write_log(rows.coalesce(1), path, "db.t", fileBytes=2000)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    old = planner.list_files(Folder(path))
    assert len(old) > 5 and keys(frames.table(spark, path, "db.t")) == list(range(1000))
    frames.write_log(rows.where("id < 10").coalesce(1), path, "db.t", mode="overwrite")
    assert keys(frames.table(spark, path, "db.t")) == list(range(10))
    assert sorted(f for f in os.listdir(path) if f.startswith("log.")) == [f"log.{len(old) + 1:06d}"]


def test_follow(spark, rows, tmp_path):
    path, lines = str(tmp_path / "log"), []
    frames.write_log(rows.coalesce(1), path, "db.t")
    maintenance.follow(spark, path, lines.append, str(tmp_path / "state"), once=True).awaitTermination()
    seen = len(lines)
    assert seen == frames.events(spark, path).count() and "formatDescription" in lines[0]
    frames.write_log(rows.where("id < 5").coalesce(1), path, "db.t")
    maintenance.follow(spark, path, lines.append, str(tmp_path / "state"), once=True).awaitTermination()
    assert len(lines) == frames.events(spark, path).count() > seen


def test_json_days_that_are_not_in_the_calendar():
    from tidelog.functions.names import TYPE
    from tidelog.sources import binjson

    def packed(year, month, day):
        return ((((year * 13 + month) << 5 | day) << 17) << 24).to_bytes(8, "little", signed=True)

    assert binjson._opaque(TYPE["dateTime"], packed(2021, 2, 28)) == "2021-02-28T00:00:00Z"
    for bad in ((2021, 2, 30), (0, 1, 1), (2021, 0, 0)):
        assert binjson._opaque(TYPE["date"], packed(*bad)) is None
