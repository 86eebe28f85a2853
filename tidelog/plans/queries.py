"""Queries over logs encoded from the test tables, each with SQL over these tables.

A log is written once for a table folder, by Spark tasks, into the shared folder, and
read back through the data source; the SQL computes the same from the tables alone.
"""

from __future__ import annotations

import functools
import hashlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exprs
from ..operators import frames, maintenance
from ..sources import events as events_module
from ..sources.files import Folder

ROWS_PER_EVENT = 256
EVENTS_PER_TRANSACTION = 8
ONE_FILE = 1 << 62
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def base_folder(spark: SparkSession) -> str:
    """Where logs are kept: beside the checkpoints that all executors share."""
    shared = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    shared = shared or os.path.join(tempfile.gettempdir(), "tidelog")
    return shared[5:] if shared.startswith("file:") and "://" not in shared else shared.replace("file://", "")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tables_state(sf_dir: str) -> str:
    """Sizes and times of the table files: other data is another log."""
    if not os.path.isdir(sf_dir):
        return ""
    return ",".join(f"{e.name}:{e.stat().st_size}:{e.stat().st_mtime_ns}" for e in sorted(os.scandir(sf_dir), key=lambda e: e.name))


@functools.cache
def _code_state() -> str:
    """A hash of what encodes logs: another encoder is another log."""
    folder = os.path.dirname(os.path.abspath(events_module.__file__))
    seen = hashlib.md5()
    for name in ("encoder.py", "events.py", "values.py", "tablemap.py", "decimals.py", "binjson.py", "datasource.py"):
        with open(os.path.join(folder, name), "rb") as f:
            seen.update(f.read())
    with open(os.path.abspath(__file__), "rb") as f:
        seen.update(f.read())
    return seen.hexdigest()


def cached(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """The folder of a log, built by ``build(path)`` where it isn't there yet."""
    key = hashlib.md5(f"{sf_dir}:{_tables_state(sf_dir)}:{_code_state()}".encode()).hexdigest()[:12]
    root = f"{base_folder(spark)}/logs-{key}"
    path = f"{root}/{name}"
    if not Folder(path).has("_done"):
        fresh = f"{root}/.{name}-{uuid.uuid4().hex[:8]}"
        build(fresh)
        Folder(fresh).write("_done", b"")
        if Folder(path).has("_done"):
            return path
        try:
            os.rename(fresh, path)
        except OSError:
            return fresh
    return path


def plain(spark: SparkSession, sf_dir: str, name: str, partitions: int = 2, **options) -> str:
    """A log of inserts of a whole table."""
    return cached(spark, sf_dir, f"{name}-{partitions}", lambda p: frames.write_log(read(spark, sf_dir, name).repartition(partitions), p, f"shop.{name}", rowsPerEvent=ROWS_PER_EVENT, **options))


def derived(spark: SparkSession, sf_dir: str, name: str, df: DataFrame, table: str, partitions: int = 2, **options) -> str:
    return cached(spark, sf_dir, name, lambda p: frames.write_log(df.repartition(partitions), p, table, **options))


def changes_of(orders: DataFrame) -> DataFrame:
    """Inserts of all orders, updates where the key divides by 7, deletes where by 11."""
    image = F.struct(*orders.columns)
    new = F.struct(*[F.lit("U").alias(c) if c == "o_orderstatus" else (F.col(c) + 100).alias(c) if c == "o_totalprice" else F.col(c) for c in orders.columns])
    none = F.lit(None).cast(orders.select(image.alias("x")).schema["x"].dataType)
    current = F.when(F.col("o_orderkey") % 7 == 0, new).otherwise(image)
    parts = [
        orders.select(F.lit(0).alias("_step"), F.col("o_orderkey").alias("_key"), F.lit("insert").alias("op"), none.alias("before"), image.alias("after")),
        orders.where("o_orderkey % 7 = 0").select(F.lit(1).alias("_step"), F.col("o_orderkey").alias("_key"), F.lit("update").alias("op"), image.alias("before"), new.alias("after")),
        orders.where("o_orderkey % 11 = 0").select(F.lit(2).alias("_step"), F.col("o_orderkey").alias("_key"), F.lit("delete").alias("op"), current.alias("before"), none.alias("after")),
    ]
    return parts[0].union(parts[1]).union(parts[2])


def change_log(spark: SparkSession, sf_dir: str) -> str:
    def build(path: str) -> None:
        df = changes_of(read(spark, sf_dir, "orders")).repartition(4, "_key").sortWithinPartitions("_step", "_key")
        frames.write_log(df.select("op", "before", "after"), path, "shop.orders", key="o_orderkey")

    return cached(spark, sf_dir, "orders-changes", build)


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.table(spark, change_log(spark, sf_dir), "shop.orders")


def images(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return frames.table(spark, plain(spark, sf_dir, name), f"shop.{name}").select("after.*")


def _roundtrip(name: str):
    return lambda spark, sf_dir: images(spark, sf_dir, name)


QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


for _name in TABLES:
    QUERIES[f"roundtrip_{_name}"] = _roundtrip(_name)
    SQL[f"roundtrip_{_name}"] = f"SELECT * FROM {_name}"


@query("SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS price FROM orders")
def decimal_money(spark, sf_dir):
    df = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(15,2)").alias("price"))
    path = derived(spark, sf_dir, "money", df, "shop.money")
    return frames.table(spark, path, "shop.money").select("after.o_orderkey", F.col("after.price").cast("string").alias("price"))


@query("SELECT count(*) AS n, CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DECIMAL(30,2)) AS VARCHAR) AS total, max(o_totalprice) AS top FROM orders")
def decimal_accessors(spark, sf_dir):
    df = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(15,2)").alias("price"))
    path = derived(spark, sf_dir, "money", df, "shop.money")
    price = F.col("after.price")
    return frames.table(spark, path, "shop.money").agg(F.count("*").alias("n"), F.sum(price).cast("decimal(30,2)").cast("string").alias("total"), F.max(price.cast("double")).alias("top"))


@query("SELECT o_orderkey, CAST(CAST(o_orderkey AS DECIMAL(38,0)) * 1000000000000 AS DECIMAL(35,0))::VARCHAR || '.000' AS wide FROM orders")
def decimal_wide(spark, sf_dir):
    df = read(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey").cast("decimal(20,0)") * F.lit(10**12).cast("decimal(14,0)")).cast("decimal(38,3)").alias("wide"))
    path = derived(spark, sf_dir, "wide", df, "shop.wide")
    return frames.table(spark, path, "shop.wide").select("after.o_orderkey", F.col("after.wide").cast("string").alias("wide"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, sf_dir):
    path = derived(spark, sf_dir, "events-json", read(spark, sf_dir, "events"), "shop.events", types='{"props": "json"}')
    t = frames.table(spark, path, "shop.events")
    return t.select("after.event_id", F.get_json_object("after.props", "$.k").cast("long").alias("k"))


@query(
    "SELECT event_id, '{\"id\":' || event_id || ',\"kind\":\"' || event_type || '\",\"list\":[' || (event_id % 7) || ',null,true],\"user\":{\"n\":' || user_id || '}}' AS doc FROM events"
)
def json_nested(spark, sf_dir):
    doc = F.to_json(F.struct(F.struct(F.col("user_id").alias("n")).alias("user"), F.col("event_type").alias("kind"), F.col("event_id").alias("id")))
    full = F.concat(F.expr("substring(doc, 1, length(doc) - 1)"), F.lit(',"list":['), (F.col("event_id") % 7).cast("string"), F.lit(",null,true]}"))
    df = read(spark, sf_dir, "events").withColumn("doc", doc).select("event_id", full.alias("doc"))
    path = derived(spark, sf_dir, "events-nested", df, "shop.docs", types='{"doc": "json"}')
    return frames.table(spark, path, "shop.docs").select("after.event_id", "after.doc")


_ENUM = "enum(" + ",".join(f"'{p}'" for p in PRIORITIES) + ")"


@query(f"SELECT o_orderkey, CAST(list_position({PRIORITIES}, o_orderpriority) AS INTEGER) AS idx, o_orderpriority AS label FROM orders")
def enum_priority(spark, sf_dir):
    df = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    path = derived(spark, sf_dir, "orders-enum", df, "shop.orders", types='{"o_orderpriority": "%s"}' % _ENUM)
    t = frames.table(spark, path, "shop.orders")
    return t.select("after.o_orderkey", "after.o_orderpriority.idx", "after.o_orderpriority.label")


@query(
    "SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 4 END + CASE l_linestatus WHEN 'O' THEN 8 ELSE 16 END AS bits "
    "FROM lineitem GROUP BY ALL"
)
def set_flags(spark, sf_dir):
    df = read(spark, sf_dir, "lineitem").select("l_orderkey", F.concat_ws(",", "l_linestatus", "l_returnflag").alias("flags"))
    path = derived(spark, sf_dir, "lineitem-set", df, "shop.flags", types="{\"flags\": \"set('A','N','R','O','F')\"}")
    m = F.col("after.flags.members")
    t = frames.table(spark, path, "shop.flags").select(m[0].alias("l_returnflag"), m[1].alias("l_linestatus"), F.col("after.flags.bits").cast("int").alias("bits"))
    return t.groupBy("l_returnflag", "l_linestatus", "bits").agg(F.count("*").alias("n"))


@query(
    "SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS c_name, CASE WHEN c_custkey % 3 <> 1 THEN CAST(c_nationkey AS VARCHAR) END AS c_nationkey, "
    "CASE WHEN c_custkey % 3 <> 2 THEN c_acctbal END AS c_acctbal, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS c_mktsegment FROM customer"
)
def null_bitmap(spark, sf_dir):
    k = F.col("c_custkey")
    df = read(spark, sf_dir, "customer").select(
        "c_custkey", F.when(k % 3 != 0, F.col("c_name")).alias("c_name"), F.when(k % 3 != 1, F.col("c_nationkey")).alias("c_nationkey"), F.when(k % 3 != 2, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(k % 2 == 0, F.col("c_mktsegment")).alias("c_mktsegment"), *[F.lit(None).cast("int").alias(f"x{i}") for i in range(6)],
    )
    path = derived(spark, sf_dir, "customer-null", df, "shop.customer")
    return frames.table(spark, path, "shop.customer").select("after.c_custkey", "after.c_name", F.col("after.c_nationkey").cast("string").alias("c_nationkey"), "after.c_acctbal", "after.c_mktsegment")


@query(
    "SELECT o_orderkey, CAST(o_orderkey % 256 AS SMALLINT) AS u8, CAST((o_orderkey * 37) % 65536 AS INTEGER) AS u16, CAST((o_orderkey * 7919) % 16777216 AS INTEGER) AS u24, "
    "CAST((o_orderkey * 104729) % 4294967296 AS BIGINT) AS u32, CAST(18446744073709551615 - CAST(o_orderkey AS HUGEINT) AS VARCHAR) AS u64, CAST((o_orderkey * 7919) % 16777216 - 8388608 AS INTEGER) AS i24 FROM orders"
)
def unsigned_ints(spark, sf_dir):
    k = F.col("o_orderkey")
    df = read(spark, sf_dir, "orders").select(
        "o_orderkey", (k % 256).alias("u8"), (k * 37 % 65536).alias("u16"), (k * 7919 % 16777216).alias("u24"), (k * 104729 % 4294967296).alias("u32"),
        (F.lit("18446744073709551615").cast("decimal(20,0)") - k).cast("decimal(20,0)").alias("u64"), (k * 7919 % 16777216 - 8388608).alias("i24"),
    )
    types = '{"u8": "unsigned tinyint", "u16": "unsigned smallint", "u24": "unsigned mediumint", "u32": "unsigned int", "u64": "unsigned bigint", "i24": "mediumint"}'
    a = frames.table(spark, derived(spark, sf_dir, "unsigned", df, "shop.numbers", types=types), "shop.numbers").select("after.*")
    return a.withColumn("u64", F.col("u64").cast("string"))


@query(
    "SELECT o_orderkey, CAST(1901 + o_orderkey % 254 AS SMALLINT) AS y, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d, o_orderdate AS ts, "
    "CAST((o_orderkey % 6000001 - 3000000) * 1000000 + o_orderkey % 1000000 AS BIGINT) AS t FROM orders"
)
def year_date_time(spark, sf_dir):
    k = F.col("o_orderkey")
    df = read(spark, sf_dir, "orders").select(
        "o_orderkey", (k % 254 + 1901).alias("y"), F.col("o_orderdate").cast("date").alias("d"), F.col("o_orderdate").alias("ts"), ((k % 6000001 - 3000000) * 1000000 + k % 1000000).alias("t")
    )
    types = '{"y": "year", "d": "date", "ts": "timestamp(6)", "t": "time(6)"}'
    a = frames.table(spark, derived(spark, sf_dir, "times", df, "shop.times", types=types), "shop.times").select("after.*")
    micros = F.extract(F.lit("DAY"), F.col("t")).cast("long") * 86_400_000_000 + F.extract(F.lit("HOUR"), F.col("t")).cast("long") * 3_600_000_000 + F.extract(F.lit("MINUTE"), F.col("t")).cast("long") * 60_000_000
    return a.withColumn("t", (micros + F.extract(F.lit("SECOND"), F.col("t")) * 1_000_000).cast("long")).withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn("d", F.col("d").cast("string"))


@query("SELECT o_orderkey, CAST(o_orderkey % 32 AS BIGINT) AS b5, CAST((o_orderkey * 2654435761) % 4611686018427387904 AS BIGINT) AS b62 FROM orders")
def bit_fields(spark, sf_dir):
    k = F.col("o_orderkey")
    df = read(spark, sf_dir, "orders").select("o_orderkey", (k % 32).alias("b5"), (k * 2654435761 % (1 << 62)).alias("b62"))
    path = derived(spark, sf_dir, "bits", df, "shop.bits", types='{"b5": "bit(5)", "b62": "bit(62)"}')
    return frames.table(spark, path, "shop.bits").select("after.*")


@query("SELECT doc_id, CAST(strlen(text) AS BIGINT) AS bytes, md5(text) AS digest FROM documents")
def blob_text(spark, sf_dir):
    df = read(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("binary").alias("text"))
    t = frames.table(spark, derived(spark, sf_dir, "documents", df, "shop.documents", rowsPerEvent=32), "shop.documents")
    return t.select("after.doc_id", F.octet_length("after.text").cast("long").alias("bytes"), F.md5("after.text").alias("digest"))


@query("SELECT vec_id, label, CAST(len(embedding) AS BIGINT) AS n FROM embeddings")
def json_arrays(spark, sf_dir):
    df = read(spark, sf_dir, "embeddings").select("vec_id", "label", F.to_json("embedding").alias("embedding"))
    t = frames.table(spark, derived(spark, sf_dir, "embeddings", df, "shop.embeddings", types='{"embedding": "json"}'), "shop.embeddings")
    return t.select("after.vec_id", "after.label", F.json_array_length("after.embedding").cast("long").alias("n"))


@query("SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, round(sum(o_totalprice), 2) AS price FROM orders")
def insert_only(spark, sf_dir):
    t = changes(spark, sf_dir).where("op = 'insert'")
    return t.agg(F.count("*").alias("n"), F.sum("after.o_orderkey").alias("keys"), F.round(F.sum("after.o_totalprice"), 2).alias("price"))


@query("SELECT o_orderkey, o_orderstatus AS old_status, 'U' AS new_status, round(o_totalprice, 2) AS old_price, round(o_totalprice + 100, 2) AS new_price FROM orders WHERE o_orderkey % 7 = 0")
def update_before_after(spark, sf_dir):
    t = changes(spark, sf_dir).where("op = 'update'")
    return t.select(
        "after.o_orderkey", F.col("before.o_orderstatus").alias("old_status"), F.col("after.o_orderstatus").alias("new_status"), F.round("before.o_totalprice", 2).alias("old_price"),
        F.round("after.o_totalprice", 2).alias("new_price"),
    )


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'U' ELSE o_orderstatus END AS status, true AS no_after FROM orders WHERE o_orderkey % 11 = 0")
def delete_images(spark, sf_dir):
    t = changes(spark, sf_dir).where("op = 'delete'")
    return t.select("before.o_orderkey", F.col("before.o_orderstatus").alias("status"), F.col("after").isNull().alias("no_after"))


@query(
    "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice, "
    "o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 11 <> 0"
)
def latest_state_orders(spark, sf_dir):
    return frames.latest_state(changes(spark, sf_dir), ["o_orderkey"])


@query("SELECT op, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(CASE WHEN o_orderkey % 77 = 0 THEN ['insert', 'update', 'delete'] WHEN o_orderkey % 7 = 0 THEN ['insert', 'update'] WHEN o_orderkey % 11 = 0 THEN ['insert', 'delete'] ELSE ['insert'] END) AS op FROM orders) GROUP BY op")
def changes_by_op(spark, sf_dir):
    return frames.rows(spark, change_log(spark, sf_dir)).groupBy("op").agg(F.count("*").alias("n"))


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS n FROM {t}" for t in ("customer", "orders", "part", "supplier")))
def changes_per_table(spark, sf_dir):
    logs = [frames.rows(spark, plain(spark, sf_dir, t)) for t in ("customer", "orders", "part", "supplier")]
    out = logs[0]
    for x in logs[1:]:
        out = out.unionByName(x)
    return out.groupBy("table_name").agg(F.count("*").alias("n"))


_COUNTS = f"(SELECT CAST(ceil(count(*) / {ROWS_PER_EVENT}.0) AS BIGINT) AS e, CAST(ceil(ceil(count(*) / {ROWS_PER_EVENT}.0) / {EVENTS_PER_TRANSACTION}.0) AS BIGINT) AS t FROM orders)"


@query(
    f"SELECT unnest(['formatDescription', 'anonymousGTID', 'query', 'tableMap', 'writeRowsV2', 'xid']) AS event_name, unnest([1, b.t, b.t, b.e, b.e, b.t]) AS n FROM "
    f"(SELECT CAST(sum(e) AS BIGINT) AS e, CAST(sum(t) AS BIGINT) AS t FROM {_COUNTS}) b"
)
def event_type_counts(spark, sf_dir):
    return frames.events(spark, one_log(spark, sf_dir), payload=False).groupBy("event_name").agg(F.count("*").alias("n"))


def one_log(spark, sf_dir) -> str:
    """Orders in one file of one table's inserts, in full events."""
    df = read(spark, sf_dir, "orders")
    return cached(spark, sf_dir, "orders-one", lambda p: _write_one(df, p, "shop.orders"))


def _write_one(df: DataFrame, path: str, table: str) -> None:
    """Rows as one more file, however large; all its events but the last are full."""
    frames.write_log(df.coalesce(1), path, table, rowsPerEvent=ROWS_PER_EVENT, eventsPerTransaction=EVENTS_PER_TRANSACTION, fileBytes=ONE_FILE)


@query(f"SELECT 1 + 3 * t + 2 * e AS events, 3 * t + 2 * e AS linked, 1 + 3 * t + 2 * e AS intact FROM {_COUNTS}")
def event_positions(spark, sf_dir):
    log = frames.events(spark, one_log(spark, sf_dir), payload=False)
    w = Window.partitionBy("log_file").orderBy("start_pos")
    return log.select((F.col("next_pos") == F.lead("start_pos").over(w)).alias("_l"), (F.col("start_pos") + F.col("event_size") == F.col("next_pos")).alias("_i")).agg(
        F.count("*").alias("events"), F.count_if("_l").alias("linked"), F.count_if("_i").alias("intact")
    )


@query(f"SELECT 1 + 3 * t + 2 * e AS good FROM {_COUNTS}")
def checksum_ok(spark, sf_dir):
    return frames.events(spark, one_log(spark, sf_dir), payload=False).agg(F.count_if("crc_ok").alias("good"))


@query(f"SELECT 'shop.orders' AS name, e AS events FROM {_COUNTS} UNION ALL SELECT 'shop.customer', CAST(ceil(count(*) / {ROWS_PER_EVENT}.0) AS BIGINT) FROM customer")
def tablemap_asof(spark, sf_dir):
    def build(path: str) -> None:
        _write_one(read(spark, sf_dir, "orders"), path, "shop.orders")
        _write_one(read(spark, sf_dir, "customer"), path, "shop.customer")

    log = frames.events(spark, cached(spark, sf_dir, "two-tables", build))
    return frames.with_table_map(log).where("event_name = 'writeRowsV2'").groupBy(F.col("table").alias("name")).agg(F.count("*").alias("events"))


@query("SELECT c_custkey, c_acctbal, true AS others_null FROM customer")
def partial_images(spark, sf_dir):
    path = derived(spark, sf_dir, "customer-partial", read(spark, sf_dir, "customer"), "shop.customer", imageColumns="c_custkey,c_acctbal")
    t = frames.table(spark, path, "shop.customer")
    return t.select("after.c_custkey", "after.c_acctbal", (F.col("after.c_name").isNull() & F.col("after.c_nationkey").isNull() & F.col("after.c_mktsegment").isNull()).alias("others_null"))


@query("SELECT c_custkey, '@' || i AS label FROM customer, range(5) r(i)")
def unnamed_columns(spark, sf_dir):
    path = derived(spark, sf_dir, "customer-minimal", read(spark, sf_dir, "customer"), "shop.customer", metadata="minimal")
    rows = frames.rows(spark, path)
    return rows.select(F.col("after")["@0"].cast("long").alias("c_custkey"), F.explode(F.map_keys("after")).alias("label"))


def _ordered_chain(spark, sf_dir) -> str:
    def build(path: str) -> None:
        orders = read(spark, sf_dir, "orders")
        for part in range(3):
            _write_one(orders.where(f"o_orderkey % 3 = {part}"), path, "shop.orders")

    return cached(spark, sf_dir, "orders-chain", build)


@query("SELECT CAST(o_orderkey % 3 AS INTEGER) AS file_seq, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY ALL")
def multi_file_chain(spark, sf_dir):
    t = frames.table(spark, _ordered_chain(spark, sf_dir), "shop.orders")
    return t.groupBy("file_seq").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 > 0")
def resume_from_position(spark, sf_dir):
    return frames.table(spark, _ordered_chain(spark, sf_dir), "shop.orders", startingPosition="log.000002:0x4").select("after.o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 > 0")
def prefix_prune(spark, sf_dir):
    def build(path: str) -> None:
        maintenance.copy_log(spark, _ordered_chain(spark, sf_dir), path)
        maintenance.prune_first(path)

    return frames.table(spark, cached(spark, sf_dir, "orders-pruned", build), "shop.orders").select("after.o_orderkey")


@query("SELECT CAST(i AS INTEGER) AS file_seq, 'log.' || lpad(CAST(i + 1 AS VARCHAR), 6, '0') AS log_file FROM range(3) r(i)")
def file_listing(spark, sf_dir):
    return frames.files(spark, _ordered_chain(spark, sf_dir)).select("file_seq", "log_file")


@query("SELECT 'log.000003' AS log_file, true AS at_end")
def end_position(spark, sf_dir):
    path = _ordered_chain(spark, sf_dir)
    end = frames.end_position(spark, path)
    return end.join(frames.files(spark, path), "log_file").select("log_file", (F.col("pos") == F.col("bytes")).alias("at_end"))


@query("SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders")
def copied_log(spark, sf_dir):
    path = cached(spark, sf_dir, "orders-copy", lambda p: maintenance.copy_log(spark, _ordered_chain(spark, sf_dir), p))
    return frames.table(spark, path, "shop.orders").agg(F.count("*").alias("n"), F.sum("after.o_orderkey").alias("keys"))


@query("SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders")
def many_ranges(spark, sf_dir):
    t = frames.table(spark, one_log(spark, sf_dir), "shop.orders", rangeBytes=65536)
    return t.agg(F.count("*").alias("n"), F.sum("after.o_orderkey").alias("keys"))


@query("SELECT c_custkey FROM customer")
def table_filter(spark, sf_dir):
    def build(path: str) -> None:
        frames.write_log(read(spark, sf_dir, "customer").coalesce(1), path, "shop.customer")
        frames.write_log(read(spark, sf_dir, "part").coalesce(1), path, "shop.part")

    rows = frames.rows(spark, cached(spark, sf_dir, "customer-part", build)).where("table_name = 'customer'")
    return rows.select(F.col("after")["c_custkey"].cast("long").alias("c_custkey"))


@query("SELECT '   SET: {\"r_name\":\"' || r_name || '\",\"r_regionkey\":\"' || r_regionkey || '\"}' AS line FROM region")
def view_json(spark, sf_dir):
    lines = maintenance.view(spark, plain(spark, sf_dir, "region", 1))
    return lines.where("line LIKE '%SET: %'").select("line")


@query("SELECT * FROM events")
def stream_available_now(spark, sf_dir):
    path = plain(spark, sf_dir, "events")
    target = f"{base_folder(spark)}/stream-{uuid.uuid4().hex[:12]}"  # the sink keeps full paths, so it is never renamed
    _drain(spark, path, target)
    return spark.read.parquet(f"{target}/out")


def _drain(spark, path: str, out: str) -> None:
    t = frames.table(spark, path, "shop.events", stream=True).select("after.*")
    q = t.writeStream.format("parquet").option("path", f"{out}/out").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
    q.awaitTermination()


@query("SELECT date_trunc('hour', ts) AS hour, event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def tumbling_counts(spark, sf_dir):
    e = images(spark, sf_dir, "events")
    return e.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query(
    "SELECT user_id, CAST(sum(gap) AS BIGINT) AS sessions FROM (SELECT user_id, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS gap FROM events "
    "WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) GROUP BY user_id"
)
def session_gaps(spark, sf_dir):
    e = images(spark, sf_dir, "events")
    before = F.lag("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    new = F.when(before.isNull() | (F.col("ts") - before > F.expr("INTERVAL 30 MINUTES")), 1).otherwise(0)
    return e.withColumn("_gap", new).groupBy("user_id").agg(F.sum("_gap").alias("sessions"))


@query("SELECT user_id, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 10")
def topk_users(spark, sf_dir):
    return images(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "user_id").limit(10)


@query("SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS orders, round(sum(o_totalprice), 2) AS revenue FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment")
def segment_revenue(spark, sf_dir):
    o, c = images(spark, sf_dir, "orders"), images(spark, sf_dir, "customer")
    return o.join(c, o["o_custkey"] == c["c_custkey"]).groupBy("c_mktsegment").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))


@query("SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube_flags(spark, sf_dir):
    return images(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query("SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY c_mktsegment")
def segment_balance(spark, sf_dir):
    return images(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query(
    "SELECT x.event_id, max_by(y.value, y.event_id) AS price FROM events x LEFT JOIN events y ON y.event_type = 'purchase' AND x.user_id = y.user_id AND y.event_id <= x.event_id GROUP BY x.event_id"
)
def asof_price(spark, sf_dir):
    """The user's last purchase at or before each event."""
    e = images(spark, sf_dir, "events")
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    return e.select("event_id", F.last(F.when(F.col("event_type") == "purchase", F.col("value")), ignorenulls=True).over(w).alias("price"))


@query("SELECT * FROM (VALUES ('3.23.58', 1), ('4.0.1-log', 2), ('4.1.22', 3), ('5.0.0', 4), ('8.0.27+build', 4), ('8.0', 0)) v(server, version)")
def server_versions(spark, sf_dir):
    rows = [("3.23.58",), ("4.0.1-log",), ("4.1.22",), ("5.0.0",), ("8.0.27+build",), ("8.0",)]
    return spark.createDataFrame(rows, "server string").select("server", F.coalesce(exprs.log_version(F.col("server")), F.lit(0)).alias("version"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'NULL' ELSE '\"' || p_name || '\"' END AS name, CAST(p_size AS VARCHAR) AS size, 'x\"' || lower(hex(encode(p_brand))) || '\"' AS brand FROM part")
def sql_literals(spark, sf_dir):
    p = images(spark, sf_dir, "part")
    name = F.when(F.col("p_partkey") % 5 != 0, F.col("p_name"))
    return p.select("p_partkey", exprs.sql_literal(name, "string").alias("name"), exprs.sql_literal(F.col("p_size"), "number").alias("size"), exprs.sql_literal(F.col("p_brand").cast("binary"), "binary").alias("brand"))


@query(f"SELECT CAST(30 AS INTEGER) AS event_type, 'writeRowsV2' AS name, 'insert' AS op, e AS n FROM {_COUNTS}")
def header_expressions(spark, sf_dir):
    """Names and kinds from codes, in Catalyst alone."""
    log = frames.events(spark, one_log(spark, sf_dir), payload=False).where(F.col("event_type") == 30)
    code = F.col("event_type")
    return log.groupBy("event_type", exprs.event_type_name(code).alias("name"), exprs.op_of(code).alias("op")).agg(F.count("*").alias("n"))
