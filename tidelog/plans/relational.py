"""Relational and streaming queries on decoded logs: joins, grouping, sets, SQL on views, and streams with state."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators import frames
from .queries import base_folder, derived, images, plain, query, read


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def customers_without_orders(spark, sf_dir):
    c, o = images(spark, sf_dir, "customer"), images(spark, sf_dir, "orders")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left_anti").select("c_custkey", "c_name")


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 5000)")
def suppliers_near_rich_customers(spark, sf_dir):
    s, c = images(spark, sf_dir, "supplier"), images(spark, sf_dir, "customer").where("c_acctbal > 5000")
    return s.join(c, s["s_nationkey"] == c["c_nationkey"], "left_semi").select("s_suppkey", "s_name")


@query("SELECT n_name, CAST(count(s_suppkey) AS BIGINT) AS suppliers FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name")
def suppliers_by_nation(spark, sf_dir):
    n, s = images(spark, sf_dir, "nation"), images(spark, sf_dir, "supplier")
    return n.join(s, n["n_nationkey"] == s["s_nationkey"], "left").groupBy("n_name").agg(F.count("s_suppkey").alias("suppliers"))


@query("SELECT coalesce(a.k, b.k) AS k, a.n AS customers, b.n AS suppliers FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1) a FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) b ON a.k = b.k")
def nations_of_both(spark, sf_dir):
    a = images(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("customers"))
    b = images(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers"))
    return a.join(b, "k", "full").select("k", "customers", "suppliers")


@query("SELECT x.user_id, CAST(count(*) AS BIGINT) AS pairs FROM events x JOIN events y ON x.user_id = y.user_id AND y.ts > x.ts AND y.ts <= x.ts + INTERVAL 10 MINUTE GROUP BY x.user_id")
def events_soon_after(spark, sf_dir):
    """A join on a range of time inside a key."""
    e = images(spark, sf_dir, "events")
    x, y = e.select("user_id", F.col("ts").alias("x")), e.select("user_id", F.col("ts").alias("y"))
    near = x.join(y, "user_id").where((F.col("y") > F.col("x")) & (F.col("y") <= F.col("x") + F.expr("INTERVAL 10 MINUTES")))
    return near.groupBy("user_id").agg(F.count("*").alias("pairs"))


@query("SELECT o_orderstatus, o_orderpriority, CAST(count(*) AS BIGINT) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def rollup_orders(spark, sf_dir):
    return images(spark, sf_dir, "orders").rollup("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")
def grouping_sets_sql(spark, sf_dir):
    """SQL on a view of a decoded log."""
    images(spark, sf_dir, "lineitem").createOrReplaceTempView("tidelog_lineitem")
    return spark.sql("SELECT l_returnflag, l_linestatus, count(*) AS n FROM tidelog_lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1")
def dearest_order_sql(spark, sf_dir):
    images(spark, sf_dir, "orders").createOrReplaceTempView("tidelog_orders")
    return spark.sql(
        "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM tidelog_orders) WHERE r = 1"
    )


@query("SELECT CAST(count(DISTINCT l_partkey) AS BIGINT) AS parts, CAST(count(DISTINCT l_suppkey) AS BIGINT) AS suppliers, CAST((SELECT count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem)) AS BIGINT) AS flags FROM lineitem")
def distinct_counts(spark, sf_dir):
    li = images(spark, sf_dir, "lineitem")
    return li.agg(F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_suppkey").alias("suppliers"), F.countDistinct("l_returnflag", "l_linestatus").alias("flags"))


@query("SELECT true AS near")
def approximate_distinct(spark, sf_dir):
    li = images(spark, sf_dir, "lineitem")
    got = li.agg(F.approx_count_distinct("l_partkey", 0.02).alias("a"), F.countDistinct("l_partkey").alias("b"))
    return got.select((F.abs(F.col("a") - F.col("b")) <= F.greatest(F.col("b") * 0.08, F.lit(2))).alias("near"))


@query("SELECT 'both' AS side, k FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'customer', k FROM (SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'any', k FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier)")
def set_operations(spark, sf_dir):
    c = images(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"))
    s = images(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))
    parts = {"both": c.intersect(s), "customer": c.subtract(s), "any": c.union(s).distinct()}
    out = [df.select(F.lit(side).alias("side"), "k") for side, df in parts.items()]
    return out[0].union(out[1]).union(out[2])


@query("SELECT o_orderstatus, round(median(o_totalprice), 4) AS middle, round(stddev_samp(o_totalprice), 4) AS spread, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date FROM orders GROUP BY o_orderstatus")
def order_statistics(spark, sf_dir):
    o = images(spark, sf_dir, "orders")
    return o.groupBy("o_orderstatus").agg(
        F.round(F.median("o_totalprice"), 4).alias("middle"), F.round(F.stddev_samp("o_totalprice"), 4).alias("spread"), F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date")
    )


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = frames.table(spark, plain(spark, sf_dir, "events"), "shop.events", stream=True).select("after.*")
    return e.withColumn("at", F.col("ts").cast("timestamp"))


def _last_batch(df: DataFrame, mode: str) -> DataFrame:
    """What a streaming query gives of all that is there: each batch's rows are kept, those of ``complete`` replaced."""
    spark, folder = df.sparkSession, f"{base_folder(df.sparkSession)}/stream-{uuid.uuid4().hex[:12]}"
    keep = "overwrite" if mode == "complete" else "append"
    q = df.writeStream.foreachBatch(lambda b, _: b.write.mode(keep).parquet(f"{folder}/out")).outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


@query("SELECT date_trunc('hour', ts) AS hour, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY ALL")
def stream_windows(spark, sf_dir):
    """Windows with a watermark over a followed log."""
    w = _stream(spark, sf_dir).withWatermark("at", "1 hour").groupBy(F.window("at", "1 hour"), "event_type").agg(F.count("*").alias("n"))
    return _last_batch(w, "complete").select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "event_type", "n")


@query("SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n FROM events JOIN customer ON user_id = c_custkey GROUP BY c_mktsegment")
def stream_static_join(spark, sf_dir):
    """A followed log joined with a table decoded from another."""
    c = images(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    e = _stream(spark, sf_dir)
    return _last_batch(e.join(c, e["user_id"] == c["c_custkey"]).groupBy("c_mktsegment").agg(F.count("*").alias("n")), "complete")


@query("SELECT x.event_id, y.event_id AS later_id FROM events x JOIN events y ON x.user_id = y.user_id AND x.event_type = 'click' AND y.event_type = 'purchase' AND y.ts >= x.ts AND y.ts <= x.ts + INTERVAL 30 MINUTE")
def stream_stream_join(spark, sf_dir):
    """Two followed logs joined inside a range of time, so that state is bounded by the watermark."""
    x = _stream(spark, sf_dir).where("event_type = 'click'").select("event_id", "user_id", F.col("at").alias("x_at")).withWatermark("x_at", "1 hour")
    y = _stream(spark, sf_dir).where("event_type = 'purchase'").select(F.col("event_id").alias("later_id"), F.col("user_id").alias("y_user"), F.col("at").alias("y_at")).withWatermark("y_at", "1 hour")
    both = x.join(y, F.expr("user_id = y_user AND y_at >= x_at AND y_at <= x_at + INTERVAL 30 MINUTES"))
    return _last_batch(both.select("event_id", "later_id"), "append")


@query("SELECT DISTINCT user_id FROM events")
def stream_distinct(spark, sf_dir):
    return _last_batch(_stream(spark, sf_dir).select("user_id").dropDuplicates(["user_id"]), "append")


def _totals(key, batches, state):
    n, total = state.get if state.exists else (0, 0.0)
    for pdf in batches:
        n, total = n + len(pdf), total + float(pdf["value"].sum())
    state.update((n, total))
    yield pd.DataFrame({"user_id": [key[0]], "n": [n], "total": [round(total, 4)]})


@query("SELECT user_id, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total FROM events GROUP BY user_id")
def stream_state(spark, sf_dir):
    """State of one's own for each user; of several batches the last row of a user counts."""
    rows = _stream(spark, sf_dir).select("user_id", "value").groupBy("user_id")
    kept = rows.applyInPandasWithState(_totals, "user_id long, n long, total double", "n long, total double", "update", GroupStateTimeout.NoTimeout)
    return _last_batch(kept, "update").groupBy("user_id").agg(F.max("n").alias("n"), F.max_by("total", "n").alias("total"))




@query("SELECT vec_id, CAST(i - 1 AS INTEGER) AS place, CAST(embedding[i] AS DOUBLE) AS value FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)")
def json_array_values(spark, sf_dir):
    """Every number of arrays that were written as JSON."""
    df = read(spark, sf_dir, "embeddings").select("vec_id", "label", F.to_json("embedding").alias("embedding"))
    t = frames.table(spark, derived(spark, sf_dir, "embeddings", df, "shop.embeddings", types='{"embedding": "json"}'), "shop.embeddings")
    values = F.posexplode(F.from_json("after.embedding", "array<float>")).alias("place", "value")
    return t.select("after.vec_id", values).select("vec_id", "place", F.col("value").cast("double").alias("value"))
