"""Distributed pieces that operators on pairs of documents share.

*Components.*  Edges are contracted round by round: every node points to its least
neighbour, pointers are followed a few steps, and edges move to what they point
to, until none is left.

*Ids as bits.*  A set of ids as a bitmap of fixed size, so that a scan can leave
out most texts that no pair needs.  It only ever lets too much through.

*Meeting at hubs.*  Rows about a document meet the content of their hub in one
sorted stream, where only the hub's content is held.  A hub with many rows is
dealt over several groups, each with a copy of its content.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fetched, written

BITS = 24
HUB_ROWS = 64
#: A key with more than 1 / HOT of all rows is told to all tasks; there are fewer than HOT.
HOT = 2000


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of (a, b) edges: the least node reachable."""
    spark = edges.sparkSession
    todo = written(edges.where("a <> b").select("a", "b").distinct())
    mapping = None
    while not todo.isEmpty():
        both = todo.select(F.col("a").alias("node"), F.col("b").alias("other")).union(todo.select("b", "a"))
        point = both.groupBy("node").agg(F.min("other").alias("to")).select("node", F.least("node", "to").alias("to"))
        point, moved = written(point), True
        while moved:  # each jump doubles how far a pointer goes; at the end all point to roots
            ahead = point.select(F.col("node").alias("_n"), F.col("to").alias("_t"))
            point = written(point.join(ahead, point["to"] == ahead["_n"], "left").select("node", F.coalesce("_t", "to").alias("to"), F.coalesce(F.col("_t") != F.col("to"), F.lit(False)).alias("moved")))
            moved = not point.where("moved").isEmpty()
            point = point.select("node", "to")
        if mapping is None:
            mapping = point
        else:
            step = point.select(F.col("node").alias("_n"), F.col("to").alias("_t"))
            mapping = written(mapping.join(step, mapping["to"] == step["_n"], "left").select("node", F.coalesce("_t", "to").alias("to")))
        left = point.select(F.col("node").alias("a"), F.col("to").alias("a2"))
        right = point.select(F.col("node").alias("b"), F.col("to").alias("b2"))
        todo = written(todo.join(left, "a").join(right, "b").where("a2 <> b2").select(F.col("a2").alias("a"), F.col("b2").alias("b")).distinct())
    if mapping is None:
        return spark.createDataFrame([], "node long, component long")
    return mapping.select("node", F.col("to").alias("component"))


def join_hot(rows: DataFrame, key: str, side: DataFrame) -> DataFrame:
    """``rows`` (computed already) joined with ``side``, which has one row a key.  Keys with a large share
    of the rows, of which there can be few only, are told to all tasks; the others are joined."""
    hot = cut(rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > rows.count() // HOT).select(key))
    if hot.isEmpty():
        return rows.join(side, key)
    few = F.broadcast(hot)  # fewer than HOT rows
    large = rows.join(F.broadcast(side.join(few, key, "left_semi")), key)
    return large.unionByName(rows.join(few, key, "left_anti").join(side, key))


class IdBits:
    """A set of ids with false positives, in 2^bits bits."""

    def __init__(self, ids: DataFrame, hashed: bool = False, bits: int = BITS):
        """``ids`` has one column (``hashed``: of 64-bit hashes already); at most 2^bits / 64 rows reach the driver."""
        name = F.col(ids.columns[0])
        value = (name if hashed else F.xxhash64(name)).alias("v")
        bit = F.col("v").bitwiseAND(F.lit((1 << bits) - 1))
        words = ids.select(value).select(F.shiftright(bit, 6).alias("w"), F.expr("shiftleft(1L, CAST(v & 63 AS INT))").alias("v"))
        got = fetched(words.groupBy("w").agg(F.bit_or("v").alias("v")))
        self.mask = (1 << bits) - 1
        self.words = np.zeros((1 << bits) // 64, np.int64)
        self.words[got["w"].to_numpy()] = got["v"].to_numpy()

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """Which ids may be there, from their xxhash64 (or their own hashes)."""
        bit = hashes.astype(np.int64) & self.mask
        return (self.words[bit >> 6] >> (bit & 63)) & 1 == 1


def meet_at_hubs(rows: DataFrame, hub: str, pairs: DataFrame, content: DataFrame, key: str, value: str, run, schema: str) -> DataFrame:
    """Streams ``rows`` (with a column ``hub``) past ``value`` of the row of
    ``content`` whose ``key`` is their hub.  ``pairs`` has the hubs of ``rows``, for counting.

    ``run(batches)`` gets Arrow batches in order of hub and group; their first
    columns are _hub, _salt, _kind and _value: a row of kind 0 brings the hub's
    value, rows of kind 1 that follow have it null and the columns of ``rows``.
    """
    names = [c for c in rows.columns if c != hub]
    degree = pairs.groupBy(F.col(hub).alias("_hub")).agg(F.ceil(F.count("*") / HUB_ROWS).cast("int").alias("_groups"))
    degree = cut(degree)
    d = degree.withColumnRenamed("_hub", "_h")
    held = content.join(d, content[key] == d["_h"]).select(
        F.col("_h").alias("_hub"), F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)).alias("_salt"), F.lit(0).alias("_kind"), F.col(value).alias("_value"),
        *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in names],
    )
    large = d.where("_groups > 1")
    dealt = rows.join(large, rows[hub] == large["_h"], "left").select(
        F.col(hub).alias("_hub"), F.pmod(F.xxhash64(*names[:1]), F.coalesce("_groups", F.lit(1))).cast("int").alias("_salt"), F.lit(1).alias("_kind"),
        F.lit(None).cast(content.schema[value].dataType).alias("_value"), *names,
    )
    both = held.union(dealt).repartition("_hub", "_salt").sortWithinPartitions("_hub", "_salt", "_kind")
    return both.mapInArrow(run, schema)
