"""Mixing sources to target weights by capped water-filling.

Every source has a weight, and all sources share ``share`` times the corpus.  A
source never takes more than ``max_epochs`` times its size: it is clamped there
and its excess goes to the others by weight, again and again until none is
above.  Each round is one aggregate over a table of one row a source; two numbers reach the driver.
The ranks that weights go by come from a range partitioning by name and the partitions' counts.

Inside a source each document is taken ``floor(target / size)`` whole times.
The rest of the target is filled by seeded buckets of documents: buckets below
the boundary are taken once more, and of the boundary bucket every document
gives the same fraction of its words.  Sums are taken per (source, bucket), so
a source with a third of all rows is spread over all tasks.

Defined cases: null text has size 0; a null source is a source of its own, the
last one; an empty table gives an empty result; rows with equal ids are equal
draws; other columns pass through (``keep``), but those that have the name of a new
column, which is the new one's; ``mixed_documents`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, documents, fetched, free_name, written
from .text import WHITE, buffer_of, slices, spans

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_EPOCHS = 2.0
BUCKET_DIGITS = 3
BUCKETS = 16**BUCKET_DIGITS
SEED = 20240229
#: A plan of one row a source is broadcast up to so many sources; beyond, it is joined by (source, salt).
BROADCAST_SOURCES = 50_000
SALTS = 16
NEW = ("size", "source_size", "target", "whole", "extra", "taken")


def word_count(col: Column) -> Column:
    return F.coalesce(F.regexp_count(col.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def ranked(sizes: DataFrame, by: str) -> DataFrame:
    """``sizes`` with _k: the rank of each row by a column, nulls last, from 0."""
    placed = written(sizes.repartitionByRange(F.col(by).asc_nulls_last()).withColumn("_part", F.spark_partition_id()))
    counts = fetched(placed.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part"))  # a row a partition
    part, n = counts["_part"].to_numpy(), counts["n"].to_numpy()
    bases = sizes.sparkSession.createDataFrame(list(zip(part.tolist(), (np.cumsum(n) - n).tolist())), "_q int, _base long")
    inside = Window.partitionBy("_part").orderBy(F.col(by).asc_nulls_last())
    out = placed.withColumn("_i", F.row_number().over(inside) - 1).join(F.broadcast(bases), F.col("_part") == F.col("_q"))
    return out.select(*sizes.columns, (F.col("_base") + F.col("_i")).alias("_k"))


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS
) -> DataFrame:
    """From (source, source_size), one row a source: source, source_size, target.
    Weights go to the sources by code point, null last, and repeat."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_k") % len(weights) + 1).cast("int"))
    rows = ranked(sizes, "source").select("source", "source_size", weight.alias("_w"), (F.col("source_size") * F.lit(float(max_epochs))).alias("_cap"))
    rows = written(rows)
    level, clamped = -1.0, -1
    while True:
        over = F.col("_cap") <= F.lit(level) * F.col("_w")
        got = rows.agg(
            F.sum("source_size").alias("all"), F.count(F.when(over, 1)).alias("n"),
            F.coalesce(F.sum(F.when(over, F.col("_cap"))), F.lit(0.0)).alias("cap"), F.sum(F.when(~over, F.col("_w"))).alias("w"),
        ).first()
        if not got["w"] or got["n"] == clamped:  # all are clamped, or no further one
            break
        clamped = got["n"]
        level = (got["all"] * float(share) - got["cap"]) / got["w"]
    target = F.col("_cap") if not got["w"] else F.least(F.col("_cap"), F.lit(level) * F.col("_w"))
    return rows.select("source", "source_size", target.alias("target"))


def _draw(df: DataFrame, keep: list[str], weights: tuple[float, ...], share: float, max_epochs: float, seed: int) -> tuple[DataFrame, dict[str, str]]:
    """``keep`` and the columns of NEW, the latter under names that ``df`` doesn't have."""
    name = {c: free_name(df, f"_{c}") for c in (*NEW, "source", "bucket", "salt", "edge", "part")}
    rows = df.select(
        *[F.col(c) for c in keep],
        F.col("doc_id").alias(free_name(df, "_id")),
        F.col("source").alias(name["source"]),
        word_count(F.col("text")).alias(name["size"]),
        F.conv(F.substring(F.md5(F.concat_ws(":", F.col("doc_id"), F.lit(seed)).cast("binary")), 1, BUCKET_DIGITS), 16, 10).cast("int").alias(name["bucket"]),
    )
    base = rows if len(keep) > 1 else cut(rows)
    sums = cut(base.groupBy(F.col(name["source"]).alias("source"), F.col(name["bucket"]).alias("bucket")).agg(F.sum(name["size"]).alias("bucket_size")))
    targets = source_targets(sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, share, max_epochs)
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    b = sums.withColumn("upto", F.sum("bucket_size").over(running)).withColumnRenamed("source", "s")
    rate = F.col("target") / F.col("source_size")
    part = (F.col("need") - (F.col("upto") - F.col("bucket_size"))) / F.col("bucket_size")
    # Of each source: the first bucket that is not taken whole once more, and the part of it that is.
    plan = cut(
        b.join(targets, b["s"].eqNullSafe(targets["source"]))
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(rate + F.lit(1e-12))).otherwise(F.lit(0)).cast("int"))
        .withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("part", F.when(F.col("bucket_size") > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), part))).otherwise(F.lit(1.0)))
        .groupBy("s", "source_size", "target", "whole")
        .agg(F.min(F.when(F.col("part") < 1, F.struct("bucket", "part"))).alias("edge"))
        .select(
            F.col("s").alias(free_name(df, "_s")), F.col("source_size").alias(name["source_size"]), F.col("target").alias(name["target"]), F.col("whole").alias(name["whole"]),
            F.coalesce("edge.bucket", F.lit(BUCKETS)).alias(name["edge"]), F.coalesce("edge.part", F.lit(0.0)).alias(name["part"]),
        )
    )
    same = base[name["source"]].eqNullSafe(plan[free_name(df, "_s")])
    if plan.count() <= BROADCAST_SOURCES:
        out = base.join(F.broadcast(plan), same)
    else:
        salted = plan.withColumn(name["salt"], F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        out = base.join(salted, same & (base[name["bucket"]] % SALTS == salted[name["salt"]]))
    bucket, edge, size = F.col(name["bucket"]), F.col(name["edge"]), F.col(name["size"])
    extra = F.when(bucket < edge, size).when(bucket > edge, F.lit(0)).otherwise(F.round(size * F.col(name["part"]))).cast("long")
    out = out.withColumn(name["extra"], extra)
    return out.withColumn(name["taken"], (F.col(name["whole"]) * size + F.col(name["extra"])).cast("long")), name


def mix_sources(
    df: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
    seed: int = SEED,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, size, source_size, target, whole (repetitions), extra (words of one
    more, partial or full, repetition) and taken (words in all), plus ``keep``."""
    others = [c for c in keep if c.lower() not in (*NEW, "doc_id")]
    drawn, name = _draw(df, ["doc_id", *others], weights, share, max_epochs, seed)
    return drawn.select("doc_id", *others, *[F.col(name[c]).alias(c) for c in NEW])


def first_words(texts: pa.Array, limits: np.ndarray) -> list[str]:
    """Each text up to the end of its first ``limit`` words."""
    out: list[str] = []
    buf, off = buffer_of(texts)
    for lo, hi in slices(off):
        part, o = buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        _, ends, first = spans(part, o, ~WHITE)
        for i in range(hi - lo):
            n = min(int(limits[lo + i]), int(first[i + 1] - first[i]))
            out.append(bytes(part[o[i] : ends[first[i] + n - 1]]).decode("utf-8") if n > 0 else "")
    return out


def _prefixes(at: int):
    """Rows with the column at ``at`` cut to the words that the last column allows."""

    def run(batches):
        for batch in batches:
            limit = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            cols = batch.columns[:-1]
            cols[at] = pa.array(first_words(batch.column(at), limit), pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names[:-1])

    return run


def mixed_documents(
    df: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS, seed: int = SEED
) -> DataFrame:
    """The mix itself: each row as often as it is taken whole, and its first words
    once more where it is taken in part.  The columns of ``df`` are kept; rows
    taken no time at all are not in the mix."""
    names = df.columns
    drawn, name = _draw(df, names, weights, share, max_epochs, seed)
    whole, extra, size = (F.col(name[c]) for c in ("whole", "extra", "size"))
    times, turn = free_name(df, "_times"), free_name(df, "_turn")
    full = (whole + F.when(extra == size, 1).otherwise(0)).cast("int")
    repeated = drawn.withColumn(times, full).where(F.col(times) > 0).select(*names, F.explode(F.sequence(F.lit(1), F.col(times))).alias(turn)).drop(turn)
    part = drawn.where((extra > 0) & (extra < size)).select(*names, extra)
    return repeated.unionByName(part.mapInArrow(_prefixes(names.index("text")), df.schema))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")
