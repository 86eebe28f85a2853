"""Sharding by histogram sort.

Rows are ordered by (hash of text, doc_id).  Splitters between shards are found
by iteration: each round counts, across all partitions, the exact bytes below a
sorted list of candidate key boundaries; each unmet splitter's bracket shrinks
to the keys that its bin really holds and gets new candidates, until the bytes
below a candidate meet the splitter's target within the tolerance or its bin
holds one key.  Then the rows are exchanged once, each to its shard's part.

Equal texts have equal hashes, so they lie together; a group of copies larger
than a shard is split by doc_id, as the key goes on with it.  The same search cuts each shard
into parts of about equal bytes, whose counts are known from the last histogram: slots
are numbered inside a part, so neither a shard nor a large group of copies is one task (rows that
are equal in text and doc_id can't be told apart and are).

What reaches the driver is one histogram, shards * (parts * (inner probes + 2) + probes) rows at most.

Defined cases: null text has no bytes and hash of the empty text; a null doc_id
sorts first; rows with equal keys lie in one shard, in any order; an empty table
gives an empty result; further columns pass through (``keep``), but those that have the name of a new column.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, documents, fetched, free_name, text_or_empty

ROW_BYTES = 16
SHARDS = 40
PROBES = 24
TOLERANCE = 0.0005
PARTS = 16
#: Parts within a shard need not be equal: their tolerance is a share of a part, and they take fewer probes.
PART_TOLERANCE = 0.2
PART_PROBES = 4
_ROUNDS = 64


def _as_int(key: bytes) -> int:
    return int.from_bytes(key, "big")


def _bins(h: np.ndarray, d: np.ndarray, probe_h: np.ndarray, probe_d: np.ndarray) -> np.ndarray:
    """For each row, the number of probes (sorted pairs) that are <= its key."""
    at = np.searchsorted(probe_h, h, "left")
    upto = np.searchsorted(probe_h, h, "right")
    tied = np.flatnonzero(upto > at)
    out = at.copy()
    for v in np.unique(h[tied]) if len(tied) else ():
        rows = tied[h[tied] == v]
        lo, hi = int(np.searchsorted(probe_h, v, "left")), int(np.searchsorted(probe_h, v, "right"))
        out[rows] = lo + np.searchsorted(probe_d[lo:hi], d[rows], "right")
    return out


def _split(probes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """128-bit keys as the signed pairs that they stand for."""
    off = 1 << 63
    return (
        np.array([(p >> 64) - off for p in probes], np.int64),
        np.array([(p & ((1 << 64) - 1)) - off for p in probes], np.int64),
    )


def _join(h: int, d: int) -> int:
    return ((int(h) + (1 << 63)) << 64) | (int(d) + (1 << 63))


def histogram(keys: DataFrame, probes: list[int]) -> pd.DataFrame:
    """Exact rows, bytes, and least and greatest key of each bin between probes."""
    ph, pd_ = _split(probes)

    def count(batches):
        acc: dict[int, list] = {}
        for b in batches:
            h, d, s = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(h):
                continue
            bins = _bins(h, d, ph, pd_)
            order = np.lexsort((d, h))
            bins, h, d, s = bins[order], h[order], d[order], s[order]
            at = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
            end = np.r_[at[1:], len(bins)]
            sums = np.add.reduceat(s, at)
            for i, (a, e) in enumerate(zip(at, end)):
                lo, hi = _join(h[a], d[a]), _join(h[e - 1], d[e - 1])
                x = acc.setdefault(int(bins[a]), [0, 0, lo, hi])
                acc[int(bins[a])] = [x[0] + int(e - a), x[1] + int(sums[i]), min(x[2], lo), max(x[3], hi)]
        if acc:
            k = sorted(acc)
            yield pa.RecordBatch.from_pydict(
                {
                    "bin": pa.array(k, pa.int32()),
                    "n": pa.array([acc[i][0] for i in k], pa.int64()),
                    "bytes": pa.array([acc[i][1] for i in k], pa.int64()),
                    "lo": pa.array([acc[i][2].to_bytes(16, "big") for i in k], pa.binary()),
                    "hi": pa.array([acc[i][3].to_bytes(16, "big") for i in k], pa.binary()),
                }
            )

    parts = keys.mapInArrow(count, "bin int, n long, bytes long, lo binary, hi binary")
    rows = fetched(parts.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))).to_pandas()
    out = rows.sort_values("bin").reset_index(drop=True)
    out["lo"] = [_as_int(bytes(x)) for x in out["lo"]]
    out["hi"] = [_as_int(bytes(x)) for x in out["hi"]]
    return out


def splitters(keys: DataFrame, shards: int, parts: int = 1, tolerance: float = TOLERANCE, probes: int = PROBES) -> list[int]:
    """The first keys of all parts but the first (every ``parts``-th is that of a shard; rows with a key below the
    first splitter are in part 0): bytes below a shard's are as near its share as the
    tolerance, a fraction of one shard, asks, or as near as one row allows; those of parts inside as PART_TOLERANCE."""
    space, pieces = 1 << 128, shards * parts
    cand = [space * i // (pieces * 2) for i in range(1, pieces * 2)]
    total, chosen, brackets = None, {}, {}
    for _ in range(_ROUNDS):
        cand = sorted(set(cand))
        hist = histogram(keys, cand)
        if total is None:
            total = int(hist["bytes"].sum())
            if not total:
                return [space - 1] * (pieces - 1)
            targets = {s: total * s / pieces for s in range(1, pieces)}
            brackets = {s: (0, 0, space, total) for s in targets}  # key, bytes below it, twice
        bounds = [0, *cand, space]
        below, seen = [0] * len(bounds), 0
        inside = {}
        for b, size, lo, hi in zip(hist["bin"], hist["bytes"], hist["lo"], hist["hi"]):
            inside[int(b)] = (int(size), lo, hi)
        for i in range(len(bounds) - 1):
            seen += inside.get(i, (0, 0, 0))[0]
            below[i + 1] = seen
        cand = []
        for s, t in targets.items():
            if s in chosen:
                continue
            i = int(np.searchsorted(np.array(below, np.int64), t, "right")) - 1
            i = min(i, len(bounds) - 2)
            lo_key, lo_below, hi_key, hi_below = brackets[s]
            if below[i] > lo_below or bounds[i] > lo_key and below[i] == lo_below:
                lo_key, lo_below = bounds[i], below[i]
            if below[i + 1] < hi_below or bounds[i + 1] < hi_key and below[i + 1] == hi_below:
                hi_key, hi_below = bounds[i + 1], below[i + 1]
            if i in inside and lo_key <= inside[i][1] and inside[i][2] < hi_key:
                lo_key, hi_key = inside[i][1], inside[i][2] + 1
            best = min(((abs(lo_below - t), lo_key), (abs(hi_below - t), hi_key)))
            inner = s % parts > 0
            if best[0] <= (PART_TOLERANCE * total / pieces if inner else tolerance * total / shards) or hi_key - lo_key <= 1:
                chosen[s] = best[1]
                continue
            brackets[s] = (lo_key, lo_below, hi_key, hi_below)
            width = hi_key - lo_key
            count = PART_PROBES if inner else probes
            cand += [lo_key + max(1, width * j // (count + 1)) for j in range(1, count + 1) if max(1, width * j // (count + 1)) < width] + [hi_key]
            edge = (lo_key | ((1 << 64) - 1)) + 1  # a whole group of copies, where that is near enough
            if lo_key < edge < hi_key:
                cand.append(edge)
            cand = [min(c, space - 1) for c in cand]
        if len(chosen) == len(targets):
            break
    for s in targets:
        chosen.setdefault(s, brackets[s][2])
    out, last = [], 0
    for s in sorted(chosen):
        last = max(last, min(chosen[s], space - 1))
        out.append(last)
    return out


def shard(df: DataFrame, shards: int = SHARDS, keep: tuple[str, ...] = (), parts: int = PARTS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and the columns of ``keep``."""
    text = text_or_empty()
    keep = tuple(c for c in keep if c.lower() not in ("doc_id", "size", "text_crc32", "shard", "slot"))
    size, crc, h, d, part, slot, q, base_name, shard_name = (free_name(df, n) for n in ("_size", "_crc", "_h", "_d", "_part", "_slot", "_q", "_base", "_shard"))
    rows = df.select(
        F.col("doc_id"),
        *[F.col(c) for c in keep],
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias(size),
        F.crc32(text.cast("binary")).alias(crc),
        F.xxhash64(text).alias(h),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias(d),
    )
    narrow = cut(rows) if not keep else rows
    keys = narrow.select(h, d, size) if not keep else cut(rows.select(h, d, size))
    bounds = splitters(keys, shards, parts)
    hist = histogram(keys, bounds)
    counts = dict(zip(hist["bin"].astype(int), hist["n"].astype(int)))
    # Splitters that are equal have empty parts between them: a row's part is the last one whose first key it reaches.
    shard_of, base, seen = [], [], 0
    for i in range(shards * parts):
        seen = 0 if i % parts == 0 else seen
        shard_of.append(i // parts)
        base.append(seen)
        seen += counts.get(i, 0)
    ph, pd_ = _split(bounds)

    @F.pandas_udf("int")
    def part_of(h: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series(_bins(h.to_numpy(), d.to_numpy(), ph, pd_).astype("int32"))

    table = df.sparkSession.createDataFrame(
        pd.DataFrame({"q": np.arange(shards * parts, dtype="int32"), "shard": np.array(shard_of, "int32"), "base": np.array(base, "int64")}),
        f"{q} int, {shard_name} int, {base_name} long",
    )
    order = Window.partitionBy(part).orderBy(h, d, crc)
    placed = narrow.withColumn(part, part_of(h, d)).withColumn(slot, F.row_number().over(order) - 1)
    out = placed.join(F.broadcast(table), placed[part] == table[q])  # shards * parts rows
    return out.select(
        "doc_id", *keep, F.col(size).alias("size"), F.col(crc).alias("text_crc32"), F.col(shard_name).alias("shard"), (F.col(base_name) + F.col(slot)).cast("long").alias("slot")
    )


def op4_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
