"""Packing token sequences by non-negative least squares.

Every document's ids are cut at multiples of the window; the pieces that are
shorter than the window are packed by their lengths alone.  Combinations of two
to four lengths that fill a window exactly are enumerated, their repeat counts
are solved by non-negative least squares against the histogram of lengths and
rounded down, and what is left is packed greedily, longest first, again on
counts.  Pieces are then dealt to the places of that plan by their rank among
the pieces of their length; ranks come from salted groups, each length's number of salts in
proportion to its pieces, so that a length with a third of all pieces is no single task.

Pairs are all enumerated; triples and fours are thinned evenly to MAX_COLUMNS columns, which only
concerns padding: what they leave is packed greedily.

Ids are those of the library for the JSON file; a test holds the fast encoder, built from that file's vocabulary and
merges, to the library on every entry of the vocabulary.

The driver sees the histogram and the plan, both bounded by the window.

Defined cases: a null text is empty and has the closing id only; an empty table
gives an empty result (only doc_id and text are read, so other columns do no harm); repeated rows are packed as often as they are there; an
id stands in exactly one piece.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import SPECIAL, tokenizer, tokens_of
from .common import cut, documents, fetched, text_or_empty
from .text import give_back

WINDOW = 2048
END_ID = 1
#: Pieces of one length are ranked in groups of about this share of all pieces, between these sizes.
GROUP_SHARE = 4096
GROUP_ROWS = (256, 1_000_000)
MAX_COLUMNS = 24_000
ROUNDS = 400

_encodings: dict[str, object] = {}


def encoder(path: str):
    """text -> ids as uint32.  The vocabulary and merges are those of the JSON file; a
    text that the fast encoder can't take goes to the library of that file."""
    if path not in _encodings:
        import tiktoken

        import public_tokenizers

        ranks, special = tokens_of(path)
        _encodings[path] = tiktoken.Encoding("from_json", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    fast, special = _encodings[path], {SPECIAL}

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special=special)
        except BaseException as e:  # the encoder's panics are no Exception
            if not isinstance(e, ValueError) and type(e).__name__ != "PanicException":
                raise
            return np.array(tokenizer(path).encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


_PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long"


def cut_pieces(df: DataFrame, path: str, window: int = WINDOW, keep_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of each piece of at most a window."""
    names = [x.split()[0] for x in _PIECES.split(", ")] + (["ids"] if keep_ids else [])

    def run(batches):
        encode = encoder(path)
        for batch in batches:
            give_back()
            out: list[list] = [[] for _ in names]
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py()), np.uint32(END_ID)).astype("<u4")
                for at in range(0, len(ids), window):
                    part = ids[at : at + window].tobytes()
                    row = [key, at, len(part) // 4, zlib.crc32(part), len(ids)]
                    for c, v in zip(out, row + ([part] if keep_ids else [])):
                        c.append(v)
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, _PIECES + (", ids binary" if keep_ids else ""))


def combinations(hist: np.ndarray, limit: int = MAX_COLUMNS) -> np.ndarray:
    """Sets of 2 to 4 lengths, of those that occur, whose sum is the window: all
    pairs, and evenly spaced ones of the triples and fours (0: no length)."""
    window = len(hist)
    there = np.flatnonzero(hist)
    has = np.zeros(window + 1, bool)
    has[there] = True
    found = [np.stack([a := there[(there * 2 <= window) & has[window - there]], window - a], axis=1)]
    found[0] = np.pad(found[0], ((0, 0), (0, 2)))
    for fixed in (0, 1):  # the fours take one length twice
        room = limit // 2
        step = max(1, int(np.ceil(np.sqrt(len(there) ** 2 / 6 / room)))) if len(there) else 1
        a = there[:: max(1, step)]
        b = there[:: max(1, step)]
        x, y = np.meshgrid(a, b, indexing="ij")
        x, y = x.ravel(), y.ravel()
        z = window - x - y - (x if fixed else 0)
        ok = (x <= y) & (z >= y) & (z > 0)
        ok[ok] &= has[z[ok]]
        cols = np.stack([x, y, z, x if fixed else np.zeros_like(x)], axis=1)[ok]
        if len(cols) > room:
            cols = cols[np.linspace(0, len(cols) - 1, room).astype(int)]
        found.append(cols)
    return np.concatenate(found).astype(np.int64)


def solve_counts(hist: np.ndarray, cols: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """x >= 0 that brings the lengths used by x combinations nearest to the histogram,
    each length weighed by the inverse root of its count (accelerated projected
    gradients; a column has four entries at most)."""
    if not len(cols):
        return np.zeros(0)
    n = len(hist)
    w = np.zeros(n)
    w[hist > 0] = 1 / np.sqrt(hist[hist > 0])
    w[0] = 0
    goal = hist * w

    def forward(x):
        return np.bincount(cols.ravel(), weights=np.repeat(x, 4), minlength=n)[:n] * w

    def back(r):
        return (r * w)[cols].sum(axis=1)

    v = np.ones(len(cols))
    for _ in range(20):
        v = back(forward(v))
        v /= np.linalg.norm(v) or 1
    step = 1 / (1.05 * np.linalg.norm(back(forward(v))) or 1)
    x = y = np.zeros(len(cols))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * back(forward(y) - goal))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def plan(hist: np.ndarray) -> list[tuple[list[tuple[int, int]], int]]:
    """[(lengths with their multiplicities, repeats)] that use up the histogram of
    lengths below the window (hist[length], length 0 unused)."""
    window = len(hist)
    left = hist.astype(np.int64).copy()
    out: list[tuple[list[tuple[int, int]], int]] = []

    def take(lengths: dict[int, int], times: int) -> None:
        times = min([times, *(int(left[k]) // m for k, m in lengths.items())])
        if times > 0:
            for k, m in lengths.items():
                left[k] -= m * times
            out.append((sorted(lengths.items(), reverse=True), times))

    cols = combinations(hist)
    x = np.floor(solve_counts(hist.astype(float), cols) + 1e-6).astype(np.int64)
    for i in np.argsort(-x, kind="stable"):
        if x[i] <= 0:
            break
        u, m = np.unique(cols[i][cols[i] > 0], return_counts=True)
        take(dict(zip(u.tolist(), m.tolist())), int(x[i]))
    while left.any():
        room, lengths = window, {}
        while True:
            fit = np.flatnonzero(left[: room + 1] > 0) if room < window else np.flatnonzero(left)
            fit = fit[::-1]
            k = next((int(f) for f in fit if left[f] > lengths.get(int(f), 0)), 0)
            if not k:
                break
            most = min(room // k, int(left[k]) - lengths.get(k, 0))
            pair = room - k  # an exact partner beats more of the same length
            if most > 1 and 0 < pair < window and pair != k and left[pair] > lengths.get(pair, 0):
                most = 1
            lengths[k] = lengths.get(k, 0) + most
            room -= k * most
            if room <= 0:
                break
        take(lengths, 1 << 60)
    return out


def assign(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """``pieces`` (doc_id, start, length and more) with sequence_id and offset."""
    spark = pieces.sparkSession
    found = fetched(pieces.groupBy("length").agg(F.count("*").alias("n")))  # at most a row a length
    by_length = dict(zip(found["length"].to_pylist(), found["n"].to_pylist()))
    group = min(max(GROUP_ROWS[0], sum(by_length.values()) // GROUP_SHARE), GROUP_ROWS[1])
    salts = F.array(*[F.lit(1 + by_length.get(k, 0) // group) for k in range(window + 1)])
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "start"), F.element_at(salts, F.col("length") + 1)).cast("int"))
    counts = cut(salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")))
    hist = np.zeros(window, np.int64)
    for k, n in by_length.items():
        if k < window:
            hist[k] = n
    rows, used, sequence = [], dict.fromkeys(by_length, 0), 0
    for lengths, times in [*([([(window, 1)], by_length[window])] if by_length.get(window) else []), *plan(hist)]:
        offset = 0
        for k, m in lengths:
            rows.append((k, used[k], used[k] + m * times, m, sequence, offset))
            used[k] += m * times
            offset += k * m
        sequence += times
    places = spark.createDataFrame(
        pd.DataFrame(rows, columns=["_l", "_from", "_to", "_m", "_seq", "_off"]).astype({"_l": "int32"}), "_l int, _from long, _to long, _m long, _seq long, _off long"
    )
    base = counts.withColumn(
        "_base", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    ).select(F.col("length").alias("_bl"), F.col("_salt").alias("_bs"), "_base")
    rank = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "start")) - 1
    ranked = salted.withColumn("_rank", rank)
    ranked = ranked.join(base, (ranked["length"] == base["_bl"]) & (ranked["_salt"] == base["_bs"])).withColumn("_rank", F.col("_rank") + F.col("_base"))
    # The plan has at most some ten thousand places, whatever the input is.
    placed = ranked.join(F.broadcast(places), (ranked["length"] == places["_l"]) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    inner = F.col("_rank") - F.col("_from")
    return placed.select(
        *pieces.columns,
        (F.col("_seq") + F.floor(inner / F.col("_m"))).cast("long").alias("sequence_id"),
        (F.col("_off") + F.pmod(inner, F.col("_m")) * F.col("length")).cast("long").alias("offset"),
    )


def pack(df: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces = cut(cut_pieces(df, path, window))
    return assign(pieces, window).withColumn("length", F.col("length").cast("long"))


def op8_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
