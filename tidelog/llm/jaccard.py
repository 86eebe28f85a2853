"""Similarity join on n-gram sets by PartEnum signatures.

Two texts are linked when the Jaccard likeness of their sets of K-word shingles is
at least 80 / 100.  Sets in one scheme (a band of sizes and the band below) that
are so alike differ in at most k = 2 * u / 9 features, u being the band's
greatest size.  The feature domain is partitioned by hash, and subsets of parts are enumerated:

* k = 0: the whole set is the one signature;
* small bands: groups of four parts, so many that spare + 1 groups at least
  differ in one part or none; every three of a group's four parts together are
  a signature;
* large bands: k + 1 + spare parts, of which 1 + spare at least are equal;
  every part is a signature (PartEnum with k + 1 first-level parts, where the second level has one part only).

A signature of no feature is left out.  A set that has more of them (or of groups with
one) than ``spare`` is partitioned again by another hash, beside the first, up to ROUNDS times: of two linked
sets, if one is not so empty in some round, a signature with features is equal in that round, and if both are,
they meet in the next.  So linked sets always share a signature, and sets without a common feature share one
only where ROUNDS partitions all fail.

Buckets of signatures with the same members count as one.  Sets that share one
are compared by the 64-bit hashes of all their features: first each with the hub (least member) that it shares most
signatures with; then with its other hubs, where they are in other components;
then, in buckets that still hold more than one component, all pairs of different
components that sizes and 1024-bit parity sketches (a lower bound of the sets'
difference; large sets have longer ones, too) don't rule out.  No pair inside a component is needed any more, so
copies are never paired off.

Defined cases: a null or empty text, or one without words, has an empty set and
is linked with nothing; a text of fewer than K words has its whole sequence as
its one shingle; rows with equal doc_id are one node, with the links of each of their texts; a row with a null doc_id
is in no link and has component null; an empty table gives an empty result; only doc_id and text are read, so
further columns of any name do no harm (``one_of_each`` keeps them).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, documents, free_name, text_or_empty
from .links import IdBits, components, join_hot, meet_at_hubs
from .text import LOWER, WHITE, buffer_of, distinct, doc_of, hash_spans, mix, shingles, slices, spans

K = 5
SMALL_K = 12
SKETCH = 16
#: Sets of more features have a second sketch of 2 to 4 bits a feature.
WIDE_FROM = 512
_VERIFIED = "a long, b long, both long, either long"
OPEN_RUN = 1 << 16
SEEN = 200_000
_SKETCH = [f"s{i}" for i in range(SKETCH)]
_INFO = "doc long, n long, h1 long, h2 long, " + ", ".join(f"{c} long" for c in _SKETCH) + ", wide binary"


def _bands() -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest size of each band: greatest <= 1.25 * least."""
    lo, hi, at = [], [], 1
    while at < 1 << 34:
        lo.append(at)
        hi.append(max(at, at * 5 // 4))
        at = hi[-1] + 1
    return np.array(lo), np.array(hi)


BAND_LO, BAND_HI = _bands()
DIFFER = BAND_HI * 2 // 9
IS_SMALL = DIFFER <= SMALL_K
# Small schemes: groups of four parts; large ones: parts.  The more are expected to be empty, the more are spare.
SPARE = np.where(IS_SMALL, np.where(DIFFER <= 2, 0, 1 + DIFFER // 8), 4 + DIFFER * 18 // 100)
PARTS = np.where(IS_SMALL, DIFFER // 2 + 1 + SPARE, DIFFER + 1 + SPARE)
ROUNDS = 12


def sets_of(buf: np.ndarray, off: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all documents, and each one's first."""
    low = LOWER[buf]
    starts, ends, first = spans(low, off, ~WHITE)
    s, s_first = shingles(hash_spans(low, starts, ends), first, k)
    return distinct(s_first, s)


def digests(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of each set and its parity sketch, as (documents, SKETCH) integers."""
    n = len(first) - 1
    doc = doc_of(first)
    one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    a, b = mix(value ^ np.uint64(0x2545F4914F6CDD1D)), mix(value + np.uint64(0x9E3779B97F4A7C15))
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        one[full] = np.add.reduceat(a, first[full])
        two[full] = np.add.reduceat(b, first[full])
    bits = 64 * SKETCH
    odd = np.bincount(doc * bits + (a % np.uint64(bits)).astype(np.int64), minlength=n * bits) & 1
    sketch = np.packbits(odd.reshape(n, bits).astype(np.uint8), axis=1).view(">i8").astype(np.int64)
    return one.view(np.int64), two.view(np.int64), sketch


def wide_sketches(value: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    """Parity sketches of large sets, with a power of two of bits; None of small ones."""
    size = np.diff(first)
    bits = np.where(size > WIDE_FROM, 1 << np.ceil(np.log2(np.maximum(size, 1) * 2)).astype(np.int64), 0)
    base = np.concatenate([[0], np.cumsum(bits)])
    doc = doc_of(first)
    large = bits[doc] > 0
    d, a = doc[large], mix(value[large] ^ np.uint64(0x2545F4914F6CDD1D))
    odd = np.bincount(base[d] + (a & (bits[d] - 1).astype(np.uint64)).astype(np.int64), minlength=int(base[-1])) & 1
    packed = np.packbits(odd.astype(np.uint8))
    return [packed[x // 8 : y // 8].tobytes() if y > x else None for x, y in zip(base[:-1].tolist(), base[1:].tolist())]


def least_difference(x: bytes, y: bytes) -> int:
    """A lower bound of the difference of two sets from their wide sketches; the longer
    one is folded to the length of the other."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def signatures(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signature, document) of every signature of every set."""
    size = np.diff(first)
    band = np.searchsorted(BAND_LO, size, "right") - 1
    feature = mix(value + np.uint64(0xD1B54A32D192ED03))
    doc_all = doc_of(first)
    out_sig, out_doc = [], []
    whole = np.flatnonzero((size > 0) & (DIFFER[band] == 0))  # the band above has sets of other sizes only, or k > 0
    if len(whole):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(feature)])
        out_sig.append(mix(sums[first[whole + 1]] - sums[first[whole]] + size[whole].astype(np.uint64)))
        out_doc.append(whole)
    for up in (0, 1):
        for small in (True, False):
            scheme = np.minimum(band + up, len(IS_SMALL) - 1)
            docs = np.flatnonzero((size > 0) & (DIFFER[scheme] > 0) & (IS_SMALL[scheme] == small))
            for turn in range(ROUNDS):
                if not len(docs):
                    break
                chosen = np.zeros(len(size), bool)
                chosen[docs] = True
                pick = chosen[doc_all]
                dense = np.zeros(len(size), np.int64)
                dense[docs] = np.arange(len(docs))
                d = dense[doc_all[pick]]
                sch = scheme[docs]
                parts, spare = PARTS[sch].astype(np.int64), SPARE[sch]
                width = parts * (4 if small else 1)
                base = np.concatenate([[0], np.cumsum(width)])
                where = mix(value[pick] ^ np.uint64(0x8CB92BA72F3D8DD7 + turn))
                at = (where >> np.uint64(32)).astype(np.int64) % parts[d]
                if small:
                    at = at * 4 + (where & np.uint64(3)).astype(np.int64)
                at += base[d]
                acc, n = np.zeros(int(base[-1]), np.uint64), np.bincount(at, minlength=int(base[-1]))
                np.add.at(acc, at, feature[pick])
                owner = np.repeat(np.arange(len(docs)), width)
                number = np.arange(len(acc)) - base[owner]
                if small:
                    quad, quad_n = acc.reshape(-1, 4), n.reshape(-1, 4)
                    acc = (quad.sum(axis=1, keepdims=True) - quad).reshape(-1)
                    n = (quad_n.sum(axis=1, keepdims=True) - quad_n).reshape(-1)
                    bad = np.add.reduceat((n.reshape(-1, 4) == 0).any(axis=1).astype(np.int64), base[:-1] // 4)
                else:
                    bad = np.add.reduceat((n == 0).astype(np.int64), base[:-1])
                poor = bad > spare
                keep = (n > 0) | poor[owner] if turn == ROUNDS - 1 else n > 0
                salt = (np.uint64(turn) << np.uint64(56)) + (sch[owner].astype(np.uint64) << np.uint64(40)) + number.astype(np.uint64)
                out_sig.append(mix(acc[keep] + mix(salt[keep] * np.uint64(2) + np.uint64(small))))
                out_doc.append(docs[owner[keep]])
                docs = docs[poor]
    if not out_sig:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out_sig), np.concatenate(out_doc)


def _info(batches):
    for batch in batches:
        ids = batch.column(0)
        buf, off = buffer_of(batch.column(1))
        for lo, hi in slices(off):
            value, first = sets_of(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
            one, two, sketch = digests(value, first)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), pa.array(np.diff(first)), pa.array(one), pa.array(two)] + [pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(SKETCH)] + [pa.array(wide_sketches(value, first), pa.binary())],
                names=["doc", "n", "h1", "h2", *_SKETCH, "wide"],
            )


def _signature_rows(batches):
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        buf, off = buffer_of(batch.column(1))
        seen: set[tuple[int, int]] = set()  # equal sets of a batch are one
        for lo, hi in slices(off):
            value, first = sets_of(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
            one, two, _ = digests(value, first)
            fresh = np.zeros(hi - lo, bool)
            for i, key in enumerate(zip(one.tolist(), two.tolist())):
                if key not in seen:
                    seen.add(key)
                    fresh[i] = True
            count = np.where(fresh, np.diff(first), 0)
            value = value[np.repeat(fresh, np.diff(first))]
            sig, doc = signatures(value, np.concatenate([[0], np.cumsum(count)]))
            for a in range(0, len(sig), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(sig[a : a + 200_000].view(np.int64)), pa.array(ids[lo + doc[a : a + 200_000]])], names=["sig", "doc"])


def _shared_runs(batches):
    """Of a stream sorted by (sig, doc): the members of signatures that several
    documents have, by a hash of the members, and the first of them as hub.  Buckets
    of the same members are one as far as SEEN reaches back; a bucket of more than
    OPEN_RUN members goes on in parts under its own signature."""
    seen: set[int] = set()
    left_sig, left_doc = np.zeros(0, np.int64), np.zeros(0, np.int64)
    open_sig, open_hub, open_doc = None, 0, 0

    def rows(key, doc, hub, size):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (key, doc, hub, size)], names=["sig", "doc", "hub", "size"])

    def closed(sig, doc):
        """Rows of whole runs."""
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (doc[1:] != doc[:-1])
        sig, doc = sig[new], doc[new]
        head = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
        size = np.diff(np.r_[head, len(sig)])
        key = mix(np.add.reduceat(mix(doc.view(np.uint64) ^ np.uint64(0x632BE59BD9B4E019)), head) + size.astype(np.uint64)).view(np.int64)  # mix(0) is 0
        take = size > 1
        for i in np.flatnonzero(take):
            k = int(key[i])
            if k in seen:
                take[i] = False
            else:
                seen.add(k)
        pick = np.repeat(take, size)
        return np.repeat(key, size)[pick], doc[pick], np.repeat(doc[head], size)[pick], np.repeat(size, size)[pick]

    for batch in batches:
        sig = np.concatenate([left_sig, batch.column(0).to_numpy()])
        doc = np.concatenate([left_doc, batch.column(1).to_numpy()])
        if not len(sig):
            continue
        if open_sig is not None:
            n = int(np.searchsorted(sig != open_sig, True)) if sig[0] == open_sig else 0
            n = len(sig) if sig[0] == open_sig and (sig == open_sig).all() else n
            if n:
                fresh = doc[:n][np.r_[doc[0] != open_doc, doc[1:n] != doc[: n - 1]]]
                open_doc = int(doc[n - 1])
                if len(fresh):
                    yield rows(np.full(len(fresh), open_sig), fresh, np.full(len(fresh), open_hub), np.full(len(fresh), OPEN_RUN))
                sig, doc = sig[n:], doc[n:]
            if len(sig):
                open_sig = None
            else:
                left_sig, left_doc = sig, doc
                continue
        last = int(np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])[-1])
        if last:
            yield rows(*closed(sig[:last], doc[:last]))
        left_sig, left_doc = sig[last:], doc[last:]
        if len(left_sig) > OPEN_RUN:
            whole = np.unique(left_doc)
            open_sig, open_hub, open_doc = int(left_sig[0]), int(whole[0]), int(whole[-1])
            if len(whole) > 1:
                yield rows(np.full(len(whole), open_sig), whole, np.full(len(whole), open_hub), np.full(len(whole), OPEN_RUN))
                left_sig, left_doc = left_sig[:0], left_doc[:0]
            else:
                left_sig, left_doc, open_sig = left_sig[:1], left_doc[:1], None
        if len(seen) > SEEN:
            seen.clear()
    if len(left_sig):
        yield rows(*closed(left_sig, left_doc))


def _sets(bits: IdBits):
    def run(batches):
        for batch in batches:
            need = bits.has(batch.column(2).to_numpy())
            if not need.any():
                continue
            part = batch.filter(pa.array(need))
            ids, (buf, off) = part.column(0), buffer_of(part.column(1))
            for lo, hi in slices(off):
                value, first = sets_of(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
                raw = [value[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(raw, pa.binary())], names=["node", "features"])

    return run


def _compare(batches):
    """Intersections and unions of sets with those of their hub, of which rows of one doc_id may have several."""
    hub, held = None, []
    for batch in batches:
        a, b, same, either = [], [], [], []
        names = batch.schema.names
        cols = [batch.column(names.index(c)) for c in ("_hub", "_kind", "_value", "doc", "features")]
        for h, kind, value, doc, features in zip(cols[0].to_pylist(), cols[1].to_pylist(), cols[2], cols[3].to_pylist(), cols[4]):
            if kind == 0:
                held = held if h == hub else []
                hub = h
                held.append(np.frombuffer(value.as_py(), np.uint64))
                continue
            x = np.frombuffer(features.as_py(), np.uint64)
            for one in held if h == hub and len(x) else ():
                if not len(one):
                    continue
                at = np.searchsorted(one, x)
                at[at == len(one)] = len(one) - 1
                n = int((one[at] == x).sum())
                a.append(h)
                b.append(doc)
                same.append(n)
                either.append(len(x) + len(one) - n)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, same, either)], names=["a", "b", "both", "either"])


def equal_sets(full: DataFrame) -> DataFrame:
    """(a, b) of each document b and the least document a with the same set, a < b."""
    keyed = full.select("doc", F.struct("h1", "h2", "n").alias("set"))
    least = keyed.groupBy("set").agg(F.min("doc").alias("a"), F.max("doc").alias("_z")).where("a <> _z").select("set", "a")
    return join_hot(keyed, "set", cut(least)).select("a", F.col("doc").alias("b")).where("a <> b")


class Join:
    """The join's state: documents, their digests, and signatures that several share."""

    def __init__(self, df: DataFrame):
        rows = df.select(F.col("doc_id").cast("long").alias("doc"), text_or_empty().alias("text")).where("doc IS NOT NULL")
        self.rows = rows
        self.info = cut(rows.mapInArrow(_info, _INFO))
        self.equal = cut(equal_sets(self.info.where("n > 0")).distinct())
        found = rows.mapInArrow(_signature_rows, "sig long, doc long")
        runs = found.repartition("sig").sortWithinPartitions("sig", "doc").mapInArrow(_shared_runs, "sig long, doc long, hub long, size long")
        self.shared = cut(runs.groupBy("sig", "doc", "hub", "size").agg(F.count("*").alias("weight")))

    def digests(self, prefix: str, name: str) -> DataFrame:
        """One row a doc_id; without a digest (null) where its rows have different sets."""
        one = F.min("h1") == F.max("h1")
        cols = self.info.groupBy("doc").agg(*[F.when(one, F.min(c)).alias(f"{prefix}_{c}") for c in ("n", *_SKETCH)])
        return cols.withColumnRenamed("doc", name)

    def plausible(self, pairs: DataFrame) -> DataFrame:
        """(a, b) pairs, a < b, without those that sizes or sketches rule out."""
        return join_hot(cut(pairs), "a", self.digests("x", "a")).join(self.digests("y", "b"), "b").where(_may_link(F.col)).select("a", "b")

    def sifted(self, pairs: DataFrame) -> DataFrame:
        """Pairs without those of large sets that the wide sketches rule out."""
        wide = self.info.groupBy("doc").agg(F.when(F.min("h1") == F.max("h1"), F.min(F.struct("n", "wide"))).alias("w"))  # of every document
        x = wide.select(F.col("doc").alias("a"), F.col("w").alias("x"))
        y = wide.select(F.col("doc").alias("b"), F.col("w").alias("y"))

        @F.pandas_udf("long")
        def difference(one: pd.Series, two: pd.Series) -> pd.Series:
            return pd.Series([0 if p is None or q is None else least_difference(p, q) for p, q in zip(one, two)], dtype="int64")

        both = join_hot(pairs, "a", x).join(y, "b")
        far = F.coalesce(difference("x.wide", "y.wide") * 9 > F.col("x.n") + F.col("y.n"), F.lit(False))
        return both.where(~far).select("a", "b")

    def verify(self, pairs: DataFrame) -> DataFrame:
        """(a, b, both, either) of pairs: sizes of the sets' intersection and union."""
        pairs = cut(self.sifted(cut(pairs)))
        if pairs.isEmpty():
            return self.rows.sparkSession.createDataFrame([], _VERIFIED)
        bits = IdBits(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
        content = self.rows.select("doc", "text", F.xxhash64("doc").alias("_x")).mapInArrow(_sets(bits), "node long, features binary")
        rows = pairs.join(content.withColumnRenamed("node", "b"), "b").select("a", F.col("b").alias("doc"), "features")
        return cut(meet_at_hubs(rows, "a", pairs, content, "node", "features", _compare, _VERIFIED))


def _may_link(c):
    """Whether two digests may be linked; true where one is null."""
    odd = sum((F.bit_count(c(f"x_s{i}").bitwiseXOR(c(f"y_s{i}"))) for i in range(1, SKETCH)), F.bit_count(c("x_s0").bitwiseXOR(c("y_s0"))))
    return F.coalesce((c("x_n") * 5 >= c("y_n") * 4) & (c("y_n") * 5 >= c("x_n") * 4) & (odd * 9 <= c("x_n") + c("y_n")), F.lit(True))


def jaccard_links(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(info, links, components): verified (a, b) links, equal sets included, that
    join all linked documents, and (node, component) of all that are linked."""
    j = Join(df)
    star = j.shared.where("doc <> hub").groupBy("doc", "hub").agg(F.sum("weight").alias("weight"))
    star = cut(star.select(F.col("hub").alias("a"), F.col("doc").alias("b"), "weight"))  # the hub is the least
    if star.isEmpty():
        return j.info, j.equal, components(j.equal)
    best = star.groupBy("b").agg(F.max_by("a", F.struct("weight", -F.col("a"))).alias("a")).select("a", "b")
    done = j.verify(j.plausible(best))
    links = cut(j.equal.union(done.where("100 * both >= 80 * either").select("a", "b")))
    comp = components(links)
    others = _apart(star.select("a", "b"), comp).join(done.select("a", "b"), ["a", "b"], "left_anti")
    got = j.verify(j.plausible(others))
    links = cut(links.union(got.where("100 * both >= 80 * either").select("a", "b")))
    done = cut(done.union(got).select("a", "b"))
    comp = components(links)
    rest = cut(_mixed(j.shared.where("size > 2"), comp))  # of two members, one is the hub
    cols = ["n", *_SKETCH]
    rest = cut(rest.join(j.digests("x", "doc"), "doc"))
    x = rest.select("sig", F.col("doc").alias("a"), F.col("comp").alias("x_comp"), *[f"x_{c}" for c in cols])
    y = rest.select(F.col("sig").alias("y_sig"), F.col("doc").alias("b"), F.col("comp").alias("y_comp"), *[F.col(f"x_{c}").alias(f"y_{c}") for c in cols])
    pairs = x.join(y, (F.col("sig") == F.col("y_sig")) & (F.col("a") < F.col("b")) & (F.col("x_comp") != F.col("y_comp")) & _may_link(F.col))
    pairs = pairs.select("a", "b").distinct().join(done, ["a", "b"], "left_anti")
    got = j.verify(pairs)
    more = cut(got.where("100 * both >= 80 * either").select("a", "b"))
    if not more.isEmpty():
        links = links.union(more)
        comp = components(links)
    return j.info, links, comp


def _apart(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """(a, b) pairs of different components."""
    x = comp.select(F.col("node").alias("a"), F.col("component").alias("_x"))
    y = comp.select(F.col("node").alias("b"), F.col("component").alias("_y"))
    both = pairs.join(x, "a", "left").join(y, "b", "left")
    return both.where(F.coalesce("_x", "a") != F.coalesce("_y", "b")).select("a", "b")


def _mixed(shared: DataFrame, comp: DataFrame) -> DataFrame:
    """(sig, doc, comp) of signatures whose documents are in several components."""
    c = comp.withColumnRenamed("node", "_n")
    rows = shared.join(c, shared["doc"] == c["_n"], "left").select("sig", "doc", F.coalesce("component", "doc").alias("comp"))
    several = rows.groupBy("sig").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi")).where("_lo <> _hi").select("sig")
    return rows.join(several, "sig")


def jaccard_components(df: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    info, _, comp = jaccard_links(df)
    known = info.join(comp, info["doc"] == comp["node"], "left").select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id"))
    lost = df.where("doc_id IS NULL").select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(_info, _INFO)
    return known.unionByName(lost.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")))


def one_of_each(df: DataFrame) -> DataFrame:
    """The rows of ``df`` whose doc_id is their component's least one (rows of a null
    doc_id stay), and of rows with equal doc_id the one whose text has the least hash."""
    _, _, comp = jaccard_links(df)
    node, gone_name, row, text, other = (free_name(df, n) for n in ("_node", "_gone", "_row", "_text", "_other"))
    gone = comp.where("node <> component").select(F.col("node").alias(gone_name))
    kept = df.join(gone, df["doc_id"] == gone[gone_name], "left_anti")
    whole = kept.where("doc_id IS NOT NULL").select(
        F.col("doc_id").alias(node), F.struct(*kept.columns).alias(row), F.xxhash64(text_or_empty()).alias(text), F.xxhash64(*kept.columns).alias(other)
    )
    single = whole.groupBy(node).agg(F.min_by(row, F.struct(text, other)).alias(row)).select(*[F.col(row)[c].alias(c) for c in kept.columns])
    return single.unionByName(kept.where("doc_id IS NULL"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))
