"""Order MinHash fingerprints of whole texts, by DataFrame functions only.

Units are what single white space bytes part; a part of more than LONG bytes counts as its characters, so
equal stretches have equal units whatever surrounds them.  Every run of K units is a k-mer; the n-th
occurrence of the same k-mer is another element than its first.  Elements stand on a circle by their
hash, and each of SAMPLES evenly spaced points selects the TUPLE elements that follow it: in long texts the least ones
of a hash range, in short ones as many, from the ranges that follow.  They are put back into
the order of the text and hashed together.  A swap of passages keeps the elements but
changes tuples, so likeness follows edit distance more than a set's likeness: a text and itself
with its halves swapped are about 0.5 alike, at any length.

A fingerprint is the list of (sample, 16-bit tuple hash); likeness is the share of equal entries.

Per row the work is a few passes and two sorts over packed 64-bit integers (hash in the upper 32
bits, place in the lower 31, as many as an array can have).

Defined cases: null and empty texts have the empty fingerprint, and two empty
ones have likeness 1, an empty and a full one 0; a text of fewer than K units
has one k-mer, the whole, and an entry of one element only; equal texts have equal fingerprints; the next document
of equal ids is found by the text's hash; rows of a null doc_id are the last; an empty table gives an empty result;
``order_minhash`` reads doc_id and text only, and ``with_fingerprint`` keeps columns of any other name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import computed_once, documents, free_name, text_or_empty

K = 3
TUPLE = 2
SAMPLES = 64
LONG = 64
PLACE_BITS = 31
HASH_BITS = 32
DOCS_PER_GROUP = 256
#: Groups of documents that follow each other are at most so many, each of about equally many rows.
MOST_GROUPS = 1 << 14
FAN = 128


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = K) -> DataFrame:
    """Adds ``out``: the fingerprint of a column of texts without nulls, as array<int>."""
    u, s, r, f, e, p, c = (free_name(df, n) for n in ("_u", "_s", "_r", "_f", "_e", "_p", "_c"))
    t = F.col(text)
    none = F.array().cast("array<string>")
    units = F.when(F.octet_length(t) == 0, none).otherwise(F.split(F.translate(t, "\n\t\r\v\f", "     "), " "))
    cut_up = F.flatten(F.transform(u, lambda w: F.when(F.octet_length(w) > LONG, F.split(w, "")).otherwise(F.array(w))))
    low = (1 << PLACE_BITS) - 1
    mask = ((1 << HASH_BITS) - 1) << PLACE_BITS

    def kmer(x: Column, i: Column) -> Column:
        return F.xxhash64(x, *[F.get(F.col(u), i + j) for j in range(1, k)]).bitwiseAND(F.lit(mask)).bitwiseOR(i.cast("long"))

    def hashed(x: Column) -> Column:
        return F.shiftright(x, PLACE_BITS)

    def same(x: Column, other: Column) -> Column:
        return F.coalesce(hashed(x) == hashed(other), F.lit(False))

    def sample(x: Column) -> Column:
        return F.shiftright(x, PLACE_BITS + HASH_BITS - 6)

    n = F.greatest(F.size(u) - (k - 1), F.least(F.size(u), F.lit(1)))
    step1 = df.withColumn(u, units).withColumn(u, F.when(F.exists(u, lambda w: F.octet_length(w) > LONG), cut_up).otherwise(F.col(u)))
    step2 = step1.withColumn(s, F.sort_array(F.transform(F.slice(u, 1, n), kmer)))
    step3 = step2.withColumn(r, F.filter(s, lambda x, i: same(x, F.get(F.col(s), i - 1))))
    # Occurrence numbers of repeated k-mers: their place in the run of equal hashes.
    first = F.filter(F.sequence(F.lit(0), F.size(r) - 1), lambda i: ~same(F.get(F.col(r), i), F.get(F.col(r), i - 1)))
    step4 = step3.withColumn(f, F.when(F.size(r) > 0, first).otherwise(F.array().cast("array<int>")))

    def numbered(at: Column, j: Column) -> Column:
        upto = F.coalesce(F.get(F.col(f), j + 1), F.size(r))
        return F.transform(
            F.slice(r, at + 1, upto - at),
            lambda x, occ: F.xxhash64(hashed(x), occ + 1).bitwiseAND(F.lit(mask)).bitwiseOR(x.bitwiseAND(F.lit(low))),
        )

    renamed = F.flatten(F.transform(f, numbered))
    only = F.filter(s, lambda x, i: ~same(x, F.get(F.col(s), i - 1)))
    step5 = step4.withColumn(e, F.when(F.size(r) > 0, F.sort_array(F.concat(only, renamed))).otherwise(F.col(s)))
    # The first TUPLE of each range: each range's first one is followed by the next on the circle.
    step6 = step5.withColumn(p, F.filter(e, lambda x, i: F.coalesce(sample(x) != sample(F.get(F.col(e), i - TUPLE)), F.lit(True))))

    def code(x: Column, i: Column) -> Column:
        """For a range's first element: how many samples it is the first for, and its tuple's hash."""
        before = F.get(F.col(p), i - 1)
        after = F.coalesce(F.get(F.col(p), i + 1), F.get(F.col(p), F.lit(0)))
        ahead = x.bitwiseAND(F.lit(low)) <= after.bitwiseAND(F.lit(low))
        tuple_hash = F.when(F.size(p) == 1, F.xxhash64(hashed(x))).when(ahead, F.xxhash64(hashed(x), hashed(after))).otherwise(F.xxhash64(hashed(after), hashed(x)))
        times = sample(x) - F.coalesce(sample(before), F.lit(-1))
        return F.when(times > 0, times * 65536 + tuple_hash.bitwiseAND(F.lit(65535)))

    step7 = step6.withColumn(c, F.filter(F.transform(p, code), lambda x: x.isNotNull()))

    def entries(x: Column, times: Column) -> Column:
        return F.array_repeat(x.bitwiseAND(F.lit(65535)), times.cast("int"))

    rest = entries(F.get(F.col(c), F.lit(0)), SAMPLES - 1 - sample(F.element_at(F.col(p), -1)))
    whole = F.concat(F.flatten(F.transform(c, lambda x: entries(x, F.shiftright(x, 16)))), rest)
    signature = F.transform(whole, lambda x, j: (j * 65536 + x).cast("int"))
    signature = F.when(F.size(c) > 0, signature).otherwise(F.array().cast("array<int>"))
    return step7.withColumn(out, computed_once(signature)).drop(u, s, r, f, e, p, c)


def fingerprint_text(sig: Column) -> Column:
    """Six hex digits an entry: the sample's two and the hash's four."""
    return F.array_join(F.transform(sig, lambda x: F.lpad(F.lower(F.hex(x)), 6, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / SAMPLES).cast("double")


def group_of(x: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most ``x``: from blocks of FAN down to single ones."""
    levels = [bounds]
    while len(levels[0]) > FAN:
        levels.insert(0, levels[0][FAN - 1 :: FAN])
    at = F.lit(0)
    for i, level in enumerate(levels):
        array = F.expr(f"array({','.join(f'{b}L' for b in level)})") if level else F.array().cast("array<long>")
        near = array if i == 0 else F.slice(array, at * FAN + 1, F.lit(FAN))
        at = at * FAN + F.size(F.filter(near, lambda b: b <= x))
    return at


def with_next(df: DataFrame, carried: list[str]) -> DataFrame:
    """Adds next_<c>: the values of the next document by descending doc_id (after
    the last one: the first).  Documents are grouped by quantiles of doc_id with some
    hundred each, so ids far from the others do no harm; only the last of a group looks
    at another group's first row.
    """
    g, lg, tie, nxt = (free_name(df, n) for n in ("_g", "_lg", "_tie", "_next"))
    rows = df.agg(F.count("doc_id")).first()[0]
    count = min(MOST_GROUPS, rows // DOCS_PER_GROUP)
    bounds: list[int] = []
    if count > 1:
        shares = F.expr(f"array({','.join(f'{i / count:.9f}D' for i in range(1, count))})")
        bounds = sorted(set(df.agg(F.percentile_approx("doc_id", shares, F.lit(max(10_000, 20 * count)))).first()[0]))
    grouped = df.withColumn(g, F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(group_of(F.col("doc_id"), bounds)).cast("int"))
    w = Window.partitionBy(g).orderBy(F.col("doc_id").desc_nulls_last(), F.col(tie))
    # One exchange of the texts: the window, the groups' first rows and the join below all read it.
    placed = grouped.withColumn(tie, F.xxhash64(*carried)).repartition(g)
    inside = placed.select(*df.columns, g, F.lead(F.struct(*carried)).over(w).alias(nxt))
    # One row a group: its first document's key, and the group that comes next.
    heads = placed.groupBy(g).agg(F.max_by(F.struct(*carried), F.struct("doc_id", F.bitwise_not(tie))).alias("_head"))
    keys = grouped.select(g).distinct()  # MOST_GROUPS + 1 rows at most
    order = keys.select(g, F.lead(g).over(Window.orderBy(F.col(g).desc())).alias("_to"), F.max(g).over(Window.partitionBy()).alias("_top"))
    order = order.select(g, F.coalesce("_to", "_top").alias("_to"))
    links = order.join(heads.withColumnRenamed(g, "_to"), "_to").select(F.col(g).alias(lg), "_head")
    closed = inside.join(links, (inside[g] == links[lg]) & F.col(nxt).isNull(), "left").withColumn(nxt, F.coalesce(nxt, "_head"))
    return closed.select(*df.columns, *[F.col(f"{nxt}.{c}").alias(f"next_{c}") for c in carried])


def order_minhash(df: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    base = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    base = with_fingerprint(base, "text", "sig")
    chain = with_next(base, ["text", "sig"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    chain = chain.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sig", "next_sig")
    both = with_fingerprint(chain, "edited", "edited_sig")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint_text(F.col("sig")).alias("fingerprint"),
        fingerprint_text(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash(documents(spark, sf_dir))
