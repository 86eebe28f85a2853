"""Operators over a whole corpus: quality, sharding, passages, mixing, similarity join, pipeline."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tidelog.llm import common, jaccard, licenses, links, media, mixing, order_minhash, packing, quality, sharding, substring, tokens
from tidelog.llm.entries import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"

WHITE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
BODY = "doc_id long, text string, lang string, source string, n_chars long"


def split(text):
    return WHITE.findall((text or "").translate(LOWER))


def shingle_set(text, k=5):
    w = split(text)
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def components_by_hand(texts):
    """texts: id -> list of texts of that id."""
    sets = {k: [s for s in map(shingle_set, v) if s] for k, v in texts.items()}
    index = defaultdict(set)
    for k, many in sets.items():
        for s in many:
            for x in s:
                index[x].add(k)
    parent = {k: k for k in texts}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for k, many in sets.items():
        for other in {o for s in many for x in s for o in index[x] if o > k}:
            if any(100 * len(a & b) >= 80 * len(a | b) for a in many for b in sets[other]):
                a, b = find(k), find(other)
                parent[max(a, b)] = min(a, b)
    return {k: find(k) for k in texts}


def by_id(df):
    out = defaultdict(list)
    for r in df.where("doc_id IS NOT NULL").select("doc_id", "text").collect():
        out[r[0]].append(r[1])
    return out


def test_jaccard(spark, odd, empty):
    want = components_by_hand(by_id(odd))
    got = jaccard.jaccard_components(odd).collect()
    assert len(got) == odd.count()
    for r in got:
        assert r["component_id"] == (None if r["doc_id"] is None else want[r["doc_id"]])
    assert want[8] == 6 and want[1000] == 6 and want[10] == 6 and want[9] == 9
    assert jaccard.jaccard_components(empty).count() == 0
    kept = [r[0] for r in jaccard.one_of_each(odd).select("doc_id").collect()]
    assert sorted(x for x in kept if x is not None) == sorted(k for k, v in want.items() if k == v) and kept.count(None) == 2


def test_jaccard_small_sets_and_chains(spark):
    """Sets of few shingles, likenesses at the very limit, and long chains of links."""
    rng, rows = random.Random(5), []
    for size in (5, 6, 7, 9, 10, 12, 20, 24, 25, 40, 60, 130):
        for _ in range(3):
            w = [f"t{rng.randrange(10**6)}" for _ in range(size + 4)]
            rows.append(" ".join(w))
            for cut in (1, 2, 3, 5):
                rows.append(" ".join(w[:-cut] if size > cut else w))
                rows.append(" ".join(w[: size // 2] + [f"new{rng.randrange(10**6)}"] + w[size // 2 + 1 :]))
    chain = [f"c{i}" for i in range(400)]
    rows += [" ".join(chain[i * 6 : i * 6 + 120]) for i in range(40)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string").repartition(5)
    want = components_by_hand({i: [t] for i, t in enumerate(rows)})
    assert {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(df).collect()} == want
    assert len({want[len(rows) - 40 + i] for i in range(40)}) == 1


def test_signatures_are_shared():
    """Whatever differs, as far as the limit allows, some signature is equal."""
    rng = np.random.default_rng(6)
    for n in (1, 4, 5, 6, 8, 11, 20, 45, 60, 120, 400, 1500):
        for _ in range(12):
            most = int(n * 2 / 9) if n > 4 else 0
            drop = int(rng.integers(0, most + 1))
            add = int(rng.integers(0, most - drop + 1))
            a = np.unique(rng.integers(0, 1 << 63, n + add, dtype=np.int64).astype(np.uint64))
            x, y = np.sort(a[: n]), np.sort(a[drop:])
            both = len(np.intersect1d(x, y))
            if 100 * both < 80 * (len(x) + len(y) - both):
                continue
            sig, doc = jaccard.signatures(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
            assert set(sig[doc == 0].tolist()) & set(sig[doc == 1].tolist()), (n, drop, add)
            one, _, sketch = jaccard.digests(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
            odd_bits = sum(bin((int(v) ^ int(w)) & ((1 << 64) - 1)).count("1") for v, w in zip(sketch[0], sketch[1]))
            assert odd_bits <= len(x) + len(y) - 2 * both
            wide = jaccard.wide_sketches(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
            if wide[0] and wide[1]:
                assert jaccard.least_difference(*wide) <= len(x) + len(y) - 2 * both


def test_small_unrelated_sets_share_no_bucket():
    """4,000 random sets of each size: no signature is common to many, and none is of no feature."""
    rng = np.random.default_rng(36)
    for n in range(1, 29):
        value = rng.integers(0, 1 << 63, 4000 * n, dtype=np.int64).astype(np.uint64)
        value = np.sort(value.reshape(4000, n), axis=1).reshape(-1)
        sig, doc = jaccard.signatures(value, np.arange(4001) * n)
        pairs = np.unique(np.stack([sig, doc.astype(np.uint64)], axis=1), axis=0)
        assert np.unique(pairs[:, 0], return_counts=True)[1].max() <= 5, n
        assert len(np.unique(doc)) == 4000


def test_rows_of_one_doc_id_with_different_texts(spark):
    """Each text keeps its links; one row a doc_id stays, always the same."""
    rng = random.Random(37)
    a, b, c = (" ".join(some_words(rng, 60)) for _ in range(3))
    rows = [(1, a, "x"), (2, a + " more", "y"), (2, b, "z"), (3, b + " more", "x"), (4, c, "x"), (4, c + " w " * 60, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = {(r["doc_id"], r["component_id"]) for r in jaccard.jaccard_components(df).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4)}
    kept = [sorted(map(tuple, jaccard.one_of_each(df.repartition(n)).collect())) for n in (1, 4)]
    assert kept[0] == kept[1] and [r[0] for r in kept[0]] == [1, 4]


def test_shared_runs_over_batches():
    import pyarrow as pa

    rng = random.Random(7)
    rows = sorted({(rng.randrange(300), rng.randrange(40)) for _ in range(1500)} | {(500, i) for i in range(50)})
    members = defaultdict(list)
    for s, d in rows:
        members[s].append(d)
    want = {tuple(v) for v in members.values() if len(v) > 1}
    rows += [rows[7]]
    rows.sort()
    for size in (1, 3, 64, 10_000):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[a : a + size]], pa.int64()) for i in (0, 1)], names=["sig", "doc"]) for a in range(0, len(rows), size)]
        for limit in (jaccard.OPEN_RUN, 8):
            before, jaccard.OPEN_RUN = jaccard.OPEN_RUN, limit
            try:
                got = defaultdict(set)
                for b in jaccard._shared_runs(iter(batches)):
                    for s, d, h, _ in zip(*[c.to_pylist() for c in b.columns]):
                        got[s].add(d)
                        assert h <= d
                assert {tuple(sorted(v)) for v in got.values()} == want
            finally:
                jaccard.OPEN_RUN = before


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(200, 260)] + [(rng.randrange(100), rng.randrange(100)) for _ in range(60)] + [(5, 5)]
    parent = {x: x for e in edges for x in e}
    for _ in range(300):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    got = {r[0]: r[1] for r in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in parent.items() if any(k in e and e[0] != e[1] for e in edges)}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracles(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    got = QUERIES[name](spark, SMALL)
    names = ", ".join(got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(con.sql(f"SELECT {names} FROM ({ORACLE_SQL[name]})").fetchall())


def fill_by_hand(sizes, weights):
    """Clamp at the caps and share the excess by weight, again and again."""
    order = sorted((k for k in sizes if k is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {k: weights[i % len(weights)] for i, k in enumerate(order)}
    total, target, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        share = {k: (total - sum(target.values())) * w[k] / sum(w[x] for x in open_) for k in open_}
        over = {k for k in open_ if share[k] > 2 * sizes[k] + 1e-9}
        if not over:
            target.update(share)
            break
        target.update({k: 2.0 * sizes[k] for k in over})
        open_ -= over
    return target


@pytest.mark.parametrize("small", [True, False])
def test_mixing(spark, odd, empty, small):
    docs = odd if small else spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs.select("doc_id", "text", "source").collect()
    sizes, source_of = Counter(), {}
    for r in rows:
        sizes[r["source"]] += len(WHITE.findall(r["text"] or ""))
        source_of[r["doc_id"]] = r["source"]
    target = fill_by_hand(sizes, mixing.WEIGHTS)
    got = mixing.mix_sources(docs, keep=("source",)).collect()
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == sizes[r["source"]] and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= 2
    again = mixing.mix_sources(docs, keep=("source",)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert mixing.mix_sources(empty).count() == 0
    if not small:
        mixed = mixing.mixed_documents(docs)
        assert mixed.columns == docs.columns
        words = mixed.select("source", mixing.word_count(F.col("text")).alias("n")).groupBy("source").agg(F.sum("n")).collect()
        assert {r[0]: r[1] for r in words} == dict(taken)
        one = QUERIES["op9_mix_sources"](spark, SMALL)
        assert one.columns == ["doc_id", "size", "source_size", "target", "taken"] and one.count() == 200


def test_first_words():
    import pyarrow as pa

    assert mixing.first_words(pa.array(["  a bb\tc ", None, "é ü"]), np.array([2, 1, 5])) == ["  a bb", "", "é ü"]


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_sharding(spark, odd, empty, shards):
    got = sharding.shard(odd, shards).collect()
    assert len(got) == odd.count()
    check_shards(got, shards, 250_000)
    assert sharding.shard(empty, shards).count() == 0


def check_shards(rows, shards, largest):
    slots, size = defaultdict(list), Counter()
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["size"]
    assert set(slots) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    mean = sum(size.values()) / shards
    assert all(abs(size[s] - mean) <= largest + 0.002 * mean for s in range(shards))


def test_sharding_skew(spark):
    """A third of all rows are copies of one text: it is split, other groups are whole."""
    rows = [(i, "the same text again " * 5 if i % 3 == 0 else f"text {i} " * (i % 17 + 1)) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sharding.shard(df, 40).collect()
    check_shards(got, 40, 200)
    where = defaultdict(set)
    for r in got:
        where[r["text_crc32"]].add(r["shard"])
    assert sorted(map(len, where.values()))[-1] > 10 and sum(len(v) > 1 for v in where.values()) < 5
    whole = QUERIES["op4_shard_documents"](spark, SMALL)
    assert {r[0] for r in whole.select("law").distinct().collect()} == {"bytes"} and whole.where("grown_shard IS NOT NULL").count() == 0


def test_shards_by_hand(spark):
    """Sizes, checksums, order and splitters of the whole query against the rows themselves."""
    docs = {r[0]: (r[1] or "").encode() for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    rows = {r["doc_id"]: r for r in QUERIES["op4_shard_documents"](spark, SMALL).collect()}
    assert set(rows) == set(docs)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    order = sorted(docs, key=lambda d: (signed(xxhash.xxh64(docs[d], seed=42).intdigest()), d))
    assert all(rows[d]["size"] == len(docs[d]) + 16 and rows[d]["text_crc32"] == zlib.crc32(docs[d]) for d in docs)
    places = [(rows[d]["shard"], rows[d]["slot"]) for d in order]
    assert places == sorted(places)
    total, below = sum(r["size"] for r in rows.values()), 0
    edge = {}
    for d in order:
        edge.setdefault(rows[d]["shard"], below)
        below += rows[d]["size"]
    sizes = np.cumsum([0] + [rows[d]["size"] for d in order])
    for s, at in edge.items():
        nearest = np.abs(sizes - total * s / 40).min()
        assert abs(at - total * s / 40) <= nearest + sharding.TOLERANCE * total / 40 + 1e-6


def test_quality_features_by_hand(spark):
    """Context sums over a small corpus, and a document's features, word by word."""
    texts = ["The cat sat. The cat ran 12 miles", "a A a", None, "x", "the CAT sat on 7 mats , the cat"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    sums = quality.context_sums(df)
    at, sign = quality.index_vectors()
    want = np.zeros_like(sums)
    lists = []
    for t in texts:
        buf = np.frombuffer((t or "").encode(), np.uint8)
        word, shape, _ = quality.tokens(buf, np.array([0, len(buf)]))
        assert len(word) == len(shape) == len((t or "").split())
        lists.append((word, shape))
        for seq in (word, shape):
            for i in range(len(seq)):
                for j in range(max(0, i - quality.REACH), min(len(seq), i + quality.REACH + 1)):
                    if i != j:
                        for k in range(quality.NONZERO):
                            want[seq[i], at[seq[j], k]] += sign[seq[j], k]
    assert (sums == want).all()
    vectors = quality.unit_vectors(sums)
    assert np.allclose(np.linalg.norm(vectors, axis=1)[np.abs(sums).sum(1) > 0], 1, atol=1e-6)
    raw = [(t or "").encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    got = quality.features(np.frombuffer(b"".join(raw), np.uint8), off, vectors)
    for i, pair in enumerate(lists):
        for part, seq in enumerate(pair):
            v = vectors[seq].astype(float) if len(seq) else np.zeros((1, quality.DIM))
            mean, dev = v.mean(0), v.std(0)
            base = part * 2 * quality.DIM
            assert np.allclose(got[i, base : base + quality.DIM], mean, atol=1e-5) and np.allclose(got[i, base + quality.DIM : base + 2 * quality.DIM], dev, atol=1e-3)
            assert got[i, 4 * quality.DIM + part] == pytest.approx(np.linalg.norm(mean), abs=1e-5)
            same = sum(a == b for a, b in zip(seq, seq[1:])) / (len(seq) - 1) if len(seq) > 1 else 0
            assert got[i, 4 * quality.DIM + 2 + part] == pytest.approx(same)


def test_quality(spark, odd, empty):
    sf = "/root/testdata/sf0.01"
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect()}
    right = total = 0
    for r in QUERIES["op3_quality_classifier"](spark, sf).collect():
        assert r["held_out"] == (quality.crc_fold(r["doc_id"]) == 1) and r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1
        if r["held_out"] and r["doc_id"] in labels:
            total += 1
            right += r["predicted"] == labels[r["doc_id"]]
    assert total > 50 and right / total > 0.95
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r[0] for r in quality.classify(odd, none).select("score").collect()} == {0.5}
    mixed = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (6, None, 0), (7, 1, 0), (None, 1, 1)], none.schema)
    assert quality.classify(odd, mixed).count() == odd.count()
    assert quality.classify(empty, mixed).count() == 0


def test_network_learns_and_is_calibrated():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, quality.FEATURES))
    y = (rng.random(3000) < 1 / (1 + np.exp(-3 * x[:, 0]))).astype(float)
    s = quality.Network().fit(x[:2000], y[:2000]).score(x[2000:])
    assert ((s >= 0.5) == y[2000:]).mean() > 0.75
    high = s > 0.9
    assert abs(y[2000:][high].mean() - s[high].mean()) < 0.12


def covered(passages):
    out = defaultdict(set)
    for r in passages:
        out[r["doc_id"]].update(range(r["start"], r["end"]))
    return out


def repeated_runs(texts, n=50):
    """(doc, start) of runs of n words that an earlier document has."""
    first, out = {}, []
    for k in sorted(texts):
        w = split(texts[k])
        runs = [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
        out += [(k, i) for i, r in enumerate(runs) if first.get(r, k) != k]
        for r in runs:
            first.setdefault(r, k)
    return out


def test_passages(spark, odd, empty):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for df in (docs, odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])):
        texts = {r[0]: r[1] for r in df.select("doc_id", "text").collect()}
        rows = substring.shared_passages(df).collect()
        cover = covered(rows)
        for doc, at in repeated_runs(texts):
            assert set(range(at, at + 50)) <= cover[doc]
        for r in rows:
            a, b = split(texts[r["doc_id"]])[r["start"] : r["end"]], split(texts[r["source_doc_id"]])[r["source_start"] : r["source_end"]]
            assert r["doc_id"] > r["source_doc_id"] and len(a) >= 50 and r["equal_words"] >= 0.8 * max(len(a), len(b))
            assert sum((Counter(a) & Counter(b)).values()) >= r["equal_words"]
    assert substring.shared_passages(empty).count() == 0
    assert QUERIES["op7_shared_passages"](spark, SMALL).count() > 0


def test_fuzzy_passages(spark):
    """Passages with changed, lost and new words are found, and clean texts are not."""
    rng = random.Random(10)

    def some(n):
        return [f"r{rng.randrange(10**6)}" for _ in range(n)]

    passage, rows, where = some(120), [], {}
    for i in range(60):
        a = some(rng.randrange(30, 200))
        if i % 2:
            p = list(passage)
            for _ in range(i % 8):
                at = rng.randrange(5, len(p) - 5)
                p[at : at + 1] = rng.choice([[], ["new"], ["new", p[at]]])
            where[i] = (len(a), len(a) + len(p))
            a += p
        rows.append((i, " ".join(a + some(rng.randrange(20, 100))), "en", "s", 1))
    df = spark.createDataFrame(rows, BODY).repartition(6)
    cover = covered(substring.shared_passages(df).collect())
    for i, (a, b) in where.items():
        hit = len(cover[i] & set(range(a, b))) / (b - a)
        assert hit > 0.9 if i > 1 else not cover[i]
        assert len(cover[i] - set(range(a, b))) <= 4
    assert not any(cover[i] for i in range(0, 60, 2))
    less = {r["doc_id"]: r["text"] for r in substring.remove_passages(df).collect()}
    assert len(less) == 60 and all(less[i] == rows[i][1] for i in range(0, 60, 2))
    assert sum(" ".join(passage[50:60]) in t or len(set(passage) & set(t.split())) > 60 for t in less.values()) == 1


def test_short_fuzzy_passages(spark):
    """Passages of 55 to 80 words with every 8th or 10th word changed are nearly all found."""
    rng, rows, where = random.Random(23), [], {}
    some = lambda n: [f"f{rng.randrange(10**7)}" for _ in range(n)]
    for i in range(120):
        n, step = (55, 60, 80)[i % 3], (8, 10)[i % 2]
        p = some(n)
        q = ["c" + w if k % step == step - 1 else w for k, w in enumerate(p)]
        for j, w in enumerate((p, q)):
            rows.append((2 * i + j, " ".join(some(40) + w + some(40)), "en", "s", 1))
        where[2 * i + 1] = set(range(40, 40 + n))
    cover = covered(substring.shared_passages(spark.createDataFrame(rows, BODY).repartition(4)).collect())
    assert sum(len(cover[d] & w) >= 0.9 * len(w) for d, w in where.items()) >= 0.95 * len(where)


def test_passages_that_repeat_words(spark):
    """Passages of one word, or of one line of up to 16 words, over and over."""
    rng = random.Random(21)
    some = lambda n, tag: [f"{tag}{rng.randrange(10**6)}" for _ in range(n)]
    rows, want = [], {}
    for i, period in enumerate((1, 2, 7, 16)):
        line = some(period, f"p{i}x")
        for j, times in enumerate((80, 80, 200)):
            body = (line * times)[:times]
            before = some(30, "b")
            rows.append((10 * i + j, " ".join(before + body + some(30, "a")), "en", "s", 1))
            if j:
                want[10 * i + j] = set(range(30, 30 + times))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    cover = covered(substring.shared_passages(df).collect())
    assert set(cover) == set(want)
    for d, w in want.items():
        assert w <= cover[d] and len(cover[d] - w) <= 6, d


def test_passages_whose_lines_stand_elsewhere(spark):
    """Passages of lines of which each stands alone in an earlier document too, and an equal
    run between stretches that are alike, but too little."""
    rng = random.Random(22)
    some = lambda n: [f"l{rng.randrange(10**6)}" for _ in range(n)]
    rows, want = [], {}
    shapes = [(2, 30), (3, 20), (3, 40), (4, 25), (10, 5)] * 8
    for i, (lines, length) in enumerate(shapes):
        passage = [some(length) for _ in range(lines)]
        for j, line in enumerate(passage):
            rows.append((100 * i + j, some(40) + line + some(40)))
        for j in (50, 51):
            rows.append((100 * i + j, some(40) + sum(passage, []) + some(40)))
        want[100 * i + 51] = set(range(40, 40 + lines * length))
    a = some(260)
    b = [w if 100 <= n < 150 or n % 12 < 7 else f"c{n}" for n, w in enumerate(a)]
    rows += [(10_000, a), (10_001, b)]
    want[10_001] = set(range(100, 150))
    df = spark.createDataFrame([(d, " ".join(w), "en", "s", 1) for d, w in rows], BODY).repartition(5)
    cover = covered(substring.shared_passages(df).collect())
    assert all(w <= cover[d] for d, w in want.items())


def test_fewest_spans():
    rng = random.Random(35)
    for _ in range(300):
        spans_ = [(a, a + rng.randrange(1, 12), i) for i in range(rng.randrange(1, 25)) for a in [rng.randrange(60)]]
        got = substring.fewest(spans_)
        assert {x for a, b, _ in got for x in range(a, b)} == {x for a, b, _ in spans_ for x in range(a, b)}
        assert set(got) <= set(spans_) and all(sum(a <= x < b for a, b, _ in got) <= 2 for x in range(80))


def some_words(rng, n, tag="q"):
    return [f"{tag}{rng.randrange(10**7)}" for _ in range(n)]


@pytest.mark.parametrize("batch", ["50", "5000"])
def test_passages_do_not_depend_on_layout(spark, batch, monkeypatch):
    """The same rows whatever the partitions, their order, and the batches."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 400")
    monkeypatch.setitem(common.ACTION_SETTINGS, "spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    found = []
    for df in (docs.coalesce(1), docs.repartition(8), docs.orderBy(F.rand(3)).repartition(3)):
        found.append(sorted(map(tuple, substring.shared_passages(df).collect())))
    assert found[0] == found[1] == found[2] and len(found[0]) > 20
    monkeypatch.setitem(common.ACTION_SETTINGS, "spark.sql.execution.arrow.maxRecordsPerBatch", "300")
    assert sorted(map(tuple, substring.shared_passages(docs).collect())) == found[0]


def test_passages_are_merged(spark):
    """A passage whose pieces of 40 words ten other documents own is one row for its pair."""
    rng = random.Random(31)
    body = some_words(rng, 400)
    rows = [(i, some_words(rng, 30) + body[40 * i : 40 * i + 40] + some_words(rng, 30)) for i in range(10)]
    rows += [(10, some_words(rng, 50) + body + some_words(rng, 50)), (11, some_words(rng, 50) + body + some_words(rng, 50))]
    df = spark.createDataFrame([(d, " ".join(w), "en", "s", 1) for d, w in rows], BODY).repartition(4)
    found = [r for r in substring.shared_passages(df).collect() if r["doc_id"] == 11]
    assert [(r["start"], r["end"], r["source_doc_id"]) for r in found] == [(50, 450, 10)]


def test_passages_that_go_on_beyond_their_seeds(spark):
    """1,500 common words of which other documents own all seeds but those of 60 words."""
    rng = random.Random(32)
    body = some_words(rng, 1500)
    rows = [(0, body[:700] + ["cut"]), (1, ["cut"] + body[760:])]
    rows += [(2, some_words(rng, 20) + body + some_words(rng, 20)), (3, some_words(rng, 40) + body + some_words(rng, 40))]
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    found = [r for r in substring.shared_passages(df).collect() if r["doc_id"] == 3]
    assert (40, 1540, 2) in [(r["start"], r["end"], r["source_doc_id"]) for r in found]


def test_runs_before_words_that_are_less_alike(spark):
    """Fifty equal words are found although what follows them, three equal words in four, is extended over."""
    run, tail = [f"r{i}" for i in range(50)], [f"t{i}" for i in range(400)]
    other = [f"x{i}" if i % 4 == 2 else w for i, w in enumerate(tail)]
    rows = spark.createDataFrame([(1, " ".join(run + tail)), (2, " ".join(run + other))], "doc_id long, text string")
    got = [tuple(r) for r in substring.shared_passages(rows).select("doc_id", "start", "end", "source_doc_id", "source_start", "equal_words").collect()]
    assert any(d == 2 and a == 0 and b >= 50 and s == 1 and c == 0 and e >= 50 for d, a, b, s, c, e in got)


def test_passages_whose_seeds_have_other_sources(spark):
    """60 words with two changed, piece by piece in nine earlier documents: the one that has the passage is the least of no seed."""
    words = [f"w{i}" for i in range(60)]
    changed = words[:20] + ["x20"] + words[21:40] + ["x40"] + words[41:]
    rows = [(i, " ".join([f"a{i}_{j}" for j in range(40)] + words[7 * i : 7 * i + 14] + [f"b{i}_{j}" for j in range(40)])) for i in range(9)]
    rows += [(20, " ".join([f"c{j}" for j in range(30)] + words + [f"d{j}" for j in range(30)])), (30, " ".join([f"e{j}" for j in range(25)] + changed + [f"f{j}" for j in range(30)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in substring.shared_passages(docs).select("doc_id", "start", "end", "source_doc_id", "source_start", "source_end", "equal_words").collect()]
    assert got == [(30, 25, 85, 20, 30, 90, 58)]
    left = {r.doc_id: r.text for r in substring.remove_passages(docs).collect()}
    assert left[30] == " ".join([f"e{j}" for j in range(25)] + [f"f{j}" for j in range(30)])


def test_partners_of_a_frequent_line(spark):
    """A line in very many documents makes partners only of those that have more in common near it."""
    line = [f"l{i}" for i in range(12)]
    rng = random.Random(5)
    body = [f"w{i}" for i in range(48)]
    rows = [(i, " ".join([f"a{i}_{j}" for j in range(60)] + line + [f"b{i}_{j}" for j in range(60)])) for i in range(300)]
    other = [w if i % 5 else f"x{i}" for i, w in enumerate(body)]  # no seed but the line's
    rows += [(400, " ".join([f"c{j}" for j in range(60)] + line + body)), (500, " ".join([f"d{j}" for j in range(70)] + line + other))]
    rng.shuffle(rows)
    got = [tuple(r) for r in substring.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "source_doc_id", "start", "source_start").collect()]
    assert got == [(500, 400, 70, 60)]


def test_partners_of_a_line_that_documents_repeat():
    """A line that documents have twice, other words between, makes no partners; the pair with a passage at it is one."""
    rng = np.random.default_rng(7)
    line, body = (rng.integers(0, 1 << 32, size).astype(np.uint32) for size in (12, 48))
    other = lambda size: rng.integers(0, 1 << 32, size).astype(np.uint32)
    changed = np.where(np.arange(48) % 5 == 0, other(48), body)
    texts = [np.concatenate([other(60), line, other(20 + i % 30), line, other(120)]) for i in range(60)]
    texts += [np.concatenate([other(60), line, body, other(60)]), np.concatenate([other(90), line, changed, other(60)])]
    places = [np.flatnonzero(t == line[4]) - 4 for t in texts]
    doc = np.repeat(np.arange(len(texts)), [len(p) for p in places])
    first, pos = np.concatenate([[0], np.cumsum([len(t) for t in texts])]), np.concatenate(places)
    near = substring._near(np.concatenate(texts), first[doc], first[doc + 1], first[doc] + pos)
    one = np.full(len(doc), 5, np.uint64)
    rows = [substring._placed(one, doc, doc * 0, pos, is_open, near) for is_open in (True, False)]
    table = pa.Table.from_batches(rows).sort_by([("doc", "ascending"), ("pos", "ascending"), ("open", "descending")]).combine_chunks()
    got = [pair for batch in substring._partners(table.to_batches()) for pair in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
    assert got == [(61, 60)]


def test_passages_of_rows_with_one_doc_id(spark):
    """Different texts of one doc_id are searched and cut each for itself; repeated rows are one."""
    rng = random.Random(33)
    passage, own, other = some_words(rng, 80), some_words(rng, 100), some_words(rng, 200)
    texts = [(1, some_words(rng, 60) + passage), (2, own + passage), (2, other), (2, own + passage)]
    df = spark.createDataFrame([(d, " ".join(w), i, "x", "x") for i, (d, w) in enumerate(texts)], "doc_id long, text string, _d int, _spans string, _key string")
    found = substring.shared_passages(df).collect()
    assert [(r["doc_id"], r["start"], r["end"], r["source_doc_id"]) for r in found] == [(2, 100, 180, 1)]
    less = {r["_d"]: r["text"].split() for r in substring.remove_passages(df).collect()}
    assert less == {0: texts[0][1], 1: own, 2: other, 3: own}


def fuzzy_by_hand(texts):
    """(doc, words) that stand in an earlier document: longest runs by extension from every common run of 5
    words along its diagonal, matches 1 and others -2 as far as the sum falls by 10."""
    at = defaultdict(list)
    for d in sorted(texts):
        for i in range(len(texts[d]) - 4):
            at[tuple(texts[d][i : i + 5])].append((d, i))
    out, seen = defaultdict(set), set()
    for places in at.values():
        for x, (a, i) in enumerate(places):
            for b, j in places[x + 1 :]:
                if a == b or (a, b, i - j, i) in seen:
                    continue
                ends = []
                for way in (1, -1):
                    best = total = 0
                    n, far = 0, 0
                    p, q = (i + 5, j + 5) if way == 1 else (i - 1, j - 1)
                    while 0 <= p < len(texts[a]) and 0 <= q < len(texts[b]):
                        total += 1 if texts[a][p] == texts[b][q] else -2
                        n += 1
                        if total > best:
                            best, far = total, n
                        if best - total > 10:
                            break
                        p, q = p + way, q + way
                    ends.append(far)
                on, back = ends
                seen |= {(a, b, i - j, k) for k in range(i - back, i + 5 + on)}
                lo, hi = j - back, j + 5 + on
                equal = sum(texts[b][k] == texts[a][k + i - j] for k in range(lo, hi))
                if hi - lo >= 50 and equal >= 0.8 * (hi - lo):
                    out[b] |= set(range(lo, hi))
    return out


def test_fuzzy_passages_against_brute_force(spark):
    """Passages of 50 to 150 words with 0 to 20% of words changed at random: recall of words and of passages."""
    rng = random.Random(34)
    texts = {}
    for i in range(150):
        p = some_words(rng, rng.randrange(52, 150))
        rate = rng.random() * 0.2
        q = [w if rng.random() > rate else "c" + w for w in p]
        texts[2 * i] = some_words(rng, 40) + p + some_words(rng, 40)
        texts[2 * i + 1] = some_words(rng, 40) + q + some_words(rng, 40)
    want = fuzzy_by_hand(texts)
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in texts.items()], "doc_id long, text string").repartition(4)
    got = covered(substring.shared_passages(df).collect())
    assert len(want) > 100
    assert sum(len(got[d] & w) >= 0.9 * len(w) for d, w in want.items()) >= 0.9 * len(want)
    assert sum(len(w - want[d]) for d, w in got.items()) < 0.05 * sum(map(len, got.values()))


def test_chains_and_alignment():
    pos = np.array([0, 10, 20, 30, 31, 500])
    apos = np.array([100, 110, 120, 130, 5, 600])
    assert substring.chains(pos, apos)[0] == [0, 1, 2, 3]
    rng = random.Random(11)
    for _ in range(200):
        x, y = [rng.randrange(4) for _ in range(rng.randrange(12))], [rng.randrange(4) for _ in range(rng.randrange(12))]
        table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, a in enumerate(x):
            for j, b in enumerate(y):
                table[i + 1][j + 1] = table[i][j] + 1 if a == b else max(table[i][j + 1], table[i + 1][j])
        assert substring.lcs(np.array(x), np.array(y)) == table[-1][-1]
    best = {}
    for _ in range(50):
        n = rng.randrange(2, 9)
        p, q = np.sort(rng.sample(range(60), n)), np.array(rng.sample(range(60), n))
        for i in range(n):
            best[i] = max([5.0] + [5 + best[j] - 0.05 * ((p[i] - p[j]) + (q[i] - q[j])) for j in range(i) if p[j] < p[i] and q[j] < q[i]])
        found = substring.chains(p, q)
        top = max(best[i] for i in range(n))
        if top > 5:
            path = found[0]
            got = 5.0 * len(path) - sum(0.05 * ((p[b] - p[a]) + (q[b] - q[a])) for a, b in zip(path, path[1:]))
            assert got == pytest.approx(top)


def _values(df, columns):
    return Counter(str([repr(r[c]) for c in columns]) for r in df.collect())


@pytest.mark.parametrize("name", ["licenses", "tokens", "quality", "shard", "shard_keep", "media", "minhash", "passages", "pack", "mix", "jaccard"])
def test_names_of_further_columns(spark, odd, clashing, name):
    """Operators give the same results whatever further columns are named."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    run = {
        "licenses": licenses.license_scan, "tokens": lambda d: tokens.count_tokens(d, path), "quality": lambda d: quality.classify(d, labels),
        "shard": lambda d: sharding.shard(d, 3), "shard_keep": lambda d: sharding.shard(d, 3, keep=tuple(c for c in d.columns if c != "doc_id")),
        "media": media.text_media, "minhash": order_minhash.order_minhash, "passages": substring.shared_passages,
        "pack": lambda d: packing.pack(d, path), "mix": lambda d: mixing.mix_sources(d, keep=tuple(d.columns)), "jaccard": jaccard.jaccard_components,
    }[name]
    plain = odd.where("doc_id IS NOT NULL AND doc_id NOT IN (3, 6)")
    more = clashing.where("doc_id IS NOT NULL AND doc_id NOT IN (3, 6)")
    a, b = run(plain), run(more)
    assert _values(a, a.columns) == _values(b, a.columns)


@pytest.mark.parametrize("stage", range(5))
def test_pipeline_stages_on_odd_tables(spark, odd, empty, clashing, stage, tmp_path_factory):
    """Stages keep columns of any name, and take nulls, repeated rows and empty tables."""
    import corpus_pipeline as pipe

    folder = str(tmp_path_factory.mktemp("stage"))
    spark.createDataFrame([(i, int(i not in (1, 4)), 0) for i in range(20)], "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    run = pipe.STAGES[stage][1]
    a, b = run(spark, odd, folder), run(spark, clashing, folder)
    if stage < 4:
        assert a.columns == odd.columns and b.columns == clashing.columns
    assert _values(a.drop("sequence_id", "offset"), [c for c in a.columns if c not in ("sequence_id", "offset")]) == _values(b, [c for c in a.columns if c not in ("sequence_id", "offset")])
    assert run(spark, empty, folder).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as pipe

    assert [n for n, _ in pipe.STAGES] == ["quality classifier", "n-gram Jaccard join", "substring dedup", "mixing sources to target weights", "packing"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality").collect()}
    kept = [docs]
    for _, stage in pipe.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], SMALL).cache())
        assert kept[-1].columns == docs.columns
    ids = [{r[0] for r in d.select("doc_id").collect()} for d in kept]
    assert all(k in ids[1] for k, q in labels.items() if q == 1) and not any(k in ids[1] for k, q in labels.items() if q == 0 and quality.crc_fold(k) != 1)
    want = components_by_hand(by_id(kept[1]))
    assert ids[2] == {k for k, v in want.items() if k == v}
    texts = {r[0]: r[1] for r in kept[3].select("doc_id", "text").collect()}
    assert len(repeated_runs(texts, 60)) == 0 and ids[3] <= ids[2]
    before = {r[0]: r[1] for r in kept[2].select("doc_id", "text").collect()}
    assert sum(before[k] == t for k, t in texts.items()) > 0.7 * len(texts)
    out = pipe.STAGES[-1][1](spark, kept[4], SMALL)
    assert out.where("start = 0").count() == kept[4].count()
    assert pipe.run(spark, SMALL).count() > 0
