"""Operators on single rows against brute force: licences, tokens, media, fingerprints."""

from __future__ import annotations

import hashlib
import io
import random
import re
import zlib
import re._parser as sre

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidelog.llm import licenses, media, order_minhash, packing, tokens
from tidelog.llm.bpe import vocabulary
from tidelog.llm.license_clauses import TEXTS
from tidelog.llm.license_rules import CLAUSES, GATES, RULES
from tidelog.llm.text import buffer_of
from tidelog.llm.entries import QUERIES

SMALL = "/root/testdata/sf0.001"

PATH = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def scan_by_hand(text):
    w = WORD.findall((text or "").translate(LOWER))
    places, base = [], set()
    for phrase, label in licenses.BASE.items():
        q = phrase.split()
        at = [i for i in range(len(w)) if w[i : i + len(q)] == q]
        places += at
        base |= {label} if at else set()
    form, found = " " + " ".join(w) + " ", []
    for r in RULES:
        for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", form) if r.keyword in form else ():
            first = form[: m.start()].count(" ") - 1
            found.append((first, -(first + m.group().count(" ") + 1), r.tier, r.id, r.label, r.confidence))
    found.sort()
    kept = [x for i, x in enumerate(found) if not any(y[1] <= x[1] and y[2] <= x[2] for y in found[:i])]
    labels = base | {x[4] for x in kept}
    score = max([x[5] for x in kept] + [licenses.BASE_SCORE if base else 0.0])
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, len(kept))


def test_licenses_by_hand(spark, odd, empty, clashing):
    got = licenses.license_scan(odd).selectExpr("text", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "size(detections) AS n")
    for r in got.collect():
        assert tuple(r)[1:] == scan_by_hand(r["text"]), r["text"]
    assert licenses.license_scan(empty).count() == 0
    assert licenses.license_scan(clashing).where("labels LIKE '%apache-2.0%'").count() == 1
    whole = QUERIES["op1_license_scan"](spark, SMALL)
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    for r in whole.collect():
        assert tuple(r)[1:] == scan_by_hand(texts[r["doc_id"]])


def test_license_rules_are_gated():
    """Random matches of every pattern hold its keyword and a gate."""
    rng = random.Random(1)

    def some(parsed):
        out = ""
        for op, arg in parsed:
            kind = str(op)
            if kind == "LITERAL":
                out += chr(arg)
            elif kind == "SUBPATTERN":
                out += some(arg[3])
            elif kind == "BRANCH":
                out += some(rng.choice(arg[1]))
            elif kind in ("MAX_REPEAT", "MIN_REPEAT"):
                out += "".join(some(arg[2]) for _ in range(rng.randint(arg[0], min(int(arg[1]), arg[0] + 2))))
            elif kind == "IN":
                k, v = rng.choice(arg)
                out += chr(v) if str(k) == "LITERAL" else chr(rng.randint(*v))
            else:
                out += "x"
        return out

    assert len(RULES) > 600 and len({c[3] for c in [*CLAUSES, *TEXTS]}) > 300
    for r in RULES:
        for _ in range(25):
            text = f" {some(sre.parse(r.pattern))} "
            assert r.keyword in text and any(g in text for g in GATES), (r, text)


def test_token_counts(spark, odd, empty):
    t = Tokenizer.from_file(PATH)
    want = {}
    rows = odd.select("doc_id", "text").collect()
    for r in rows:
        want.setdefault(r["doc_id"], set()).add((len((r["text"] or "").encode()), len(t.encode(r["text"] or "", add_special_tokens=False).ids)))
    for r in tokens.count_tokens(odd, PATH).collect():
        assert (r["n_bytes"], r["n_tokens"]) in want[r["doc_id"]] and r["over_limit"] == (r["n_tokens"] > 1024)
    assert tokens.count_tokens(empty, PATH).count() == 0
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    ids = t.encode_batch([r["text"] for r in docs], add_special_tokens=False)
    assert {r["doc_id"]: r["n_tokens"] for r in QUERIES["op2_count_tokens"](spark, SMALL).collect()} == {r["doc_id"]: len(e.ids) for r, e in zip(docs, ids)}


def test_counts_at_every_prefix():
    t, rng = Tokenizer.from_file(PATH), random.Random(2)
    counter = tokens.PrefixCounter(vocabulary(PATH))
    texts = ["a  b", "  x ", "it's 're we'll  don't\n\n\tfoo  bar", "é<|endoftext|>ñ  z<|endoftext|>", "日本語　テキスト", "a \n b", "'ll", "x'llama 12 345...!!'re", "", " ", "end  ", "<|endoftext|", "tab\tq\t\tr  \n"]
    texts += ["".join(rng.choice(a) for _ in range(rng.randint(1, 24))) for a in ("ab '\nlrev<|>", "aé 1!　\t x") for _ in range(60)]
    for text in texts:
        buf, off = buffer_of(pa.array([text]))
        total, fit, tables = counter.slice(buf, off, True, 3)
        table, at, best = np.frombuffer(tables[0], "<i4"), 0, 0
        for i, c in enumerate(text):
            at += len(c.encode())
            n = len(t.encode(text[: i + 1], add_special_tokens=False).ids)
            assert table[at - 1] == n, (text, i)
            best = at if n <= 3 else best
        assert fit[0] == best and (not text or total[0] == table[-1])


def test_every_token_is_its_own_encoding():
    v = vocabulary(PATH)
    assert all(v.encode(t) == [i] for t, i in list(v.tokens.items())[::37])


def test_fast_ids_are_the_library_s():
    """The packing encoder gives the library's ids for every entry of the vocabulary, alone, in pairs and in runs."""
    t, fast, rng = Tokenizer.from_file(PATH), packing.encoder(PATH), random.Random(40)
    words = [t.decode([i], skip_special_tokens=False) for i in range(t.get_vocab_size())]
    texts = words + [rng.choice(words) + rng.choice(words) for _ in range(30_000)] + ["".join(rng.choices(words, k=40)) for _ in range(3000)]
    for text, ids in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
        assert fast(text).tolist() == ids.ids, text


def hash_by_hand(payload, rows=8, cols=9):
    """Means of the areas under an 8 by 9 grid, cell by cell, and whether each is darker than the next."""
    h, w = len(payload) // 64, 64
    out = ""
    grid = [[0.0] * cols for _ in range(rows)]
    for i in range(rows):
        for j in range(cols):
            total = area = 0.0
            for y in range(int(i * h / rows), min(h, -(-(i + 1) * h // rows))):
                dy = min(y + 1, (i + 1) * h / rows) - max(y, i * h / rows)
                for x in range(int(j * w / cols), min(w, -(-(j + 1) * w // cols))):
                    part = dy * (min(x + 1, (j + 1) * w / cols) - max(x, j * w / cols))
                    total, area = total + part * payload[y * 64 + x], area + part
            grid[i][j] = total / area
    for row in grid:
        out += "".join("1" if a < b - 1e-9 else "0" for a, b in zip(row, row[1:]))
    return f"{int(out, 2):016x}"


def test_media_features_by_hand(spark):
    docs = {r[0]: r[1] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    for r in QUERIES["op5_media_columns"](spark, SMALL).where("n_bytes < 4000").collect():
        assert r["feature"] == hash_by_hand(media.payload_of((docs[r["doc_id"]] or "").encode())), r["doc_id"]


def test_media(spark, odd, empty):
    for r in media.text_media(odd, keep_media=True).join(odd.select("doc_id", "text"), "doc_id").where("doc_id NOT IN (3, 6)").collect():
        text = (r["text"] or "").encode()
        payload = text + bytes(-len(text) % 64 if text else 64)
        back = media.decode(bytes(r["media"]))
        assert back.tobytes() == payload and r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["tail_crc32"] == zlib.crc32(payload[-64:])
        assert (r["n_bytes"], r["payload_bytes"], r["media_bytes"], r["media_sha256"]) == (len(text), len(payload), len(r["media"]), hashlib.sha256(r["media"]).hexdigest())
        assert np.load(io.BytesIO(r["tile"])).shape == (16, 16) and len(r["feature"]) == 16
    assert media.text_media(empty).count() == 0
    assert QUERIES["op5_media_columns"](spark, SMALL).count() == 200


def test_codecs_and_resizing():
    rng = np.random.default_rng(1)
    for shape in ((1, 1), (5, 7), (16, 3), (4, 6, 3)):
        a = rng.integers(0, 256, shape, dtype=np.uint8)
        assert (media.decode_netpbm(media.encode_netpbm(a)) == a).all() and (media.decode_bmp(media.encode_bmp(a)) == a).all()
        rows, cols = 3, 2
        fine = np.kron(a.astype(float), np.ones((rows, cols) if a.ndim == 2 else (rows, cols, 1)))
        h, w = a.shape[:2]
        want = fine.reshape(rows, h, cols, w, *a.shape[2:]).mean(axis=(1, 3))
        assert np.allclose(media.resize_area(a, rows, cols), want)
    assert media.decode_netpbm(b"P2 # note\n2 1\n15\n0 15\n").tolist() == [[0, 255]]
    assert media.decode_netpbm(b"P1\n3 1\n1 0 1\n").tolist() == [[0, 255, 0]] and media.decode_netpbm(b"P4\n3 1\n\xa0").tolist() == [[0, 255, 0]]
    assert media.decode_netpbm(b"P3\n1 1\n255\n1 2 3\n").tolist() == [[[1, 2, 3]]]
    for bad in (b"P5\n2 2\n255\n\0", b"P7\n", b"BM", b"P2\n2 2\n70000\n1"):
        with pytest.raises(ValueError):
            media.decode(bad)


def _hash(*parts):
    seed = 42
    for p in parts:
        if p is not None:
            seed = xxhash.xxh64(p.encode() if isinstance(p, str) else (p % (1 << 64)).to_bytes(8, "little"), seed=seed).intdigest()
    return seed


def fingerprint_by_hand(text):
    o = order_minhash
    flat = re.sub("[\n\t\r\v\f]", " ", text)
    units = [x for w in flat.split(" ") for x in (w if len(w.encode()) > o.LONG else [w])] if text else []
    n = max(len(units) - o.K + 1, min(len(units), 1))
    mask = ((1 << o.HASH_BITS) - 1) << o.PLACE_BITS
    seen, items = {}, []
    for i in range(n):
        h = (_hash(*units[i : i + o.K]) & mask) >> o.PLACE_BITS
        k = seen[h] = seen.get(h, -1) + 1
        if k:
            h = (xxhash.xxh64(k.to_bytes(4, "little"), seed=xxhash.xxh64(h.to_bytes(8, "little"), seed=42).intdigest()).intdigest() & mask) >> o.PLACE_BITS
        items.append((h, i))
    items.sort()
    out = []
    for j in range(o.SAMPLES) if items else ():
        at = next((x for x, (h, _) in enumerate(items) if h >> (o.HASH_BITS - 6) >= j), 0)
        pick = [items[at]] + [items[(at + 1) % n]] * (n > 1)
        out.append(j << 16 | _hash(*[h for h, _ in sorted(pick, key=lambda x: x[1])]) & 65535)
    return out


def test_order_counts_at_all_lengths(spark):
    """Texts with their halves swapped are about half alike; equal stretches of texts with and without spaces are found."""
    rng, rows = random.Random(12), []
    for n in (30, 60, 100, 200, 1000):
        for i in range(60):
            w = [f"w{rng.randrange(10**6)}" for _ in range(n)]
            rows.append((n, " ".join(w), " ".join(w[n // 2 :] + w[: n // 2])))
    df = spark.createDataFrame(rows, "n int, a string, b string")
    both = order_minhash.with_fingerprint(order_minhash.with_fingerprint(df, "a", "x"), "b", "y")
    for n, near in both.groupBy("n").agg(F.avg(order_minhash.likeness(F.col("x"), F.col("y")))).collect():
        assert 0.3 < near <= 0.55, (n, near)
    solid = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(900))
    spaced = " ".join(f"v{i}" for i in range(40))
    pair = spark.createDataFrame([(solid, solid + " " + spaced)], "a string, b string")
    got = order_minhash.with_fingerprint(order_minhash.with_fingerprint(pair, "a", "x"), "b", "y")
    assert got.select(order_minhash.likeness(F.col("x"), F.col("y"))).first()[0] > 0.7


def test_next_document_with_outliers(spark):
    """Ids far from the others leave groups of equal size; the order goes round."""
    ids = [*range(3000), 10**15, -(10**15)]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string").repartition(5)
    got = {r[0]: r[1] for r in order_minhash.with_next(df, ["text"]).select("doc_id", "next_text").collect()}
    down = sorted(ids, reverse=True)
    assert got == {a: f"t{b}" for a, b in zip(down, down[1:] + down[:1])}
    bounds = [10, 20, 20 + 1, *range(30, 2000, 7)]
    at = spark.range(-5, 2100, 3).select("id", order_minhash.group_of(F.col("id"), bounds).alias("g")).collect()
    assert all(g == sum(b <= i for b in bounds) for i, g in at)


def test_order_minhash(spark, odd, empty):
    rows = [r for r in odd.where("doc_id NOT IN (3, 6)").select("doc_id", "text").distinct().collect()]
    got = {r["doc_id"]: r for r in order_minhash.order_minhash(odd.where("doc_id NOT IN (3, 6)")).collect()}
    order = sorted(rows, key=lambda r: -r["doc_id"])
    texts = [r["text"] or "" for r in order]
    for i, r in enumerate(order):
        text, nxt = texts[i], texts[(i + 1) % len(texts)]
        edited = text[: len(text) - len(text) // 2] + nxt[: len(text) // 2]
        g = got[r["doc_id"]]
        assert (g["n_chars"], g["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = fingerprint_by_hand(text), fingerprint_by_hand(edited), fingerprint_by_hand(nxt)
        assert g["fingerprint"] == "".join(f"{x:06x}" for x in a) and g["edited_fingerprint"] == "".join(f"{x:06x}" for x in b)
        for near, other in ((g["near_edited"], b), (g["near_next"], c)):
            assert near == pytest.approx(len(set(a) & set(other)) / order_minhash.SAMPLES if a or other else 1.0)
    assert order_minhash.order_minhash(empty).count() == 0
    full = order_minhash.order_minhash(odd)
    assert full.count() == odd.count() and full.where("near_edited NOT BETWEEN 0 AND 1").count() == 0
    whole = QUERIES["op6_order_minhash"](spark, SMALL)
    means = whole.selectExpr("avg(near_edited)", "avg(near_next)", "count(*)").first()
    assert means[0] > 0.08 > means[1] and means[2] == 200


def check_packing(pieces, texts):
    t = Tokenizer.from_file(PATH)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    assert set(by_doc) == set(texts)
    for key, text in texts.items():
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(by_doc[key], key=lambda p: p["start"]):
            part = ids[p["start"] : p["start"] + p["length"]]
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(part.tobytes()) and p["doc_tokens"] == len(ids)
            at += p["length"]
        assert at == len(ids)
    used = [sum(n for _, n in parts) for parts in by_sequence.values()]
    return sum(packing.WINDOW - u for u in used) / (packing.WINDOW * len(used))


def test_packing(spark, odd, empty):
    single = odd.where("doc_id NOT IN (3, 6)")
    check_packing(packing.pack(single, PATH).collect(), {r["doc_id"]: r["text"] for r in single.collect()})
    repeated = packing.pack(odd.where("doc_id IN (3, 6)"), PATH)
    assert repeated.where("start = 0").count() == 4
    assert packing.pack(empty, PATH).count() == 0
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    pad = check_packing(QUERIES["op8_pack_documents"](spark, SMALL).collect(), {r["doc_id"]: r["text"] for r in docs.collect()})
    assert pad < 0.05


def test_plan_uses_up_the_histogram():
    rng = np.random.default_rng(4)
    for n in (1, 5, 300, 20_000):
        lengths = np.minimum(1 + rng.exponential(500, n).astype(int), packing.WINDOW - 1)
        hist = np.bincount(lengths, minlength=packing.WINDOW)
        used, sequences = np.zeros(packing.WINDOW, int), 0
        for parts, times in packing.plan(hist):
            assert sum(k * m for k, m in parts) <= packing.WINDOW
            sequences += times
            for k, m in parts:
                used[k] += m * times
        assert (used == hist).all()
        if n == 20_000:
            assert lengths.sum() / (sequences * packing.WINDOW) > 0.99
    short = np.zeros(packing.WINDOW, int)
    short[7] = 1_000_000
    assert sum(times for _, times in packing.plan(short)) == -(-1_000_000 // (packing.WINDOW // 7))
