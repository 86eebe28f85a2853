"""Quality classifier: random-indexing word vectors pooled per document, a
two-layer numpy network, and probabilities calibrated by a temperature.

*Word vectors.*  Tokens are a word's hash bucket and its shape (runs of letter
cases, digits and signs).  Each token has a fixed sparse random index vector; the
vector of a token is the sum of the index vectors of its neighbours over the
whole corpus.  Hashing bounds the table, so it is summed in a distributed
aggregate and handed to every task.

*Documents.*  Means and deviations of the unit vectors of their tokens, the
lengths of these means, and how often a token follows itself (1 as the likeness of
two index vectors, 0 on average otherwise).

*Network.*  Fitted on at most FIT_ROWS labelled rows (the least by a hash of
doc_id), never on rows held out; a tenth of them chooses the temperature.

The temperature comes from the rows trained on where the tenth has one label only.

Only the text is an input, further columns of any name do no harm.  Defined cases: a null or empty text has zero features
and the network's score for them; labels that are null, or contradict each other
for a doc_id, are not learned from; without both labels the score is the share
of label 1 (0.5 without any); an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import documents, fetched, text_or_empty
from .text import LOWER, WHITE, buffer_of, hash_spans, slices, spans

DIM = 48
WORDS = 4096
SHAPES = 512
NONZERO = 4
REACH = 2
FIT_ROWS = 20_000
FEATURES = 4 * DIM + 4
HIDDEN = 32
EPOCHS = 40
SEED = 7
SLICE = 1 << 20
FOLDS, HELD = 3, 1

#: Byte classes of a shape: lower (and all beyond ASCII), upper, digit; signs are themselves.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = 97
_CLASS[128:] = 97
_CLASS[65:91] = 65
_CLASS[48:58] = 48


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of each token's index vector."""
    rng = np.random.default_rng(SEED)
    n = WORDS + SHAPES
    return rng.integers(0, DIM, (n, NONZERO)), rng.integers(0, 2, (n, NONZERO)) * 2.0 - 1.0


def tokens(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word tokens, shape tokens and each document's first one."""
    starts, ends, first = spans(buf, off, ~WHITE)
    if not len(starts):
        e = np.zeros(0, np.int64)
        return e, e, first
    word = (hash_spans(LOWER[buf], starts, ends) % np.uint64(WORDS)).astype(np.int64)
    kind = _CLASS[buf]
    keep = np.ones(len(kind), bool)
    keep[1:] = kind[1:] != kind[:-1]
    keep[starts] = True
    upto = np.concatenate([[0], np.cumsum(keep)])
    shape = (hash_spans(kind[keep], upto[starts], upto[ends]) % np.uint64(SHAPES)).astype(np.int64) + WORDS
    return word, shape, first


def context_sums(df: DataFrame) -> np.ndarray:
    """The sums of the neighbours' index vectors, one row a token, over all rows."""
    at, sign = index_vectors()
    n = WORDS + SHAPES

    def run(batches):
        total = np.zeros(n * DIM)
        for batch in batches:
            buf, off = buffer_of(batch.column(0))
            for lo, hi in slices(off, SLICE):
                word, shape, first = tokens(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
                doc = np.repeat(np.arange(hi - lo), np.diff(first))
                for step in range(1, REACH + 1):
                    near = doc[step:] == doc[:-step]
                    for t in (word, shape):
                        for a, b in ((t[:-step][near], t[step:][near]), (t[step:][near], t[:-step][near])):
                            for k in range(NONZERO):
                                total += np.bincount(a * DIM + at[b, k], weights=sign[b, k], minlength=n * DIM)
        table = total.astype(np.int64).reshape(n, DIM)
        rows = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(rows.astype(np.int32))] + [pa.array(np.ascontiguousarray(table[rows, i])) for i in range(DIM)], names=["token"] + [f"c{i}" for i in range(DIM)])

    schema = "token int, " + ", ".join(f"c{i} long" for i in range(DIM))
    rows = df.select(text_or_empty().alias("text")).mapInArrow(run, schema)
    got = fetched(rows.groupBy("token").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(DIM)])).to_pandas()  # WORDS + SHAPES rows at most
    out = np.zeros((n, DIM))
    out[got["token"].to_numpy()] = got[[f"c{i}" for i in range(DIM)]].to_numpy()
    return out


def unit_vectors(sums: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(sums, axis=1, keepdims=True)
    return (sums / np.where(size > 0, size, 1)).astype(np.float32)


def features(buf: np.ndarray, off: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Means and deviations of the vectors of a document's words and shapes."""
    word, shape, first = tokens(buf, off)
    n = len(off) - 1
    out = np.zeros((n, FEATURES))
    count = np.diff(first)
    for part, t in enumerate((word, shape)):
        total, square = np.zeros((n, DIM)), np.zeros((n, DIM))
        for a in range(0, len(t), 65536):
            b = min(a + 65536, len(t))
            v = vectors[t[a:b]]
            lo, hi = int(np.searchsorted(first, a, "right")) - 1, int(np.searchsorted(first, b, "left"))
            docs = np.arange(lo, hi)
            docs = docs[count[docs] > 0]
            cut = np.maximum(first[docs], a) - a
            total[docs] += np.add.reduceat(v, cut, axis=0)
            square[docs] += np.add.reduceat(v * v, cut, axis=0)
        mean = total / np.maximum(count, 1)[:, None]
        out[:, part * 2 * DIM : part * 2 * DIM + DIM] = mean
        out[:, 4 * DIM + part] = np.linalg.norm(mean, axis=1)
        same = np.zeros(len(t) + 1)
        same[2:] = np.cumsum(t[1:] == t[:-1])  # a document's first token follows none
        out[:, 4 * DIM + 2 + part] = np.where(count > 1, (same[first[1:]] - same[np.minimum(first[:-1] + 1, len(t))]) / np.maximum(count - 1, 1), 0)
        out[:, part * 2 * DIM + DIM : (part + 1) * 2 * DIM] = np.sqrt(np.maximum(square / np.maximum(count, 1)[:, None] - mean**2, 0))
    return out


class Network:
    """Two layers; ``score`` gives calibrated probabilities of label 1."""

    def __init__(self, prior: float = 0.5):
        self.prior, self.w1 = prior, None
        self.temperature = 1.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Network:
        if len(y):
            self.prior = float(y.mean())
        if len(np.unique(y)) < 2:
            return self
        rng = np.random.default_rng(SEED)
        order = rng.permutation(len(y))
        held, use = order[: len(y) // 10], order[len(y) // 10 :]
        self.mean, self.scale = x[use].mean(0), x[use].std(0) + 1e-3
        z = (x - self.mean) / self.scale
        p = {
            "w1": rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN),
            "w2": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "b2": np.zeros(1),
        }
        m, v, t = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
        epochs = max(EPOCHS, min(400, 200_000 // max(1, len(use))))
        for epoch in range(epochs):
            rate = 3e-3 * (1 - epoch / epochs) + 1e-5
            rng.shuffle(use)
            for a in range(0, len(use), 128):
                k = use[a : a + 128]
                h = np.maximum(0, z[k] @ p["w1"] + p["b1"])
                e = (1 / (1 + np.exp(-np.clip(h @ p["w2"] + p["b2"], -40, 40))) - y[k]) / len(k)
                back = np.outer(e, p["w2"]) * (h > 0)
                g = {"w1": z[k].T @ back + 1e-4 * p["w1"], "b1": back.sum(0), "w2": h.T @ e + 1e-4 * p["w2"], "b2": np.array([e.sum()])}
                t += 1
                for name, grad in g.items():
                    m[name] = 0.9 * m[name] + 0.1 * grad
                    v[name] = 0.999 * v[name] + 0.001 * grad**2
                    p[name] -= rate * (m[name] / (1 - 0.9**t)) / (np.sqrt(v[name] / (1 - 0.999**t)) + 1e-8)
        self.w1, self.b1, self.w2, self.b2 = p["w1"], p["b1"], p["w2"], p["b2"]
        check = held if len(np.unique(y[held])) == 2 else use
        s = self.logits(x[check])
        grid = np.exp(np.linspace(np.log(0.5), np.log(8), 60))
        loss = [np.mean(np.logaddexp(0, s / g) - y[check] * s / g) for g in grid]
        self.temperature = float(grid[int(np.argmin(loss))])
        return self

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(0, (x - self.mean) / self.scale @ self.w1 + self.b1)
        return h @ self.w2 + self.b2[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.w1 is None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD


def fit(df: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors of all of ``df`` and the network of a bounded sample of its labelled rows."""
    vectors = unit_vectors(context_sums(df))
    sample = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("_lo"), F.max("quality").alias("_hi"))
        .where("_lo = _hi")
        .select(F.col("doc_id").alias("_id"), F.col("_lo").cast("double").alias("_y"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
    )
    texts = df.select(F.col("doc_id"), F.col("text"))
    got = texts.join(F.broadcast(sample), texts["doc_id"] == sample["_id"])  # ``rows`` rows at most
    got = got.groupBy("_id").agg(F.min(text_or_empty()).alias("text"), F.first("_y").alias("_y"))

    def run(batches):
        for batch in batches:
            buf, off = buffer_of(batch.column(0))
            for lo, hi in slices(off, SLICE):
                x = features(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], vectors)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array([r.astype("<f4").tobytes() for r in x], pa.binary())], names=["_id", "_y", "x"])

    table = fetched(got.select("text", "_id", "_y").mapInArrow(run, "_id long, _y double, x binary")).to_pandas()
    table = table.sort_values("_id")
    x = np.array([np.frombuffer(b, "<f4") for b in table["x"]], dtype=float).reshape(len(table), FEATURES)
    return vectors, Network().fit(x, table["_y"].to_numpy())


def with_score(df: DataFrame, vectors: np.ndarray, network: Network, out: str = "score", text: str = "text") -> DataFrame:
    """``df`` with the probability of label 1 of every row's text."""
    at, names = df.columns.index(text), [*df.columns, out]

    def run(batches):
        for batch in batches:
            buf, off = buffer_of(batch.column(at))
            parts = [network.score(features(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], vectors)) for lo, hi in slices(off, SLICE)]
            score = pa.array(np.concatenate(parts) if parts else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*batch.columns, score], names=names)

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(out, DoubleType())]))


def classify(df: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    vectors, network = fit(df, labels, **options)
    scored = with_score(df.select("doc_id", "text"), vectors, network)
    return scored.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def crc_fold(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % FOLDS


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
