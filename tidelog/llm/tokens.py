"""Token counts of whole texts, with exact counts at every prefix.

Defined cases: a null text is an empty one, with no tokens; special strings in a
text are the special token, as by the library's default; runs of white space
and special strings are handled by the tokenizer's own pattern over the whole
text; an empty table gives an empty result; equal rows give equal results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import PieceCache, Vocabulary, pieces, plain_docs, pretokens, put_ragged, vocabulary
from .common import documents, text_or_empty
from .text import buffer_of, slices

LIMIT = 1024


class PrefixCounter:
    """Counts at every byte of pieces and of whole texts."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.cache = PieceCache()

    def tables(self, items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Counts at every byte of each piece, from the tables of its pretokens."""
        lists = [pretokens(t.decode("utf-8")) for t in items]
        return self._joined([[None if p is None else p.encode("utf-8") for p in x] for x in lists], [len(t) for t in items])

    def _joined(self, lists, lengths):
        known = {p: i for i, p in enumerate(dict.fromkeys(p for x in lists for p in x if p is not None))}
        counts, off = self.vocab.prefix_counts(list(known))
        flat = [(-1 if p is None else known[p]) for x in lists for p in x]
        rows = np.array(flat, np.int64)
        n_each = np.fromiter(map(len, lists), np.int64, len(lists))
        out_off = np.concatenate([[0], np.cumsum(np.array(lengths, np.int64))]) if lengths else np.zeros(1, np.int64)
        out = np.zeros(int(out_off[-1]), np.int32)
        if not len(rows):
            return out, out_off
        special = rows < 0
        size = np.where(special, 13, np.diff(off)[np.maximum(rows, 0)]) if len(known) else np.full(len(rows), 13)
        start = np.cumsum(size) - size
        ok = ~special
        if len(known):
            put_ragged(out, start[ok], counts, off[:-1][rows[ok]], size[ok])
        if special.any():  # an unfinished special string is ordinary text
            ends = np.cumsum(size)[special] - 1
            out[ends] = 1
            for e in ends:
                for k in range(1, 13):
                    out[e - 13 + k] = len_plain(self.vocab, "<|endoftext|>"[:k])
        total = out[start + size - 1].astype(np.int64)
        before = np.cumsum(total) - total
        head = np.cumsum(n_each) - n_each
        full = n_each > 0
        base = np.zeros(len(lists), np.int64)
        base[full] = before[head[full]]
        add = before - np.repeat(base, n_each)
        out += np.repeat(add, size).astype(np.int32)
        return out, out_off

    def slice(self, buf: np.ndarray, off: np.ndarray, table: bool, limit: int):
        """Per document: tokens, the longest prefix within the limit (bytes, at a
        character's end), and the counts at every byte where ``table``."""
        n = len(off) - 1
        total, fit = np.zeros(n, np.int64), np.zeros(n, np.int64)
        counts: list[bytes | None] = [b"" if table else None] * n
        plain = plain_docs(buf, off)
        starts, ends, first = pieces(buf, off, plain)
        row, t_off, val = self.cache.get(buf, starts, ends, self.tables) if len(starts) else (np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int32))
        each = val[t_off[row + 1] - 1].astype(np.int64) if len(row) else np.zeros(0, np.int64)
        cum = np.concatenate([[0], np.cumsum(each)])
        for d in range(n):
            text = buf[off[d] : off[d + 1]]
            if plain[d]:
                a, b = int(first[d]), int(first[d + 1])
                total[d] = cum[b] - cum[a]
                if not table and total[d] <= limit:
                    fit[d] = len(text)
                    continue
                if table:
                    c = np.concatenate([val[t_off[r] : t_off[r + 1]] + (cum[a + i] - cum[a]) for i, r in enumerate(row[a:b])])
                    counts[d] = c.astype("<i4").tobytes()
                k = int(np.searchsorted(cum[a : b + 1], cum[a] + limit, "right")) - 1
                at = int(starts[a + k] - off[d]) if a + k < b else len(text)
                if a + k < b:
                    inner = val[t_off[row[a + k]] : t_off[row[a + k] + 1]]
                    good = np.flatnonzero(inner <= limit - (cum[a + k] - cum[a]))
                    at = _at_char(text, at, at + (int(good[-1]) + 1 if len(good) else 0))
                fit[d] = at
            elif len(text):
                c = self.whole(text.tobytes())
                total[d] = c[-1]
                good = np.flatnonzero(c <= limit)
                fit[d] = _at_char(text, 0, int(good[-1]) + 1 if len(good) else 0)
                if table:
                    counts[d] = c.astype("<i4").tobytes()
        return total, fit, counts

    def whole(self, data: bytes) -> np.ndarray:
        """Counts at every byte of a text with runs of white space or special strings."""
        parts = [None if p is None else p.encode("utf-8") for p in pretokens(data.decode("utf-8"))]
        out = self._joined([parts], [len(data)])[0]
        at = 0
        for p, q in zip(parts, parts[1:]):
            # A prefix that ends in a run of white space takes all of it as one pretoken.
            size = 13 if p is None else len(p)
            if p and q and p.isspace() and q[:1] == b" " and not q.isspace():
                both, _ = self.vocab.prefix_counts([p + b" "])
                out[at + size] = both[-1] + (out[at - 1] if at else 0)
            elif p and q and p.decode().isspace() and q.decode().isspace():
                both, _ = self.vocab.prefix_counts([p + q])
                out[at + size : at + size + len(q)] = both[size:] + (out[at - 1] if at else 0)
            at += size
        return out


def len_plain(vocab: Vocabulary, text: str) -> int:
    return sum(len(vocab.encode(p.encode("utf-8"))) for p in pretokens(text) if p is not None)


def _at_char(text: np.ndarray, low: int, at: int) -> int:
    while at > low and at < len(text) and (text[at] & 0xC0) == 0x80:
        at -= 1
    return at


_SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_bytes long"


def count_tokens(df: DataFrame, path: str, limit: int = LIMIT, table: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_bytes (the longest prefix of whole
    characters within the limit) and with ``table`` prefix_tokens: the exact
    counts at every byte, as 32-bit little-endian integers."""
    names = [x.split()[0] for x in _SCHEMA.split(", ")] + (["prefix_tokens"] if table else [])

    def run(batches):
        counter = _counter(path)
        for batch in batches:
            buf, off = buffer_of(batch.column(1))
            total, fit, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
            for lo, hi in slices(off):
                t, f, c = counter.slice(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], table, limit)
                total.append(t)
                fit.append(f)
                counts += c
            n = np.concatenate(total)
            cols = [batch.column(0), pa.array(np.diff(off)), pa.array(n), pa.array(n > limit), pa.array(np.concatenate(fit))]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(counts, pa.binary())] if table else []), names=names)

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, _SCHEMA + (", prefix_tokens binary" if table else ""))


_counters: dict[str, PrefixCounter] = {}


def _counter(path: str) -> PrefixCounter:
    if path not in _counters:
        _counters[path] = PrefixCounter(vocabulary(path))
    return _counters[path]


def op2_count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
