"""Byte-level BPE: exact token counts at every prefix by dynamic programming, and
token ids of whole texts from the ids of their distinct pieces.

*Prefix counts.*  The encoding of a prefix ends in exactly one token, and what
stands before that token is the encoding of a shorter prefix; a token may follow
another one just when merging their joint bytes gives these two back.  So the
last token of every prefix, and with it the count at every prefix, comes from
those of shorter prefixes: one table answers what a text costs, what any of its
prefixes costs, and where it must end to fit a budget, without encoding again.
The recurrence runs over all distinct pretokens of a slice at once.

*Pieces.*  In a text without runs of white space the tokenizer's own pattern
never joins what a single space or line feed parts, so the text falls into
pieces (with that byte in front) that are encoded on their own; other texts are
taken whole.  Text is never shortened, padded or normalised.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import regex

from .text import hash_spans

_SPACE = r"\t-\r\x20\x85\xa0  -     　"
PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + _SPACE + r"\p{L}\p{N}]+|[" + _SPACE + r"]+(?![^" + _SPACE + r"])|[" + _SPACE + r"]+"
)
SPECIAL = "<|endoftext|>"
_TABLE_BITS = 20
_NONE = 65535
_CACHE_ROWS = 400_000
#: Pretokens of more bytes are counted one by one.
LONG = 40


def byte_chars() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in shown}
    out.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))})
    return out


def tokens_of(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ids by token's bytes, and ids of special strings, of a tokenizer's JSON file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    chars = byte_chars()
    raw = {bytes(chars[c] for c in t): i for t, i in spec["model"]["vocab"].items() if all(c in chars for c in t)}
    return raw, {t["content"]: t["id"] for t in spec["added_tokens"]}


class Vocabulary:
    """Tokens as bytes, their ids and the order of merges, from a tokenizer's JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = byte_chars()
        raw, self.special = tokens_of(path)
        self.tokens = raw
        self.bytes_of = {i: t for t, i in raw.items()}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = (bytes(chars[c] for c in x) for x in (pair if isinstance(pair, list) else pair.split(" ")))
            self.merge[raw[a], raw[b]] = (rank, raw[a + b])
        if max([*raw.values(), len(raw)]) >= _NONE:
            raise ValueError(f"a vocabulary of {_NONE} tokens or more has no room in 16-bit pairs")
        self.longest = max(map(len, raw))
        self._lengths = sorted({len(t) for t in raw}, reverse=True)
        self._follows: dict[tuple[int, int], bool] = {}
        self._build_table()
        self._pairs = np.zeros(0, np.int64)
        self._valid = np.zeros(0, bool)

    def encode(self, data: bytes) -> list[int]:
        """Plain merging of one pretoken's bytes; what the recurrence must agree with."""
        ids = [self.tokens[data[i : i + 1]] for i in range(len(data))]
        while len(ids) > 1:
            best = min(((self.merge.get(p, (1 << 30, 0))[0], i) for i, p in enumerate(zip(ids, ids[1:]))))
            if best[0] == 1 << 30:
                break
            i = best[1]
            ids[i : i + 2] = [self.merge[ids[i], ids[i + 1]][1]]
        return ids

    def _build_table(self) -> None:
        tokens = sorted(self.tokens, key=self.tokens.get)
        data = np.frombuffer(b"".join(tokens), np.uint8)
        ends = np.cumsum([len(t) for t in tokens])
        h = hash_spans(data, ends - np.array([len(t) for t in tokens]), ends)
        size = 1 << _TABLE_BITS
        self._slot_hash = np.zeros(size, np.uint64)
        self._slot_id = np.full(size, _NONE, np.int64)
        self._probes = 0
        for x, t in zip(h.tolist(), tokens):
            at, n = x >> (64 - _TABLE_BITS), 1
            while self._slot_id[at] != _NONE:
                at, n = (at + 1) & (size - 1), n + 1
            self._slot_hash[at], self._slot_id[at] = x, self.tokens[t]
            self._probes = max(self._probes, n)

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Ids by hash of a token's bytes; 65535 where there is none."""
        at = (h >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
        out = np.where(self._slot_hash[at] == h, self._slot_id[at], _NONE)
        for i in range(1, self._probes):
            at = (at + 1) & ((1 << _TABLE_BITS) - 1)
            more = (out == _NONE) & (self._slot_hash[at] == h)
            out[more] = self._slot_id[at[more]]
        return out

    def may_follow(self, last: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether merging the bytes of ``last`` and ``token`` gives these two tokens."""
        key = last * 65536 + token
        at = np.searchsorted(self._pairs, key)
        known = at < len(self._pairs)
        known[known] = self._pairs[at[known]] == key[known]
        if not known.all():
            new = np.unique(key[~known])
            ok = np.empty(len(new), bool)
            for i, k in enumerate(new.tolist()):
                a, b = divmod(k, 65536)
                ok[i] = self.encode(self.bytes_of[b]) == [b] if a == _NONE else self.encode(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
            pairs = np.concatenate([self._pairs, new])
            order = np.argsort(pairs, kind="stable")
            self._pairs, self._valid = pairs[order], np.concatenate([self._valid, ok])[order]
            at = np.searchsorted(self._pairs, key)
        return self._valid[at]

    def prefix_counts(self, items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For pretokens: the counts at their prefixes of 1, 2, ... bytes, one after
        the other, and each one's offset in that array (one entry more)."""
        n = len(items)
        lens = np.fromiter(map(len, items), np.int64, n)
        off = np.concatenate([[0], np.cumsum(lens)])
        out = np.zeros(int(off[-1]), np.int32)
        if not n:
            return out, off
        for i in np.flatnonzero(lens > LONG):
            out[off[i] : off[i + 1]] = self._long_counts(items[i])
        data = np.frombuffer(b"".join(items), np.uint8)
        order = np.argsort(-lens, kind="stable")
        order = order[lens[order] <= LONG]
        start, size = off[:-1][order], lens[order]
        last = np.full(len(out), _NONE, np.int64)
        top = int(size[0]) if len(size) else 0
        for j in range(1, top + 1):
            act = int(np.searchsorted(-size, -j, "right"))
            todo = np.arange(act)
            for length in range(min(j, self.longest), 0, -1):
                s = start[todo]
                e = s + j
                token = self.lookup(_hash_fixed(data, e - length, length))
                before = np.full(len(todo), _NONE, np.int64) if length == j else last[e - length - 1]
                has = np.flatnonzero(token != _NONE)
                ok = has[self.may_follow(before[has], token[has])] if len(has) else has
                if len(ok):
                    at = e[ok] - 1
                    last[at] = token[ok]
                    out[at] = 1 if length == j else out[at - length] + 1
                    rest = np.ones(len(todo), bool)
                    rest[ok] = False
                    todo = todo[rest]
                    if not len(todo):
                        break
            if len(todo):
                raise ValueError("a byte has no token")
        for i, t in enumerate(items):
            if t in (b"'re", b"'ve", b"'ll"):  # cut after two bytes, its pattern parts the quote from the letter
                out[off[i] + 1] = 2
        return out, off


    def _long_counts(self, item: bytes) -> np.ndarray:
        """The same recurrence for one long pretoken, byte by byte."""
        n = len(item)
        last, count = [_NONE] * (n + 1), [0] * (n + 1)
        lengths, tokens, follows = self._lengths, self.tokens, self._follows
        for j in range(1, n + 1):
            for length in lengths:
                if length > j:
                    continue
                t = tokens.get(item[j - length : j])
                if t is None:
                    continue
                key = (last[j - length], t)
                ok = follows.get(key)
                if ok is None:
                    a = key[0]
                    ok = self.encode(self.bytes_of[t]) == [t] if a == _NONE else self.encode(self.bytes_of[a] + self.bytes_of[t]) == [a, t]
                    follows[key] = ok
                if ok:
                    last[j], count[j] = t, count[j - length] + 1
                    break
            else:
                raise ValueError("a byte has no token")
        return np.array(count[1:], np.int32)


def _hash_fixed(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """hash_spans for spans of one length at any places."""
    from .text import _P, mix

    acc = np.zeros(len(starts), np.uint64)
    power = np.uint64(1)
    for i in range(length):
        acc += (data[starts + i].astype(np.uint64) + np.uint64(1)) * power
        power = np.uint64((int(power) * int(_P)) & 0xFFFFFFFFFFFFFFFF)
    return mix(acc + np.uint64(length * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_padding()
    t.no_truncation()
    return t


def pretokens(text: str) -> list[str | None]:
    """The pattern's parts of a whole text; None for a special string."""
    out: list[str | None] = []
    for i, part in enumerate(text.split(SPECIAL)):
        if i:
            out.append(None)
        out += PATTERN.findall(part)
    return out


_CUT = np.zeros(256, bool)
_CUT[[0x20, 0x0A]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True


def plain_docs(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Which documents fall into pieces at spaces and line feeds."""
    ok = np.diff(off) > 0
    if not len(buf):
        return ok
    blank = _BLANK[buf]
    bad = np.zeros(len(buf), bool)
    bad[1:] = blank[1:] & blank[:-1]
    lead = buf >= 0xC2
    if lead.any():
        a = np.flatnonzero(lead[:-1])
        b, c = buf[a + 1], buf[np.minimum(a + 2, len(buf) - 1)]
        x = buf[a]
        wide = (x == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (x == 0xE1) & (b == 0x9A) & (c == 0x80) | (x == 0xE3) & (b == 0x80) & (c == 0x80)
        wide |= (x == 0xE2) & ((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F))
        bad[a[wide]] = True
    if len(buf) > 2:
        bad[:-2] |= (buf[:-2] == 0x3C) & (buf[1:-1] == 0x7C) & (buf[2:] == 0x65)
    full = np.flatnonzero(ok)
    ok[full] &= ~(blank[off[full]] | blank[off[full + 1] - 1])
    at = np.flatnonzero(bad)
    if len(at):
        ok[np.searchsorted(off, at, "right") - 1] = False
    return ok


def pieces(buf: np.ndarray, off: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of the documents of a mask, and each
    document's first piece (no pieces for documents outside the mask)."""
    cut = _CUT[buf]
    cut[off[:-1][docs]] = True
    outside = np.flatnonzero(~docs)
    for d in outside:
        cut[off[d] : off[d + 1]] = False
    starts = np.flatnonzero(cut)
    first = np.searchsorted(starts, off)
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:]
    if len(starts):
        has = np.flatnonzero(np.diff(first) > 0)
        ends[first[has + 1] - 1] = off[has + 1]
    return starts, ends, first


class PieceCache:
    """Values (arrays of integers) by hash of piece, of those met more than once."""

    def __init__(self):
        self.h = np.zeros(0, np.uint64)
        self.off = np.zeros(1, np.int64)
        self.val = np.zeros(0, np.int32)

    def get(self, buf, starts, ends, compute) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of each piece, offsets of rows, values): ``compute`` maps a list of
        the bytes of unknown pieces to (values, offsets)."""
        h = hash_spans(buf, starts, ends)
        u, at, row, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        pos = np.searchsorted(self.h, u)
        hit = pos < len(self.h)
        hit[hit] = self.h[pos[hit]] == u[hit]
        miss = np.flatnonzero(~hit)
        raw = buf.tobytes()
        new_val, new_off = compute([raw[s:e] for s, e in zip(starts[at[miss]].tolist(), ends[at[miss]].tolist())])
        size = np.empty(len(u), np.int64)
        size[hit] = (self.off[1:] - self.off[:-1])[pos[hit]]
        size[miss] = np.diff(new_off)
        off = np.concatenate([[0], np.cumsum(size)])
        val = np.empty(int(off[-1]), np.int32)
        put_ragged(val, off[:-1][hit], self.val, self.off[:-1][pos[hit]], size[hit])
        put_ragged(val, off[:-1][miss], new_val, new_off[:-1], size[miss])
        self._keep(u, off, val, (n > 1) & ~hit)
        return row, off, val

    def _keep(self, u, off, val, fresh) -> None:
        if len(self.h) + int(fresh.sum()) > _CACHE_ROWS:
            self.h, self.off, self.val = np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int32)
            fresh = np.ones(len(u), bool) if len(u) <= _CACHE_ROWS else fresh
        k = np.flatnonzero(fresh)
        h = np.concatenate([self.h, u[k]])
        size = np.concatenate([np.diff(self.off), (off[1:] - off[:-1])[k]])
        src = np.concatenate([self.off[:-1], off[:-1][k] + len(self.val)])
        pool = np.concatenate([self.val, val])
        order = np.argsort(h, kind="stable")
        new_off = np.concatenate([[0], np.cumsum(size[order])])
        new_val = np.empty(int(new_off[-1]), np.int32)
        put_ragged(new_val, new_off[:-1], pool, src[order], size[order])
        self.h, self.off, self.val = h[order], new_off, new_val


def put_ragged(dst, dst_start, src, src_start, size) -> None:
    """dst[dst_start[i] + j] = src[src_start[i] + j] for j < size[i], for all i."""
    total = int(size.sum())
    if not total:
        return
    inner = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
    dst[np.repeat(dst_start, size) + inner] = src[np.repeat(src_start, size) + inner]
