from __future__ import annotations

import random

import pytest

BODY = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, near copies."""
    rng = random.Random(3)
    base = words(rng, 220, 5000)
    parts = base.split(" ")
    near = " ".join(parts[:100] + ["changed"] + parts[101:])
    far = " ".join(p if i % 9 else "x" for i, p in enumerate(parts))
    passage = words(rng, 60, 9000)
    texts = [
        None, "", " ", "one", "a b c d", "A B c d", base, base, near, far, base.upper(), words(rng, 30_000, 20_000), "x" * 5000, "Ünï çødé ß 日本語 text with K and İ", "tabs\tand\n\nlines  and   spaces ",
        "Licensed under the Apache License, Version 2.0. All rights reserved.", "cc-by cc by CC BY 4.0; released under the MIT License (GNU General Public License v3)", "<|endoftext|> in a text<|endoftext|>",
        words(rng, 80) + " " + passage + " " + words(rng, 70), words(rng, 40) + " " + passage + " " + words(rng, 90), "spam!! " * 200, " nbsp  end",
    ]
    rows = [(i, t, "en", f"s{i % 3}" if i % 4 else None, len(t) if t is not None else None) for i, t in enumerate(texts)]
    return [*rows, rows[6], rows[3], (None, base, None, None, None), (None, None, None, None, None), (1000, base, "en", "ß", 1), (-5, "negative id", "en", "S", 1)]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), BODY).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], BODY)


#: Names that operators use themselves, for results or on the way.
OWN_NAMES = """
n_words n_base first_word last_word base_labels labels score detections _form _split _count _places _found _all _base _kept
n_bytes n_tokens over_limit held_out predicted _score _id _y x quality toxic size shard slot law grown_shard _size _crc _h _d _part _slot _q _shard
payload media feature sig edited fingerprint next_text next_sig _u _r _f _e _p _c _g _lg _tie _next
start length ids ids_crc32 doc_tokens sequence_id offset _salt _rank target taken whole extra source_size bucket _bucket _source _s _edge _times _turn _target _taken
doc node _node _gone _row _text _other component hub weight h1 h2 n a b key text_key _key _spans _mine spans slice seeds docs places kind end hash
""".split()


@pytest.fixture(scope="session")
def clashing(odd):
    """Further columns with all names that operators use themselves."""
    return odd.selectExpr("*", *[f"'x' AS `{name}`" for name in OWN_NAMES])
