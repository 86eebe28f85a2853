"""Licence scans by DataFrame functions only: ordered signature rules, gated by
keywords, resolved by priority and containment of intervals.

A text is brought into word form once.  Texts without any gate literal are done;
of the others each rule whose keyword is there is matched, and its detections
are word intervals.  In one sweep over detections by start (longer first, then
higher priority) a detection is dropped when one of at least its priority
contains it; the sweep keeps the furthest end of each tier.  All of this stays
in the row: there is no shuffle.

Base phrases are counted word by word beside the rules and always give labels.

Defined cases: a null or empty text has no words, no labels and score 0; texts of
any length are scanned whole; other columns pass through ``license_scan``, but
those that have the name of a new column; an
empty table gives an empty result; equal texts give equal results.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import computed_once, documents, free_name, text_or_empty
from .license_rules import GATES, RULES, Rule

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
BASE_SCORE = 0.6
TIERS = 4
_RULE_FIELDS = ("id", "label", "tier", "keyword", "pattern", "confidence")
_RULE_TABLE = "array<struct<id:int,label:string,tier:int,keyword:string,pattern:string,confidence:double>>"
_SPAN = "array<struct<first:int,minus_end:int,tier:int,rule:int,label:string,confidence:double>>"


def lower_ascii(text: Column) -> Column:
    """A-Z only.  lower() changes other letters too, of which two become ASCII."""
    odd = F.contains(text, F.lit("K")) | F.contains(text, F.lit("İ"))
    return F.when(odd, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def word_form(text: Column) -> Column:
    """Lower-cased words with one space before, between and after; two spaces without any."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(lower_ascii(text), SEPARATORS, " ")), F.lit(" "))


def _spaces(c: Column) -> Column:
    return F.octet_length(c) - F.octet_length(F.replace(c, F.lit(" "), F.lit("")))


def _any(text: Column, literals: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(x)) for x in literals])


def _rule_table(rules: list[Rule]) -> Column:
    """The rules as one literal (which the optimizer folds): quicker to plan than a column for each field."""
    rows = [dict(zip(_RULE_FIELDS, (r.id, r.label, r.tier, r.keyword, f"(?<= )(?:{r.pattern})(?= )", float(r.confidence)))) for r in rules]
    return F.from_json(F.lit(json.dumps(rows)), _RULE_TABLE)


def _matches(words: Column, rule: Column) -> Column:
    """The intervals of one rule: words before each match, and in it."""
    between = F.split(words, rule["pattern"])
    inside = F.regexp_extract_all(words, rule["pattern"], F.lit(0))
    sizes = F.zip_with(
        F.slice(between, 1, F.greatest(F.size(between) - 1, F.lit(0))), inside, lambda gap, hit: F.struct(_spaces(gap).alias("gap"), _spaces(hit).alias("hit"))
    )
    empty = F.array().cast("array<struct<first:int,end:int>>")
    start = F.struct(F.lit(-1).alias("at"), empty.alias("out"))

    def step(acc: Column, s: Column) -> Column:
        first = acc["at"] + s["gap"]
        end = first + s["hit"]
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(first.alias("first"), (end + 1).alias("end")))).alias("out"))

    found = F.aggregate(sizes, start, step, lambda acc: acc["out"])
    return F.transform(
        found,
        lambda d: F.struct(
            d["first"].alias("first"), (-d["end"]).alias("minus_end"), rule["tier"].alias("tier"), rule["id"].alias("rule"), rule["label"].alias("label"), rule["confidence"].alias("confidence")
        ),
    )


def _all_matches(words: Column, rules: list[Rule]) -> Column:
    """The intervals of all rules whose keyword is there."""
    return F.flatten(F.transform(F.filter(_rule_table(rules), lambda r: F.contains(words, r["keyword"])), lambda r: _matches(words, r)))


def _resolve(detections: Column) -> Column:
    """Drops what a detection of the same or a better tier contains."""
    ends = [f"e{i}" for i in range(TIERS)]
    kept = F.array().cast(_SPAN)
    start = F.struct(*[F.lit(-1).alias(e) for e in ends], kept.alias("kept"))

    def step(acc: Column, d: Column) -> Column:
        end = -d["minus_end"]
        covered = reduce(lambda a, b: a | b, [(d["tier"] >= i) & (acc[e] >= end) for i, e in enumerate(ends)])
        return F.struct(
            *[F.when(d["tier"] == i, F.greatest(acc[e], end)).otherwise(acc[e]).alias(e) for i, e in enumerate(ends)],
            F.when(covered, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(d))).alias("kept"),
        )

    return F.aggregate(F.sort_array(detections), start, step, lambda acc: acc["kept"])


def _places(words: Column, split: Column, phrase: str) -> Column:
    parts = phrase.split(" ")
    hit = F.transform(
        split, lambda w, i: F.when(reduce(lambda a, b: a & b, [w == parts[0]] + [F.get(split, i + j) == p for j, p in enumerate(parts[1:], 1)]), i)
    )
    return F.when(F.contains(words, F.lit(f" {phrase} ")), F.filter(hit, lambda i: i.isNotNull())).otherwise(F.array().cast("array<int>"))


def license_scan(df: DataFrame, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """``df`` with n_words, n_base, first_word, last_word, base_labels, labels, score
    and detections (first word, minus the end word, tier, rule, label, confidence)."""
    names = df.columns
    made = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
    kept = [c for c in names if c.lower() not in made]
    form, parted, count, places, found, all_, base, best_of = (free_name(df, f"_{n}") for n in ("form", "split", "count", "places", "found", "all", "base", "kept"))
    step1 = df.select(*kept, word_form(text_or_empty(text)).alias(form))
    words = F.col(form)
    gate = _any(words, GATES)
    phrases = _any(words, [f" {p} " for p in BASE])
    none = F.array().cast("array<int>")
    split = F.split(F.trim(words), " ")
    step2 = step1.withColumn(parted, F.when(phrases, split)).select(
        *kept,
        F.when(F.octet_length(words) <= 2, F.lit(0)).otherwise(_spaces(words) - 1).cast("long").alias(count),
        F.when(phrases, F.array(*[_places(words, F.col(parted), p) for p in BASE])).otherwise(F.array(*[none] * len(BASE))).alias(places),
        F.when(computed_once(gate), _all_matches(words, rules)).otherwise(F.array().cast(_SPAN)).alias(found),
    )
    step3 = step2.select(
        *kept,
        count,
        F.flatten(places).alias(all_),
        F.filter(F.array(*[F.when(F.size(F.get(F.col(places), i)) > 0, F.lit(label)) for i, label in enumerate(BASE.values())]), lambda x: x.isNotNull()).alias(base),
        F.when(F.size(found) > 0, _resolve(F.col(found))).otherwise(F.col(found)).alias(best_of),
    )
    by_rule = F.transform(best_of, lambda d: d["label"])
    best = F.array_max(F.concat(F.transform(best_of, lambda d: d["confidence"]), F.array(F.when(F.size(base) > 0, BASE_SCORE).otherwise(0.0))))
    return step3.select(
        *kept,
        F.col(count).alias("n_words"),
        F.size(all_).cast("long").alias("n_base"),
        F.array_min(all_).cast("long").alias("first_word"),
        F.array_max(all_).cast("long").alias("last_word"),
        F.array_join(F.sort_array(base), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_distinct(F.concat(base, by_rule))), ",").alias("labels"),
        best.cast("double").alias("score"),
        F.col(best_of).alias("detections"),
    )


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return license_scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", F.size("detections").alias("n_detections"))
