"""Filter interaction audit: what each filter of a chain removes, in every order of the chain, from one pass over the texts.

Native expressions give each document a mask of the filters that it fails. What an order removes at a step depends on the
masks alone, so documents are counted by mask, 32 cells a part, and all 120 orders are worked out from those cells.

One filter fails texts that a smaller doc_id has already. Rows are grouped by the SHA-256 of their text, counted by part,
mask and label before the digest alone deals them, so a group of copies meets as one row for each part and label.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Limits:
    """Of the filters A to D: least words, least share of distinct words, most capitals a code point (per cent), forbidden characters."""

    words: int = 50
    distinct_percent: int = 65
    capitals_percent: int = 5
    symbols: str = "[#$%&*|]"


FILTERS = "ABCDE"
BIT = {f: 1 << k for k, f in enumerate(FILTERS)}
_LABELS = ("good", "toxic")


def steps() -> list[dict]:
    """Every order's steps: filter_order, step (from 1), own (the bit of its filter) and earlier (the bits before it)."""
    out = []
    for order in map("".join, permutations(FILTERS)):
        bits = [BIT[f] for f in order]
        out += [{"filter_order": order, "step": k + 1, "own": own, "earlier": sum(bits[:k])} for k, own in enumerate(bits)]
    return out


def failure_mask(text: Column, words: Column, limits: Limits) -> Column:
    """Bits of the filters A to D that a text fails; words are its words."""
    n, capitals = F.size(words).cast("long"), F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    fails = {
        "A": n < limits.words,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < limits.distinct_percent * n,
        "C": 100 * capitals > limits.capitals_percent * F.length(text).cast("long"),
        "D": text.rlike(limits.symbols),
    }
    return sum((F.when(x, BIT[f]).otherwise(0) for f, x in fails.items()), F.lit(0))


def failures(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, part, mask (of A to D) and digest of each row of docs: all that the audit needs of a text."""
    text, part = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("source").cast("string"), F.lit(""))
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), part.alias("part"), text.alias("text"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    return whole.withColumn("words", words).select("doc_id", "part", failure_mask(F.col("text"), F.col("words"), limits).alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))


def _counts() -> list[Column]:
    return [F.sum("n").alias("n"), *[F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in _LABELS]]


def mask_cells(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """part, mask (of A to E), n, good, toxic (long): how many documents of a part have each mask that occurs.

    docs has doc_id, text and source. A document is good or toxic if any row of labels (doc_id, quality, toxic) says so of
    its doc_id; null labels say nothing. A row fails E if its text is that of a row with a smaller doc_id, in any part;
    rows of one doc_id don't fail each other, and a null doc_id neither is smaller than another nor has a smaller one. A
    null text counts as empty, a null source as an empty string. An empty table gives no rows.
    """
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(*[F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(name) for c, name in zip(("quality", "toxic"), _LABELS, strict=True)])
    rows = failures(docs, limits)
    named = rows.where("doc_id IS NOT NULL").join(known, "doc_id", "left").na.fill(False, list(_LABELS))
    # Repeated rows first, which need no shuffle after the join; then the rows of a digest, part, mask and label.
    keys = ["digest", "part", "mask", *_LABELS]
    groups = named.groupBy("doc_id", *keys).agg(F.count("*").alias("n")).groupBy(*keys).agg(F.min(F.struct("doc_id", "n")).alias("first"), F.sum("n").alias("n"))
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    unique = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = F.array(F.struct("mask", unique.alias("n")), F.struct((F.col("mask") + BIT["E"]).alias("mask"), (F.col("n") - unique).alias("n")))
    cells = groups.withColumn("least", least).select("part", *_LABELS, F.inline(split)).where("n > 0").select("part", "mask", *_LABELS, "n")
    nameless = rows.where("doc_id IS NULL").groupBy("part", "mask").agg(F.count("*").alias("n")).select("part", "mask", *[F.lit(False).alias(c) for c in _LABELS], "n")
    return cells.unionByName(nameless).groupBy("part", "mask").agg(*_counts())


def order_steps(cells: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley of mask_cells: 600 rows a part.

    A part's 32 cells are one row, from which each order's steps are sums. A document that fails m filters is removed by
    each of them first in one of m orders, so it counts 120 / m times in the shapley of each.
    """
    orders = F.from_json(F.lit(json.dumps(steps())), "array<struct<filter_order: string, step: int, own: int, earlier: int>>")
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # at most 32 a part
    rows = parts.select("part", "cells", F.inline(orders))
    own, earlier = F.col("own"), F.col("earlier")

    def total(which, what: str = "n"):
        return F.aggregate(F.filter("cells", which), F.lit(0).cast("long"), lambda a, c: a + c[what])

    def lost(c):
        return ((c["mask"].bitwiseAND(earlier)) == 0) & (c["mask"].bitwiseAND(own) != 0)

    fails = lambda c: c["mask"].bitwiseAND(own) != 0
    each = F.transform(F.filter("cells", fails), lambda c: c["n"] * F.floor(F.lit(120) / F.bit_count(c["mask"])))
    return rows.select(
        "part", "filter_order", "step",
        total(lambda c: c["mask"].bitwiseAND(own.bitwiseOR(earlier)) == 0).alias("kept"), total(lost).alias("removed"),
        total(lambda c: fails(c) & (c["mask"].bitwiseAND(earlier) != 0)).alias("redundant"), total(lambda c: c["mask"] == own).alias("unique_fails"),
        total(lost, "good").alias("good_lost"), total(lost, "toxic").alias("toxic_lost"), F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Every part's 120 orders, step by step; see order_steps for the columns and mask_cells for what counts as a failure."""
    return order_steps(mask_cells(docs, labels, limits))
