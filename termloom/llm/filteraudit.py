"""How filters overlap: what each of all orders of five filters removes, keeps and repeats.

A document becomes a mask of the filters it fails.  Everything asked for depends on the
masks alone, so documents are reduced to counts of (part, mask, labels), at most 128 a
part, and the 120 orders are worked out from those.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.text import let
from termloom.llm.tries import flag_repeats
from termloom.session import stage

# The filters and their bits, in the order of their letters.
FILTERS = {"A": 1, "B": 2, "C": 4, "D": 8, "E": 16}
LEAST_WORDS = 200
MARKS = "[#$%&*|]"
SPACE = r"[\x20\x09-\x0D]+"

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_mask(text: Column) -> Column:
    """The filters A to D that a text fails."""

    def of_words(words: Column) -> Column:
        n, different = F.size(words), F.size(F.array_distinct(words))
        return F.when(n < LEAST_WORDS, FILTERS["A"]).otherwise(0).bitwiseOR(
            F.when(100 * different.cast("bigint") < 50 * n, FILTERS["B"]).otherwise(0)
        )

    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return (
        let(words, of_words)
        .bitwiseOR(
            F.when(100 * capitals.cast("bigint") > 3 * F.length(text), FILTERS["C"]).otherwise(0)
        )
        .bitwiseOR(F.when(text.rlike(MARKS), FILTERS["D"]).otherwise(0))
        .cast("int")
    )


def masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, n) of whole texts; null texts are empty, null parts too."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        text_mask(text).alias("mask"),
        text.alias("text"),
    )
    return flag_repeats(rows, FILTERS["E"])


def mask_counts(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): documents, by what is known of them.

    An id with several labels is good if one says so, and toxic if one says so.
    """
    known = (
        labels.filter("doc_id is not null")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(
            F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
            F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
        )
    )
    said = ("good", "toxic")
    with_id = masked.filter("doc_id is not null").join(known, "doc_id", "left")
    without = masked.filter("doc_id is null").select("*", *(F.lit(False).alias(c) for c in said))
    return (
        with_id.unionByName(without)
        .groupBy("part", "mask", *(F.coalesce(F.col(c), F.lit(False)).alias(c) for c in said))
        .agg(F.sum("n").alias("n"))
    )


def steps() -> Column:
    """An array of every (filter_order, step, own bit, bits of the steps before)."""
    found = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            row = {"filter_order": "".join(order), "step": step, "own": FILTERS[letter], "before": before}
            found.append(F.struct(*(F.lit(v).alias(k) for k, v in row.items())))
            before |= FILTERS[letter]
    return F.array(*found)


def interactions(counts: DataFrame) -> DataFrame:
    """One row per part, order and step; zeros are rows too."""
    n = F.col("n")
    wide = counts.select("*", F.inline(steps()))
    own, before = F.col("mask").bitwiseAND(F.col("own")), F.col("mask").bitwiseAND(F.col("before"))
    removed = (own != 0) & (before == 0)

    def total(which: Column, value: Column = n) -> Column:
        return F.sum(F.when(which, value).otherwise(0)).cast("bigint")

    # A filter comes first of those that a document fails in 120 / (their number) orders.
    first = n * F.expr("cast(120 div bit_count(mask) as bigint)")
    figures = (
        total((own == 0) & (before == 0)),
        total(removed),
        total((own != 0) & (before != 0)),
        total(F.col("mask") == F.col("own")),
        total(removed & F.col("good")),
        total(removed & F.col("toxic")),
        total(own != 0, first),
    )
    return wide.groupBy("part", "filter_order", "step").agg(
        *(figure.alias(name) for name, figure in zip(COUNTS, figures, strict=True))
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The interactions of the five filters over whole documents.

    A null or empty text has no words: it fails A, not B or C.  Of equal texts all but those
    of the smallest id fail E, so rows that share that id pass; a row without an id comes
    after all others, and without labels it is neither good nor toxic.  An empty table has
    no parts and gives no rows.  Other columns are not read.
    """
    return interactions(mask_counts(stage(masks(docs), "audit-masks"), labels))
