"""Ranges of the order of postings: where they begin, and which one a row is in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.operators.index import IndexSpec, postings_of

# Postings looked at for each range, and documents for all of them, at least.
SAMPLE_PER_RANGE = 100
SAMPLE_DOCS = 200

# Comparisons that are written out as one expression; lists of bounds come below them.
TREE = 64


def cut_points(
    documents: DataFrame, spec: IndexSpec, n_docs: int, n_postings: int, parts: int
) -> list[tuple]:
    """At most ``parts - 1`` ascending (field, term, doc_id) that cut the postings evenly.

    They come from a sample of documents, and from a sample of the postings of those: how
    even the ranges are depends on it, and nothing else.
    """
    if parts < 2:
        return []
    wanted = SAMPLE_PER_RANGE * parts
    share = min(1.0, max(20 * wanted / n_postings, SAMPLE_DOCS / max(n_docs, 1)))
    rows = postings_of(documents.sample(share, 11), spec, "doc_id").select("field", "term", "doc_id")
    rows = rows.sample(min(1.0, wanted / (share * n_postings)), 12)
    order = sorted(
        (tuple(r) for r in rows.collect()), key=lambda r: (r[0].encode(), r[1].encode(), r[2])
    )
    places = [order[i * len(order) // parts] for i in range(1, parts)] if order else []
    return list(dict.fromkeys(places))


def range_number(bounds: list[tuple], *key: str) -> Column:
    """How many of the ascending bounds are at or before a row's key.

    The first comparisons are a tree in generated code; beyond ``TREE`` bounds the rest is
    a search of one short list.
    """
    bounds = list(dict.fromkeys(bounds))

    def before(bound: tuple) -> Column:
        test = F.lit(False)
        for name, value in reversed(list(zip(key, bound, strict=True))):
            test = (F.col(name) < F.lit(value)) | ((F.col(name) == F.lit(value)) & test)
        return test

    def tree(at: list[int], leaf) -> Column:
        """``at`` are the places of the bounds that are compared."""

        def node(low: int, high: int) -> Column:
            if low == high:
                return leaf(low)
            middle = (low + high) // 2
            test = before(bounds[at[middle]])
            return F.when(test, node(low, middle)).otherwise(node(middle + 1, high))

        return node(0, len(at))

    if len(bounds) <= TREE:
        return tree(list(range(len(bounds))), lambda n: F.lit(n))
    step = -(-len(bounds) // TREE)
    at = list(range(step - 1, len(bounds), step))

    def struct(bound: tuple) -> Column:
        return F.struct(*(F.lit(v).alias(k) for k, v in zip(key, bound, strict=True)))

    # Group g holds the bounds after the g-th compared one, up to the next.
    groups = [bounds[g * step : (g + 1) * step - 1] for g in range(len(at) + 1)]
    empty = F.array().cast(f"array<{_struct_type(bounds[0], key)}>")
    lists = F.array(*(F.array(*map(struct, g)) if g else empty for g in groups))
    group = tree(at, lambda n: F.lit(n))
    here = F.struct(*(F.col(k).alias(k) for k in key))
    within = F.size(F.filter(F.get(lists, group), lambda b: b <= here))
    return (group * F.lit(step) + within).cast("int")


def _struct_type(bound: tuple, key: tuple[str, ...]) -> str:
    kinds = {str: "string", int: "bigint"}
    return "struct<" + ",".join(f"{k}:{kinds[type(v)]}" for k, v in zip(key, bound)) + ">"
