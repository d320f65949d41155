"""Point fields: the order documents are stored in, and range search over an index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.functions.metadata import between
from termloom.operators.index import Index

# Bits of each point in the order of the documents, and values looked at to find the steps.
BITS = 6
ACCURACY = 1000

NUMBERS = (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType)


def step_number(value: Column, steps: list) -> Column:
    """How many of the ascending steps are at or below a value; 0 for null."""

    def node(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= F.lit(steps[middle]), node(middle + 1, high)).otherwise(
            node(low, middle)
        )

    return node(0, len(steps))


def interleaved(numbers: list[Column]) -> Column:
    """The bits of several numbers in turn, the highest first: near in all is near in one."""
    total = F.lit(0)
    for bit in range(BITS):
        for place, number in enumerate(numbers):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1))
            total = total + F.shiftleft(one.cast("bigint"), bit * len(numbers) + place)
    return total


def point_steps(documents: DataFrame, points: tuple[str, ...]) -> dict[str, list]:
    """For each point field the quantiles that cut it into steps; reads those columns alone.

    A single field needs no steps: it is an order.
    """
    points = [p for p in points if isinstance(documents.schema[p].dataType, NUMBERS)]
    points = points[: 62 // BITS]
    if len(points) < 2:
        return {p: [] for p in points}
    at = [i / (1 << BITS) for i in range(1, 1 << BITS)]
    found = documents.agg(*(F.percentile_approx(p, at, ACCURACY).alias(p) for p in points)).first()
    return {p: sorted(set(found[p] or [])) for p in points}


def in_point_order(documents: DataFrame, steps: dict[str, list]) -> DataFrame:
    """Documents of a task, folder by folder in the Z-order of their points.

    A folder's row groups then hold narrow ranges of every point, so a range search skips
    those outside.  The steps are quantiles, so each of them holds as many documents.
    """
    numbers = [step_number(F.col(p), at) for p, at in steps.items()]
    order = [interleaved(numbers)] if len(steps) > 1 else [F.col(p) for p in steps]
    return documents.sortWithinPartitions("chunk", *order)


def range_documents(index: Index, **ranges: tuple) -> DataFrame:
    """(doc_id, exact and point columns) of the documents within all the closed ranges.

    A range is ``field=(low, high)`` of a point field; None leaves a side open.  The tests
    reach the files, and row groups outside a range are skipped.
    """
    for field in ranges:
        if field not in index.spec.points:
            raise ValueError(f"{field!r} is no point field")
    found = index.documents
    for field, (low, high) in ranges.items():
        found = found.filter(between(F.col(field), low, high))
    return found.select("doc_id", *index.spec.exact, *index.spec.points)
