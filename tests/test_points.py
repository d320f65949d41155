"""Range search over the points of an index."""

from __future__ import annotations

import random

import pyarrow.parquet as pq
import pytest

import termloom as tl
from termloom.operators import points
from termloom.session import new_path
from termloom.sinks import index_store

SPEC = tl.IndexSpec(text=("contents",), exact=("path",), points=("size", "age"))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    return [
        (k, f"p{k}", "some words here", rng.randrange(10_000), None if k % 50 == 0 else rng.random())
        for k in range(6000)
    ]


@pytest.fixture(scope="module")
def stored(spark, rows):
    patch = pytest.MonkeyPatch()
    patch.setattr(index_store, "ROW_GROUP_BYTES", 4096)
    docs = spark.createDataFrame(rows, "doc_id long, path string, contents string, size long, age double")
    found = tl.write_index(docs.repartition(2), SPEC, new_path(spark, "points"))
    patch.undo()
    return found


@pytest.mark.parametrize(
    "wanted",
    [
        {"size": (100, 700)}, {"age": (0.9, None)}, {"size": (5000, 6000), "age": (0.2, 0.3)},
        {"size": (None, None)}, {"size": (20_000, None)}, {"size": (3, 3)},
    ],
)
def test_brute_force(stored, rows, wanted):
    def inside(value, ends):
        low, high = ends
        if ends == (None, None):
            return True
        return value is not None and (low is None or value >= low) and (high is None or value <= high)

    want = [r for r in rows if inside(r[3], wanted.get("size", (None, None))) and inside(r[4], wanted.get("age", (None, None)))]
    got = tl.range_documents(stored, **wanted).collect()
    assert sorted((r["doc_id"], r["path"], r["size"], r["age"]) for r in got) == sorted((r[0], r[1], r[3], r[4]) for r in want)


def test_row_groups_outside_a_range_are_skipped(stored):
    files = {f.removeprefix("file://") for f in stored.pieces[0].documents.inputFiles()}
    for field, low, high in (("size", 5000, 5600), ("age", 0.5, 0.56)):
        hit = total = 0
        for file in files:
            meta = pq.ParquetFile(file).metadata
            place = [meta.schema.column(i).path for i in range(meta.num_columns)].index(field)
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(place).statistics
                total += 1
                hit += stats.has_min_max and stats.min <= high and stats.max >= low
        assert total >= 20 and hit <= total / 2, (field, hit, total)
    text = tl.range_documents(stored, size=(5000, 5600))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(size,5000), LessThanOrEqual(size,5600)" in text
    assert "terms" not in text.split("ReadSchema")[1]


def test_wrong_fields_and_lazy_indexes(spark, stored, rows):
    with pytest.raises(ValueError, match="no point field"):
        tl.range_documents(stored, path=(1, 2))
    docs = spark.createDataFrame(rows[:10], "doc_id long, path string, contents string, size long, age double")
    lazy = tl.build_index(docs, SPEC)
    assert tl.range_documents(lazy, size=(0, 10_000)).count() == 10


def test_bits_in_turn(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(5, 3), (0, 0), (63, 63)], "a int, b int")
    got = [r[0] for r in rows.select(points.interleaved([F.col("a"), F.col("b")])).collect()]
    assert got == [0b011011, 0, (1 << 12) - 1]
