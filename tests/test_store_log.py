"""What a write costs: hidden documents, the log of statistics, merges by name, expiry."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import termloom as tl
from termloom.operators import ranges
from termloom.session import list_folder, new_path, path_exists, qualified, staging, stage
from termloom.sinks import index_store
from tests.test_operators import SPEC, docs, pairs
from tests.test_store import consistent, contents


def files_below(path):
    path = path.removeprefix("file:")
    return {
        os.path.join(folder, name): os.path.getsize(os.path.join(folder, name))
        for folder, _, names in os.walk(path)
        for name in names
        if name.endswith(".parquet")
    }


def many(spark, n, word="w"):
    row = [F.col("id").alias("doc_id"), F.concat(F.lit("p"), "id").alias("path"), F.lit("en").alias("lang"),
           F.col("id").alias("size")]
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(30)), lambda k: F.concat(F.lit(word), F.col("id") * 7 % 1000 + k)), " ")
    return spark.range(0, n, 1, 2).select(*row, text.alias("contents"))


def test_replacing_a_document_writes_in_proportion_to_it(spark):
    path = new_path(spark, "upsert")
    tl.write_index(many(spark, 5000), SPEC, path)
    before = files_below(path)
    one = many(spark, 1, "new").withColumn("path", F.lit("p77"))
    found = tl.write_index(one, SPEC, path, "append", update=True)
    after = files_below(path)
    assert before.items() <= after.items()  # nothing that was there is touched
    tables = ("/documents/", "/postings/", "/term_stats/", "/hidden/")
    new = sum(size for f, size in after.items() if f not in before and any(t in f for t in tables))
    old = sum(size for f, size in before.items() if any(t in f for t in tables))
    assert new < 30_000 < old / 15
    manifest = index_store.read_manifest(spark, path)
    assert [(b["n_docs"], b["n_hidden"]) for b in manifest.batches] == [(4999, 1), (1, 0)]
    assert [h["n_rows"] for h in manifest.hidden] == [1]
    consistent(found)
    assert found.documents.filter("path = 'p77'").select("contents.terms").first()[0][0] == "new1"
    assert pairs(tl.term_vector(found, 77, "contents")) == []


def test_a_batch_with_more_replaced_than_left_is_written_anew(spark):
    path = new_path(spark, "rewrite")
    tl.write_index(docs(spark, ["a b", "a c", "a d", "a e"]), SPEC, path)
    first = index_store.read_manifest(spark, path).batches[0]["name"]
    new = docs(spark, ["x", "y"], ["p1", "p2"])
    found = tl.write_index(new, SPEC, path, "append", update=True)
    consistent(found)
    assert index_store.read_manifest(spark, path).batches[0]["name"] == first
    found = tl.write_index(docs(spark, ["z"], ["p0"]), SPEC, path, "append", update=True)
    consistent(found)
    manifest = index_store.read_manifest(spark, path)
    assert first not in manifest.names() and all(b["n_hidden"] == 0 for b in manifest.batches)
    assert contents(found) == [("p0", ["z"]), ("p1", ["x"]), ("p2", ["y"]), ("p3", ["a", "e"])]


def grown(sizes, merged):
    """The log after parts of the given sizes, merges giving ``merged`` of the rows."""
    from pyspark.sql import Row

    log = ()
    for size in sizes:
        kept, last = index_store.log_parts((*log, Row(n_rows=size)))
        log = (*kept, Row(n_rows=max(1, int(merged * sum(p["n_rows"] for p in last))))) if last else kept
    return [p["n_rows"] for p in log]


@pytest.mark.parametrize("merged", [1.0, 0.6])
@pytest.mark.parametrize("sizes", [[1] * 50, [100] * 50, list(range(1000, 950, -1)), [1000] + [1] * 49, [0, 5, 0]])
def test_the_log_of_statistics_stays_logarithmic(sizes, merged):
    log = grown(sizes, merged)
    assert len(log) <= max(1, sum(sizes)).bit_length()
    assert all(a > 2 * b for a, b in zip(log, log[1:]))


def test_fifty_appends_leave_few_parts(spark):
    """The manifests of fifty small writes, the tables of the last ones."""
    path = new_path(spark, "appends")
    for k in range(6):
        found = tl.write_index(docs(spark, [f"t{k} common"], [f"q{k}"]), SPEC, path, "create_or_append")
    assert len(index_store.read_manifest(spark, path).stats) <= 3
    consistent(found)


def test_a_merge_is_one_manifest(spark):
    parts = [new_path(spark, "part") for _ in range(3)]
    for k, part in enumerate(parts):
        tl.write_index(docs(spark, [f"a{k} common", "common b"], [f"x{k}", f"y{k}"]), SPEC, part)
    tl.write_index(docs(spark, ["changed"], ["y1"]), SPEC, parts[1], "append", update=True)
    path = new_path(spark, "merged")
    merged = tl.merge_indexes(spark, parts, path)
    assert [f.name for f in list_folder(spark, path)] == ["manifest"]
    consistent(merged)
    ids = {r["path"]: r["doc_id"] for r in merged.documents.select("path", "doc_id").collect()}
    assert pairs(tl.term_vector(merged, ids["y1"], "contents")) == [("changed", 1)]
    assert dict(pairs(tl.cosine_dot(merged, "contents", "common", "tf")))["common"] == 5
    # It can be updated, and merged again, as any other.
    again = tl.write_index(docs(spark, ["later"], ["x0"]), SPEC, path, "append", update=True)
    consistent(again)
    assert ("x0", ["later"]) in contents(again)
    twice = tl.merge_indexes(spark, [path, parts[0]], new_path(spark, "twice"))
    consistent(twice)
    assert twice.documents.count() == 8
    # The lenders keep what the merged indexes read.
    tl.write_index(docs(spark, ["other"]), SPEC, parts[0])
    tl.expire(spark, parts[0], older_than_s=-1)
    consistent(tl.read_index(spark, path))


def test_the_slower_of_two_writers_fails(spark, monkeypatch):
    path = new_path(spark, "race")
    tl.write_index(docs(spark, ["a"], ["p"]), SPEC, path)
    inner = index_store.write_term_stats

    def slow(*args):
        monkeypatch.undo()
        tl.write_index(docs(spark, ["first"], ["q"]), SPEC, path, "append")
        return inner(*args)

    monkeypatch.setattr(index_store, "write_term_stats", slow)
    with pytest.raises(tl.ConcurrentWriteError):
        tl.write_index(docs(spark, ["second"], ["r"]), SPEC, path, "append")
    found = tl.read_index(spark, path)
    assert contents(found) == [("p", ["a"]), ("q", ["first"])]
    consistent(found)


def test_expiry_keeps_the_newest_and_the_young(spark):
    path = new_path(spark, "expire")
    for text in ("one", "two"):
        found = tl.write_index(docs(spark, [text]), SPEC, path)
    assert tl.expire(spark, path) == []
    gone = tl.expire(spark, path, older_than_s=-1)
    assert len(gone) == 4  # a manifest, documents, postings and statistics
    assert not any(path_exists(spark, p) for p in gone)
    assert contents(found) == [("p0", ["two"])] and tl.expire(spark, path, older_than_s=-1) == []
    consistent(tl.read_index(spark, path))


def test_staged_tables_go_with_their_scope(spark):
    with staging(spark):
        kept = stage(spark.range(3).toDF("n"), "scope")
        folder = os.path.dirname(kept.inputFiles()[0])
        assert kept.count() == 3 and path_exists(spark, folder)
    assert not path_exists(spark, folder)
    assert qualified(spark, folder).startswith("file:")


@pytest.mark.parametrize("n", [0, 1, 3, 64, 65, 200, 5000])
def test_range_numbers(spark, n):
    bounds = sorted({("f" if k % 3 else "g", f"t{k * 37 % 101:03d}", k) for k in range(n)})
    keys = [("e", "x", 0), ("f", "t050", 7), ("g", "t000", 0), ("h", "", 1), *bounds[:: max(1, n // 40)]]
    rows = spark.createDataFrame(keys, "field string, term string, doc_id bigint")
    got = {tuple(r)[:3]: r["k"] for r in rows.withColumn("k", ranges.range_number(bounds, "field", "term", "doc_id")).collect()}
    assert got == {key: sum(b <= key for b in bounds) for key in keys}


def test_postings_explode_once(spark, monkeypatch):
    """Ranges come from a sample, so the documents are exploded in one plan, once."""
    plans = []
    inner = index_store.write_postings
    monkeypatch.setattr(index_store, "LEAST_ROWS", 100)

    def seen(postings, *rest):
        plans.append(postings._jdf.queryExecution().executedPlan().toString())
        inner(postings, *rest)

    monkeypatch.setattr(index_store, "write_postings", seen)
    found = tl.write_index(many(spark, 500), SPEC, new_path(spark, "once"))
    assert "rangepartitioning" not in plans[0] and plans[0].count("FileScan") == 1
    assert len({r[0] for r in found.pieces[0].postings.select(F.input_file_name()).distinct().collect()}) > 4
    consistent(found)
