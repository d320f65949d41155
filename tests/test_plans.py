"""The plans that the scale of the data depends on."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import termloom as tl
from termloom.functions.metadata import between
from termloom.operators import index
from termloom.sinks import index_store
from termloom.session import new_path
from tests.test_operators import SPEC, docs


@pytest.fixture(scope="module")
def stored(spark):
    return tl.write_index(docs(spark), SPEC, new_path(spark, "plans"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def every_plan(found):
    yield found.postings
    yield tl.doc_freq(found)
    yield tl.all_field_stats(found)
    yield tl.vocabulary(found)
    yield tl.postings_with_df(found, "contents")
    yield tl.best_terms(found, 0, "contents", 5, "tfxidf")
    yield tl.best_terms_all_docs(found, "contents", 5, "tf")
    yield tl.best_terms_all_docs(found, "contents", 5, "tfxidf")
    yield tl.similar_terms(found, "contents", "apple", 5, "tfxidf")
    yield tl.term_weights(found, "contents", "tfxidf")


def test_no_cross_join_and_no_python(stored, spark):
    for found in (stored, tl.build_index(docs(spark), SPEC)):
        for df in every_plan(found):
            text = plan(df)
            for word in ("CartesianProduct", "BroadcastNestedLoop", "EvalPython", "InPandas"):
                assert word not in text


def test_postings_need_no_shuffle(stored, spark, tmp_path):
    docs(spark).write.parquet(str(tmp_path / "docs"))
    table = spark.read.parquet(str(tmp_path / "docs"))
    lazy = tl.build_index(table, SPEC)
    assert "Exchange" not in plan(lazy.postings)
    assert plan(tl.all_field_stats(lazy)).count("Exchange hashpartitioning") == 0


def test_cosine_sums_shuffle_once(stored):
    text = plan(tl.cosine_dot(stored, "contents", "apple", "tf"))
    assert text.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in text


def test_only_the_needed_columns_are_read(stored):
    text = plan(tl.cosine_dot(stored, "contents", "apple", "tf"))
    assert "ReadSchema: struct<doc_id:bigint,contents:struct<length:bigint,terms:array<string>,tfs:array<bigint>>>" in text
    text = plan(tl.term_norms(stored, "contents", "bin"))
    assert "ReadSchema: struct<term:string,df:bigint>" in text


def test_lookups_are_pushed_down(stored):
    text = plan(tl.postings_lookup(stored, "contents", "apple"))
    assert "EqualTo(term,apple)" in text
    assert "PartitionFilters" in text and "field" in text.split("PartitionFilters")[1]
    assert "EqualTo(doc_id,0)" in plan(tl.term_vector(stored, 0, "contents"))


def folders_read(df):
    """(folders a pruned scan of documents read, folders there are) once ``df`` has run."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text
    scans, stack = [], [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            stack.append(node.plan())
            continue
        if "chunk" in node.toString().split("\n")[0] and "terms" in node.toString().split("\n")[0]:
            if node.metrics().contains("numPartitions"):
                scans.append(node.metrics().apply("numPartitions").value())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return max(scans)


@pytest.mark.parametrize("df", [30, 1000])
def test_cosines_read_only_the_folders_in_the_postings(spark, monkeypatch, df):
    """Documents with the term lie together; the folders of all others are skipped."""
    monkeypatch.setattr(index_store, "CHUNK_DOCS", 128)
    n = 4096
    word = F.when(F.col("id") < df, F.lit("seldom common")).otherwise(F.lit("common other"))
    rows = spark.range(0, n, 1, 4).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("p"), "id").alias("path"), F.lit("en").alias("lang"),
        F.col("id").alias("size"), word.alias("contents"),
    )
    found = tl.write_index(rows, SPEC, new_path(spark, "folders"))
    assert found.pieces[0].documents.select("chunk").distinct().count() == n // 128
    dots = tl.cosine_dot(found, "contents", "seldom", "tf")
    assert folders_read(dots) == -(-df // 128)
    assert {r["term"]: r["dot"] for r in dots.collect()} == {"seldom": df, "common": df}


def test_ranges_are_pushed_down(stored):
    text = plan(stored.documents.filter(between(F.col("size"), 1, 2)).select("path"))
    assert "GreaterThanOrEqual(size,1), LessThanOrEqual(size,2)" in text


def test_field_statistics_of_a_stored_index_read_the_manifest_alone(stored):
    text = plan(tl.all_field_stats(stored))
    assert text.count("FileScan") == 1 and "struct<generation:bigint,batches:" in text


def test_top_k(stored):
    assert "TakeOrderedAndProject" in plan(tl.best_terms(stored, 0, "contents", 5, "tf"))
    assert "TakeOrderedAndProject" in plan(tl.similar_terms(stored, "contents", "a", 5, "tf"))
    assert "WindowGroupLimit" in plan(tl.best_terms_all_docs(stored, "contents", 5, "df"))


def test_frequency_order_cuts_before_it_joins(stored):
    assert "Window" not in plan(tl.best_terms_all_docs(stored, "contents", 5, "tf"))


def test_a_large_vocabulary_is_not_broadcast_whole(stored, monkeypatch):
    monkeypatch.setattr(index, "BROADCAST_ROWS", 3)
    text = plan(tl.postings_with_df(stored, "contents"))
    assert "LeftAnti" in text and "Union" in text


@pytest.mark.parametrize("order", ["tf", "df", "tfxidf"])
def test_best_terms_join_before_parts_are_summed(spark, order):
    path = new_path(spark, "two-batches")
    tl.write_index(docs(spark), SPEC, path)
    more = docs(spark, ["banana banana", "apple cherry"], first_id=10, paths=["x", "y"])
    found = tl.write_index(more, SPEC, path, "append")
    below_the_join = plan(tl.best_terms(found, 0, "contents", 2, order)).split("BroadcastHashJoin", 1)[1]
    assert "Exchange hashpartitioning" not in below_the_join
    best = {r["term"]: r["df"] for r in tl.best_terms(found, 0, "contents", 2, order).collect()}
    assert best == {"banana": 5, "apple": 3}
