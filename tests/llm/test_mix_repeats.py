"""Rows are repeated as ``mix`` takes them, and stay where they are."""

from collections import Counter, defaultdict

import pytest

from termloom.llm import mixing, stages
from termloom.session import stage


def documents(spark, rows):
    schema = "doc_id bigint, text string, source string, times_ int"
    # A real table: its size is known, so a plan that would move it shows.
    return stage(spark.createDataFrame(rows, schema), "test-mix")


def odd_rows():
    rows = [(i, "w " * (1 + i * 7 % 5), "abc"[i % 3] if i % 11 else None, i) for i in range(400)]
    rows += [(i, "w " * (1 + i % 4), "c", -1) for i in range(0, 60, 2)]  # other sources and sizes
    rows += [(i, "w " * (1 + i * 7 % 5), "abc"[i % 3], -2) for i in range(60, 90)]  # the same again
    return rows + [(None, "w " * (i % 6), "b", -3) for i in range(9)] + [(500, None, "a", -4), (501, "", None, -5)]


@pytest.mark.parametrize("part_rows", [4096, 4])
def test_as_often_as_the_mix_takes_the_id(spark, monkeypatch, part_rows):
    monkeypatch.setattr(mixing, "PART_ROWS", part_rows)
    rows = odd_rows()
    docs = documents(spark, rows)
    most = defaultdict(int)
    for r in mixing.mix(docs).collect():
        most[r["doc_id"]] = max(most[r["doc_id"]], r["copies"])
    assert len(set(most.values())) > 1
    wanted = Counter()
    for row in rows:
        wanted[row] += most[row[0]]
    found = stages.mix_sources(spark, docs, "")
    assert found.columns == docs.columns
    assert Counter(tuple(r) for r in found.collect()) == +wanted


def test_texts_are_not_shuffled(spark):
    had = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")  # the ids of larger tables are beyond any such
    try:
        found = stages.mix_sources(spark, documents(spark, odd_rows()), "")
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", had)
    assert "Exchange hashpartitioning" not in plan


def test_empty(spark):
    assert stages.mix_sources(spark, documents(spark, []), "").count() == 0
