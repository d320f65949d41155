"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from termloom.plans import oracle
from termloom.plans import queries as registry
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(registry.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    query, sql = entry.queries()[name], entry.oracle_sql()[name]
    assert compare(spark, con, SF_DIR, name, query, sql) is None


def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns == ["doc_id", "rank", "term", "tf", "df", "tfidf"]
    assert found.count() > 0


def test_each_query_of_the_updated_index_writes_it(spark, tmp_path, monkeypatch):
    from termloom.plans import queries

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    put("documents", [(1, "un chat", "fr", "s"), (2, "a dog", "en", "s")],
        "doc_id bigint, text string, lang string, source string")
    put("conversations", [(1, 0, "user", "hello")], "conv_id bigint, turn int, role string, text string")
    put("benchmark", [(1, "a dog")], "item_id bigint, text string")
    written, inner = [], queries.index_store.write_index

    def seen(docs, spec, path, *args, **kwargs):
        written.append(path)
        return inner(docs, spec, path, *args, **kwargs)

    monkeypatch.setattr(queries.index_store, "write_index", seen)
    for name in ("upsert_documents", "write_index_update"):
        found = queries.queries()[name](spark, str(tmp_path))
        terms = {(r["term"], r["tf"] if "tf" in found.columns else r["ttf"]) for r in found.collect()}
        assert ("revised", 1) in terms and ("dog", 1 if "tf" in found.columns else 2) in terms
    assert len(written) == 8 and len(set(written)) == 2
