from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import termloom as tl
from termloom.sinks import index_store
from termloom.session import new_path
from tests.test_operators import SPEC, TEXTS, docs, pairs


@pytest.fixture
def path(spark):
    return new_path(spark, "test")


def contents(found):
    """path -> terms, from the stored documents."""
    rows = found.documents.select("path", "contents.terms").collect()
    return sorted(((r["path"], r["terms"]) for r in rows), key=str)


def consistent(found):
    """All tables of an index tell the same story."""
    derived = index_store.postings_of(found.documents, found.spec)
    assert sorted(pairs(found.postings)) == sorted(pairs(derived))
    stats = index_store.count_terms(derived)
    assert sorted(pairs(found.term_stats.select(*stats.columns))) == sorted(pairs(stats))
    ids = [r["doc_id"] for r in found.documents.select("doc_id").collect()]
    assert len(set(ids)) == len(ids)
    n_docs = found.documents.agg(F.count("*"), F.max(found.n_docs)).first()
    assert n_docs[0] == len(ids) and n_docs[1] in (len(ids), None)
    total = derived.groupBy("field").agg(F.sum("tf"), F.count("*"))
    kept = found.field_counts.select("field", "sum_total_term_freq", "sum_doc_freq")
    assert sorted(pairs(total)) == sorted(pairs(kept))


def test_create_replaces(spark, path):
    tl.write_index(docs(spark), SPEC, path)
    found = tl.write_index(docs(spark, ["new"]), SPEC, path, update=True)
    assert contents(found) == [("p0", ["new"])]
    consistent(found)


def test_append_needs_an_index_and_keeps_equal_keys(spark, path):
    with pytest.raises(ValueError, match="no index"):
        tl.write_index(docs(spark), SPEC, path, "append")
    with pytest.raises(ValueError, match="no index"):
        tl.read_index(spark, path)
    tl.write_index(docs(spark), SPEC, path)
    found = tl.write_index(docs(spark, ["again"]), SPEC, path, "append")
    assert [p for p, _ in contents(found)] == ["p0", "p0", "p1", "p2", "p3"]
    consistent(found)


def test_create_or_append(spark, path):
    tl.write_index(docs(spark, ["one"]), SPEC, path, "create_or_append")
    found = tl.write_index(docs(spark, ["two"]), SPEC, path, "create_or_append")
    assert contents(found) == [("p0", ["one"]), ("p0", ["two"])]
    consistent(found)


def test_update_replaces_by_key(spark, path):
    tl.write_index(docs(spark, ["a", "b"], ["p", "q"]), SPEC, path)
    tl.write_index(docs(spark, ["c"], ["s"]), SPEC, path, "append")
    new = docs(spark, ["b2", "d"], ["q", "r"])
    want = [("p", ["a"]), ("q", ["b2"]), ("r", ["d"]), ("s", ["c"])]
    found = tl.write_index(new, SPEC, path, "append", update=True)
    assert contents(found) == want
    consistent(found)
    found = tl.write_index(new, SPEC, path, "create_or_append", update=True)
    assert contents(found) == want
    consistent(found)


def test_update_rewrites_only_batches_it_touches(spark, path):
    tl.write_index(docs(spark, ["a"], ["p"]), SPEC, path)
    tl.write_index(docs(spark, ["b"], ["q"]), SPEC, path, "append")
    before = index_store.read_manifest(spark, path).batches
    tl.write_index(docs(spark, ["b2"], ["q"]), SPEC, path, "append", update=True)
    after = index_store.read_manifest(spark, path).batches
    assert [b["name"] for b in before][0] in [b["name"] for b in after]
    assert [b["name"] for b in before][1] not in [b["name"] for b in after]


def test_update_keeps_the_last_of_equal_new_keys(spark, path):
    tl.write_index(docs(spark, ["a"], ["p"]), SPEC, path)
    new = docs(spark, ["first", "last", "x", "y"], ["q", "q", None, None])
    found = tl.write_index(new, SPEC, path, "append", update=True)
    assert contents(found) == [
        ("p", ["a"]), ("q", ["last"]), (None, ["x"]), (None, ["y"])
    ]
    consistent(found)


def test_update_of_a_key_that_holds_most_documents(spark, path):
    tl.write_index(docs(spark, ["a"] * 50 + ["b"], ["hot"] * 50 + ["p"]), SPEC, path)
    found = tl.write_index(docs(spark, ["new"], ["hot"]), SPEC, path, "append", update=True)
    assert contents(found) == [("hot", ["new"]), ("p", ["b"])]
    consistent(found)


def test_merge_equals_one_pass_and_keeps_equal_keys(spark, path):
    parts = []
    for texts in (TEXTS[:2], TEXTS[2:]):
        parts.append(new_path(spark, "part"))
        tl.write_index(docs(spark, texts), SPEC, parts[-1])
    found = tl.merge_indexes(spark, parts, path)
    consistent(found)
    assert [p for p, _ in contents(found)] == ["p0", "p0", "p1", "p1"]
    one = tl.build_index(docs(spark), SPEC)
    stats = lambda ix: sorted(r for r in pairs(tl.doc_freq(ix)) if r[0] == "contents")
    assert stats(found) == stats(one)
    assert pairs(tl.field_stats(found, "contents")) == pairs(tl.field_stats(one, "contents"))
    more = tl.merge_indexes(spark, parts[:1], path, "append")
    assert len(contents(more)) == 6
    consistent(more)


def test_an_index_merged_in_twice_counts_twice(spark, path):
    part = new_path(spark, "part")
    tl.write_index(docs(spark, ["a b", "a c", "a d"], ["p", "q", "r"]), SPEC, part)
    found = tl.merge_indexes(spark, [part, part], path)
    consistent(found)
    assert {r["term"]: r["df"] for r in tl.doc_freq(found).collect()}["a"] == 6
    found = tl.write_index(docs(spark, ["a x"], ["q"]), SPEC, path, "append", update=True)
    assert [p for p, _ in contents(found)] == ["p", "p", "q", "r", "r"]
    consistent(found)


def test_wrong_use(spark, path):
    tl.write_index(docs(spark, ["a"]), SPEC, path)
    with pytest.raises(ValueError, match="mode"):
        tl.write_index(docs(spark), SPEC, path, "overwrite")
    other = tl.IndexSpec(text=("contents",), exact=("path",))
    with pytest.raises(ValueError, match="other fields"):
        tl.write_index(docs(spark), other, path, "append")
    with pytest.raises(ValueError, match="no index"):
        tl.merge_indexes(spark, [path, new_path(spark, "none")], path)
    with pytest.raises(ValueError, match="negative"):
        tl.write_index(docs(spark, first_id=-2), SPEC, path)


def test_a_write_that_dies_leaves_the_index_as_it_was(spark, path, monkeypatch):
    tl.write_index(docs(spark, ["a"]), SPEC, path)

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(index_store, "write_term_stats", fail)
    with pytest.raises(RuntimeError):
        tl.write_index(docs(spark, ["b"]), SPEC, path, "append")
    monkeypatch.undo()
    found = tl.read_index(spark, path)
    assert contents(found) == [("p0", ["a"])]
    consistent(found)


def test_empty_index(spark, path):
    found = tl.write_index(docs(spark).limit(0), SPEC, path)
    assert pairs(tl.vocabulary(found)) == [(f, None) for f in sorted(SPEC.fields)]
    assert pairs(tl.all_field_stats(found)) == []
    found = tl.write_index(docs(spark, ["a"]), SPEC, path, "append")
    assert contents(found) == [("p0", ["a"])]


def text_of(spark, path):
    """The files of a folder, in name order, as one text."""
    files = spark.read.format("binaryFile").load(path).orderBy("path")
    return "".join(r["content"].decode() for r in files.select("content").collect())


def test_vocabulary_listing(spark, path):
    tl.write_vocabulary(tl.build_index(docs(spark), SPEC), path)
    assert text_of(spark, f"{path}/field=contents") == (
        "Terms of field 'contents':\n3,000.5\na1\napple\nb\nbanana\ncan't\ncherry\n\n\n"
    )
    assert text_of(spark, f"{path}/field=size") == "Terms of field 'size':\n\n\n"


def test_best_terms_report(spark, path):
    found = tl.build_index(docs(spark), SPEC)
    for top in (5, 1):
        tl.write_best_terms(tl.best_terms(found, 0, "contents", top, "df"), path, top, "df")
    assert text_of(spark, path) == (
        "Top 1 terms ordered by 'df'\n\nterm='banana', tf=1, df=4, tfxidf=0.00\n"
    )
