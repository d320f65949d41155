"""Roots in other stores: mapped to a file system of Arrow, or an error."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyarrow import fs

import termloom as tl
from termloom.plans import queries
from termloom.sources import files


def test_hadoop_schemes_are_mapped(monkeypatch):
    asked = []

    def from_uri(uri):
        asked.append(uri)
        return fs.LocalFileSystem(), uri.split("://")[1]

    fake = SimpleNamespace(
        FileSystem=SimpleNamespace(from_uri=from_uri), LocalFileSystem=fs.LocalFileSystem,
        SubTreeFileSystem=fs.SubTreeFileSystem,
    )
    monkeypatch.setattr(files, "fs", fake)
    assert files._opened("s3a://bucket/a/b/")[1:] == ("bucket/a/b", "s3a://")
    account = "wasbs://box@acc.blob.core.windows.net"
    assert files._opened(f"{account}/a/b")[1:] == ("a/b", f"{account}/")
    assert asked == ["s3://bucket/a/b", "abfss://box@acc.dfs.core.windows.net/"]


def test_a_store_that_arrow_does_not_reach_is_an_error(spark, tmp_path):
    (tmp_path / "a.txt").write_text("seen")
    (tmp_path / "_b.txt").write_text("hidden")
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.here.link./in", f"file://{tmp_path}")
    with pytest.raises(ValueError, match="viewfs"):
        tl.scan_files(spark, "viewfs://here/in")


def test_documents_without_a_language_are_scanned(spark, tmp_path):
    rows = [(1, "one", "en"), (2, "deux", "fr"), (3, "none", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.q_scan_files(spark, str(tmp_path)).collect()
    assert {(r["lang"], r["term"], r["ttf"]) for r in found} == {("en", "one", 1), ("fr", "deux", 1), (None, "none", 1)}
