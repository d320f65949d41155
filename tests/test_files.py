from __future__ import annotations

import os

import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import termloom as tl
from termloom.session import new_path
from termloom.sources import files


@pytest.fixture
def tree(tmp_path):
    (tmp_path / "sub.d").mkdir()
    content = {
        "a.txt": b"Apple banana\napple\nend",
        "b.py": b"print",
        "sub.d/c.txt": b"x" * 3500,
        "sub.d/plain": "café ÿ".encode() + b"\xff!",
        "empty.txt": b"",
        "D.TXT": b"upper",
    }
    for name, text in content.items():
        (tmp_path / name).write_bytes(text)
    os.utime(tmp_path / "a.txt", (1577836799, 1577836799))
    return str(tmp_path)


def names(df):
    return sorted(r["path"].rsplit("/", 1)[1] for r in df.select("path").collect())


def test_scan_is_recursive_and_has_metadata(spark, tree):
    found = tl.scan_files(spark, tree)
    assert names(found) == ["D.TXT", "a.txt", "b.py", "c.txt", "empty.txt", "plain"]
    rows = {r["path"].rsplit("/", 1)[1]: r for r in found.collect()}
    a = rows["a.txt"]
    assert (a["modified"], a["modified_str"]) == (1577836799000, "1577836799000")
    assert a["last_modified"] == "31/12/2019 23:59:59"
    assert a["last_modified_sortable"] == "20191231235959"
    assert (rows["c.txt"]["size_kb"], rows["c.txt"]["size_kb_str"]) == (3.0, "3.0")
    assert rows["plain"]["contents"] == "café ÿ�!"
    assert len({r["doc_id"] for r in rows.values()}) == 6
    assert rows["empty.txt"]["contents"] == ""


def test_single_file_and_missing_root(spark, tree):
    assert names(tl.scan_files(spark, f"{tree}/b.py")) == ["b.py"]
    with pytest.raises(AnalysisException):
        tl.scan_files(spark, [tree, f"{tree}/none"]).count()
    with pytest.raises(ValueError):
        tl.scan_files(spark, [])


def test_hidden_and_empty_files_are_documents(spark, tmp_path):
    for name in ("a.py", "pkg/__init__.py", "pkg/_private.py", ".hidden.py", "empty.py", "_pkg/x.py"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"" if name == "empty.py" else name.encode())
    found = tl.scan_files(spark, str(tmp_path), only_extensions=[".py"])
    assert {r["contents"] for r in found.select("contents").collect()} == {
        "a.py", "pkg/__init__.py", "pkg/_private.py", ".hidden.py", "", "_pkg/x.py"
    }
    assert found.count() == 6
    one = tl.scan_files(spark, f"{tmp_path}/pkg/__init__.py").collect()
    assert [r["contents"] for r in one] == ["pkg/__init__.py"]
    uri = tl.scan_files(spark, f"file://{tmp_path}/_pkg")
    assert names(uri) == ["x.py"] and uri.first()["path"].startswith("file:/")


def test_several_roots_are_not_compared(spark, tree):
    found = tl.scan_files(spark, [tree, f"{tree}/sub.d"])
    assert names(found).count("c.txt") == 2
    assert found.select("doc_id").distinct().count() == found.count() == 8


@pytest.mark.parametrize(
    ("extensions", "kept"),
    [
        ([".txt"], ["a.txt", "c.txt", "empty.txt"]),
        ([".txt", ".py"], ["a.txt", "b.py", "c.txt", "empty.txt"]),
        ([".d/plain"], ["plain"]),
        ([], []),
    ],
)
def test_extension_filter(spark, tree, extensions, kept):
    assert names(tl.scan_files(spark, tree, only_extensions=extensions)) == kept


def test_line_window_of_files(spark, tree):
    found = tl.scan_files(spark, f"{tree}/a.txt", top_lines=1, bottom_lines=1)
    assert found.first()["contents"] == "Apple banana\nend\n"


def test_unreadable_files_are_left_out(spark, tree):
    found = tl.scan_files(spark, tree)
    assert found.columns
    os.remove(f"{tree}/b.py")
    assert "b.py" not in names(found.filter(F.col("contents").isNotNull()))


def test_files_to_index_and_update(spark, tree):
    path = new_path(spark, "files")
    found = tl.write_index(tl.scan_files(spark, tree), tl.FILE_SPEC, path)
    stats = {r["field"]: r for r in tl.all_field_stats(found).collect()}
    assert stats["path"]["doc_count"] == stats["contents"]["max_doc"] == 6
    assert stats["contents"]["doc_count"] == 5
    with open(f"{tree}/b.py", "w") as file:
        file.write("changed text")
    again = tl.scan_files(spark, tree, only_extensions=[".py"])
    found = tl.write_index(again, tl.FILE_SPEC, path, "append", update=True)
    rows = found.documents.filter(F.col("path").endswith("b.py")).select("contents.terms").collect()
    assert [r["terms"] for r in rows] == [["changed", "text"]]
    assert found.documents.count() == 6


def test_every_file_is_accounted_for(spark, tree, monkeypatch):
    monkeypatch.setattr(files, "LISTED_ROWS", 4)
    monkeypatch.setattr(files, "TASK_FILES", 10)
    os.makedirs(f"{tree}/flat")
    for k in range(50):
        with open(f"{tree}/flat/{k}.txt", "w") as file:
            file.write("x" * k)
    found = files.scan_accounted(spark, tree)
    os.remove(f"{tree}/b.py")
    os.remove(f"{tree}/flat/7.txt")
    os.remove(f"{tree}/flat/8.txt")
    os.makedirs(f"{tree}/flat/8.txt")  # no longer a file
    rows = {r["path"].rsplit("/", 1)[1]: r for r in found.collect()}
    assert len(rows) == 56 and found.rdd.getNumPartitions() > 4
    status = {name: r["status"] for name, r in rows.items()}
    assert (status.pop("b.py"), status.pop("7.txt")) == ("vanished", "vanished")
    assert status.pop("8.txt") in ("failed", "vanished", "denied")
    assert set(status.values()) == {"read"}
    assert rows["b.py"]["content"] is None and rows["9.txt"]["content"] == b"x" * 9
    counts = {r["status"]: r["n_files"] for r in files.skipped_files(found).collect()}
    assert counts["read"] == 53 and sum(counts.values()) == 56
    only = files.scan_accounted(spark, [tree], only_extensions=[".TXT"])
    assert [r["content"] for r in only.collect()] == [b"upper"]
    with pytest.raises(FileNotFoundError):
        files.scan_accounted(spark, f"{tree}/none")


def test_what_keeps_a_file_from_being_read(monkeypatch):
    class Refusing:
        def __init__(self, error):
            self.error = error

        def open_input_stream(self, _):
            raise self.error

    errors = {"a": FileNotFoundError(), "b": PermissionError(), "c": OSError()}
    monkeypatch.setattr(files, "_opened", lambda path: (Refusing(errors[path]), path, ""))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(list(errors)), pa.array([1, 2, 3]), pa.array([0, 0, 0], pa.timestamp("us"))],
        ["path", "length", "modificationTime"],
    )
    got = [b.to_pylist()[0] for b in files._read(iter([batch]))]
    assert [(r["status"], r["content"]) for r in got] == [("vanished", None), ("denied", None), ("failed", None)]


def test_a_large_file_leaves_python_in_pieces(spark, tree, monkeypatch):
    """No batch holds more than a piece, and the rows are those of files read whole."""
    rows = lambda: sorted(map(str, files.scan_accounted(spark, tree).collect()))
    whole = rows()
    monkeypatch.setattr(files, "PIECE_BYTES", 6)
    assert rows() == whole
    listing = pa.RecordBatch.from_pylist(
        [{"path": f"{tree}/{n}", "length": 9, "modificationTime": None} for n in ("sub.d/c.txt", "empty.txt", "none")]
    )
    got = [b.to_pylist()[0] for b in files._pieces(iter([listing]))]
    assert max(len(r["content"] or b"") for r in got) == 6
    assert b"".join(r["content"] for r in got if "c.txt" in r["path"]) == b"x" * 3500
    assert [(r["content"], r["status"], r["piece"]) for r in got[-2:]] == [(b"", "read", 0), (None, "vanished", 0)]


def test_a_file_that_fails_half_way_has_no_content(spark):
    rows = [("a", 2, b"cd", "read"), ("a", 0, b"ab", "read"), ("a", 3, None, "failed"), ("b", 1, b"z", "read"), ("b", 0, b"\xffy", "read")]
    given = spark.createDataFrame(rows, "path string, piece bigint, content binary, status string")
    timed = given.select("*", F.lit(None).cast("timestamp").alias("modificationTime"), F.lit(1).cast("bigint").alias("length"))
    got = {r["path"]: (r["content"], r["status"]) for r in files._joined(timed).collect()}
    assert got == {"a": (None, "failed"), "b": (b"\xffyz", "read")}
