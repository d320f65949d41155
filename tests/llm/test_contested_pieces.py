"""Only snippets that an earlier document may share a string with are sorted."""

import pyarrow as pa
import pytest

from termloom.llm import suffixdedup

ROWS = [
    (3, b"c" * 40, 8), (1, b"a" * 60, 5), (2, b"b" * 60, 4), (3, b"d" * 50, 7), (2, b"e" * 70, 4), (5, b"f" * 10, 9),
    (-4, b"g" * 55, 1), (-4, b"h" * 51, 2), (-4, b"i" * 52, 1), (3, b"j" * 53, 7), (9, b"k" * 54, 2), (9, b"l" * 54, 3),
]
CONTESTED = sorted(r for r in ROWS if r[0] in (3, -4, 9))


def table(rows):
    piece, snippet, doc = (list(x) for x in zip(*rows, strict=True))
    key = pa.array(range(len(rows)), pa.int64())
    return pa.table({"piece": pa.array(piece, pa.int64()), "snippet": snippet, "snippet_key": key, "doc_id": doc})


@pytest.mark.parametrize("size", [1, 100, 150, 200, 300, 10_000])
def test_pieces_of_one_document_are_left_out(monkeypatch, size):
    monkeypatch.setattr(suffixdedup, "SHARD_BYTES", size)
    shards = [s.to_pylist() for s in suffixdedup._contested(table(ROWS))]
    rows = [(r["piece"], r["snippet"], r["doc_id"]) for s in shards for r in s]
    assert sorted(rows) == CONTESTED
    # A piece is in one shard.
    assert sum(len({r["piece"] for r in s}) for s in shards) == 3
    assert all(len({r["piece"] for r in s}) == 1 or sum(len(r["snippet"]) for r in s) <= 2 * size for s in shards)


def test_nothing_to_sort():
    assert list(suffixdedup._contested(table([r for r in ROWS if r[0] not in (3, -4, 9)]))) == []
