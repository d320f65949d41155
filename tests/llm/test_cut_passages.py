"""Texts without benchmark passages, against a plain version."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

from termloom.llm import decontaminate
from termloom.sources.tables import read_table
from tests.llm.plain import UPPER

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEM = " ".join(f"w{k}" for k in range(20))
TEXTS = [
    (1, f"Before it: {ITEM.upper()}, after it."),
    (2, "x " * 500 + ITEM + " é漢 y" * 3 + "! "),
    (3, None),
    (4, ""),
    (5, " ?! "),
    (6, f"({ITEM}) {ITEM}... {' '.join(['z'] * 900)} kurz und gut -- " + " \n" * 50),
    (7, "a kurz und gut b"),
    (8, "v " * 100 + "Kurz, und: gut; " + "v " * 100),
    (None, f"no id {ITEM}"),
    (7, "clean text of a repeated id"),
    (1, f"Before it: {ITEM.upper()}, after it."),
    (9, ITEM),
    (10, "😀 " + ITEM[3:] + " 😀é tail"),
]
ITEMS = [(1, ITEM), (2, "kurz und gut"), (3, None), (4, "")]


def plain_cut(text, items, window, least_words, least_share):
    """The text by marking words one window at a time."""
    if text is None:
        return None
    found = list(WORD.finditer(text.translate(UPPER)))
    words = [m.group() for m in found]
    hit = [False] * len(words)
    for item in items:
        seq = WORD.findall((item or "").translate(UPPER))
        n = min(window, len(seq))
        for k in range(len(seq) - n + 1 if n else 0):
            for at in range(len(words) - n + 1):
                if words[at : at + n] == seq[k : k + n]:
                    hit[at : at + n] = [True] * n
    every = least_share is not None and sum(hit) > 0 and sum(hit) / len(words) >= least_share
    out, k = text[: found[0].start()] if found else text, 0
    while k < len(words):
        end = k + 1
        while end < len(words) and hit[end] == hit[k]:
            end += 1
        gone = hit[k] and (every or (least_words is not None and end - k >= least_words))
        stop = found[end].start() if end < len(words) else len(text)
        out += "" if gone else text[found[k].start() : stop]
        k = end
    return out


@pytest.mark.parametrize("limits", [(13, 0.05), (13, None), (None, 0.05), (3, None), (None, None), (1, 1.0)])
@pytest.mark.parametrize("blocks", ["one", "several"])
def test_cut_texts(spark, monkeypatch, limits, blocks):
    if blocks == "several":
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 16)
    docs = spark.createDataFrame(
        [(i, t, k, "c") for k, (i, t) in enumerate(TEXTS)], "doc_id bigint, text string, spans int, `units.x` string"
    )
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = decontaminate.cut_passages(docs, items, 13, *limits)
    assert found.columns == docs.columns
    got = {r["spans"]: (r["doc_id"], r["text"], r["units.x"]) for r in found.collect()}
    want = {k: (i, plain_cut(t, [x for _, x in ITEMS], 13, *limits), "c") for k, (i, t) in enumerate(TEXTS)}
    assert got == want
    assert found.count() == len(TEXTS)


def test_nothing_to_cut(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert sorted(decontaminate.cut_passages(docs, none).collect(), key=str) == sorted(docs.collect(), key=str)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert decontaminate.cut_passages(docs.limit(0), items).count() == 0


@pytest.mark.skipif(not Path(SF).exists(), reason="no tables")
def test_no_long_span_is_left(spark):
    """On the given tables, what is left has no passage of a benchmark item that was cut whole."""
    docs = read_table(spark, SF, "documents")
    items = read_table(spark, SF, "benchmark")
    before = decontaminate.benchmark_hits(docs, items)
    touched = decontaminate.removable(before).count()
    cut = decontaminate.cut_passages(docs, items)
    after = decontaminate.removable(decontaminate.benchmark_hits(cut, items)).count()
    changed = cut.withColumnRenamed("text", "new").join(docs, "doc_id").filter("not (text <=> new)").count()
    assert (changed, after) == (touched, 0)
