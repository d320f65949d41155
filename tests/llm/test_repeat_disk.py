"""Repeats are found without moving all snippets, and what lies on disk for them goes on the way."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from termloom.llm import suffixdedup
from termloom.session import list_folder, path_exists, shared_folder
from tests.llm import plain

LINES = [" ".join(random.Random(i).choice(["ab", "cde", "fghi", "jk"]) for _ in range(20)) for i in range(12)]


def documents(n=60):
    draw = random.Random(3)

    def noise():
        return "".join(draw.choice("lmnopqrstuvw ") for _ in range(draw.choice([30, 120, 200])))

    rows = [(i, noise() + draw.choice(LINES) + noise() + draw.choice(LINES)) for i in range(n)]
    return rows + [(n, rows[4][1]), (n + 1, rows[5][1] + noise())]


def removed(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = suffixdedup.digest(suffixdedup.remove_repeats(docs)).collect()
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found}


@pytest.mark.parametrize("most", [0, 1 << 40])
def test_all_ways_to_the_snippets_give_the_same(spark, monkeypatch, most):
    monkeypatch.setattr(suffixdedup, "MAX_SHARED", most)
    monkeypatch.setattr(suffixdedup, "PART_PIECES", 1)
    monkeypatch.setattr(suffixdedup, "PARTS", 3)
    rows = documents()
    got = removed(spark, rows)
    assert got == plain.repeat_rows(rows)
    assert sum(r[1] > 0 for r in got.values()) > 30


def test_rows_of_an_id_and_text_that_repeat_meet_their_places(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "MAX_SHARED", 0)
    rows = documents(12)
    once, twice = removed(spark, rows), removed(spark, rows + rows[:5])
    assert once == twice


def test_bytes_move_as_texts_beyond_the_sieve(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "MAX_SHARED", 0)
    text = F.col("text").cast("binary").alias("text")
    texts = spark.createDataFrame(documents(), "doc_id bigint, text string").select("doc_id", F.hash("text").cast("bigint").alias("text_key"), text)
    shared = suffixdedup.piece_counts(texts, suffixdedup.SPAN, suffixdedup.GRAM).filter("n > 1").select("piece").cache()
    staged = []
    monkeypatch.setattr(suffixdedup, "stage", lambda df, label: staged.append((label, df)) or df)
    joined = suffixdedup.snippets(texts, shared, shared.count(), suffixdedup.SPAN, suffixdedup.GRAM)
    assert [(label, df.columns) for label, df in staged] == [("suffix-runs", ["piece", "doc_id", "text_key", "start", "n"])]
    monkeypatch.setattr(suffixdedup, "MAX_SHARED", 1 << 40)
    sieved = suffixdedup.snippets(texts, shared, shared.count(), suffixdedup.SPAN, suffixdedup.GRAM)
    columns = ["piece", "doc_id", "text_key", "start", "snippet"]
    want = sorted(map(tuple, sieved.join(shared, "piece").select(*columns).collect()))
    assert want and sorted(map(tuple, joined.select(*columns).collect())) == want
    shared.unpersist()


@pytest.mark.parametrize("n", [1, 700, 20_000])
def test_a_sieve_knows_all_its_pieces_and_few_others(spark, n):
    draw = np.random.default_rng(n)
    known = draw.integers(-(2**63), -(2**62), n)  # least hashes: their leading bits are alike
    shared = spark.createDataFrame([(int(x),) for x in known], "piece bigint")
    table = suffixdedup.sieve(shared, n)
    assert len(suffixdedup.passed(table, known.view(np.uint64))) == n
    others = draw.integers(-(2**63), -(2**62), 100_000).view(np.uint64)
    assert len(suffixdedup.passed(table, others)) < 2_000


def test_no_shared_piece(spark):
    table = suffixdedup.sieve(spark.createDataFrame([], "piece bigint"), 0)
    assert len(suffixdedup.passed(table, np.arange(1000, dtype=np.uint64))) == 0
    rows = [(1, "a" * 10), (2, "".join(random.Random(1).choice("abcdef") for _ in range(300)))]
    assert removed(spark, rows) == plain.repeat_rows(rows)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {name for name in names if name.startswith("shuffle_")}


def test_tables_and_shuffles_are_gone_before_the_last_step(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "PART_PIECES", 1)
    monkeypatch.setattr(suffixdedup, "PARTS", 2)
    folder = f"{shared_folder(spark)}/termloom"
    before = {f.name for f in list_folder(spark, folder)} if path_exists(spark, folder) else set()
    files = shuffle_files(spark)
    found = suffixdedup.remove_repeats(spark.createDataFrame(documents(), "doc_id bigint, text string"))
    new = {f.name for f in list_folder(spark, folder)} - before
    assert sorted(name.rsplit("-", 1)[0] for name in new) == ["suffix-copies", "suffix-spans", "suffix-texts"]
    left, end = {"all"}, time.time() + 10
    while len(left) > 2 and time.time() < end:
        time.sleep(0.2)
        left = {name.split("_")[1] for name in shuffle_files(spark) - files}
    assert len(left) <= 2  # of the counts that see whether a table is small
    assert found.count() == 62
