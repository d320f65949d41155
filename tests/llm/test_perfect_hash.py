"""Exact duplicates: the hash itself, SQL-free brute force, edges, a given history."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np

from termloom.llm import perfecthash
from termloom.session import stage

SCHEMA = "doc_id bigint, text string, digest string, row string, keep_id int, bucket int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "d", "r", 1, 2) for i, t in rows], SCHEMA)


def brute(rows):
    same = defaultdict(list)
    for i, t in rows:
        same[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()].append(i)
    return sorted(
        (i, min(ids), len(ids), i == min(ids), sha) for sha, ids in same.items() for i in ids
    )


def result(found):
    return sorted(tuple(r) for r in found.collect())


def random_digests(n, seed):
    return np.random.default_rng(seed).integers(0, 256, (n, 32), dtype=np.uint8)


def test_slots_are_a_permutation_and_strangers_fail_the_comparison():
    for n in (0, 1, 2, 1000, 30_000):
        keys = random_digests(n, n)
        slots, levels = perfecthash.perfect_hash(keys)
        assert sorted(slots) == list(range(n))
        assert (perfecthash.find_slots(keys, levels) == slots).all()
        strangers = random_digests(500, n + 1)
        at = perfecthash.find_slots(strangers, levels)
        assert at.max(initial=-1) < n
        in_slot = np.empty_like(keys)
        in_slot[slots] = keys
        assert not any((in_slot[s] == k).all() for s, k in zip(at, strangers) if s >= 0)


def test_digests_that_share_words_part_in_the_end():
    keys = random_digests(1, 5).repeat(300, axis=0)
    keys[:, 24:26] = np.arange(300, dtype="<u2").view(np.uint8).reshape(-1, 2)
    slots, _ = perfecthash.perfect_hash(keys)
    assert sorted(slots) == list(range(300))


def test_brute_force_and_edges(spark):
    rows = [(i, f"text  {i % 7}\n") for i in range(40)] + [
        (100, None), (101, ""), (102, " "), (103, "\t\r\n"), (104, " text 1 "), (105, "text 1 "),
        (-5, "text\x0b1 "), (106, " "), (107, "a" * 300_000), (108, "a" * 300_000), (109, "a" * 299_999),
    ]
    assert result(perfecthash.exact_duplicates(table(spark, rows))) == brute(rows)
    assert perfecthash.exact_duplicates(table(spark, [])).count() == 0


def test_rows_without_id_and_repeated_rows(spark):
    rows = [(None, "x"), (3, "x"), (3, "x"), (4, "x"), (None, "only"), (None, "only"), (9, "y")]
    found = perfecthash.exact_duplicates(table(spark, rows)).collect()
    got = sorted((r["doc_id"] or 0, r["keep_id"] or 0, r["group_size"], r["kept"]) for r in found)
    assert got == [
        (0, 0, 2, False), (0, 0, 2, True), (0, 3, 4, False),
        (3, 3, 4, False), (3, 3, 4, True), (4, 3, 4, False), (9, 9, 1, True),
    ]
    none = perfecthash.exact_duplicates(table(spark, [(None, "x"), (None, "x")])).collect()
    assert sorted(r["kept"] for r in none) == [False, True]


def test_a_given_history_wins(spark, monkeypatch):
    monkeypatch.setattr(perfecthash, "BUCKET", 3)
    old = [(i, f"t{i % 20}") for i in range(1000, 1060)]
    groups = stage(perfecthash.groups(perfecthash.digests(table(spark, old))), "old")
    history = stage(perfecthash.build_history(groups, perfecthash.buckets_for(groups)), "history")
    assert history.count() > 1
    new = [(1, "t3"), (2, "t99"), (3, "t99"), (4, "t\n3"), (0, "t5")]
    found = perfecthash.exact_duplicates(table(spark, new), history).collect()
    got = sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in found)
    assert got == [(0, 1005, 4, False), (1, 1003, 4, False), (2, 2, 2, True), (3, 2, 2, False), (4, 4, 1, True)]
