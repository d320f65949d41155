"""Tries, masks and interactions against plain Python; nulls, ties, repeats, empty tables."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from termloom.llm import filteraudit, tries

SCHEMA = "doc_id bigint, text string, lang string, part string, mask string, n string, range string"
LABELS = "doc_id bigint, quality int, toxic int, n int, mask int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, p, "p", "m", "n", "r") for i, t, p in rows], SCHEMA)


def label_table(spark, rows):
    return spark.createDataFrame([(*r, 0, 0) for r in rows], LABELS)


def failures(rows):
    """The letters each row fails."""
    last = 1 << 63
    least = {}
    for i, text, _ in rows:
        key = text or ""
        least[key] = min(least.get(key, last), last if i is None else i)
    out = []
    for i, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        out.append(
            "A" * (len(words) < 200)
            + "B" * (100 * len(set(words)) < 50 * len(words))
            + "C" * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text))
            + "D" * bool(re.search(r"[#$%&*|]", text))
            + "E" * ((last if i is None else i) > least[text])
        )
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    failed = failures(rows)
    out = Counter()
    shapley = Counter()
    parts = {p or "" for _, _, p in rows}
    for part in parts:
        docs = [(i, f) for (i, _, p), f in zip(rows, failed) if (p or "") == part]
        for order in permutations("ABCDE"):
            left = docs
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                shapley[part, letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(letter in f for _, f in docs) - len(gone),
                    sum(f == letter for _, f in docs), sum(i in good for i, _ in gone),
                    sum(i in toxic for i, _ in gone),
                ]
    return {
        (part, order, step): (*v, shapley[part, order[step - 1]])
        for (part, order, step), v in out.items()
    }


def result(found):
    return {
        (r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in filteraudit.COUNTS)
        for r in found.collect()
    }


def corpus():
    rng = random.Random(3)
    base = ["word " * 250, " ".join(f"w{k}" for k in range(300)), "SHOUT " * 10, "a#b", "", None, "x" * 50_000,
            "x" * 50_000 + "y", " ".join(f"W{k}" for k in range(220)), " \n\t", "é漢字 " * 210, "200% " * 200]
    rows = [(k, rng.choice(base), rng.choice(["en", "de", None, ""])) for k in range(300)]
    rng.shuffle(rows)
    return [*rows, (None, "a#b", "en"), (None, "nobody else", "de"), (None, "nobody else", "de"), (2, rows[0][1], "fr"), (2, rows[0][1], "fr")]


@given(st.lists(st.binary(max_size=12).map(lambda b: bytes(c % 3 for c in b)), max_size=60))
@settings(max_examples=200, deadline=None)
def test_a_trie_finds_equal_texts(texts):
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    least = {t: min(i for i, u in rows if u == t) for _, t in rows}
    assert tries.least_ids(rows).tolist() == [least[t] for _, t in rows]


def test_long_shared_prefixes_are_stored_once():
    root = tries.Node(b"", 0, 0)
    head = b"h" * 100_000
    for k in range(200):
        end = tries.insert(root, head + b"%03d" % k)
        assert end.text[: end.end] == head + b"%03d" % k
    nodes, held = tries.trie_size(root)
    assert nodes <= 400 and held < 101_000
    assert tries.insert(root, head).end == 100_000
    assert tries.shared(head, 0, head + b"x", 0, 100_000) == 100_000


@pytest.mark.parametrize("local, step", [(32 << 20, 16), (60_000, 2)])
def test_brute_force(spark, monkeypatch, local, step):
    monkeypatch.setattr(tries, "LOCAL_BYTES", local)
    monkeypatch.setattr(tries, "SAMPLE_STEP", step)
    rows = corpus()
    labels = [(k, k % 2, int(k % 3 == 0)) for k in range(0, 300, 2)] + [(4, 1, None), (4, None, 1), (None, 1, 1)]
    found = filteraudit.audit(table(spark, rows).repartition(3), label_table(spark, labels))
    assert result(found) == brute(rows, labels)


def test_ranges_part_texts_behind_a_long_shared_beginning(spark):
    rows = [(k, "licence " * 300 + f"{k * 7919 % 1000:03d}", "en") for k in range(1000)]
    starts = tries.range_starts(table(spark, rows), 1000, 16)
    assert len(starts) > 8 and all(len(s) > 2400 for s in starts) and starts == sorted(starts)


def test_empty_tables(spark):
    nothing = label_table(spark, [])
    assert filteraudit.audit(table(spark, []), nothing).count() == 0
    found = result(filteraudit.audit(table(spark, [(1, None, None)]), nothing))
    assert len(found) == 600 and found["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)
    assert found == brute([(1, None, None)], [])
