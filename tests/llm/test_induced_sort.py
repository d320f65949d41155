"""Induced sorting against plain sorting of suffixes."""

from __future__ import annotations

import numpy as np
import pytest

from termloom.llm.common import prefix_sums, span_hashes
from termloom.llm.inducedsort import sorted_suffixes


def text_of(parts):
    out = []
    for p in parts:
        out += [b + 1 for b in p] + [0]
    return np.array(out, dtype=np.int64)


def check(parts, cap, held):
    text = text_of(parts)
    sums = prefix_sums((text - 1).astype(np.uint8))
    positions, prefixes = sorted_suffixes(text, cap, sums, span_hashes, held)
    tails = {}
    at = 0
    for p in parts:
        for i in range(len(p)):
            tails[at + i] = p[i:]
        at += len(p) + 1
    assert sorted(positions.tolist()) == sorted(tails)
    cut = [tails[i][:cap] for i in positions.tolist()]
    assert cut == sorted(cut, reverse=True)
    for k in range(1, len(cut)):
        n = 0
        while n < min(len(cut[k]), len(cut[k - 1])) and cut[k][n] == cut[k - 1][n]:
            n += 1
        assert prefixes[k] == n


@pytest.mark.parametrize("seed", range(60))
def test_small_alphabets(seed):
    rng = np.random.default_rng(seed)
    letters = int(rng.integers(1, 5))
    parts = [bytes(rng.integers(97, 97 + letters, rng.integers(0, 40)).tolist()) for _ in range(rng.integers(1, 9))]
    parts += parts[:2]
    check(parts, int(rng.integers(2, 30)), int(rng.choice([5, 1000])))


def test_periodic_and_all_bytes():
    check([b"abab" * 30, b"a" * 70, b"aab" * 20, bytes(range(256)), b"\x00\x00\xff\xff" * 5, b""], 50, 10)
