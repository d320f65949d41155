"""The suffix automaton against plain scanning over small alphabets."""

from __future__ import annotations

import random

import pytest

from termloom.llm.decontaminate import SuffixAutomaton


def plain(items, words, window):
    """(end, size, item) of every occurrence of a window, by scanning."""
    found = set()
    for item, seq in items:
        size = window if len(seq) >= window else len(seq)
        if not size:
            continue
        windows = {tuple(seq[k : k + size]) for k in range(len(seq) - size + 1)}
        for end in range(size, len(words) + 1):
            if tuple(words[end - size : end]) in windows:
                found.add((end, size, item))
    return found


@pytest.mark.parametrize("seed", range(60))
def test_stream_finds_every_window(seed):
    rng = random.Random(seed)
    letters, window = rng.randint(1, 4), rng.randint(2, 6)
    items = [
        (i, [rng.randrange(letters) for _ in range(rng.randint(1, 12))])
        for i in range(rng.randint(1, 8))
    ]
    words = [rng.randrange(letters + 1) for _ in range(200)]
    words[50:50] = items[0][1]
    automaton = SuffixAutomaton(items, window)
    got = {(end, size, i) for end, size, _, ids in automaton.stream(words) for i in ids}
    assert got == plain(items, words, window)


def test_longest_match_is_followed():
    automaton = SuffixAutomaton([(1, list(range(10)))], 3)
    assert [m for _, _, m, _ in automaton.stream([99, *range(2, 9), 99])] == [3, 4, 5, 6, 7]
