"""External induced sorting of suffixes with common-prefix values.

Suffixes are sorted from the leftmost-S ones: those are ranked first, by inducing the
order of the pieces between them, naming the pieces and ranking the string of names; then
one ascending pass induces all L suffixes and one descending pass all S suffixes.  A pass
takes suffixes from a priority queue in order and puts each one's predecessor in.  The
queue keeps a first-in first-out run of (position, common prefix) tuples for each first
byte, and spills runs to disk when it holds more than ``held`` tuples.  The common prefix
of two neighbours in a run is one more than the least common prefix that was passed
between their successors, so it is carried along, capped at ``cap``.
"""

from __future__ import annotations

import tempfile

import numpy as np

from termloom.llm.common import mix

SEPARATOR = 0
ALPHABET = 257
HELD = 4_000_000


class RunQueue:
    """Runs of (position, common prefix) by first byte, in memory up to a limit."""

    def __init__(self, held: int):
        self.limit, self.held = held, 0
        self.runs: list[list] = [[] for _ in range(ALPHABET)]
        self.file = None

    def push(self, char: int, positions: np.ndarray, prefixes: np.ndarray) -> None:
        self.runs[char].append((positions, prefixes))
        self.held += len(positions)
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        for run in self.runs:
            for i, part in enumerate(run):
                if isinstance(part[0], np.ndarray):
                    at = self.file.seek(0, 2)
                    self.file.write(part[0].tobytes() + part[1].tobytes())
                    run[i] = (at, len(part[0]))
        self.held = 0

    def pop(self, char: int) -> tuple[np.ndarray, np.ndarray] | None:
        """The oldest tuples of a byte, up to the limit in one; None if there are none."""
        run = self.runs[char]
        if not run:
            return None
        n = size = 0
        while n < len(run) and (not n or size < self.limit):
            size += len(run[n][0]) if isinstance(run[n][0], np.ndarray) else run[n][1]
            n += 1
        parts, self.runs[char] = [self._load(part) for part in run[:n]], run[n:]
        if len(parts) == 1:
            return parts[0]
        return np.concatenate([p for p, _ in parts]), np.concatenate([v for _, v in parts])

    def _load(self, part: tuple) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(part[0], np.ndarray):
            self.held -= len(part[0])
            return part
        at, n = part
        self.file.seek(at)
        raw = self.file.read(n * 9)
        return np.frombuffer(raw[: n * 8], np.int64), np.frombuffer(raw[n * 8 :], np.uint8)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _range_minimum(values: np.ndarray) -> list[np.ndarray]:
    table, step = [values], 1
    while 2 * step <= len(values):
        last = table[-1]
        table.append(np.minimum(last[:-step], last[step:]))
        step *= 2
    return table


def _least(table: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low:high] for ranges that are not empty."""
    level = np.frexp((high - low).astype(np.float64))[1] - 1
    out = np.empty(len(low), dtype=np.uint8)
    for k in np.unique(level):
        at = level == k
        out[at] = np.minimum(table[k][low[at]], table[k][high[at] - (1 << k)])
    return out


def _first_apart(prefixes: np.ndarray) -> np.ndarray:
    """The first suffix of a byte shares nothing with the one before."""
    prefixes = prefixes.copy()
    prefixes[0] = 0
    return prefixes


class InducedSort:
    """The suffixes of texts (each ended by ``SEPARATOR``) over bytes shifted by one."""

    def __init__(self, text: np.ndarray, cap: int, held: int = HELD):
        self.text, self.cap, self.held, self.carried = text, cap, held, True
        n = len(text)
        down = np.zeros(n, dtype=bool)  # L: larger than the next suffix
        if n > 1:
            change = np.flatnonzero(text[:-1] != text[1:])
            run = np.cumsum(text[:-1] != text[1:]) - (text[:-1] != text[1:])
            at = change[np.minimum(run, max(len(change) - 1, 0))] if len(change) else np.zeros(n - 1, int)
            down[:-1] = (run < len(change)) & (text[at] > text[np.minimum(at + 1, n - 1)])
        down[text == SEPARATOR] = False
        self.down = down
        star = np.zeros(n, dtype=bool)
        star[1:] = down[:-1] & ~down[1:]
        star[text == SEPARATOR] = True
        self.star = star

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefixes of suffix pairs by comparison, for seams and seeds."""
        out = np.zeros(len(a), dtype=np.uint8)
        live = np.arange(len(a))
        last = len(self.text) - 1
        for k in range(self.cap):
            x = self.text[np.minimum(a[live] + k, last)]
            live = live[(x == self.text[np.minimum(b[live] + k, last)]) & (x != SEPARATOR)]
            if not len(live):
                break
            out[live] += 1
        return out

    def _induce(self, queue: RunQueue, carry: np.ndarray, positions: np.ndarray, prefixes: np.ndarray, want: bool) -> None:
        """Put the predecessors (of type L if ``want``) of suffixes in order into the queue."""
        if not len(positions):
            return
        before = positions - 1
        ok = np.flatnonzero((positions > 0) & (self.down[before] == want) & (self.text[before] != SEPARATOR))
        if not self.carried:
            self._deal(queue, before[ok], self.text[before[ok]])
            return
        table = _range_minimum(prefixes)
        lowest = int(prefixes.min())
        if not len(ok):
            np.minimum(carry, lowest, out=carry)
            return
        chars = self.text[before[ok]]
        order = np.argsort(chars, kind="stable")
        ok, chars = ok[order], chars[order]
        first = np.append(True, chars[1:] != chars[:-1])
        low = np.where(first, 0, np.append(0, ok[:-1] + 1))
        least = _least(table, low, ok + 1)
        starts = np.flatnonzero(first)
        seen = chars[starts]
        least[starts] = np.minimum(least[starts], carry[seen])
        value = np.minimum(least.astype(np.int64) + 1, self.cap).astype(np.uint8)
        np.minimum(carry, lowest, out=carry)
        ends = np.append(starts[1:], len(ok))
        tail = ok[ends - 1] + 1
        some = tail < len(prefixes)
        carry[seen] = self.cap
        carry[seen[some]] = _least(table, tail[some], np.full(some.sum(), len(prefixes)))
        found = before[ok]
        for c, i, j in zip(seen.tolist(), starts.tolist(), ends.tolist(), strict=True):
            queue.push(c, found[i:j], value[i:j])

    def _deal(self, queue: RunQueue, found: np.ndarray, chars: np.ndarray) -> None:
        """Put positions into the queue without common prefixes."""
        if not len(found):
            return
        order = np.argsort(chars, kind="stable")
        found, chars = found[order], chars[order]
        starts = np.flatnonzero(np.append(True, chars[1:] != chars[:-1]))
        none = np.zeros(len(found), dtype=np.uint8)
        ends = np.append(starts[1:], len(chars))
        for i, j in zip(starts.tolist(), ends.tolist(), strict=True):
            queue.push(int(chars[i]), found[i:j], none[i:j])

    def passes(self, seeds: np.ndarray, prefixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All suffixes but the separators, descending, with the common prefix to the one before."""
        text = self.text
        bounds = np.searchsorted(text[seeds], np.arange(ALPHABET + 1))
        rising: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(ALPHABET)]
        queue, carry = RunQueue(self.held), np.zeros(ALPHABET, dtype=np.uint8)
        for c in range(ALPHABET):
            last = None
            while found := queue.pop(c):
                part, lcp = found
                lcp = lcp if last is not None else _first_apart(lcp)
                rising[c].append((part, lcp))
                self._induce(queue, carry, part, lcp, True)
                last = part[-1:]
            part = seeds[bounds[c] : bounds[c + 1]]
            if len(part):
                lcp = prefixes[bounds[c] : bounds[c + 1]].copy()
                lcp[0] = self.common(last, part[:1])[0] if last is not None else 0
                self._induce(queue, carry, part, lcp, True)
        queue.close()
        queue, carry = RunQueue(self.held), np.zeros(ALPHABET, dtype=np.uint8)
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for c in range(ALPHABET - 1, SEPARATOR, -1):
            last = None
            while found := queue.pop(c):
                part, lcp = found
                lcp = lcp if last is not None else _first_apart(lcp)
                out.append((part, lcp))
                self._induce(queue, carry, part, lcp, False)
                last = part[-1:]
            if rising[c]:
                part = np.concatenate([p for p, _ in rising[c]])[::-1]
                lcp = np.concatenate([v for _, v in rising[c]])
                lcp = np.append(np.uint8(0), lcp[1:][::-1])
                if last is not None:
                    lcp[0] = self.common(last, part[:1])[0]
                out.append((part, lcp))
                self._induce(queue, carry, part, lcp, False)
                rising[c] = []
        queue.close()
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.uint8)
        return np.concatenate([p for p, _ in out]), np.concatenate([v for _, v in out])

    def ranked_stars(self, sums: np.ndarray, hashes) -> np.ndarray:
        """The leftmost-S suffixes in order, exact up to ``cap`` bytes."""
        stars = np.flatnonzero(self.star)
        ends = stars[self.text[stars] == SEPARATOR]
        inner = stars[self.text[stars] != SEPARATOR]
        if not len(inner):
            return ends
        # Pieces between neighbours, sorted by inducing from seeds that are in no order.
        loose = np.concatenate([ends, inner[np.argsort(self.text[inner], kind="stable")]])
        self.carried = False
        falling, _ = self.passes(loose, np.zeros(len(loose), dtype=np.uint8))
        self.carried = True
        pieces = falling[self.star[falling]][::-1]
        place = np.zeros(len(self.text), dtype=np.int64)
        place[stars] = np.arange(len(stars))
        where = place[pieces]
        following = stars[where + 1]
        content = mix(hashes(sums, pieces, following + 1) ^ (following - pieces).astype(np.uint64))
        new = np.append(True, content[1:] != content[:-1])
        first = np.flatnonzero(new)
        # A rank is the place of the first of its equals: separators come first, each alone.
        rank = np.zeros(len(stars), dtype=np.int64)
        rank[where] = len(ends) + first[np.cumsum(new) - 1]
        rank[place[ends]] = np.arange(len(ends))
        return stars[self._refine(rank)]

    def _refine(self, rank: np.ndarray) -> np.ndarray:
        """Order of the string of names: ranks of equals are split by what follows them."""
        step, m = 1, len(rank)
        while 2 * step <= max(self.cap, 2) * 2:
            size = np.bincount(rank, minlength=m)
            open_ = np.flatnonzero(size[rank] > 1)
            if not len(open_):
                break
            after = rank[np.minimum(open_ + step, m - 1)]
            order = np.argsort(rank[open_] * m + after)  # in one number: both are below m
            open_, after = open_[order], after[order]
            base = rank[open_]
            group = np.append(True, base[1:] != base[:-1])
            split = group | np.append(True, after[1:] != after[:-1])
            at = np.arange(len(open_))
            head = at[group][np.cumsum(group) - 1]
            sub = at[split][np.cumsum(split) - 1]
            rank = rank.copy()
            rank[open_] = base + (sub - head)
            step *= 2
        return np.argsort(rank, kind="stable")


def sorted_suffixes(
    text: np.ndarray, cap: int, sums: np.ndarray, hashes, held: int = HELD
) -> tuple[np.ndarray, np.ndarray]:
    """(positions, prefixes): suffixes in descending order, each with the length of the
    prefix it shares with the one before, both exact up to ``cap``.

    ``text`` holds bytes plus one, every part ended by ``SEPARATOR``; ``sums`` and
    ``hashes`` give the hash of any of its substrings.
    """
    if not len(text):
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    job = InducedSort(text, cap, held)
    seeds = job.ranked_stars(sums, hashes)
    prefixes = np.append(np.uint8(0), job.common(seeds[:-1], seeds[1:]))
    return job.passes(seeds, prefixes)
