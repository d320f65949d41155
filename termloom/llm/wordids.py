"""Token ids of texts by a byte-level tokenizer file, through a table of units met before.

A byte-level tokenizer splits at the border between a word and the single space in front of
it, at line ends between words, and before a mark that ends a word.  Between those borders
lie units, whose ids do not depend on what is around them.  A slice of texts is cut into
units in numpy; each is looked up by a 64-bit hash in an open table of plain arrays, and the
ids are gathered.  Only units that a task has not met go to the tokenizers library.  Texts
with other white space beside a space or a line end, with a special token's string or with a
unit of more than ``LONGEST`` bytes are encoded whole.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from termloom.llm.common import mix, pieces, prefix_sums, span_hashes

#: Units a table holds before it starts anew: some 90 MB in all.
MOST_UNITS = 2_000_000
LONGEST = 255
#: Marks that end many words; a byte-level tokenizer splits them from letters.
MARKS = ",.;:!?|)"

#: Kinds of units: behind a space; at the start, behind a line end or a mark; line ends in
#: front of a word; line ends in front of a space or the end.
SPACED, BARE, LINES, LAST_LINES = range(4)
_SALT = mix(np.arange(71, 75, dtype=np.uint64))

_SPACE, _LINE, _MARK, _ALNUM = (np.zeros(256, dtype=bool) for _ in range(4))
_SPACE[32] = _LINE[10] = True
_MARK[list(MARKS.encode())] = True
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 11, 12, 13, 28, 29, 30, 31]] = True
#: Lead byte -> the characters of two or three bytes that are white space.
_WIDE_BLANKS = {
    0xC2: (0x0085, 0x00A0),
    0xE1: (0x1680,),
    0xE2: (*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F),
    0xE3: (0x3000,),
}


def blanks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where white space other than a space or a line end begins, and where it ends."""
    begin = _BLANK[data]
    end = begin.copy()
    for lead, chars in _WIDE_BLANKS.items():
        at = np.flatnonzero(data == lead)
        size = len(chr(chars[0]).encode())
        at = at[at + size <= len(data)]
        if not len(at):
            continue
        if size == 2:
            code = (data[at].astype(np.int32) & 31) << 6 | (data[at + 1] & 63)
        else:
            code = (data[at].astype(np.int32) & 15) << 12 | (data[at + 1].astype(np.int32) & 63) << 6
            code |= data[at + 2] & 63
        at = at[np.isin(code, chars)]
        begin[at] = True
        end[at + size - 1] = True
    return begin, end


def odd_gaps(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts with white space behind a space, or other white space beside a line end."""
    odd = np.zeros(len(offsets) - 1, dtype=bool)
    if len(data) < 2:
        return odd
    begin, end = blanks(data)
    space, line = _SPACE[data], _LINE[data]
    found = space[:-1] & (space[1:] | line[1:] | begin[1:])
    found |= (end[:-1] & line[1:]) | (line[:-1] & begin[1:])
    at = np.flatnonzero(found)
    row = np.searchsorted(offsets, at, side="right") - 1
    odd[row[at + 1 < offsets[row + 1]]] = True
    return odd


class UnitTable:
    """Hash of a unit -> where its ids lie in one long array."""

    def __init__(self, wide: str):
        self.wide = wide
        self.clear()

    def clear(self) -> None:
        self.units, self.end = 0, 0
        self.ids = np.zeros(1 << 16, dtype=self.wide)
        self._resize(16)

    def _resize(self, bits: int) -> None:
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.zeros(1 << bits, dtype=np.uint64)
        self.at = np.zeros(1 << bits, dtype=np.uint32)
        self.n = np.zeros(1 << bits, dtype=np.uint16)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where it is not there."""
        out = np.full(len(keys), -1, dtype=np.int64)
        place = (keys >> self.shift).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            here = self.keys[place[left]]
            hit = here == keys[left]
            out[left[hit]] = place[left[hit]]
            left = left[~hit & (here != 0)]
            place[left] = (place[left] + 1) & self.mask
        return out

    def _place(self, keys: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
        """Put different keys that are not there into free slots."""
        place = (keys >> self.shift).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.keys[place[left]] == 0]
            _, first = np.unique(place[free], return_index=True)
            won = free[first]
            self.keys[place[won]], self.at[place[won]], self.n[place[won]] = keys[won], at[won], n[won]
            rest = np.ones(len(keys), dtype=bool)
            rest[won] = False
            left = left[rest[left]]
            place[left] = (place[left] + 1) & self.mask

    def add(self, keys: np.ndarray, n: np.ndarray, ids: np.ndarray) -> None:
        """Add different keys that are not there, with their ``n`` ids each, one after another."""
        at = self.end + np.cumsum(n) - n
        total = len(ids)
        if self.end + total > len(self.ids):
            grown = np.zeros(2 * (self.end + total), dtype=self.wide)
            grown[: self.end] = self.ids[: self.end]
            self.ids = grown
        self.ids[self.end : self.end + total] = ids
        self.end += total
        self.units += len(keys)
        if 2 * self.units > len(self.keys):
            old = self.keys != 0
            known = self.keys[old], self.at[old], self.n[old]
            self._resize(int(2 * self.units).bit_length())
            self._place(*known)
        self._place(keys, at, n)


def units_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, kind, start, end) of the units of a slice of texts."""
    n = len(data)
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True  # a byte that begins a text, and the end of all
    space, line = _SPACE[data], _LINE[data]
    behind_line = np.zeros(n, dtype=bool)
    behind_line[1:] = line[:-1]
    behind_line &= ~first[:-1]
    bare = ~space & ~line & (first[:-1] | behind_line)
    marked = np.zeros(n, dtype=bool)
    marked[1:] = _MARK[data[1:]] & _ALNUM[data[:-1]]
    stops = first[1:].copy()
    stops[:-1] |= space[1:] | line[1:]
    marked &= stops & ~first[:-1]
    begins = line & ~behind_line
    anchors = np.flatnonzero(space | bare | marked | begins)
    row = np.searchsorted(offsets, anchors, side="right") - 1
    spaced = space[anchors]
    ends = offsets[row + 1].copy()
    ends[:-1] = np.minimum(ends[:-1], anchors[1:])
    lines = begins[anchors]
    kind = np.where(spaced, SPACED, BARE)
    follows = np.minimum(ends, max(n - 1, 0))
    last = (ends == offsets[row + 1]) | (space[follows] if n else False)
    kind[lines] = np.where(last[lines], LAST_LINES, LINES)
    return row, kind, anchors + spaced, ends


class Encoder:
    """Ids of texts; the table of units lives as long as its owner."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.wide = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.by_unit = splits_at_spaces(self.tokenizer)
        self.table = UnitTable(self.wide)
        self.line_id = self._whole(["\n"])[0]

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.wide) for e in found]

    def _learn_together(self, keys: np.ndarray, lead: str, units: list[str]) -> None:
        """Add units without white space, encoded a line each."""
        for at in range(0, len(units), 4000):
            part = units[at : at + 4000]
            ids = self._whole([lead + ("\n" + lead).join(part)])[0]
            cuts = ids == self.line_id[0]
            n = np.diff(np.flatnonzero(cuts), prepend=-1, append=len(ids)) - 1
            self.table.add(keys[at : at + 4000], n, ids[~cuts])

    def _learn(self, keys: np.ndarray, kind: int, units: list[str]) -> None:
        lead = " " if kind == SPACED else ""
        if kind in (SPACED, BARE):
            plain = np.array([u.split() == [u] for u in units], dtype=bool)
            self._learn_together(keys[plain], lead, [u for u, p in zip(units, plain, strict=True) if p])
            keys, units = keys[~plain], [u for u, p in zip(units, plain, strict=True) if not p]
            ids = self._whole([lead + u for u in units])
        elif kind == LINES:
            ids = [np.concatenate([f, self.line_id]) for f in self._whole([u[:-1] for u in units])]
        else:
            ids = self._whole(units)
        if ids:
            self.table.add(keys, np.array([len(i) for i in ids], dtype=np.int64), np.concatenate(ids))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text, of two or four bytes."""
        column = pa.array(texts, pa.large_string())
        return [raw for _, _, rows in self.encode_column(column) for raw in rows]

    def encode_column(self, column: pa.Array) -> Iterator[tuple[int, int, list[bytes]]]:
        """(first row, end row, ids of each text) in slices; a null text is empty."""
        for first, end, data, offsets in pieces(column):
            texts = [t or "" for t in column.slice(first, end - first).to_pylist()]
            yield first, end, self._slice(texts, data, offsets)

    def _slice(self, texts: list[str], data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        odd = odd_gaps(data, offsets)
        odd |= np.array([not self.by_unit or any(s in t for s in self.special) for t in texts], dtype=bool)
        row, kind, start, stop = units_of(data, offsets)
        odd[row[stop - start > LONGEST]] = True
        keep = ~odd[row]
        row, kind, start, stop = row[keep], kind[keep], start[keep], stop[keep]
        keys = mix(span_hashes(prefix_sums(data), start, stop) + _SALT[kind])
        keys[keys == 0] = 1
        if self.table.units > MOST_UNITS:
            self.table.clear()
        slots = self.table.find(keys)
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            body = data.tobytes()
            fresh, at = np.unique(keys[missing], return_index=True)
            at = missing[at]
            for k in range(4):
                mine = np.flatnonzero(kind[at] == k)
                spans = zip(start[at[mine]].tolist(), stop[at[mine]].tolist(), strict=True)
                units = [body[i:j].decode() for i, j in spans]
                if units:
                    self._learn(fresh[mine], k, units)
            slots = self.table.find(keys)
        n = self.table.n[slots].astype(np.int64)
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        place = np.repeat(self.table.at[slots].astype(np.int64) - (ends - n), n) + np.arange(total)
        raw = self.table.ids[place].tobytes()
        step = np.dtype(self.wide).itemsize
        upto = np.concatenate([[0], ends])[np.searchsorted(row, np.arange(len(texts) + 1))] * step
        whole = iter(self._whole([t for t, o in zip(texts, odd, strict=True) if o]))
        bounds = upto.tolist()
        return [
            next(whole).tobytes() if odd[i] else raw[bounds[i] : bounds[i + 1]]
            for i in range(len(texts))
        ]


def splits_at_spaces(tokenizer) -> bool:
    """Whether units may be encoded alone: byte-level pieces, no normaliser."""
    return (
        tokenizer.normalizer is None
        and type(tokenizer.pre_tokenizer).__name__ == "ByteLevel"
        and not tokenizer.pre_tokenizer.add_prefix_space
        and len(tokenizer.encode("\n", add_special_tokens=False).ids) == 1
    )


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The encoder of this process; its table serves the tasks that come after."""
    return Encoder(path)
