"""Benchmark decontamination with a generalised suffix automaton over item words.

The automaton of a bounded block of items is built once and sent to the tasks; each
task streams the words of its documents through it and follows the length of the
longest match.  A word is hit when it lies in an occurrence of a window: any
``window`` consecutive words of an item, or all words of a shorter item.  Spans of hit
words beyond a limit of length or coverage can be cut out of the texts.

Runs of words whose three-word sequences are all known to the block are found with
numpy first; a window cannot lie outside such a run, so only they are streamed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import WORD_BYTE, map_batches, mix, pieces, words_of

WINDOW = 13
#: Text bytes of the items in one automaton; more items are taken in further passes.
BLOCK_BYTES = 1 << 20
FOUND = (
    "text_key bigint, n_words bigint, longest bigint, spans array<struct<start:bigint,end:bigint>>,"
    " item_ids array<bigint>"
)

#: A word and what follows it up to the next.
UNIT = r"[0-9A-Za-z\x{80}-\x{10FFFF}]++[^0-9A-Za-z\x{80}-\x{10FFFF}]*+"

_PLACES = mix(np.arange(7, 10, dtype=np.uint64)) | np.uint64(1)


class SuffixAutomaton:
    """All suffixes of several word sequences; states know the windows that end in them."""

    def __init__(self, items: list[tuple[int, list[int]]], window: int = WINDOW):
        self.window = window
        self.step: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self._mark(items)

    def _state(self, step: dict[int, int], link: int, length: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.step) - 1

    def _split(self, at: int, word: int, target: int) -> int:
        """The state of the length that ``at`` gives, cut out of ``target`` where needed."""
        if self.length[target] == self.length[at] + 1:
            return target
        copy = self._state(dict(self.step[target]), self.link[target], self.length[at] + 1)
        self.link[target] = copy
        while at >= 0 and self.step[at].get(word) == target:
            self.step[at][word] = copy
            at = self.link[at]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.step[last]:
            return self._split(last, word, self.step[last][word])
        fresh, at = self._state({}, 0, self.length[last] + 1), last
        while at >= 0 and word not in self.step[at]:
            self.step[at][word] = fresh
            at = self.link[at]
        if at >= 0:
            self.link[fresh] = self._split(at, word, self.step[at][word])
        return fresh

    def _mark(self, items: list[tuple[int, list[int]]]) -> None:
        order = sorted(range(len(self.step)), key=self.length.__getitem__)
        self.cut = [0] * len(order)  # the state of the last ``window`` words
        for s in order[1:]:
            up = self.link[s]
            self.cut[s] = s if self.length[up] < self.window else self.cut[up]
        self.full: dict[int, set[int]] = {}
        self.short: dict[int, dict[int, set[int]]] = {}  # by length
        for item, words in items:
            state = 0
            for i, word in enumerate(words):
                state = self.step[state][word]
                if i + 1 >= self.window:
                    self.full.setdefault(self.cut[state], set()).add(item)
            if 0 < len(words) < self.window:
                self.short.setdefault(state, {}).setdefault(len(words), set()).add(item)
        self.above = [0] * len(order)  # the nearest state, itself included, of a short item
        for s in order[1:]:
            self.above[s] = s if s in self.short else self.above[self.link[s]]

    def stream(self, words: list[int]) -> Iterator[tuple[int, int, int, set[int]]]:
        """(end, window length, longest match, items) of every occurrence of a window."""
        step, link, length = self.step, self.link, self.length
        state = matched = 0
        for i, word in enumerate(words):
            while state and word not in step[state]:
                state = link[state]
                matched = length[state]
            if word not in step[state]:
                continue
            state, matched = step[state][word], matched + 1
            if matched >= self.window:
                yield i + 1, self.window, matched, self.full[self.cut[state]]
            mark = self.above[state]
            while mark:
                for size, items in self.short[mark].items():
                    if size <= matched:
                        yield i + 1, size, matched, items
                mark = self.above[link[mark]] if link[mark] > 0 else 0


class Block:
    """The automaton of some items and the numpy filter in front of it."""

    def __init__(self, items: list[tuple[int, bytes]], window: int):
        column = pa.array([text for _, text in items], type=pa.large_binary())
        sequences = []
        for _, _, data, offsets in pieces(column):
            words = words_of(data, offsets, WORD_BYTE)
            for low, high in zip(words.bounds[:-1], words.bounds[1:], strict=True):
                sequences.append(words.hashes[low:high])
        ids = [i for i, _ in items]
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for s in sequences for w in s.tolist()}))}
        known = [
            (i, [self.vocabulary[w] for w in s.tolist()])
            for i, s in zip(ids, sequences, strict=True)
            if len(s)
        ]
        shortest = min((min(len(s), window) for _, s in known), default=1)
        self.gram = min(3, shortest)
        self.least_run = shortest - self.gram + 1
        self.grams = np.unique(
            np.concatenate([np.zeros(0, np.uint64), *(self._grams(s) for s in sequences)])
        )
        self.automaton = SuffixAutomaton(known, window)

    def _grams(self, hashes: np.ndarray) -> np.ndarray:
        n = max(len(hashes) - self.gram + 1, 0)
        out = np.zeros(n, dtype=np.uint64)
        for k in range(self.gram):
            out += hashes[k : k + n] * _PLACES[k]
        return mix(out)

    def runs(self, hashes: np.ndarray) -> list[tuple[int, int]]:
        """Word ranges outside of which no window can lie."""
        grams = self._grams(hashes)
        if not len(self.grams) or not len(grams):
            return []
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        known = np.zeros(len(grams) + 2, dtype=np.int8)
        known[1:-1] = self.grams[at] == grams
        change = np.diff(known)
        starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        keep = ends - starts >= self.least_run
        return list(
            zip(starts[keep].tolist(), (ends[keep] + self.gram - 1).tolist(), strict=True)
        )


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _match(docs: DataFrame, shared, text: str, keyed: bool) -> DataFrame:
    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        block: Block = shared.value
        vocabulary, automaton = block.vocabulary, block.automaton
        for first, end, data, offsets in pieces(batch.column(1)):
            words = words_of(data, offsets, WORD_BYTE)
            bounds = words.bounds
            n = end - first
            spans: list[list[tuple[int, int]]] = [[] for _ in range(n)]
            items: list[set[int]] = [set() for _ in range(n)]
            longest = [0] * n
            for low, high in block.runs(words.hashes):
                row = int(np.searchsorted(bounds, low, side="right")) - 1
                while low < high:  # a run may reach over the end of a text
                    stop = min(high, int(bounds[row + 1]))
                    known = [vocabulary.get(w, -1) for w in words.hashes[low:stop].tolist()]
                    base = low - int(bounds[row])
                    for at, size, matched, found in automaton.stream(known):
                        spans[row].append((base + at - size, base + at))
                        items[row] |= found
                        longest[row] = max(longest[row], matched)
                    low, row = stop, row + 1
            yield {
                "doc_id": batch.column(0).slice(first, n),
                "text_key": batch.column(2).slice(first, n),
                "n_words": np.diff(bounds),
                "longest": longest,
                "spans": [[{"start": a, "end": b} for a, b in _merged(s)] for s in spans],
                "item_ids": [sorted(i) for i in items],
            }

    return map_batches(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text"),
            (F.xxhash64(text) if keyed else F.lit(0)).cast("bigint").alias("text_key"),
        ),
        f"doc_id bigint, {FOUND}",
        work,
    )


def _pass(
    docs: DataFrame, items: DataFrame, window: int, text: str, keyed: bool = False
) -> DataFrame:
    rows = items.select("item_id", "text").collect()  # one block, of a checked size
    block = Block([(r["item_id"], bytes(r["text"])) for r in rows], window)
    return _match(docs, docs.sparkSession.sparkContext.broadcast(block), text, keyed)


def benchmark_hits(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text"
) -> DataFrame:
    """(doc_id, n_words, longest, spans, item_ids) of every row of ``docs``.

    Words are runs of digits, letters and all non-ASCII characters, A-Z lower-cased.
    ``spans`` are the merged word ranges inside occurrences of windows, ``longest`` the
    longest match with an item where a window ends, ``item_ids`` the items with an
    occurring window.  Null texts have no words; null, empty and wordless items no
    window, and items without an id are left out.  Repeated rows stay; extra columns are ignored.

    Items of more than ``BLOCK_BYTES`` are cut into blocks by a hash of the id, one
    automaton and one pass each, so what is broadcast does not grow with the items.
    """
    columns = ["doc_id", "n_words", "longest", "spans", "item_ids"]
    chosen = _blocks(items)
    if len(chosen) == 1:
        return _pass(docs, chosen[0], window, text).select(*columns)
    keys = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.xxhash64(text).alias("key"))
    merged = _keyed_hits(docs, items, window, text, chosen)
    same = keys["id"].eqNullSafe(merged["doc_id"]) & (keys["key"] == merged["text_key"])
    return keys.join(merged, same).select(*columns)


def _blocks(items: DataFrame) -> list[DataFrame]:
    """(item_id, text) of the usable items, cut by a hash of the id into blocks of a bounded size."""
    usable = items.filter("text is not null and item_id is not null").select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("binary").alias("text")
    )
    size = usable.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = -(-size // BLOCK_BYTES) or 1
    if n == 1:
        return [usable]
    return [usable.filter(F.pmod(F.xxhash64("item_id"), F.lit(n)) == b) for b in range(n)]


def _keyed_hits(
    docs: DataFrame, items: DataFrame, window: int, text: str, chosen: list[DataFrame] | None = None
) -> DataFrame:
    """Hits with the hash of their text; with several blocks one row for each id and text."""
    parts = [_pass(docs, block, window, text, keyed=True) for block in chosen or _blocks(items)]
    return parts[0] if len(parts) == 1 else _combined(parts)


def _combined(parts: list[DataFrame]) -> DataFrame:
    """Rows of several passes as one for each id and text: spans merged, items united."""
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    merged = every.groupBy("doc_id", "text_key").agg(
        F.max("n_words").alias("n_words"),
        F.max("longest").alias("longest"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("all_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
    )
    empty = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")

    def grow(done, span):
        last = F.element_at(done, -1)
        joined = F.struct(
            last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end")
        )
        return F.when(
            (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] >= span["start"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined)),
        ).otherwise(F.concat(done, F.array(span)))

    spans = F.aggregate("all_spans", empty, grow)
    return merged.select(
        "doc_id", "text_key", "n_words", "longest", spans.alias("spans"), "item_ids"
    )


def contaminated(n_hit, n_words):
    """The contract's rule: a twentieth of the words or more lie in benchmark windows."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def removable(hits: DataFrame, least_words: int | None = WINDOW, least_share: float | None = 0.05) -> DataFrame:
    """The rows of ``hits`` with spans to remove, and of their spans only those.

    A span goes when it has ``least_words`` words or more, and every span of a text goes
    when ``least_share`` or more of its words lie in spans.  None turns a limit off.
    """
    share = F.try_divide(n_covered(), F.col("n_words"))
    covered = F.lit(False) if least_share is None else share >= least_share
    every = F.when(covered, F.col("spans"))
    none = F.slice("spans", 1, 0)
    long = none if least_words is None else F.filter("spans", lambda s: s["end"] - s["start"] >= least_words)
    return hits.withColumn("spans", F.coalesce(every, long)).filter(F.size("spans") > 0)


def cut_passages(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    least_words: int | None = WINDOW,
    least_share: float | None = 0.05,
    text: str = "text",
) -> DataFrame:
    """The rows and columns of ``docs``, their texts without passages of the benchmark.

    Spans go by the limits of ``removable``: their words, and what stands after each of
    them up to the next word.  All else stays byte for byte, and so do texts without such a span,
    null and empty ones included.  A text whose words all go keeps what stands before the
    first.  Rows are told apart by id and text, so ids may be null or repeat; extra columns
    may have any name.  Texts move only in a join with the ids that lose a span.
    """
    cuts = removable(_keyed_hits(docs, items, window, text), least_words, least_share)
    cuts = cuts.select("doc_id", "text_key", "spans").dropDuplicates(["doc_id", "text_key"])
    same = F.col("d.doc_id").cast("bigint").eqNullSafe(F.col("c.doc_id"))
    whole, names = F.col(f"d.`{text}`"), [f"d.`{c}`" for c in docs.columns]
    joined = docs.alias("d").join(cuts.alias("c"), same & (F.xxhash64(whole) == F.col("c.text_key")), "left")
    units = F.when(F.col("c.spans").isNotNull(), F.regexp_extract_all(whole, F.lit(UNIT), F.lit(0)))
    split = joined.select(F.struct(*names).alias("row"), F.col("c.spans").alias("spans"), units.alias("units"))
    whole, none = F.col("row")[text], F.lit(0).cast("bigint")
    starts = F.concat(F.array(none), F.transform("spans", lambda s: s["end"]))
    ends = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.size("units").cast("bigint")))
    left = F.zip_with(starts, ends, lambda a, b: F.slice("units", (a + 1).cast("int"), (b - a).cast("int")))
    before = F.length(whole) - F.length(F.array_join("units", ""))
    clean = F.concat(F.substring(whole, F.lit(1), before), F.array_join(F.flatten(left), ""))
    return split.withColumn("text", F.when(F.col("spans").isNull(), whole).otherwise(clean)).select(
        *(F.col("text").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns)
    )


def n_covered():
    """Words of a row of hits that lie in spans."""
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


def digest(hits: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    n_hit = n_covered()
    names = F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), "item_ids", "longest", names.alias("names")).select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2("names", 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
        "longest",
    )
