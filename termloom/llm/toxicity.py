"""Toxicity: a bidirectional gated recurrent network over overlapping windows of words.

A word enters as its own vector (words of the training vocabulary) plus the mean vector
of its byte pairs, so unseen words are read by their spelling.  Two recurrences run over
each window, an attention layer pools their states, and a text's score is that of its
highest window, calibrated on held-back training rows.  Trained in numpy on the driver
over a bounded sample of labelled rows; scored in tasks over all windows of all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import LOWER, WORD_BYTE, Words, map_batches, pieces, words_of

#: Bounds of the training sample: rows, and bytes of a text that may be in it.
TRAIN_ROWS = 3000
TRAIN_TEXT_BYTES = 20_000
VOCABULARY = 20_000
PAIRS = 1 << 12
WINDOW, STRIDE = 32, 24
WORD_DIM, HIDDEN = 12, 8
EPOCHS = 6
THRESHOLD = 0.3


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * 0.5) * 0.5 + 0.5


@dataclass
class Text:
    """Words of some rows: distinct words, their byte pairs and the index of each word."""

    distinct: np.ndarray
    pairs: np.ndarray
    pair_bounds: np.ndarray
    index: np.ndarray
    bounds: np.ndarray


def byte_pairs(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(pair buckets, first pair of each word) of lower-cased words, edges included."""
    sizes = ends - starts + 1
    first = np.cumsum(sizes) - sizes
    right_at = np.arange(sizes.sum()) + np.repeat(starts - first, sizes)
    last = max(len(data) - 1, 0)
    left = LOWER[data[np.clip(right_at - 1, 0, last)]].astype(np.int32)
    right = LOWER[data[np.minimum(right_at, last)]].astype(np.int32)
    left[first] = 1
    right[first + sizes - 1] = 2
    return (left * 769 + right * 31) % PAIRS, first


def read_words(texts: list[bytes]) -> Text:
    """The words of whole texts, hashed slice by slice."""
    starts, ends, hashes, bounds = [], [], [], [np.zeros(1, np.int64)]
    at = n = 0
    for _, _, data, offsets in pieces(pa.array(texts, pa.large_binary())):
        words = words_of(data, offsets, WORD_BYTE)
        starts.append(words.starts + at)
        ends.append(words.ends + at)
        hashes.append(words.hashes)
        bounds.append(words.bounds[1:] + n)
        at, n = at + len(data), n + len(words.hashes)
    none = np.zeros(0, np.int64)
    hashes = np.concatenate([none.astype(np.uint64), *hashes])
    distinct, first, index = np.unique(hashes, return_index=True, return_inverse=True)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    starts, ends = np.concatenate([none, *starts])[first], np.concatenate([none, *ends])[first]
    pairs, pair_bounds = byte_pairs(data, starts, ends)
    return Text(distinct, pairs, pair_bounds, index.astype(np.int32), np.concatenate(bounds))


def windows_of(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, row) of every window; a row without words has one empty window."""
    n = np.diff(bounds)
    count = 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE))
    row = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return bounds[:-1][row] + k * STRIDE, row


class Model:
    """Parameters, forward pass and gradients of the network."""

    def __init__(self, vocabulary: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        d, h = WORD_DIM, HIDDEN
        self.vocabulary = vocabulary  # sorted hashes; row 0 of the vectors is any other word
        self.scale, self.shift = 1.0, 0.0
        self.p = {
            "word": normal(len(vocabulary) + 1, d, scale=0.1),
            "pair": normal(PAIRS, d, scale=0.1),
            "pad": normal(1, d, scale=0.1),
            "att": normal(2 * h, scale=0.3),
            "out": normal(2 * h, scale=0.3),
            "bias": np.full(1, -1.0, dtype=np.float32),
        }
        for side in "fb":
            self.p |= {
                f"W{side}": normal(d, 3 * h, scale=d**-0.5),
                f"U{side}": normal(h, 3 * h, scale=h**-0.5),
                f"b{side}": np.zeros(3 * h, dtype=np.float32),
            }

    def rows_of(self, distinct: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(distinct), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, distinct), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == distinct, at + 1, 0)

    def inputs(self, text: Text, rows: np.ndarray) -> np.ndarray:
        """Vectors of the distinct words, and last that of the padding."""
        p = self.p
        x = np.empty((len(rows) + 1, WORD_DIM), dtype=np.float32)
        if len(rows):
            sums = np.add.reduceat(p["pair"][text.pairs], text.pair_bounds, axis=0)
            counts = np.diff(np.append(text.pair_bounds, len(text.pairs)))
            x[:-1] = p["word"][rows] + sums / counts[:, None].astype(np.float32)
        x[-1] = p["pad"]
        return x

    def _run(self, gates: np.ndarray, index: np.ndarray, side: str, keep: list | None) -> np.ndarray:
        p, h = self.p[f"U{side}"], HIDDEN
        state = np.zeros((len(index), h), dtype=np.float32)
        states = np.empty((index.shape[1], len(index), h), dtype=np.float32)
        order = range(index.shape[1]) if side == "f" else range(index.shape[1] - 1, -1, -1)
        for t in order:
            g = gates[index[:, t]]
            u = state @ p
            zr = sigmoid(g[:, : 2 * h] + u[:, : 2 * h])
            z, r = zr[:, :h], zr[:, h:]
            n = np.tanh(g[:, 2 * h :] + r * u[:, 2 * h :])
            if keep is not None:
                keep.append((t, state, z, r, n, u[:, 2 * h :]))
            state = n + z * (state - n)
            states[t] = state
        return states

    def forward(self, x: np.ndarray, index: np.ndarray, real: np.ndarray, keep: dict | None = None):
        """Logits of windows: ``index`` (windows, words) into ``x``, ``real`` marks no padding."""
        p = self.p
        states = []
        for side in "fb":
            kept = [] if keep is not None else None
            states.append(self._run(x @ p[f"W{side}"] + p[f"b{side}"], index, side, kept))
            if keep is not None:
                keep[side] = kept
        both = np.concatenate(states, axis=2)
        energy = np.where(real.T, both @ p["att"], np.float32(-30.0))
        energy = np.exp(energy - energy.max(axis=0))
        weight = energy / energy.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", weight, both)
        if keep is not None:
            keep |= {"both": both, "weight": weight, "pooled": pooled}
        return pooled @ p["out"] + p["bias"]

    def gradients(self, text: Text, rows: np.ndarray, index: np.ndarray, real: np.ndarray,
                  target: np.ndarray, cost: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted cross-entropy of windows, by back-propagation through time."""
        p, h, keep = self.p, HIDDEN, {}
        x = self.inputs(text, rows)
        logit = self.forward(x, index, real, keep)
        d_logit = ((sigmoid(logit) - target) * cost).astype(np.float32)
        both, weight, pooled = keep["both"], keep["weight"], keep["pooled"]
        g = {"out": pooled.T @ d_logit, "bias": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * p["out"]
        d_weight = np.einsum("tbh,bh->tb", both, d_pooled)
        d_energy = weight * (d_weight - (weight * d_weight).sum(axis=0))
        d_energy = np.where(real.T, d_energy, 0).astype(np.float32)
        g["att"] = np.einsum("tb,tbh->h", d_energy, both)
        d_both = weight[:, :, None] * d_pooled + d_energy[:, :, None] * p["att"]
        dx = np.zeros_like(x)
        for k, side in enumerate("fb"):
            u = p[f"U{side}"]
            g[f"U{side}"] = np.zeros_like(u)
            d_gates = np.zeros((len(x), 3 * h), dtype=np.float32)
            carry = np.zeros((len(index), h), dtype=np.float32)
            for t, before, z, r, n, un in reversed(keep[side]):
                d = carry + d_both[t, :, k * h : (k + 1) * h]
                dn = d * (1 - z) * (1 - n * n)
                dz = d * (before - n) * z * (1 - z)
                dr = dn * un * r * (1 - r)
                du = np.concatenate([dz, dr, dn * r], axis=1)
                g[f"U{side}"] += before.T @ du
                carry = d * z + du @ u.T
                np.add.at(d_gates, index[:, t], np.concatenate([dz, dr, dn], axis=1))
            g[f"W{side}"] = x.T @ d_gates
            g[f"b{side}"] = d_gates.sum(axis=0)
            dx += d_gates @ p[f"W{side}"].T
        g["pad"] = dx[-1:]
        g["word"] = np.zeros_like(p["word"])
        np.add.at(g["word"], rows, dx[:-1])
        g["pair"] = np.zeros_like(p["pair"])
        counts = np.diff(np.append(text.pair_bounds, len(text.pairs)))
        np.add.at(g["pair"], text.pairs, np.repeat(dx[:-1] / np.maximum(counts, 1)[:, None], counts, axis=0))
        return g

    def freeze(self, text: Text, rows: np.ndarray) -> None:
        """Compute the gate inputs of the vocabulary and of the padding once, for scoring."""
        x = np.zeros((len(self.vocabulary) + 1, WORD_DIM), dtype=np.float32)
        found = self.inputs(text, rows)
        x[rows[rows > 0] - 1] = found[:-1][rows > 0]
        x[-1] = found[-1]
        self.known = [self._gate_inputs(x, side) for side in "fb"]

    def _gate_inputs(self, x: np.ndarray, side: str) -> list[np.ndarray]:
        """Update, reset and candidate inputs; the first two halved for ``tanh``."""
        g = x @ self.p[f"W{side}"] + self.p[f"b{side}"]
        h = HIDDEN
        return [np.ascontiguousarray(g[:, k * h : (k + 1) * h] * (1.0 if k == 2 else 0.5)) for k in range(3)]

    def gate_tables(self, words: Words, data: np.ndarray) -> tuple[list, np.ndarray, int]:
        """(gate inputs by direction, row of each word, row of the padding) of a slice.

        Words of the vocabulary use the frozen rows; others are read by their spelling.
        """
        rows = self.rows_of(words.hashes) - 1
        other = np.flatnonzero(rows < 0)
        pad = len(self.vocabulary)
        if not len(other):
            return self.known, rows, pad
        pairs, first = byte_pairs(data, words.starts[other], words.ends[other])
        sizes = (words.ends[other] - words.starts[other] + 1).astype(np.float32)
        x = np.add.reduceat(self.p["pair"][pairs], first, axis=0) / sizes[:, None]
        x += self.p["word"][0]
        rows[other] = pad + 1 + np.arange(len(other))
        tables = [
            [np.concatenate([a, b]) for a, b in zip(old, self._gate_inputs(x, side), strict=True)]
            for old, side in zip(self.known, "fb", strict=True)
        ]
        return tables, rows, pad

    def _fast_states(self, tables: list, index: np.ndarray, side: str, out: np.ndarray) -> None:
        h, u = HIDDEN, self.p[f"U{side}"]
        uz, ur, un = (np.ascontiguousarray(u[:, k * h : (k + 1) * h] * (1.0 if k == 2 else 0.5)) for k in range(3))
        state = np.zeros((index.shape[1], h), dtype=np.float32)
        steps = range(len(index)) if side == "f" else range(len(index) - 1, -1, -1)
        for t in steps:
            z, r, n = (table.take(index[t], axis=0) for table in tables)
            z += state @ uz
            np.tanh(z, out=z)
            z *= 0.5
            z += 0.5
            r += state @ ur
            np.tanh(r, out=r)
            r *= 0.5
            r += 0.5
            r *= state @ un
            n += r
            np.tanh(n, out=n)
            state -= n
            state *= z
            state += n
            out[t] = state

    def window_logits(self, words: Words, data: np.ndarray, starts: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Logits of windows by their first word and row: ``forward`` without gradients."""
        tables, rows, pad = self.gate_tables(words, data)
        p, h = self.p, HIDDEN
        logit = np.empty(len(starts), dtype=np.float32)
        for at in range(0, len(starts), 1024):
            part = slice(at, at + 1024)
            place = np.arange(WINDOW)[:, None] + starts[part]
            real = place < words.bounds[row[part] + 1]
            index = np.full(place.shape, pad)
            index[real] = rows[place[real]]
            f = np.empty((*place.shape, h), dtype=np.float32)
            b = np.empty_like(f)
            self._fast_states(tables[0], index, "f", f)
            self._fast_states(tables[1], index, "b", b)
            energy = f @ p["att"][:h] + b @ p["att"][h:]
            energy = np.where(real, energy, np.float32(-30.0))
            energy = np.exp(energy - energy.max(axis=0))
            energy /= energy.sum(axis=0)
            value = f @ p["out"][:h] + b @ p["out"][h:]
            logit[part] = (energy * value).sum(axis=0) + p["bias"]
        return logit

    def all_logits(self, texts: list[bytes]) -> np.ndarray:
        """Logits of all windows of all texts, in order."""
        out = [np.zeros(0, dtype=np.float32)]
        for _, _, data, offsets in pieces(pa.array(texts, pa.large_binary())):
            words = words_of(data, offsets, WORD_BYTE)
            out.append(self.window_logits(words, data, *windows_of(words.bounds)))
        return np.concatenate(out)

    def highest(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The logit of the highest window of each row."""
        words = words_of(data, offsets, WORD_BYTE)
        starts, row = windows_of(words.bounds)
        if not len(row):
            return np.zeros(0)
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        logit = self.window_logits(words, data, starts, row)
        return np.maximum.reduceat(logit, first).astype(np.float64)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The calibrated score of each row."""
        best = self.scale * self.highest(data, offsets) + self.shift
        return 1 / (1 + np.exp(-np.clip(best, -30, 30)))


def spread_out(text: Text, starts: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indexes, real) of windows; padding points behind the last distinct word."""
    at = starts[:, None] + np.arange(WINDOW)
    real = at < text.bounds[row + 1][:, None]
    padding = len(text.distinct)
    if not len(text.index):
        return np.full(at.shape, padding), real
    return np.where(real, text.index[np.minimum(at, len(text.index) - 1)], padding), real


def train(texts: list[bytes], labels: list[int], seed: int = 5, epochs: int = EPOCHS) -> Model:
    """Fit the network on whole texts with one label each.

    The windows of a text share its label, so each epoch takes the window of a positive
    text that scores highest (at first by word counts) and for a negative text that one
    and two others.  A fifth of the texts is held back to calibrate the scores.
    """
    rng = np.random.default_rng(seed)
    text = read_words(texts)
    y = np.array(labels, dtype=np.float64)
    held = rng.random(len(y)) < 0.2
    starts, row = windows_of(text.bounds)
    of_word = np.searchsorted(text.bounds, np.arange(len(text.index)), side="right") - 1
    both = of_word * len(text.distinct) + text.index
    in_row, word = np.divmod(np.unique(both[~held[of_word]]), max(len(text.distinct), 1))
    good = np.bincount(word, weights=y[in_row], minlength=len(text.distinct))
    every = np.bincount(word, minlength=len(text.distinct))
    del both, of_word, in_row, word
    common = np.flatnonzero(every >= 2)
    common = common[np.argsort(-every[common], kind="stable")[:VOCABULARY]]
    model = Model(np.sort(text.distinct[common]), seed)
    rows = model.rows_of(text.distinct)
    n_pos, n_neg = (y[~held] == 1).sum(), (y[~held] == 0).sum()
    if not n_pos or not n_neg:
        model.freeze(text, rows)
        model.scale, model.shift = 0.0, 4.0 if n_pos else -4.0
        return model
    odds = np.log((good + 0.1) / (n_pos + 0.2)) - np.log((every - good + 0.1) / (n_neg + 0.2))
    odds = np.where(every >= 3, odds, 0.0) * np.minimum(1.0, good / 6)
    model.p["word"][rows, 0] = np.where(rows > 0, odds * 0.2, 0.0)
    index, real = spread_out(text, starts, row)
    guess = np.append(np.maximum(odds, 0), 0.0)[index].max(axis=1)
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    logit = guess.astype(np.float32)
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in model.p.items()}
    tick = 0
    for epoch in range(epochs):
        best = np.empty(len(y), dtype=np.int64)
        order = np.lexsort((-logit, row))
        best[row[order[first]]] = order[first]
        others = np.flatnonzero(~held & (y == 0))
        more = [first[others] + rng.integers(0, np.bincount(row, minlength=len(y))[others]) for _ in range(2)]
        chosen = np.concatenate([best[~held], *more])
        cost = np.where(y[row[chosen]] == 1, max(1.0, 0.3 * n_neg / n_pos), 1.0)
        if epoch > 1:  # a positive text without one telling window is likelier a wrong label
            cost[(y[row[chosen]] == 1) & (logit[chosen] < 0)] *= 0.05
        shuffle = rng.permutation(len(chosen))
        for at in range(0, len(chosen), 64):
            w = chosen[shuffle[at : at + 64]]
            unseen = np.where(rng.random(len(rows)) < 0.1, 0, rows)
            g = model.gradients(
                *_narrow(text, unseen, index[w]), real[w], y[row[w]],
                cost[shuffle[at : at + 64]] / len(w),
            )
            tick += 1
            rate = 0.005 * (1 - 0.8 * epoch / epochs)
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            shrink = np.float32(min(1.0, 1.0 / (norm + 1e-9)))
            for k, v in g.items():
                v = v.reshape(model.p[k].shape) * shrink + (1e-5 * model.p[k] if k in ("word", "pair") else 0)
                m, s = moment[k]
                m += 0.1 * (v - m)
                s += 0.01 * (v * v - s)
                step = m / (1 - 0.9**tick) / (np.sqrt(s / (1 - 0.99**tick)) + 1e-6)
                model.p[k] -= (rate * step).astype(np.float32)
        if epoch in (1, 3, epochs - 1):
            model.freeze(text, rows)
            logit = model.all_logits(texts)
    _calibrate(model, np.maximum.reduceat(logit, first).astype(np.float64), y, held)
    return model


def _narrow(text: Text, rows: np.ndarray, index: np.ndarray):
    """The part of a text that some windows use."""
    used, inverse = np.unique(index, return_inverse=True)
    used = used[used < len(rows)]
    bounds = np.append(text.pair_bounds, len(text.pairs))
    sizes = bounds[used + 1] - bounds[used]
    starts = np.cumsum(sizes) - sizes
    at = np.repeat(bounds[used] - starts, sizes) + np.arange(sizes.sum())
    part = Text(text.distinct[used], text.pairs[at], starts, text.index[:0], text.bounds[:1])
    return part, rows[used], np.minimum(inverse.reshape(index.shape), len(used))


def _calibrate(model: Model, logit: np.ndarray, y: np.ndarray, held: np.ndarray) -> None:
    """Slope and shift of the scores on the rows held back, or on all if they are few."""
    use = held if (y[held] == 1).sum() >= 5 and (y[held] == 0).sum() >= 5 else np.ones(len(y), bool)
    x = np.stack([np.clip(logit[use], -8, 8), np.ones(use.sum())], axis=1)
    t, w = y[use], np.array([1.0, 0.0])
    for _ in range(50):
        s = 1 / (1 + np.exp(-x @ w))
        h = (x * (s * (1 - s))[:, None]).T @ x + np.diag([0.05, 0.01])
        step = np.linalg.solve(h, x.T @ (s - t) + np.array([0.05 * (w[0] - 1), 0.01 * w[1]]))
        w = w - step / max(1.0, float(np.abs(step).max()))
    model.scale, model.shift = max(float(w[0]), 0.05), float(w[1])


def training_rows(docs: DataFrame, labels: DataFrame, text: str = "text") -> tuple[list, list]:
    """The bounded sample: rows with a label whose crc32(doc_id) mod 4 is not 2."""
    usable = labels.filter("toxic in (0, 1) and doc_id is not null").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")
    )
    usable = usable.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= TRAIN_TEXT_BYTES)
    found = rows.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    return [(r["text"] or "").encode() for r in found], [r["toxic"] for r in found]


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text") -> Model:
    """Train on at most ``TRAIN_ROWS`` labelled rows of at most ``TRAIN_TEXT_BYTES`` each."""
    texts, toxic = training_rows(docs, labels, text)
    if not texts:
        model = Model(np.zeros(0, dtype=np.uint64))
        model.freeze(read_words([]), np.zeros(0, np.int64))
        model.scale, model.shift = 0.0, -4.0
        return model
    return train(texts, toxic)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """(doc_id, score) of every row, from all windows of the whole text.

    Null and empty texts, and texts without a word, are one window of padding and get
    the score of that.  Repeated rows stay, null ids too; extra columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for first, end, data, offsets in pieces(batch.column(1)):
            yield {
                "doc_id": batch.column(0).slice(first, end - first),
                "score": shared.value.scores(data, offsets),
            }

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(slim, "doc_id bigint, score double", work)
