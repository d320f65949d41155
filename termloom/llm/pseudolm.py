"""Masked pseudo-likelihood: every word predicted from the words on both sides of it.

A small network is trained in numpy: the vectors of ``REACH`` words on each side, weighted
by place, sum to a hidden state that predicts the masked word in two steps, its class and
the word within it.  The vocabulary comes from counts over all documents.  Tasks train
on their own rows from common parameters, and their parameters are averaged, weighted by
words, after each round.  The rounds share out the places of a document, so every word
of every document is a target once.  A document's score is the sum of the conditional log-probabilities of all its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import WORD_BYTE, map_batches, mix, pieces, words_of
from termloom.session import stage

REACH = 4
DIM = 16
CLASSES = WITHIN = 64
VOCABULARY = CLASSES * WITHIN
ROUNDS = 2
BATCH = 1 << 14
RATE = 0.08
STEEPEST = 60  # logits end here on both sides; what they give still sums to one
_SHIFTS = (*range(REACH), *range(REACH + 1, 2 * REACH + 1))  # of the words around, from the first
SHARE = 4096  # values of the parameters in one row of the exchange
SALTS = 64
HEAD = 16  # leading bits by which words are looked up
_REST = np.uint64(64 - HEAD)


@dataclass
class Vocabulary:
    """Hashes of the most frequent words; id 0 stands for all others, counted together."""

    order: np.ndarray
    ids: np.ndarray
    log_share: np.ndarray
    other: int
    first: np.ndarray  # where the hashes of each ``HEAD`` leading bits begin in ``order``
    most: int  # such hashes at most

    @staticmethod
    def of(hashes: np.ndarray, counts: np.ndarray, other: int) -> Vocabulary:
        """From the frequent words, most frequent first, and what is left of all counts."""
        share = np.full(VOCABULARY, 0.5)
        share[0] += other
        share[1 : len(counts) + 1] += counts
        order = np.argsort(hashes)
        heads = np.bincount((hashes >> _REST).astype(np.int64), minlength=1 << HEAD)
        first = np.cumsum(heads) - heads
        log_share = np.log(share / share.sum())
        return Vocabulary(hashes[order], order + 1, log_share, max(other, 1), first, int(heads.max()))

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.order):
            return np.zeros(len(hashes), dtype=np.int64)
        # Few share their leading bits, so a word meets one or two of them, not a search.
        start = self.first.take((hashes >> _REST).astype(np.int64))
        found = np.zeros(len(hashes), dtype=np.int64)
        for step in range(self.most):
            at = np.minimum(start + step, len(self.order) - 1)
            np.copyto(found, self.ids.take(at), where=self.order.take(at) == hashes)
        return found


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """(word, n) over all documents, summed in each task before it moves."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(words.view(np.int64)), pa.array(counts)], names=["word", "n"]
            )

        for batch in batches:
            for _, _, data, offsets in pieces(batch.column(0)):
                fresh, n = np.unique(words_of(data, offsets, WORD_BYTE).hashes, return_counts=True)
                words, where = np.unique(np.concatenate([words, fresh]), return_inverse=True)
                counts = np.bincount(where, weights=np.concatenate([counts, n])).astype(np.int64)
                if len(words) > 1 << 20:
                    yield out()
                    words, counts = words[:0], counts[:0]
        yield out()

    found = docs.select(text).mapInArrow(work, "word bigint, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary_of(counts: DataFrame) -> Vocabulary:
    """From the staged table of ``count_words``."""
    top = counts.orderBy(F.col("n").desc(), "word").limit(VOCABULARY - 1).collect()
    whole = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    hashes = np.array([r["word"] for r in top], dtype=np.int64).view(np.uint64)
    n = np.array([r["n"] for r in top], dtype=np.int64)
    return Vocabulary.of(hashes, n, whole - int(n.sum()))


class Network:
    """The parameters and their gradients."""

    def __init__(self, vocabulary: Vocabulary, seed: int = 11):
        rng = np.random.default_rng(seed)
        share = np.exp(vocabulary.log_share).reshape(CLASSES, WITHIN)
        mass = share.sum(axis=1)

        def normal(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) * 0.1).astype(np.float32)

        # One more row of vectors is the edge of a document.
        self.p = {
            "vector": normal(VOCABULARY + 1, DIM),
            "place": np.ones((2 * REACH, DIM), dtype=np.float32) / REACH,
            "bias": np.zeros(DIM, dtype=np.float32),
            "class": normal(DIM, CLASSES) * 0,
            "class_bias": np.log(mass).astype(np.float32),
            "word": normal(CLASSES, DIM, WITHIN) * 0,
            "word_bias": np.log(share / mass[:, None]).astype(np.float32),
        }

    def hidden(self, padded: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hidden states at the places ``at``, and the vectors of all of ``padded`` as columns.

        The words around are shifted slices, so each vector is looked up once.
        """
        p, n = self.p, len(padded) - 2 * REACH
        near = np.ascontiguousarray(p["vector"].take(padded, axis=0).T)
        h = np.repeat(p["bias"][:, None], n, axis=1)
        part = np.empty_like(h)
        for k, shift in enumerate(_SHIFTS):
            h += np.multiply(near[:, shift : shift + n], p["place"][k][:, None], out=part)
        h = np.ascontiguousarray(h.T).take(at - REACH, axis=0)
        return np.tanh(h, out=h), near

    def log_probabilities(self, padded: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of each word of ``padded`` at the places ``at`` given the words around it."""
        p = self.p
        order, slices = _by_class(padded[at])
        h, _ = self.hidden(padded, at[order])
        group, word = np.divmod(padded[at[order]], WITHIN)
        logit = h @ p["class"]
        logit += p["class_bias"]
        found = _log_share(logit, group)
        for c, rows in slices:
            np.add(h[rows] @ p["word"][c], p["word_bias"][c], out=logit[rows])
        found += _log_share(logit, word)
        out = np.empty_like(found)
        out[order] = found
        return out

    def gradients(self, padded: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log-probability of the words of ``padded`` at ``at``."""
        p = self.p
        order, slices = _by_class(padded[at])
        at = at[order]
        target = padded[at]
        h, near = self.hidden(padded, at)
        group, word = np.divmod(target, WITHIN)
        g = {k: np.zeros_like(v) for k, v in p.items() if k in ("word", "word_bias", "vector")}
        d = _soft(h @ p["class"] + p["class_bias"])
        d[np.arange(len(h)), group] -= 1
        g["class"], g["class_bias"] = h.T @ d, d.sum(axis=0)
        dh = d @ p["class"].T
        for c, rows in slices:
            np.add(h[rows] @ p["word"][c], p["word_bias"][c], out=d[rows])
        _soft(d)
        d[np.arange(len(h)), word] -= 1
        for c, rows in slices:
            g["word"][c], g["word_bias"][c] = h[rows].T @ d[rows], d[rows].sum(axis=0)
            dh[rows] += d[rows] @ p["word"][c].T
        dh *= 1 - h * h
        g["bias"] = dh.sum(axis=0)
        # Shifted back to the words around, where each word's parts are summed once.
        n = len(padded) - 2 * REACH
        spread = np.zeros((n, DIM), dtype=dh.dtype)
        spread[at - REACH] = dh
        spread, back = np.ascontiguousarray(spread.T), np.zeros_like(near)
        g["place"], part = np.empty_like(p["place"]), np.empty_like(spread)
        for k, shift in enumerate(_SHIFTS):
            back[:, shift : shift + n] += np.multiply(spread, p["place"][k][:, None], out=part)
            g["place"][k] = np.einsum("ij,ij->i", spread, near[:, shift : shift + n])
        ids = padded.astype(np.uint16)  # sorted by digits
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        g["vector"][ids[first]] = np.add.reduceat(back.T.take(order, axis=0), first, axis=0)
        return {k: v / len(target) for k, v in g.items()}


def _exp(logit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In place, (exponentials, their sums): logits end at ``STEEPEST``, so none overflows."""
    np.exp(logit, out=logit)
    return logit, logit @ np.ones(logit.shape[1], dtype=logit.dtype)


def _log_share(logit: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    np.clip(logit, -STEEPEST, STEEPEST, out=logit)
    picked = logit[np.arange(len(logit)), chosen]
    return picked - np.log(_exp(logit)[1])


def _soft(logit: np.ndarray) -> np.ndarray:
    np.clip(logit, -STEEPEST, STEEPEST, out=logit)
    logit, sums = _exp(logit)
    logit *= (1 / sums)[:, None]
    return logit


def _by_class(target: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order of the targets by class, and the classes with their slices of it."""
    group = (target // WITHIN).astype(np.uint8)
    ends = np.cumsum(np.bincount(group, minlength=CLASSES)).tolist()
    slices = [(c, slice(a, b)) for c, (a, b) in enumerate(zip([0, *ends], ends)) if a < b]
    return np.argsort(group, kind="stable"), slices


def contexts(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(padded ids, place of each word in them): rows are kept apart by edges."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    place = np.arange(len(ids)) + REACH * (row + 1)
    padded = np.full(len(ids) + REACH * len(bounds), VOCABULARY, dtype=np.int64)
    padded[place] = ids
    return padded, place


def targets(place: np.ndarray, bounds: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    """Those of ``place`` whose words are targets in a round, by their place in the document.

    Of ``rounds`` neighbours each is in another round; which is first is hashed, so no
    regular text has some of its words in one round only.
    """
    within = np.arange(len(place)) - np.repeat(bounds[:-1], np.diff(bounds))
    shift = mix((within // rounds).astype(np.uint64)) % np.uint64(rounds)
    return place[(within + shift.astype(np.int64)) % rounds == turn]


def batches_of(padded: np.ndarray, place: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first, words, places in them) of at most ``BATCH`` places each, with the words around."""
    for first in range(0, len(place), BATCH):
        here = place[first : first + BATCH]
        low = here[0] - REACH
        yield first, padded[low : here[-1] + REACH + 1], here - low


def train(docs: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS, text: str = "text") -> Network:
    """Rounds of local training over all rows, each followed by an average."""
    network = Network(vocabulary)
    spark = docs.sparkSession
    shapes = {k: v.shape for k, v in network.p.items()}

    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((vocabulary, network.p))

        def work(batches: Iterator[pa.RecordBatch], turn=turn, shared=shared) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            words, start = shared.value
            local = Network(words)
            local.p = {k: v.copy() for k, v in start.items()}
            squares = {k: np.full_like(v, 1e-6) for k, v in local.p.items()}
            seen = 0
            for batch in batches:
                for _, _, data, offsets in pieces(batch.column(0)):
                    found = words_of(data, offsets, WORD_BYTE)
                    padded, place = contexts(words.look_up(found.hashes), found.bounds)
                    place = targets(place, found.bounds, turn, rounds)
                    for _, around, here in batches_of(padded, place):
                        for k, v in local.gradients(around, here).items():
                            squares[k] += v * v
                            local.p[k] -= RATE / (turn + 1) * v / np.sqrt(squares[k])
                        seen += len(here)
            part = TaskContext.get().partitionId()
            flat = np.concatenate([local.p[k].ravel() for k in shapes]).astype(np.float64) * seen
            for at in range(0, len(flat) if seen else 0, SHARE):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([at], pa.int64()), pa.array([part], pa.int64()),
                        pa.array([float(seen)]), pa.array([flat[at : at + SHARE].tobytes()]),
                    ],
                    names=["at", "part", "weight", "total"],
                )

        sums = docs.select(text).mapInArrow(work, "at bigint, part bigint, weight double, total binary")
        # Salted first, so no group grows with the number of tasks beyond its share.
        sums = _added(sums.withColumn("part", F.pmod("part", F.lit(SALTS))), "at", "part")
        rows = _added(sums.withColumn("part", F.lit(0)), "at", "part").collect()  # the parameters
        if not rows:
            return network
        flat = np.concatenate(
            [np.frombuffer(r["total"]) / r["weight"] for r in sorted(rows, key=lambda r: r["at"])]
        ).astype(np.float32)
        at = 0
        for k, shape in shapes.items():
            size = int(np.prod(shape))
            network.p[k] = flat[at : at + size].reshape(shape)
            at += size
    return network


def _added(sums: DataFrame, *keys: str) -> DataFrame:
    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(raw) for raw in rows["total"]], axis=0)
        return rows.iloc[:1].assign(weight=rows["weight"].sum(), total=[total.tobytes()])

    schema = "at bigint, part bigint, weight double, total binary"
    return sums.select("at", F.col("part").cast("bigint").alias("part"), "weight", "total").groupBy(
        *keys
    ).applyInPandas(add, schema)


def rare_words(words: np.ndarray, row: np.ndarray, n_rows: int) -> tuple[pa.Array, pa.Array]:
    """(words, times): the different words of each row and how often they are in it."""
    order = np.lexsort((words, row))
    words, row = words[order], row[order]
    new = np.append(True, (words[1:] != words[:-1]) | (row[1:] != row[:-1]))[: len(words)]
    first = np.flatnonzero(new)
    bounds = pa.array(np.searchsorted(row[first], np.arange(n_rows + 1)).astype(np.int32))
    times = np.diff(np.append(first, len(words))).astype(np.int32)
    return (
        pa.ListArray.from_arrays(bounds, pa.array(words[first].view(np.int64))),
        pa.ListArray.from_arrays(bounds, pa.array(times)),
    )


def score(
    docs: DataFrame, network: Network, vocabulary: Vocabulary, counts: DataFrame, text: str = "text"
) -> DataFrame:
    """(doc_id, n_words, pseudo_log_likelihood, score) of every row, over whole texts.

    A word outside the vocabulary also pays for its share of all such words, by its own
    count in ``counts``.  ``score`` is the mean over the words; null, empty and wordless
    texts have a sum of 0 and a null score.  Repeated rows stay; extra columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, network))

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        words, model = shared.value
        for first, end, data, offsets in pieces(batch.column(2)):
            found = words_of(data, offsets, WORD_BYTE)
            ids = words.look_up(found.hashes)
            padded, place = contexts(ids, found.bounds)
            logs = np.empty(len(ids))
            for at, around, here in batches_of(padded, place):
                logs[at : at + BATCH] = model.log_probabilities(around, here)
            rare = np.flatnonzero(ids == 0)
            row = np.repeat(np.arange(end - first), np.diff(found.bounds))[rare]
            hashes, times = rare_words(found.hashes[rare], row, end - first)
            yield {
                "row": batch.column(0).slice(first, end - first),
                "doc_id": batch.column(1).slice(first, end - first),
                "n_words": np.diff(found.bounds),
                "logs": np.diff(np.append(0.0, np.cumsum(logs))[found.bounds]),
                "words": hashes,
                "times": times,
            }

    slim = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col(text).alias("text"),
    )
    schema = "row bigint, doc_id bigint, n_words bigint, logs double, words array<bigint>, times array<int>"
    scored = stage(map_batches(slim, schema, work), "lm-scored")  # rows keep their numbers
    rare = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("w"))
    rare = rare.select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    price = F.log(F.col("n") / F.lit(float(vocabulary.other)))
    paid = rare.join(counts, "word").groupBy("row").agg(F.sum(F.col("times") * price).alias("paid"))
    whole = F.col("logs") + F.coalesce("paid", F.lit(0.0))
    return scored.select("row", "doc_id", "n_words", "logs").join(paid, "row", "left").select(
        "doc_id", "n_words", whole.alias("pseudo_log_likelihood"),
        F.when(F.col("n_words") > 0, whole / F.col("n_words")).alias("score"),
    )


def score_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """Count, train and score over one table.  An empty table gives an empty result."""
    counts = stage(count_words(docs, text), "lm-words")
    vocabulary = vocabulary_of(counts)
    return score(docs, train(docs, vocabulary, text=text), vocabulary, counts, text)
