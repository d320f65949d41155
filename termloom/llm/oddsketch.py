"""Near-duplicate documents: MinHash bands for candidates, odd sketches to verify them.

A document's MinHash samples make band keys and are folded into a parity bitmap (an
odd sketch): bit ``hash(i, sample i) mod SKETCH_BITS`` is flipped for every sample.
The population count of the XOR of two bitmaps estimates how many samples differ, and
with it the similarity, very sharply where it is high.  Pairs that pass go to an exact
comparison of the full shingle sets.

Documents with equal sets become one class first, so no number of copies makes a pair.
In a bucket every class is held against the bucket's leader.  Where that leaves several
components in a bucket, its members get a fine sketch of many more samples and are
compared across components by it, block against block.  Two blocks give the most similar
pairs that join their components, a forest: fewer pairs than members.  Rounds go on while
any is confirmed and components grow.  What is still open then is settled by the full sets
in the tasks themselves: every estimate that may reach the threshold is checked there, and
only the forest of the links that hold comes out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import (
    NOT_SPACE,
    connected_components,
    give_back_memory,
    map_batches,
    mix,
    pieces,
    small_side,
    words_of,
)
from termloom.session import stage

SHINGLE = 5
BANDS, ROWS = 40, 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
#: Pairs whose estimate is below this are dropped: 0.75 less six standard deviations.
SKETCH_LEAST = 0.55
#: The fine sketch estimates with a standard deviation of 0.014 around 0.75.
FINE_SAMPLES, FINE_BITS, FINE_LEAST = 1024, 4096, 0.685
BLOCK = 512
#: Rows of a batch whose signatures are held at a time.
SLICE = 512

_U = np.uint64
_RNG = np.random.default_rng(97)
FACTORS = _RNG.integers(1, 2**63, FINE_SAMPLES, dtype=np.uint64) * _U(2) + _U(1)
PLACES = _RNG.integers(1, 2**63, max(SHINGLE, 8), dtype=np.uint64) * _U(2) + _U(1)
BAND_SALT = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
SAMPLE_SALT = mix(np.arange(1001, 1001 + FINE_SAMPLES, dtype=np.uint64))


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a column, in order."""
    for _, _, data, offsets in pieces(column):
        words = words_of(data, offsets, NOT_SPACE)
        h = words.hashes
        runs = np.zeros(max(len(h) - SHINGLE + 1, 0), dtype=np.uint64)
        for k in range(SHINGLE):
            runs += h[k : k + len(runs)] * PLACES[k]
        runs = mix(runs)
        for low, high in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
            n = high - low
            if n >= SHINGLE:
                yield np.unique(runs[low : high - SHINGLE + 1])
            elif n:
                short = (h[low:high] * PLACES[:n]).sum(dtype=np.uint64)
                yield mix(np.array([short + _U(n)], dtype=np.uint64))
            else:
                yield h[:0]


def samples_of(shingles: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """The least value of each of some permutations over a set."""
    least = np.full(samples, np.iinfo(np.uint64).max, dtype=np.uint64)
    step = max(1, 40_960 // samples)
    for at in range(0, len(shingles), step):
        block = shingles[at : at + step, None] * FACTORS[None, :samples]
        np.minimum(least, block.min(axis=0), out=least)
    return least


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each row of samples."""
    rows = samples.reshape(-1, BANDS, ROWS)
    keys = np.broadcast_to(BAND_SALT, rows.shape[:2]).copy()
    for r in range(ROWS):
        keys = mix(keys * _U(0x9E3779B97F4A7C15) + rows[:, :, r])
    return keys


def odd_sketches(samples: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity bitmaps, as ``bits / 64`` words, for each row of samples."""
    at = (mix(samples + SAMPLE_SALT[: samples.shape[1]]) % np.uint64(bits)).astype(np.int64)
    rows = np.arange(len(samples))[:, None] * bits
    odd = np.bincount((rows + at).ravel(), minlength=len(samples) * bits) & 1
    packed = np.packbits(odd.astype(np.uint8).reshape(len(samples), -1), axis=1, bitorder="little")
    return packed.reshape(-1).view(np.int64).reshape(-1, bits // 64)


def most_odd_bits(least: float, samples: int = SAMPLES, bits: int = SKETCH_BITS) -> int:
    """The largest XOR count at which the estimated similarity is still ``least``."""
    differing = 2 * samples * (1 - least)
    return int(np.ceil(bits / 2 * (1 - np.exp(-2 * differing / bits))))


def signatures(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bands, sketch) of every row."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        column = batch.column(1)
        for at in range(0, max(len(column), 1), SLICE):
            part = column.slice(at, SLICE)
            n, a, b, samples = [], [], [], []
            for s in shingle_sets(part):
                n.append(len(s))
                a.append(mix(s).sum(dtype=np.uint64))
                b.append(mix(s ^ _U(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                samples.append(samples_of(s))
            table = np.array(samples, dtype=np.uint64).reshape(-1, SAMPLES)
            yield {
                "doc_id": batch.column(0).slice(at, SLICE),
                "n_shingles": np.array(n, dtype=np.int64),
                "set_a": np.array(a, dtype=np.uint64).view(np.int64),
                "set_b": np.array(b, dtype=np.uint64).view(np.int64),
                "bands": _lists(band_keys(table).view(np.int64)),
                "sketch": _lists(odd_sketches(table)),
            }

    return map_batches(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text")),
        "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint,"
        " bands array<bigint>, sketch array<bigint>",
        work,
    )


def _lists(table: np.ndarray) -> pa.Array:
    offsets = np.arange(len(table) + 1, dtype=np.int32) * table.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(table.reshape(-1)))


def full_sets(ids: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, shingles) of the documents in ``ids``: all hashes, sorted, as bytes."""

    def sets(batch: pa.RecordBatch) -> Iterator[dict]:
        column = batch.column(1)
        for at in range(0, len(column), 128):
            yield {
                "doc_id": batch.column(0).slice(at, 128),
                "shingles": [s.tobytes() for s in shingle_sets(column.slice(at, 128))],
            }

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    wanted = slim.join(small_side(ids), "doc_id", "left_semi")
    return map_batches(wanted, "doc_id bigint, shingles binary", sets)


def confirm(pairs: DataFrame, docs: DataFrame, percent: int, text: str = "text") -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * common >= percent * union."""
    ids = stage(
        pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "near-ids"
    )
    full = stage(full_sets(ids, docs, text), "near-sets")
    one = full.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
    two = full.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))

    def judge(batch: pa.RecordBatch) -> Iterator[dict]:
        cols = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        keep = [
            similar(
                np.frombuffer(x.as_py(), dtype=np.uint64), np.frombuffer(y.as_py(), dtype=np.uint64), percent
            )
            for x, y in zip(cols["set_a"], cols["set_b"], strict=True)
        ]
        chosen = pa.array(keep, type=pa.bool_())
        yield {"a": cols["a"].filter(chosen), "b": cols["b"].filter(chosen)}

    joined = pairs.select("a", "b").join(two, "b").join(one, "a").select("a", "b", "set_a", "set_b")
    return map_batches(joined, "a bigint, b bigint", judge)


def passing(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches leave possible."""
    slim = classes.select("doc_id", "n_shingles", "sketch")
    one = slim.toDF("a", "n_a", "s_a")
    two = slim.toDF("b", "n_b", "s_b")
    odd = F.aggregate(
        F.zip_with("s_a", "s_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int")),
        F.lit(0), lambda x, y: x + y,
    )
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    joined = pairs.join(one, "a").join(two, "b").filter(sizes)
    return joined.filter(odd <= most_odd_bits(SKETCH_LEAST)).select("a", "b")


def fine_sketches(ids: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, sketch) of the documents in ``ids``, from ``FINE_SAMPLES`` samples."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        column = batch.column(1)
        for at in range(0, len(column), 256):
            rows = [samples_of(s, FINE_SAMPLES) for s in shingle_sets(column.slice(at, 256))]
            table = np.array(rows, dtype=np.uint64).reshape(-1, FINE_SAMPLES)
            yield {
                "doc_id": batch.column(0).slice(at, 256),
                "sketch": _lists(odd_sketches(table, FINE_BITS)),
            }

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    wanted = slim.join(small_side(ids), "doc_id", "left_semi")
    return map_batches(wanted, "doc_id bigint, sketch array<bigint>", work)


def rest_pairs(rows: DataFrame, percent: int, exact: bool) -> DataFrame:
    """Pairs (a, b) that join components of a bucket, a forest for any two blocks of it.

    ``rows`` has key, doc_id, component, n_shingles, the fine sketch, shingles (the full
    set, where ``exact``) and blocks, the number of blocks of its bucket.  A task sees two
    blocks at a time.  ``exact`` gives links only, and as many as connect what can be.
    """
    mine = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    dealt = rows.withColumn("mine", mine).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))
    )
    dealt = dealt.withColumn("low", F.least("mine", "other")).withColumn(
        "high", F.greatest("mine", "other")
    )
    dealt = dealt.select(
        "key", "low", "high", "doc_id", "component", "n_shingles", "mine", "sketch",
        *(["shingles"] if exact else []),
    )

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for numbers, sketches, sets in _groups(batches):
            pairs = _forest(numbers, sketches, sets, percent)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"]
            )
        give_back_memory()

    ordered = dealt.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return ordered.mapInArrow(forest, "a bigint, b bigint").distinct()


def _groups(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes] | None]]:
    """(numbers, sketches, sets) of each run of equal first three columns in sorted batches."""
    numbers = np.zeros((0, 7), dtype=np.int64)
    sketches = np.zeros((0, FINE_BITS // 64), dtype=np.uint64)
    sets: list[bytes] | None = None
    for batch in batches:
        fresh = [np.asarray(batch.column(i), dtype=np.int64) for i in range(7)]
        flat = np.asarray(batch.column(7).flatten(), dtype=np.int64).view(np.uint64)
        numbers = np.concatenate([numbers, np.stack(fresh, axis=1)])
        sketches = np.concatenate([sketches, flat.reshape(-1, FINE_BITS // 64)])
        if batch.num_columns > 8:
            sets = (sets or []) + batch.column(8).to_pylist()
        cuts = np.flatnonzero((numbers[1:, :3] != numbers[:-1, :3]).any(axis=1)) + 1
        for low, high in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=False):
            yield numbers[low:high], sketches[low:high], sets and sets[low:high]
        if len(cuts):
            numbers, sketches = numbers[cuts[-1] :], sketches[cuts[-1] :]
            sets = sets and sets[cuts[-1] :]
    if len(numbers):
        yield numbers, sketches, sets


def _may_be_links(numbers: np.ndarray, sketches: np.ndarray, percent: int) -> np.ndarray:
    """(odd bits, i, j) of the pairs across components that sizes and sketches leave possible."""
    _, low, high, _, comp, n, side = numbers.T
    split = low[0] != high[0]
    most = most_odd_bits(FINE_LEAST, FINE_SAMPLES, FINE_BITS)
    out = [np.zeros((0, 3), dtype=np.int32)]
    for at in range(0, len(numbers), 32):
        i = slice(at, at + 32)
        may = comp[i, None] != comp[None, :]
        may &= np.arange(len(numbers))[i, None] < np.arange(len(numbers))[None, :]
        may &= 100 * np.minimum(n[i, None], n) >= percent * np.maximum(n[i, None], n)
        if split:
            may &= side[i, None] != side[None, :]
        x, y = np.nonzero(may)
        for part in range(0, len(x), 1 << 14):
            a, b = x[part : part + (1 << 14)] + at, y[part : part + (1 << 14)]
            odd = np.bitwise_count(sketches[a] ^ sketches[b]).sum(axis=1, dtype=np.int32)
            good = odd <= most
            out.append(np.stack([odd[good], a[good], b[good]], axis=1).astype(np.int32))
    return np.concatenate(out)


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share ``percent`` of their union."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _forest(
    numbers: np.ndarray, sketches: np.ndarray, sets: list[bytes] | None, percent: int
) -> np.ndarray:
    """Pairs (smaller id, larger id), the most similar first, that join components."""
    found = _may_be_links(numbers, sketches, percent)
    ids = numbers[:, 3]
    _, tree = np.unique(numbers[:, 4], return_inverse=True)  # the component each row is in
    arrays = sets and [np.frombuffer(s, dtype=np.uint64) for s in sets]
    out = []
    for _, i, j in found[np.argsort(found[:, 0], kind="stable")].tolist():
        if tree[i] == tree[j] or (arrays and not similar(arrays[i], arrays[j], percent)):
            continue
        tree[tree == tree[j]] = tree[i]
        out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
    return np.array(out, dtype=np.int64).reshape(-1, 2)


def near_duplicates(docs: DataFrame, percent: int = 75, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Words are runs of non-space bytes with A-Z lower-cased; a set holds the distinct
    runs of five words, or the whole sequence of a shorter text.  Null, empty and blank
    texts have no shingles and link with nothing; so do rows without an id, whose
    component is null and which are kept.  Rows that repeat an id are all returned and
    share a component through that id.  Extra columns are ignored.  An empty table
    gives an empty result.
    """
    sig = stage(signatures(docs, text), "near-signatures")
    sets = ["n_shingles", "set_a", "set_b"]
    usable = sig.filter("n_shingles > 0 and doc_id is not null")
    classes = stage(usable.groupBy(*sets).agg(F.min("doc_id").alias("doc_id")), "near-classes")
    members = stage(
        usable.join(classes, ["doc_id", *sets], "left_semi").dropDuplicates(["doc_id", *sets]),
        "near-members",
    )
    keyed = members.select("doc_id", F.explode("bands").alias("key"))
    leaders = keyed.groupBy("key").agg(F.min("doc_id").alias("a"), F.count("*").alias("n"))
    leaders = stage(leaders.filter("n > 1"), "near-leaders")
    crowded = stage(
        keyed.join(leaders, "key").select("key", "n", "a", F.col("doc_id").alias("b")),
        "near-buckets",
    )
    pairs = crowded.filter("a < b").select("a", "b").distinct()
    tried = stage(passing(pairs, members, percent), "near-candidates")
    links = stage(confirm(tried, docs, percent, text), "near-links")
    labels = connected_components(links, "near-components")
    # Buckets of two are settled: their one pair has been judged.
    larger = crowded.filter("n > 2").select("key", "n", F.col("b").alias("doc_id"))
    fine, exact = None, False
    while True:
        marked = larger.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        marked = marked.withColumn("component", F.coalesce("component", "doc_id"))
        open_keys = marked.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high")
        )
        open_keys = open_keys.filter("low < high").select("key")
        rows = marked.join(open_keys, "key", "left_semi").withColumn(
            "blocks", F.ceil(F.col("n") / BLOCK)
        )
        rows = stage(rows.select("key", "doc_id", "component", "blocks"), "near-open")
        if not rows.limit(1).count():
            break
        ids = rows.select("doc_id").distinct()
        if fine is None:  # later rounds have no bucket that is not open now
            fine = fine_sketches(stage(ids, "near-ids"), docs, text)
            fine = stage(fine.dropDuplicates(["doc_id"]), "near-fine")
        facts = members.select("doc_id", "n_shingles").join(fine, "doc_id")
        if exact:
            full = full_sets(stage(ids, "near-ids"), docs, text).dropDuplicates(["doc_id"])
            facts = facts.join(stage(full, "near-sets"), "doc_id")
        rest = stage(rest_pairs(rows.join(facts, "doc_id"), percent, exact), "near-rest")
        if exact:
            links = links.union(rest)
            labels = connected_components(links, "near-components")
            break
        more = stage(rest.join(tried, ["a", "b"], "left_anti"), "near-more")
        found = stage(confirm(more, docs, percent, text), "near-links")
        tried, links = tried.union(more), links.union(found)
        # Without another link the best estimates have failed: the rest is for the full sets.
        exact = not found.limit(1).count()
        if not exact:
            labels = connected_components(links, "near-components")
    labels = labels.withColumnRenamed("id", "rep")
    reps = classes.withColumnRenamed("doc_id", "rep").join(labels, "rep", "left")
    reps = reps.select(*sets, F.coalesce("component", "rep").alias("component_id"))
    out = sig.select("doc_id", *sets).join(reps, sets, "left")
    component = F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")
    )
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
