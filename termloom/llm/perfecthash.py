"""Exact duplicates against a history of digests under a minimal perfect hash.

A history holds the distinct texts met so far.  Their SHA-256 digests are dealt to
buckets by hash; a bucket is one row with a minimal perfect hash of its digests and,
slot by slot, the full digest, the locator of the document that stays and the number of
copies.  A new digest is looked up in its bucket: any digest finds some slot or none, so
all 32 bytes are compared.  Members are repeats of a historical text; nonmembers are
groups of their own.

Copies are counted before they move, so a text that a third of all rows share is one row
per task, and buckets hold distinct digests, which are even.  Nothing but the winners of
the few largest groups (fewer than ``MANY``) is broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import mix
from termloom.session import stage

#: Distinct digests a bucket holds on average: some 4 MB with their locators.
BUCKET = 1 << 16
#: Groups with more than 1 / MANY of all rows are fewer than MANY.
MANY = 10_000

GROUPS = "digest binary, keep_id bigint, keep_row bigint, group_size bigint"
HISTORY = (
    "bucket bigint, buckets bigint, sizes array<int>, bits array<binary>, digests binary,"
    " ids array<bigint>, rows array<bigint>, counts array<bigint>"
)


def normalised(text: Column) -> Column:
    """Runs of white space become one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, row, digest): a stored table, so the row numbers stay what they are."""
    found = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"),
    )
    return stage(found, "exact-digests")


def groups(rows: DataFrame) -> DataFrame:
    """One row per digest: the smallest (doc_id, row), an id before no id, and the count."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    found = rows.groupBy("digest").agg(first.alias("first"), F.count("*").alias("group_size"))
    return found.select(
        "digest", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"),
        "group_size",
    )


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets))


def bytes_of(column: pa.ChunkedArray) -> np.ndarray:
    """A column of digests as rows of 32 bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, 32)


def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """The bit of each digest in a level; the words of a digest take turns."""
    words = np.ascontiguousarray(keys).view("<u8")[:, level % 4]
    seed = mix(np.array([level + 1], dtype=np.uint64))
    return (mix(words + seed) % np.uint64(size)).astype(np.int64)


def perfect_hash(keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Slots 0 to n - 1 of n different digests, and the bit table of each level.

    A digest alone at its bit takes it; those that collide go on to the next level, which
    has two bits for each of them.  A slot is the number of set bits before its own.
    """
    slots = np.empty(len(keys), dtype=np.int64)
    levels: list[np.ndarray] = []
    left, before = np.arange(len(keys)), 0
    while len(left):
        size = 2 * len(left) + 62
        at = place(keys[left], len(levels), size)
        bits = np.bincount(at, minlength=size) == 1
        alone = bits[at]
        slots[left[alone]] = before + np.cumsum(bits)[at[alone]] - 1
        before += int(bits.sum())
        levels.append(bits)
        left = left[~alone]
    return slots, levels


def find_slots(keys: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The slot each digest leads to, -1 for none; whose slot it is must be compared."""
    slots = np.full(len(keys), -1, dtype=np.int64)
    left, before = np.arange(len(keys)), 0
    for level, bits in enumerate(levels):
        at = place(keys[left], level, len(bits))
        hit = bits[at]
        slots[left[hit]] = before + np.cumsum(bits)[at[hit]] - 1
        before += int(bits.sum())
        left = left[~hit]
    return slots


def _build(buckets: int):
    def build(key: tuple, table: pa.Table) -> pa.Table:
        keys = bytes_of(table["digest"])
        slots, levels = perfect_hash(keys)
        order = pa.array(np.argsort(slots))
        row = {
            "bucket": [key[0].as_py()],
            "buckets": [buckets],
            "sizes": [[len(bits) for bits in levels]],
            "bits": [[np.packbits(bits).tobytes() for bits in levels]],
            "digests": [keys[order.to_numpy()].tobytes()],
            "ids": [table["keep_id"].take(order).to_pylist()],
            "rows": [table["keep_row"].take(order).to_pylist()],
            "counts": [table["group_size"].take(order).to_pylist()],
        }
        return pa.table(row, schema=HISTORY_ARROW)

    return build


HISTORY_ARROW = pa.schema(
    [
        ("bucket", pa.int64()), ("buckets", pa.int64()), ("sizes", pa.list_(pa.int32())),
        ("bits", pa.list_(pa.binary())), ("digests", pa.binary()), ("ids", pa.list_(pa.int64())),
        ("rows", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
    ]
)
GROUPS_ARROW = pa.schema(
    [("digest", pa.binary()), ("keep_id", pa.int64()), ("keep_row", pa.int64()), ("group_size", pa.int64())]
)


def build_history(found: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket over the groups of earlier documents; empty without any."""
    dealt = found.withColumn("bucket", bucket_of(buckets))
    return dealt.groupBy("bucket").applyInArrow(_build(buckets), HISTORY)


def _look_up(key: tuple, history: pa.Table, new: pa.Table) -> pa.Table:
    """The groups of a bucket after the new ones: historical winners, then nonmembers."""
    new = new.select(GROUPS_ARROW.names).cast(GROUPS_ARROW)
    if not history.num_rows:
        return new
    row = history.slice(0, 1).to_pylist()[0]
    sizes, packed = row["sizes"], row["bits"]
    levels = [
        np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool)
        for n, b in zip(sizes, packed, strict=True)
    ]
    kept = np.frombuffer(row["digests"], dtype=np.uint8).reshape(-1, 32)
    counts = np.array(row["counts"], dtype=np.int64)
    keys = bytes_of(new["digest"])
    slots = find_slots(keys, levels)
    member = slots >= 0
    member[member] = (kept[slots[member]] == keys[member]).all(axis=1)
    np.add.at(counts, slots[member], new["group_size"].to_numpy()[member])
    old = pa.table(
        {
            "digest": pa.array([k.tobytes() for k in kept], pa.binary()),
            "keep_id": pa.array(row["ids"], pa.int64()),
            "keep_row": pa.array(row["rows"], pa.int64()),
            "group_size": counts,
        },
        schema=GROUPS_ARROW,
    )
    return pa.concat_tables([old, new.filter(pa.array(~member))])


def look_up(history: DataFrame, new: DataFrame, buckets: int) -> DataFrame:
    """All groups, of the history and new: a member adds its copies to a historical group."""
    dealt = new.withColumn("bucket", bucket_of(buckets))
    return (
        history.groupBy("bucket").cogroup(dealt.groupBy("bucket")).applyInArrow(_look_up, GROUPS)
    )


def buckets_for(*tables: DataFrame) -> int:
    return max(t.count() for t in tables) // BUCKET + 1


def exact_duplicates(docs: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per document.

    ``history`` is a stored table of ``build_history``; its documents stay whatever their
    ids, and ``group_size`` counts them.  Without one, the documents up to the median id
    are the history of the others, so the smallest id of equal texts stays.

    A null text is empty, and empty texts are equal.  A row without an id comes after all
    others; of rows that share id and text one is kept.  Texts of any length are whole; an
    empty table gives no rows; other columns are not read.
    """
    rows = digests(docs)
    if history is None:
        middle = rows.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
        early = F.coalesce(F.col("doc_id") <= F.lit(middle).cast("bigint"), F.lit(False))
        old = stage(groups(rows.filter(early)), "exact-old")
        new = stage(groups(rows.filter(~early)), "exact-new")
        buckets = buckets_for(old, new)
        history = stage(build_history(old, buckets), "exact-history")
    else:
        new = groups(rows)
        first = history.select("buckets").first()
        buckets = first[0] if first else buckets_for(rows)
        # Rows of another table may have the same numbers.
        history = history.withColumn("rows", F.transform("rows", lambda _: F.lit(-1).cast("bigint")))
    found = stage(look_up(history, new, buckets), "exact-groups")
    return with_groups(rows, found)


def with_groups(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each document with its group; the largest groups are few and come to the rows."""
    large = F.col("group_size") * F.lit(MANY) > F.lit(rows.count())
    hot = F.broadcast(found.filter(large))
    near = rows.join(hot, "digest")
    far = rows.join(hot.select("digest"), "digest", "left_anti").join(found.filter(~large), "digest")
    return near.unionByName(far).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
