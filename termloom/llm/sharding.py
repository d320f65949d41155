"""Shards of near equal bytes by balanced label propagation over linked documents.

A document's label is its shard.  Documents of one group (equal texts, say) are linked
through the group, never pair by pair.  In every round a join tells each document how its
group is spread, and documents move to the shard that holds most of their group's bytes,
as far as that shard has room: requests are summed per shard, and where they exceed the
room a hash decides which are granted.  Unlinked documents cut no edge wherever they are;
they fill the shards up to equal size at the end.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.session import stage

ROUNDS = 60
#: Hash parts in which running sums are taken; each is a small task, all are one table.
PARTS = 2048
#: Documents above this share of a shard are placed one by one: FINE a shard at most.
FINE = 512


def unit(*cols: Column | str) -> Column:
    """A number in [0, 1) from a hash."""
    return (F.xxhash64(*cols).bitwiseAND(F.lit((1 << 52) - 1))) / F.lit(float(1 << 52))


def _loads(rows: DataFrame, shards: int) -> list[int]:
    sums = rows.groupBy("shard").agg(F.sum("size").alias("n")).collect()  # a row a shard
    out = [0] * shards
    for r in sums:
        out[r["shard"]] = r["n"]
    return out


def start_labels(linked: DataFrame, shards: int) -> DataFrame:
    """``linked`` with a shard for each row that knows nothing of its links."""
    return linked.withColumn("shard", F.floor(unit("row", F.lit(1)) * shards).cast("int"))


def cut_edges(labels: DataFrame) -> float:
    """How many links (grp, shard) join documents of different shards, from counts."""
    held = labels.groupBy("grp", "shard").agg(F.count("*").cast("double").alias("n"))
    cut = held.groupBy("grp").agg((F.pow(F.sum("n"), F.lit(2)) - F.sum(F.col("n") * F.col("n"))).alias("n"))
    return (cut.agg(F.sum("n").alias("n")).first()["n"] or 0.0) / 2


def propagate(linked: DataFrame, shards: int, capacity: float, rounds: int = ROUNDS) -> DataFrame:
    """(row, shard) of linked rows (row, grp, size), by rounds of capped moves.

    Labels start at random.  A round offers each group the shard that already holds most
    of it among those with room.  Groups of less than an eighth of a shard move as a whole,
    larger ones by document.  It ends when no move is left or granted.
    """
    state = stage(start_labels(linked, shards), "shard-state")
    loads = _loads(state, shards)
    # The start may overfill a shard; what is too much leaves it at random.
    over = [max(0.0, 1 - capacity / n) if n else 0.0 for n in loads]
    if any(over):
        share = F.element_at(F.array(*[F.lit(x) for x in over]), F.col("shard") + 1)
        other = F.floor(unit("row", F.lit(3)) * shards).cast("int")
        state = stage(
            state.withColumn("shard", F.when(unit("row", F.lit(2)) < share, other).otherwise(F.col("shard"))),
            "shard-state",
        )
    for turn in range(rounds):
        loads = _loads(state, shards)
        room = [max(0.0, capacity - n) for n in loads]
        space = F.element_at(F.array(*[F.lit(x) for x in room]), F.col("shard") + 1)
        held = state.groupBy("grp", "shard").agg(F.sum("size").alias("bytes"), F.max("size").alias("most"))
        best = held.groupBy("grp").agg(
            F.sum("bytes").alias("whole"),
            F.count("*").alias("spread"),
            F.max(F.when(space >= F.col("most"), F.struct("bytes", "shard"))).alias("top"),
        ).filter("spread > 1 and top is not null")
        best = best.select("grp", "whole", F.col("top.bytes").alias("have"), F.col("top.shard").alias("to"))
        # Only from shards that hold less of the group: moves gather it, never swap it.
        wish = held.join(best, "grp").filter(
            (F.col("bytes") < F.col("have")) | ((F.col("bytes") == F.col("have")) & (F.col("shard") < F.col("to")))
        ).select("grp", "shard", "bytes", "whole", "to")
        wish = stage(wish, "shard-wishes")
        asked = wish.groupBy("to").agg(F.sum("bytes").alias("n")).collect()  # a row a shard
        if not asked:
            break
        grant = [1.0] * shards
        for r in asked:
            grant[r["to"]] = min(1.0, 0.97 * room[r["to"]] / r["n"]) if r["n"] > room[r["to"]] else 1.0
        part = F.element_at(F.array(*[F.lit(x) for x in grant]), F.col("to") + 1)
        coin = F.when(F.col("whole") * 8 <= capacity, unit("grp", F.lit(100 + turn))).otherwise(
            unit("row", F.lit(100 + turn))
        )
        moved = state.join(wish.drop("bytes"), ["grp", "shard"], "left").withColumn(
            "go", F.col("to").isNotNull() & (coin < part)
        )
        state = stage(
            moved.select(
                "row", "grp", "size", F.when(F.col("go"), F.col("to")).otherwise(F.col("shard")).alias("shard"), "go"
            ),
            "shard-state",
        )
        if not state.filter("go").limit(1).count():
            break
        state = state.drop("go")
    return state.select("row", "shard")


def within_capacity(placed: DataFrame, shards: int, capacity: float) -> DataFrame:
    """The rows (row, shard, size) that fit; what grants by hash let in too much leaves.

    Rows leave by hash parts, so a shard keeps its capacity up to one part.
    """
    loads = _loads(placed, shards)
    over = [k for k, n in enumerate(loads) if n > capacity]
    if not over:
        return placed
    part = F.floor(unit("row", F.lit(11)) * PARTS).cast("int")
    sums = placed.filter(F.col("shard").isin(over)).groupBy("shard", part.alias("part")).agg(
        F.sum("size").alias("n")
    ).collect()  # PARTS rows a shard at most
    last = [PARTS] * shards
    held = dict.fromkeys(over, 0)
    for r in sorted(sums, key=lambda r: (r["shard"], r["part"])):
        held[r["shard"]] += r["n"]
        if held[r["shard"]] > capacity:
            last[r["shard"]] = min(last[r["shard"]], r["part"])
    limit = F.element_at(F.array(*[F.lit(n) for n in last]), F.col("shard") + 1)
    return placed.filter(part < limit)


def level(loads: list[int], amount: int) -> list[float]:
    """How much each shard gets of an amount so that the lowest loads rise to one level."""
    order = sorted(loads)
    height = 0.0
    for k in range(1, len(order) + 1):
        height = (sum(order[:k]) + amount) / k
        if k == len(order) or height <= order[k]:
            break
    return [max(0.0, height - n) for n in loads]


def fill(free: DataFrame, loads: list[int], capacity: float) -> DataFrame:
    """(row, shard) of unlinked rows (row, size) so that all shards end near equal.

    The few rows that are large against a shard go one by one to the emptiest; the rest
    are laid end to end in hash order and cut where the shards are full.
    """
    shards, loads = len(loads), list(loads)
    limit = max(capacity / FINE, 1.0)
    # At most FINE rows a shard can be above the limit, whatever the input.
    large = free.filter(F.col("size") > limit).select("row", "size").collect()
    heap = [(n, k) for k, n in enumerate(loads)]
    heapq.heapify(heap)
    placed = []
    for r in sorted(large, key=lambda r: (-r["size"], r["row"])):
        n, k = heapq.heappop(heap)
        placed.append((r["row"], k))
        heapq.heappush(heap, (n + r["size"], k))
    for n, k in heap:
        loads[k] = n
    small = free.filter(F.col("size") <= limit).withColumn(
        "part", F.floor(unit("row", F.lit(7)) * PARTS).cast("int")
    )
    sums = small.groupBy("part").agg(F.sum("size").alias("n")).collect()  # PARTS rows at most
    before, total = {}, 0
    for r in sorted(sums, key=lambda r: r["part"]):
        before[r["part"]] = total
        total += r["n"]
    ends, at = [], 0.0
    for share in level(loads, total):
        at += share
        ends.append(at)
    spark = free.sparkSession
    offsets = spark.createDataFrame(list(before.items()) or [(0, 0)], "part int, before bigint")
    running = F.sum("size").over(
        Window.partitionBy("part").orderBy(F.xxhash64("row"), "row").rowsBetween(Window.unboundedPreceding, 0)
    )
    middle = F.col("before") + running - F.col("size") / 2
    shard = F.size(F.filter(F.array(*[F.lit(e) for e in ends[:-1]]), lambda e: e < middle))
    laid = small.join(F.broadcast(offsets), "part").select("row", shard.cast("int").alias("shard"))
    return laid.union(spark.createDataFrame(placed, "row bigint, shard int"))


def slots(rows: DataFrame, shards: int, order: str) -> DataFrame:
    """``rows`` with ``slot``, gapless from 0 in each shard: by hash part, then ``order``."""
    parted = rows.withColumn("part", F.floor(unit(order, F.lit(9)) * max(PARTS // shards, 1)).cast("int"))
    counts = parted.groupBy("shard", "part").agg(F.count("*").alias("n"))  # PARTS rows at most
    upto = F.sum("n").over(
        Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    )
    offsets = counts.select("shard", "part", (upto - F.col("n")).alias("before"))
    rank = F.row_number().over(Window.partitionBy("shard", "part").orderBy(order))
    joined = parted.withColumn("rank", rank).join(F.broadcast(offsets), ["shard", "part"])
    return joined.withColumn("slot", F.col("before") + F.col("rank") - 1).drop("part", "rank", "before")


def shard_documents(docs: DataFrame, shards: int = 24, text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row; equal texts are linked.

    A size is the UTF-8 bytes of the text plus eight.  Null texts have no bytes and link
    with nothing, empty ones are equal texts.  Shards are equal up to a fraction of a
    percent or the largest document, as long as unlinked documents can fill them; a group
    larger than the room in a shard is cut.  Repeated ids and null ids are rows like any
    other; extra columns are ignored.  An empty table gives an empty result.
    """
    bytes_ = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    group = F.when(F.col(text).isNotNull(), F.md5(F.col(text).cast("string").cast("binary")))
    # The row number names a row until the end; it is stored, so it never changes.
    nodes = stage(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.octet_length(bytes_) + 8).cast("bigint").alias("size"),
            F.crc32(bytes_).alias("text_crc32"),
            group.alias("grp"),
        ),
        "shard-nodes",
    )
    total = nodes.agg(F.sum("size").alias("n")).first()["n"] or 0
    capacity = max(total / shards, 1.0)
    several = nodes.filter("grp is not null").groupBy("grp").agg(F.count("*").alias("n")).filter("n > 1")
    several = stage(several.select("grp"), "shard-groups")
    slim = nodes.select("row", "grp", "size")
    linked = propagate(slim.join(several, "grp"), shards, capacity).join(slim.select("row", "size"), "row")
    sizes = stage(within_capacity(linked.select("row", "shard", "size"), shards, capacity), "shard-linked")
    linked = sizes.select("row", "shard")
    free = nodes.select("row", "size").join(linked, "row", "left_anti")
    free = stage(fill(stage(free, "shard-free"), _loads(sizes, shards), capacity), "shard-filled")
    labels = linked.union(free)
    return slots(nodes.drop("grp").join(labels, "row"), shards, "row").drop("row")
