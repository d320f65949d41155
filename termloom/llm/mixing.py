"""Mixing sources to target weights by entropy balancing.

Each source has a number of words to give.  Among all document rates between zero and
``LIMIT`` that give it, the ones nearest to one in relative entropy are exponential
tilts, ``min(LIMIT, exp(lambda * size))``, with one dual variable for each source's
token constraint.  Newton iterations solve the convex dual of all sources at once as
Spark aggregations; rates are then rounded into copies.

A rate depends on source and size only, so everything but the last step works on counts
of (source, size), which partial aggregation makes small before anything moves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.common import small_side
from termloom.session import stage

WORD = r"[^\x20\x09-\x0D]+"
LIMIT = 3
WEIGHTS = (1, 2, 3)
#: Newton stops when every source's words are within this share of its target.
TOLERANCE = 1e-9
#: Documents of one source and size are ranked in parts of about so many.
PART_ROWS = 4096


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sources: DataFrame, weights: tuple = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """(source, source_size, target) from (source, source_size), a row for each source.

    Sources in code-point order, null last, weigh ``weights`` in turn and share all
    words; a target stops at ``limit`` times its source, and the excess is shared out
    again by weight until no target is above.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    rows = stage(
        sources.withColumn("weight", weight).withColumn("most", F.col("source_size") * limit),
        "mix-sources",
    )
    total = rows.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    level, stopped = 0.0, -1
    while True:  # each round stops at least one more source
        above = F.col("most") <= F.lit(level) * F.col("weight")
        sums = rows.agg(
            F.sum(F.when(above, F.col("most"))).alias("full"),
            F.sum(F.when(~above, F.col("weight"))).alias("open"),
            F.count(F.when(above, 1)).alias("n"),
        ).first()
        if sums["n"] == stopped or not sums["open"]:
            break
        stopped = sums["n"]
        level = (total - (sums["full"] or 0)) / sums["open"]
    target = F.least(F.col("most").cast("double"), F.lit(float(level)) * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def _same(a: DataFrame, b: DataFrame, *names: str) -> Column:
    match = F.lit(True)
    for name in names:
        match = match & a[name].eqNullSafe(b[name])
    return match


def tilts(counts: DataFrame, targets: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(source, tilt) that meets every target, by safeguarded Newton on the dual.

    ``counts`` has source, size and n.  A step that leaves the bracket of a source's
    dual variable is replaced by its middle; sources with nothing to give or asked for
    all of ``limit`` copies have no finite solution and get a null tilt.
    """
    top = counts.groupBy("source").agg(F.min("size").alias("low"), F.max("size").alias("high"))
    state = targets.join(top, _same(targets, top, "source")).select(
        targets["source"], "source_size", "target", "low", "high"
    )
    inner = (F.col("target") > 0) & (F.col("target") < F.col("source_size") * limit * (1 - 1e-9))
    # Far enough that every document is at the limit, or all but nothing is taken.
    up = F.log(F.lit(float(limit))) / F.greatest(F.col("low"), F.lit(1))
    down = F.log(F.col("target") / F.col("source_size") / 2) / F.greatest(F.col("low"), F.lit(1))
    state = stage(
        state.filter(inner).select(
            "source", "target", F.least(down, F.lit(0.0)).alias("least"), up.alias("most"),
            F.lit(0.0).alias("tilt"),
        ),
        "mix-state",
    )
    while True:
        joined = counts.join(state, _same(counts, state, "source")).select(
            state["source"], "target", "least", "most", "tilt", "size", "n"
        )
        raw = F.exp(F.col("tilt") * F.col("size"))
        words = F.col("n") * F.col("size") * F.least(raw, F.lit(float(limit)))
        slope = F.when(raw < limit, F.col("n") * F.col("size") * F.col("size") * raw).otherwise(0.0)
        sums = joined.groupBy("source", "target", "least", "most", "tilt").agg(
            F.sum(words).alias("words"), F.sum(slope).alias("slope")
        )
        over = F.col("words") > F.col("target")
        least = F.when(over, F.col("least")).otherwise(F.col("tilt"))
        most = F.when(over, F.col("tilt")).otherwise(F.col("most"))
        # Newton on the logarithm of the words taken: near straight in the tilt.
        step = F.col("tilt") - F.log(F.col("words") / F.col("target")) * F.col("words") / F.col("slope")
        inside = (F.col("slope") > 0) & (step > least) & (step < most)
        gap = F.abs(F.col("words") - F.col("target")) / F.col("target")
        done = (gap <= TOLERANCE) | ((most - least) <= F.abs(F.col("tilt")) * 1e-13)
        state = stage(
            sums.select(
                "source", "target", least.alias("least"), most.alias("most"), done.alias("done"),
                F.when(done, F.col("tilt")).when(inside, step).otherwise((least + most) / 2).alias("tilt"),
            ),
            "mix-state",
        )
        if not state.filter(~F.col("done")).limit(1).count():
            return state.select("source", "tilt")
        state = state.drop("done")


def round_copies(rows: pd.DataFrame, limit: int) -> np.ndarray:
    """Copies of all documents of each size of one source, by error feedback.

    Sizes are taken from the largest down, and what a size gives too much or too little
    is carried to the next, so a source misses its target by half its least size at most,
    as long as the copies left can make up for it.
    """
    out = np.zeros(len(rows), dtype=np.int64)
    carried = 0.0
    for i in np.argsort(-rows["size"].to_numpy(), kind="stable"):
        size, n = int(rows["size"].iloc[i]), int(rows["n"].iloc[i])
        wanted = n * float(rows["rate"].iloc[i]) * size + carried
        if size:
            out[i] = min(max(round(wanted / size), 0), limit * n)
        else:
            out[i] = n
        carried = wanted - out[i] * size
    return out


def copies(counts: DataFrame, targets: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(source, size, n, copies): how often the documents of a size are taken in all."""
    found = tilts(counts, targets, limit)
    rows = counts.join(targets, _same(counts, targets, "source")).select(
        counts["source"], "size", "n", "target", "source_size"
    )
    rows = rows.join(found, _same(rows, found, "source"), "left").select(
        rows["source"], "size", "n",
        F.when(F.col("tilt").isNotNull(), F.least(F.exp(F.col("tilt") * F.col("size")), F.lit(float(limit))))
        .when(F.col("target") > 0, F.lit(float(limit))).otherwise(0.0).alias("rate"),
    )

    def one_source(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.assign(copies=round_copies(rows, limit))[["source", "size", "n", "copies"]]

    # A group has a row for each different size, never one for each document.
    return rows.groupBy("source").applyInPandas(
        one_source, "source string, size bigint, n bigint, copies bigint"
    )


def mix(
    docs: DataFrame, weights: tuple = WEIGHTS, limit: int = LIMIT, text: str = "text"
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) of every row.

    ``copies`` is how often the mix repeats the document, 0 to ``limit``.  Documents of
    one source and size differ by one copy at most; which get it depends on a hash of the
    id, so runs agree (rows that share an id are alike).  Null and blank texts have size
    0 and take no words; their copies are 1 in a source that gives any.  A null source is
    a source of its own, the last.  Extra columns are ignored.  An empty table gives an
    empty result.
    """
    return _dealt(docs, weights, limit, text).drop("salts", "salt")


def _sizes(text: str) -> list[Column]:
    """(doc_id, source, size) of the rows of ``mix``."""
    return [
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col(text).cast("string")).alias("size"),
    ]


def _salt(ident: Column, salts: Column) -> Column:
    return F.pmod(F.xxhash64(ident, F.lit(3)), salts)


def _dealt(docs: DataFrame, weights: tuple, limit: int, text: str) -> DataFrame:
    """The rows of ``mix``, and of how many parts of their source and size they are in which."""
    sized = stage(docs.select(*_sizes(text)), "mix-sizes")
    counts = stage(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-counts")
    totals = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = stage(source_targets(totals, weights, limit), "mix-targets")
    quota = stage(copies(counts, targets, limit), "mix-copies")
    # The quota of a (source, size) is dealt to salted parts of it, then to documents.
    salts = F.ceil(F.col("n") / PART_ROWS)
    salted = sized.join(quota, _same(sized, quota, "source", "size")).select(
        "doc_id", sized["source"], sized["size"], "n", "copies", salts.alias("salts"),
        _salt(F.col("doc_id"), salts).alias("salt"),
    )
    parts = salted.groupBy("source", "size", "salt", "n", "copies").agg(F.count("*").alias("m"))
    by_salt = Window.partitionBy("source", "size").orderBy("salt")
    upto = F.sum("m").over(by_salt.rowsBetween(Window.unboundedPreceding, 0))
    extra = F.col("copies") % F.col("n")

    def share(upto: Column) -> Column:
        return F.floor(upto * F.col("extra") / F.col("n"))

    parts = parts.withColumn("upto", upto).withColumn("extra", extra)
    parts = stage(
        parts.select(
            "source", "size", "salt",
            F.floor(F.col("copies") / F.col("n")).cast("bigint").alias("base"),
            (share(F.col("upto")) - share(F.col("upto") - F.col("m"))).cast("bigint").alias("more"),
        ),
        "mix-parts",
    )
    rank = F.row_number().over(
        Window.partitionBy("source", "size", "salt").orderBy(F.xxhash64("doc_id"), "doc_id")
    )
    ranked = salted.withColumn("rank", rank)
    dealt = ranked.join(parts, _same(ranked, parts, "source", "size", "salt")).select(
        "doc_id", ranked["source"], ranked["size"], "salts", ranked["salt"],
        (F.col("base") + F.when(F.col("rank") <= F.col("more"), 1).otherwise(0)).alias("copies"),
    )
    return dealt.join(targets, _same(dealt, targets, "source")).select(
        "doc_id", dealt["source"], "size", "source_size", "target", "copies", "salts", "salt"
    )


def repeats(
    docs: DataFrame, times: str, weights: tuple = WEIGHTS, limit: int = LIMIT, text: str = "text"
) -> DataFrame:
    """``docs`` and a column ``times``: how often ``mix`` takes the row.

    Rows that share an id, or have none, get the most that one of them is taken.  The rows do
    not move: of a part of a source and size those up to one hash and id are taken once more
    than the others, so a row for each part says it all, and one for each id whose rows are
    not taken alike.  Both tables are sent to all tasks while they are short, and joined else.
    ``times`` must be longer than any name in ``docs``.
    """
    dealt = stage(_dealt(docs, weights, limit, text), "mix-dealt")
    order = F.xxhash64("doc_id")
    last = F.max(F.struct("copies", order.alias("hash"), "doc_id"))
    parts = dealt.groupBy("source", "size", "salt").agg(F.min("copies").alias("least"), last.alias("last"))
    several = dealt.filter("salts > 1").select("source", "size", "salts").distinct()
    uneven = dealt.groupBy("doc_id").agg(F.max("copies").alias("most"), F.min("copies").alias("least"))
    uneven = uneven.filter("least < most").select("doc_id", "most")

    def beside(rows: DataFrame, table: DataFrame, how: str, **keys: Column) -> DataFrame:
        """Joined by keys that may be null, under names that ``docs`` does not have."""
        table = small_side(table.toDF(*[times + c for c in table.columns]))
        match = F.lit(True)
        for name, key in keys.items():
            match = match & key.eqNullSafe(table[times + name])
        return rows.join(table, match, how)

    def own(name: str) -> Column:
        return F.col(times + name)

    rows = docs.select("*", *[c.alias(times + n) for n, c in zip(("i", "s", "n"), _sizes(text), strict=True)])
    by = {"source": own("s"), "size": own("n")}
    rows = beside(rows, stage(several, "mix-several"), "left", **by)
    salt = _salt(own("i"), F.coalesce(own("salts"), F.lit(1)))
    rows = rows.withColumn(times + "k", salt)
    rows = beside(rows.drop(*[times + c for c in several.columns]), stage(parts, "mix-last"), "inner", **by, salt=own("k"))
    top, here = own("last"), F.xxhash64(own("i"))
    # Ids ascend within a hash, null first.
    upto = F.coalesce(own("i") <= top["doc_id"], own("i").isNull())
    upto = (here < top["hash"]) | ((here == top["hash"]) & upto)
    taken = F.when(upto, top["copies"]).otherwise(own("least"))
    rows = rows.select(*docs.columns, own("i"), taken.alias(times + "t"))
    rows = beside(rows, stage(uneven, "mix-uneven"), "left", doc_id=own("i"))
    return rows.select(*docs.columns, F.coalesce(own("most"), own("t")).alias(times))
