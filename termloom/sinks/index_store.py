"""Indexes as Parquet tables: create, append, update, merge, expire, read.

An index is four tables below one path, in parts that are written once and never changed:

    documents/batch=B/chunk=C     one row per document, so many of them a folder
    postings/batch=B/field=F      ordered by term, so a lookup skips row groups
    term_stats/batch=B/field=F    one row per term, ordered by term
    hidden/batch=B                (of, doc_id): documents of other batches that were replaced

and ``manifest``, one small file per generation, which names the parts in force.  A write
first puts its parts down and then gives its manifest the name of the next generation; if
another writer took that name first, it fails and nothing is changed.  A job that dies
half-way leaves parts no manifest names, and a reader that started earlier keeps its parts;
``expire`` deletes what no kept manifest names.

An update hides the replaced documents and adds their statistics with the sign turned, so
it writes as much as it changes.  Term statistics are a log of parts that is merged so that
each part is more than twice the next: n writes leave at most log n parts.  A merge of indexes names the parts of the others where they lie and shifts the ids at
read.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.functions.weights import check_choice
from termloom.operators.index import (
    BROADCAST_ROWS,
    TERM_COUNTS,
    FieldSize,
    Index,
    IndexSpec,
    Piece,
    analyse_documents,
    combine_term_stats,
    count_terms,
    field_counters,
    postings_of,
    taken_back,
)
from termloom.operators.points import in_point_order, point_steps
from termloom.operators.ranges import cut_points, range_number
from termloom.session import delete_path, list_folder, move_to_new, qualified

# The ways to open an index for writing.
MODES = ("create", "append", "create_or_append")

# Postings a task sorts and writes: about a gigabyte, some 60 MB as Parquet.  Below
# LEAST_ROWS a further task is not worth starting.
ROWS_PER_PARTITION = 20_000_000
LEAST_ROWS = 100_000

# Documents of a writing task that share a folder: what a lookup can skip.
CHUNK_DOCS = 1 << 16

# What a search by doc_id or by a point reads at least.
ROW_GROUP_BYTES = 16 << 20

TABLES = ("documents", "postings", "term_stats", "hidden")
PLACE = "batch string, chunk bigint"
POSTINGS = "term string, doc_id bigint, chunk bigint, tf bigint, batch string, field string"
TERM_STATS = "term string, df bigint, ttf bigint, sum_sq_tf bigint, batch string, field string"
HIDDEN = "of string, doc_id bigint, batch string"
SPEC = "struct<text:array<string>, exact:array<string>, points:array<string>, key:string>"
FIELD = "struct<field:string, doc_count:bigint, sum_total_term_freq:bigint, sum_doc_freq:bigint>"
COUNTERS = ("doc_count", "sum_total_term_freq", "sum_doc_freq")
BATCH_ENTRY = (
    "struct<name:string, home:string, offset:bigint, n_docs:bigint, n_hidden:bigint,"
    f" first_id:bigint, next_id:bigint, fields:array<{FIELD}>>"
)
PART_ENTRY = (
    "struct<name:string, home:string, n_rows:bigint, n_terms:array<struct<field:string, n:bigint>>>"
)
MANIFEST = (
    f"generation bigint, spec {SPEC}, document_schema string, batches array<{BATCH_ENTRY}>,"
    f" stats array<{PART_ENTRY}>, hidden array<{PART_ENTRY}>"
)


class ConcurrentWriteError(RuntimeError):
    """Another writer changed the index since this one opened it."""


@dataclass(frozen=True)
class Manifest:
    """What an index consists of; ``home`` is the index that holds a part, None for its own.

    A batch's counts are of the documents that are left.  ``n_rows`` of a part are its rows,
    ``n_terms`` those of each field.
    """

    generation: int
    spec: IndexSpec
    document_schema: T.StructType
    batches: tuple[Row, ...] = ()
    stats: tuple[Row, ...] = ()
    hidden: tuple[Row, ...] = ()

    @property
    def next_id(self) -> int:
        return max((b["next_id"] for b in self.batches), default=0)

    def names(self, home: str | None = None) -> set[str]:
        """The parts that lie in one index."""
        parts = (*self.batches, *self.stats, *self.hidden)
        return {p["name"] for p in parts if p["home"] == home}


def manifest_path(path: str, generation: int) -> str:
    return f"{path}/manifest/g{generation:010d}.parquet"


def generations(spark: SparkSession, path: str) -> dict[int, int]:
    """The committed generations and when each was committed, in milliseconds."""
    return {
        int(f.name[1:11]): f.modified
        for f in list_folder(spark, f"{path}/manifest")
        if f.name.startswith("g") and f.name.endswith(".parquet")
    }


def read_manifest(spark: SparkSession, path: str, generation: int | None = None) -> Manifest | None:
    """The newest manifest or the one asked for, None where there is no index."""
    if generation is None:
        generation = max(generations(spark, path), default=None)
    if generation is None:
        return None
    row = spark.read.schema(MANIFEST).parquet(manifest_path(path, generation)).first()
    spec = IndexSpec(
        tuple(row["spec"]["text"]),
        tuple(row["spec"]["exact"]),
        tuple(row["spec"]["points"]),
        row["spec"]["key"],
    )
    schema = T.StructType.fromJson(json.loads(row["document_schema"]))
    parts = (tuple(row[kind]) for kind in ("batches", "stats", "hidden"))
    return Manifest(row["generation"], spec, schema, *parts)


def commit(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Make the manifest the newest; fails if its generation is there already."""
    spec = manifest.spec
    row = (
        manifest.generation,
        (list(spec.text), list(spec.exact), list(spec.points), spec.key),
        manifest.document_schema.json(),
        list(manifest.batches),
        list(manifest.stats),
        list(manifest.hidden),
    )
    draft = f"{path}/manifest/_{uuid.uuid4().hex}"
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.parquet(draft)
    try:
        (file,) = [f.name for f in list_folder(spark, draft) if f.name.startswith("part-")]
        target = manifest_path(path, manifest.generation)
        if not move_to_new(spark, f"{draft}/{file}", target):
            raise ConcurrentWriteError(f"generation {manifest.generation} of {path} exists")
    finally:
        delete_path(spark, draft)


def read_parts(
    spark: SparkSession, path: str, table: str, parts: tuple[Row, ...], schema: str | T.StructType
) -> DataFrame:
    """The named parts of a table, each from the index it lies in.

    Statistics named twice, by an index that another was merged into twice, count twice: a
    reader takes a folder it is given again for the same, so the second is another read.
    The other tables are told apart by offset, and read once here.
    """
    homes: dict[tuple[str, int], list[str]] = {}
    times: Counter = Counter()
    for part in parts:
        home = part["home"] or path
        times[home, part["name"]] += 1
        homes.setdefault((home, times[home, part["name"]]), []).append(part["name"])
    found = None
    for (home, time), names in homes.items():
        if time > 1 and table != "term_stats":
            continue
        folders = [f"{home}/{table}/batch={name}" for name in names]
        reader = spark.read.schema(schema).option("basePath", f"{home}/{table}")
        rows = reader.parquet(*folders)
        found = rows if found is None else found.unionByName(rows)
    return spark.createDataFrame([], schema) if found is None else found


def read_documents(
    spark: SparkSession, path: str, batches: tuple[Row, ...], schema: T.StructType
) -> DataFrame:
    """Stored rows with their ``batch`` and ``chunk``."""
    place = T._parse_datatype_string(PLACE)
    return read_parts(spark, path, "documents", batches, T.StructType([*schema.fields, *place.fields]))


def new_batch_name() -> str:
    return f"b{uuid.uuid4().hex[:12]}"


def write_documents(
    documents: DataFrame, spec: IndexSpec, path: str, name: str
) -> dict[str, int]:
    """Store the documents of a batch; return what was counted.

    Each task cuts its documents into folders as they come, and orders a folder by its
    points.  The bloom filter lets a lookup by doc_id skip row groups.  The counts are taken
    by the writing tasks, so nothing is read again.
    """
    counters = {
        "n_docs": F.count("*"),
        "low": F.coalesce(F.min("doc_id"), F.lit(0)),
        "high": F.coalesce(F.max("doc_id"), F.lit(-1)),
    }
    for field in spec.term_fields:
        for counter, value in field_counters(spec, field).items():
            counters[f"{counter} {field}"] = value
    seen = Observation()
    # The id that grows within a task and differs between tasks; its quotient numbers folders.
    chunk = F.floor(F.monotonically_increasing_id() / F.lit(CHUNK_DOCS)).alias("chunk")
    placed = documents.observe(seen, *(value.alias(c) for c, value in counters.items()))
    (
        in_point_order(placed.select("*", chunk), point_steps(documents, spec.points))
        .write.option("parquet.bloom.filter.enabled#doc_id", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .option("parquet.bloom.filter.candidates.number", "9")
        .option("parquet.bloom.filter.max.bytes", str(2 * CHUNK_DOCS))
        .option("parquet.block.size", str(ROW_GROUP_BYTES))
        .partitionBy("chunk")
        .parquet(f"{path}/documents/batch={name}")
    )
    if seen.get["low"] < 0:
        raise ValueError("doc_id must not be negative")
    return seen.get


def entry_of(spec: IndexSpec, name: str, seen: dict[str, int]) -> Row:
    """The manifest entry of a batch of its own."""
    fields = [
        Row(field=f, **{c: seen[f"{c} {f}"] for c in COUNTERS})
        for f in spec.term_fields
        if seen[f"sum_doc_freq {f}"]
    ]
    return Row(
        name=name, home=None, offset=0, n_docs=seen["n_docs"], n_hidden=0,
        first_id=seen["low"], next_id=seen["high"] + 1, fields=fields,
    )


def changed(entry: Row, **values) -> Row:
    return Row(**{**entry.asDict(), **values})


def partitions_for(spark: SparkSession, n_rows: int) -> int:
    """Tasks for so many term rows: the cores, unless that makes them too small or too large."""
    wanted = min(spark.sparkContext.defaultParallelism, n_rows // LEAST_ROWS)
    return max(1, wanted, -(-n_rows // ROWS_PER_PARTITION))


def write_postings(postings: DataFrame, path: str, name: str) -> None:
    (
        postings.sortWithinPartitions("field", "term", "doc_id")
        .write.partitionBy("field")
        .parquet(f"{path}/postings/batch={name}")
    )


def write_batch_postings(
    spark: SparkSession, path: str, entry: Row, spec: IndexSpec, schema: T.StructType
) -> list[tuple]:
    """Write the postings of a stored batch by ranges; return where these begin.

    The ranges go down to the document, so a term that is in a third of all postings fills
    as many as it needs.  They come from a few documents, so all are exploded just once.
    """
    documents = read_documents(spark, path, (entry,), schema)
    n_postings = sum(f["sum_doc_freq"] for f in entry["fields"])
    parts = partitions_for(spark, n_postings)
    bounds = cut_points(documents, spec, entry["n_docs"], n_postings, parts)
    rows = postings_of(documents, spec, "doc_id", "chunk")
    number = range_number(bounds, "field", "term", "doc_id")
    write_postings(rows.repartitionById(len(bounds) + 1, number), path, entry["name"])
    return bounds


def write_term_stats(stats: DataFrame, spec: IndexSpec, path: str, name: str) -> Row:
    """Store a part of the statistics; return its manifest entry."""
    seen = Observation()
    counted = stats.observe(
        seen, *(F.count_if(F.col("field") == f).alias(f) for f in spec.term_fields)
    )
    (
        counted.sortWithinPartitions("field", "term")
        .write.partitionBy("field")
        .parquet(f"{path}/term_stats/batch={name}")
    )
    n_terms = [Row(field=f, n=n) for f, n in seen.get.items() if n]
    return Row(name=name, home=None, n_rows=sum(t["n"] for t in n_terms), n_terms=n_terms)


def log_parts(parts: tuple[Row, ...]) -> tuple[tuple[Row, ...], tuple[Row, ...]]:
    """(parts that stay, parts to be made one): the last ones, while one is at most twice
    the rows of those after it."""
    parts = tuple(p for p in parts if p["n_rows"])
    first, after = len(parts) - 1, parts[-1]["n_rows"] if parts else 0
    while first > 0 and parts[first - 1]["n_rows"] <= 2 * after:
        first -= 1
        after += parts[first]["n_rows"]
    if first >= len(parts) - 1:
        return parts, ()
    return parts[:first], parts[first:]


def some_count() -> Column:
    return (F.col("df") != 0) | (F.col("ttf") != 0) | (F.col("sum_sq_tf") != 0)


def settle_stats(
    spark: SparkSession, path: str, spec: IndexSpec, parts: tuple[Row, ...]
) -> tuple[Row, ...]:
    """Merge the last parts of the log where that is due; counts that cancel are dropped."""
    kept, merged = log_parts(parts)
    if not merged:
        return kept
    rows = read_parts(spark, path, "term_stats", merged, TERM_STATS).drop("batch")
    total = combine_term_stats([rows]).filter(some_count())
    ordered = total.repartitionByRange(
        partitions_for(spark, sum(p["n_rows"] for p in merged)), "field", "term"
    )
    part = write_term_stats(ordered, spec, path, new_batch_name())
    return (*kept, part) if part["n_rows"] else kept


def write_hidden(rows: DataFrame, path: str) -> tuple[Row, dict]:
    """Store (of, doc_id); return the manifest entry and which batches and ids are in it."""
    name, seen = new_batch_name(), Observation()
    what = {
        "n": F.count("*"), "low": F.min("doc_id"), "high": F.max("doc_id"), "of": F.collect_set("of")
    }
    observed = rows.select("of", "doc_id").observe(seen, *(v.alias(k) for k, v in what.items()))
    observed.write.parquet(f"{path}/hidden/batch={name}")
    return Row(name=name, home=None, n_rows=seen.get["n"], n_terms=[]), seen.get


def settle_hidden(
    spark: SparkSession, path: str, batches: tuple[Row, ...], parts: tuple[Row, ...]
) -> tuple[Row, ...]:
    """Merge the last lists of replaced documents where due, without those of gone batches."""
    kept, merged = log_parts(parts)
    if not merged:
        return kept
    rows = read_parts(spark, path, "hidden", merged, HIDDEN)
    alive = [b["name"] for b in batches if b["n_hidden"]]
    part, _ = write_hidden(rows.filter(F.col("of").isin(alive)), path)
    return (*kept, part) if part["n_rows"] else kept


def without_hidden(
    spark: SparkSession, path: str, hidden: tuple[Row, ...], batches: tuple[Row, ...], rows: DataFrame
) -> DataFrame:
    """Rows of batches but for those of replaced documents."""
    if not any(b["n_hidden"] for b in batches):
        return rows
    gone = read_parts(spark, path, "hidden", hidden, HIDDEN).select(
        F.col("of").alias("batch"), "doc_id"
    )
    if sum(h["n_rows"] for h in hidden) <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return rows.join(gone, ["batch", "doc_id"], "left_anti")


def open_for_writing(
    spark: SparkSession, path: str, spec: IndexSpec, mode: str
) -> Manifest | None:
    """The manifest to build on, None for a fresh index."""
    check_choice("mode", mode, MODES)
    manifest = read_manifest(spark, path)
    if mode == "append" and manifest is None:
        raise ValueError(f"no index to append to at {path}")
    if manifest is not None and mode != "create" and manifest.spec != spec:
        raise ValueError(f"the index at {path} has other fields: {manifest.spec}")
    return manifest


def write_index(
    docs: DataFrame, spec: IndexSpec, path: str, mode: str = "create", update: bool = False
) -> Index:
    """Index ``docs`` at ``path`` and return the index as it then stands.

    ``create`` replaces what is there.  ``append`` adds without a look at the
    key; it needs an index.  ``create_or_append`` appends where there is one.
    With ``update`` an added document replaces all that have the same key, and
    of several new ones with the same key the highest doc_id stays; ``create``
    ignores the flag.  Added documents get ids above those in use.

    If another writer commits in the meantime, ``ConcurrentWriteError`` is raised and the
    index is as that writer left it.
    """
    spark = docs.sparkSession
    opened = open_for_writing(spark, path, spec, mode)
    documents = analyse_documents(docs, spec)
    base = opened if mode != "create" else None
    if base:
        documents = documents.withColumn("doc_id", F.col("doc_id") + F.lit(base.next_id))
    manifest = replace(
        base or Manifest(0, spec, T.StructType()),
        generation=opened.generation + 1 if opened else 1,
        document_schema=as_nullable(documents.schema),
    )
    schema = manifest.document_schema

    name = new_batch_name()
    entry = entry_of(spec, name, write_documents(documents, spec, path, name))
    if base and update:
        entry = only_last_of_key(spark, path, spec, schema, entry)
    bounds = write_batch_postings(spark, path, entry, spec, schema)
    postings = read_parts(spark, path, "postings", (entry,), POSTINGS)
    counts = count_terms(postings)
    if base and update:
        manifest, gone = hide_replaced(spark, path, manifest, entry)
        if gone is not None:
            counts = combine_term_stats([counts, taken_back(gone)]).filter(some_count())
    by_term = range_number([b[:2] for b in bounds], "field", "term")
    part = write_term_stats(counts.repartitionById(len(bounds) + 1, by_term), spec, path, name)

    batches = (*manifest.batches, entry)
    if any(b["n_docs"] for b in batches):
        batches = tuple(b for b in batches if b["n_docs"])
    manifest = replace(
        manifest,
        batches=batches,
        stats=settle_stats(spark, path, spec, (*manifest.stats, part)),
        hidden=settle_hidden(spark, path, batches, manifest.hidden),
    )
    commit(spark, path, manifest)
    return open_index(spark, path, manifest)


def only_last_of_key(
    spark: SparkSession, path: str, spec: IndexSpec, schema: T.StructType, entry: Row
) -> Row:
    """The new batch, written again if two of its documents have the same key."""
    fresh = read_documents(spark, path, (entry,), schema).drop("batch", "chunk")
    key = spec.key
    last = fresh.groupBy(key).agg(F.max("doc_id").alias("doc_id"), F.count("*").alias("n"))
    if last.filter(F.col(key).isNotNull() & (F.col("n") > 1)).isEmpty():
        return entry
    winners = last.filter(F.col(key).isNotNull()).select("doc_id")
    unique = fresh.join(winners, "doc_id", "left_semi").unionByName(
        fresh.filter(F.col(key).isNull())
    )
    name = new_batch_name()
    return entry_of(spec, name, write_documents(unique, spec, path, name))


def hide_replaced(
    spark: SparkSession, path: str, manifest: Manifest, entry: Row
) -> tuple[Manifest, DataFrame | None]:
    """Hide the documents whose key the new batch holds: (manifest, their statistics).

    The keys are looked up in the postings of the key, which are ordered by it.  Only the
    replaced documents are read whole.  A batch with nothing left is dropped, and one with
    less left than was replaced is written anew, which the replaced ones have paid for.
    """
    spec, schema, key = manifest.spec, manifest.document_schema, manifest.spec.key
    if not manifest.batches or not entry["n_docs"]:
        return manifest, None
    fresh = read_documents(spark, path, (entry,), schema)
    keys = fresh.select(F.col(key).cast("string").alias("term")).filter("term is not null").distinct()
    span = keys.agg(F.min("term"), F.max("term")).first()
    if span[0] is None:
        return manifest, None
    if key in spec.exact:
        held = read_parts(spark, path, "postings", manifest.batches, POSTINGS)
        held = held.filter(F.col("field") == key)
    else:
        held = read_documents(spark, path, manifest.batches, schema)
        held = held.withColumn("term", F.col(key).cast("string"))
    held = held.filter(F.col("term").between(*span)).select("batch", "doc_id", "term")
    live = without_hidden(spark, path, manifest.hidden, manifest.batches, held)
    small = entry["n_docs"] <= BROADCAST_ROWS
    hit = live.join(F.broadcast(keys) if small else keys, "term", "left_semi")
    part, ends = write_hidden(hit.select(F.col("batch").alias("of"), "doc_id"), path)
    if not part["n_rows"]:
        return manifest, None

    gone = read_parts(spark, path, "hidden", (part,), HIDDEN).select(
        F.col("of").alias("batch"), "doc_id"
    )
    touched = tuple(b for b in manifest.batches if b["name"] in ends["of"])
    old = read_documents(spark, path, touched, schema)
    old = old.filter(F.col("doc_id").between(ends["low"], ends["high"]))
    few = part["n_rows"] <= BROADCAST_ROWS
    replaced = old.join(F.broadcast(gone) if few else gone, ["batch", "doc_id"], "left_semi")
    counted = {
        r["batch"]: r
        for r in replaced.groupBy("batch")
        .agg(
            F.count("*").alias("n_docs"),
            *(
                value.alias(f"{c} {f}")
                for f in spec.term_fields
                for c, value in field_counters(spec, f).items()
            ),
        )
        .collect()
    }
    hidden = (*manifest.hidden, part)
    batches = tuple(
        less(spark, path, spec, schema, hidden, b, counted[b["name"]]) if b["name"] in counted else b
        for b in manifest.batches
    )
    batches = tuple(b for b in batches if b is not None)
    stats = count_terms(postings_of(replaced, spec))
    # A batch that was merged in twice is read once and loses its documents twice.
    copies = Counter(b["name"] for b in touched)
    for time in range(2, max(copies.values(), default=1) + 1):
        again = [name for name, n in copies.items() if n >= time]
        rows = replaced.filter(F.col("batch").isin(again))
        stats = combine_term_stats([stats, count_terms(postings_of(rows, spec))])
    return replace(manifest, batches=batches, hidden=hidden), stats


def less(
    spark: SparkSession, path: str, spec: IndexSpec, schema: T.StructType,
    hidden: tuple[Row, ...], batch: Row, gone: Row,
) -> Row | None:
    """The entry of a batch without the counted documents; None if nothing is left of it."""
    left, n_hidden = batch["n_docs"] - gone["n_docs"], batch["n_hidden"] + gone["n_docs"]
    if not left:
        return None
    fields = [
        Row(field=f["field"], **{c: f[c] - gone[f"{c} {f['field']}"] for c in COUNTERS})
        for f in batch["fields"]
    ]
    fields = [f for f in fields if f["sum_doc_freq"]]
    entry = changed(batch, n_docs=left, n_hidden=n_hidden, fields=fields)
    if n_hidden <= left:
        return entry
    rows = read_documents(spark, path, (batch,), schema)
    kept = without_hidden(spark, path, hidden, (entry,), rows).drop("batch", "chunk")
    if batch["offset"]:
        kept = kept.withColumn("doc_id", F.col("doc_id") + F.lit(batch["offset"]))
    name = new_batch_name()
    anew = entry_of(spec, name, write_documents(kept, spec, path, name))
    write_batch_postings(spark, path, anew, spec, schema)
    return anew


def merge_indexes(spark: SparkSession, sources: list[str], path: str, mode: str = "create") -> Index:
    """Put partial indexes together at ``path``, which costs one manifest.

    Documents are not compared: equal keys in two parts stay two documents.  Ids of each
    part are shifted past those before it, which keeps every order.  The tables stay where
    they are and must stay there: the sources are told, and their ``expire`` minds it.
    """
    parts = [read_manifest(spark, source) for source in sources]
    missing = [s for s, part in zip(sources, parts) if part is None]
    if missing or not parts:
        raise ValueError(f"no index at {', '.join(missing) or 'no path'}")
    spec, schema = parts[0].spec, parts[0].document_schema
    if any(part.spec != spec or part.document_schema != schema for part in parts):
        raise ValueError("the parts have different fields")
    opened = open_for_writing(spark, path, spec, mode)
    base = opened if opened and mode != "create" else Manifest(0, spec, schema)

    own, offset = qualified(spark, path), base.next_id
    batches, stats, hidden = list(base.batches), list(base.stats), list(base.hidden)
    for source, part in zip(sources, parts):
        home = qualified(spark, source)

        def at_home(p: Row, home: str = home) -> Row:
            there = p["home"] or home
            return changed(p, home=None if there == own else there)

        for b in part.batches:
            moved = {k: b[k] + offset for k in ("offset", "first_id", "next_id")}
            batches.append(changed(at_home(b), **moved))
        stats += map(at_home, part.stats)
        hidden += map(at_home, part.hidden)
        offset += part.next_id
    lenders = {p["home"] for p in (*batches, *stats, *hidden)} - {None}
    for lender in sorted(lenders):
        pin(spark, lender, own)
    manifest = Manifest(
        opened.generation + 1 if opened else 1, spec, schema,
        tuple(batches),
        tuple(sorted(stats, key=lambda p: -p["n_rows"])),  # the next write merges what is due
        tuple(hidden),
    )
    commit(spark, path, manifest)
    return open_index(spark, path, manifest)


PIN = "borrower string"


def pin(spark: SparkSession, lender: str, borrower: str) -> None:
    """Note in an index that another one reads its parts."""
    spark.createDataFrame([(borrower,)], PIN).coalesce(1).write.mode("append").parquet(f"{lender}/pins")


def borrowers(spark: SparkSession, path: str) -> set[str]:
    if not list_folder(spark, f"{path}/pins"):
        return set()
    return {r["borrower"] for r in spark.read.schema(PIN).parquet(f"{path}/pins").collect()}


def expire(spark: SparkSession, path: str, older_than_s: float = 7 * 86_400) -> list[str]:
    """Delete what no reader should need any more; return the deleted paths.

    The newest generation stays, and those committed within ``older_than_s`` seconds.  Of
    the parts, those stay that a kept manifest names, here or in an index merged from this
    one, and those that are younger than that: a write may be under way.
    """
    import time

    before = (time.time() - older_than_s) * 1000
    found = generations(spark, path)
    kept = {g for g, modified in found.items() if modified >= before or g == max(found)}
    names: set[str] = set()
    for g in kept:
        names |= read_manifest(spark, path, g).names()
    home = qualified(spark, path)
    for borrower in borrowers(spark, path):
        for g in generations(spark, borrower):
            names |= read_manifest(spark, borrower, g).names(home)
    gone = [manifest_path(path, g) for g in sorted(set(found) - kept)]
    gone += [
        f"{path}/manifest/{f.name}"
        for f in list_folder(spark, f"{path}/manifest")
        if f.name.startswith("_") and f.modified < before
    ]
    for table in TABLES:
        for f in list_folder(spark, f"{path}/{table}"):
            name = f.name.removeprefix("batch=")
            if name != f.name and name not in names and f.modified < before:
                gone.append(f"{path}/{table}/{f.name}")
    for part in gone:
        delete_path(spark, part)
    return gone


def read_index(spark: SparkSession, path: str) -> Index:
    """Open a stored index as it stands now."""
    manifest = read_manifest(spark, path)
    if manifest is None:
        raise ValueError(f"no index at {path}")
    return open_index(spark, path, manifest)


def pieces_of(spark: SparkSession, path: str, manifest: Manifest) -> tuple[Piece, ...]:
    """The batches by home and offset: as many pieces as indexes were merged."""
    together: dict[tuple, list[Row]] = {}
    for b in manifest.batches:
        together.setdefault((b["home"], b["offset"]), []).append(b)
    found = []
    for (_, offset), batches in together.items():
        batches = tuple(batches)
        documents = read_documents(spark, path, batches, manifest.document_schema)
        postings = read_parts(spark, path, "postings", batches, POSTINGS)
        found.append(
            Piece(
                without_hidden(spark, path, manifest.hidden, batches, documents),
                without_hidden(spark, path, manifest.hidden, batches, postings),
                offset,
                min(b["first_id"] for b in batches),
                max(b["next_id"] for b in batches),
            )
        )
    return tuple(found)


def open_index(spark: SparkSession, path: str, manifest: Manifest) -> Index:
    spec = manifest.spec
    pieces = pieces_of(spark, path, manifest)
    documents = postings = None
    for p in pieces:
        rows, terms = p.with_ids(p.documents), p.with_ids(p.postings)
        documents = rows if documents is None else documents.unionByName(rows)
        postings = terms if postings is None else postings.unionByName(terms)
    parts = read_parts(spark, path, "term_stats", manifest.stats, TERM_STATS).drop("batch")
    # Only where replaced documents are taken back can a term have lost all of its own.
    stats = parts
    if len(manifest.stats) > 1:
        stats = combine_term_stats([parts]).filter(F.col("df") > 0)
    sizes: dict[str, FieldSize] = {}
    for part in manifest.stats:
        for t in part["n_terms"]:
            so_far = sizes.get(t["field"], FieldSize())
            sizes[t["field"]] = replace(so_far, n_terms=so_far.n_terms + t["n"])
    for batch in manifest.batches:
        for f in batch["fields"]:
            so_far = sizes.get(f["field"], FieldSize())
            sizes[f["field"]] = replace(so_far, n_postings=so_far.n_postings + f["sum_doc_freq"])
    return Index(
        spec=spec,
        documents=documents.drop("batch", "chunk"),
        postings=postings.select("field", "term", "doc_id", "tf"),
        term_stats=stats.select("field", "term", *TERM_COUNTS),
        field_counts=stored_field_counts(spark, path, manifest.generation),
        n_docs=F.lit(sum(b["n_docs"] for b in manifest.batches)),
        sizes=sizes,
        term_parts=parts,
        pieces=pieces,
    )


def stored_field_counts(spark: SparkSession, path: str, generation: int) -> DataFrame:
    """Field statistics out of the manifest: no table of the index is read."""
    table = spark.read.schema(MANIFEST).parquet(manifest_path(path, generation))
    batches = table.filter(F.col("generation") == generation).select(F.inline("batches"))
    return (
        batches.select(F.inline("fields"))
        .groupBy("field")
        .agg(*(F.sum(c).alias(c) for c in COUNTERS))
    )


def as_nullable(schema: T.StructType) -> T.StructType:
    """The schema as Parquet gives it back."""

    def loosen(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(loosen(kind.elementType), True)
        if isinstance(kind, T.StructType):
            return T.StructType([T.StructField(f.name, loosen(f.dataType), True) for f in kind])
        return kind

    return loosen(schema)
