"""The index: one row per document, and the term tables derived from it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.text import count_tokens, tokenize

# Most rows that are ever sent to every executor.
BROADCAST_ROWS = 200_000
TERM_COUNTS = ("df", "ttf", "sum_sq_tf")


@dataclass(frozen=True)
class IndexSpec:
    """Which document columns are indexed, and how.

    ``text`` columns are tokenised, an ``exact`` column is one term as it
    stands, ``points`` can be range-filtered but have no terms.  ``key`` names
    the exact column that identifies a document for an update.
    """

    text: tuple[str, ...] = ("contents",)
    exact: tuple[str, ...] = ()
    points: tuple[str, ...] = ()
    key: str = "path"

    @property
    def fields(self) -> tuple[str, ...]:
        return self.text + self.exact + self.points

    @property
    def term_fields(self) -> tuple[str, ...]:
        return self.text + self.exact

    def check_field(self, field: str) -> None:
        if field not in self.fields:
            raise ValueError(f"no field {field!r}; fields are {', '.join(self.fields)}")
        if field in self.points:
            raise ValueError(f"field {field!r} has no terms")


@dataclass(frozen=True)
class FieldSize:
    """What a stored index knows of a field: at most ``n_terms`` terms, ``n_postings`` postings."""

    n_terms: int = 0
    n_postings: int = 0


@dataclass(frozen=True)
class Piece:
    """Stored batches whose rows get their ids in the same way.

    ``documents`` and ``postings`` are as they lie on disk, with their ``batch`` and
    ``chunk``, the folders of the documents; replaced documents are left out.  The ids of
    the index are the stored ones plus ``offset`` and lie from ``first_id`` up to, but not
    including, ``next_id``.
    """

    documents: DataFrame
    postings: DataFrame
    offset: int
    first_id: int
    next_id: int

    def with_ids(self, rows: DataFrame) -> DataFrame:
        """Rows with the ids of the index; untouched where those are the stored ones."""
        if not self.offset:
            return rows
        return rows.withColumn("doc_id", F.col("doc_id") + F.lit(self.offset))


@dataclass(frozen=True)
class Index:
    """Tables of an index.

    ``documents``  doc_id, exact and point columns, and per text field a
                   struct(length, n_terms, terms, tfs)
    ``postings``   field, term, doc_id, tf
    ``term_stats`` field, term, df, ttf, sum_sq_tf
    ``field_counts`` field, doc_count, sum_total_term_freq, sum_doc_freq
    ``n_docs``     number of documents, with or without terms
    ``sizes``      size of every field with terms, if the index is stored
    ``term_parts`` statistics that are still to be summed by term, where a stored index
                   has several parts of them
    ``pieces``     the batches of a stored index, by how their ids are made
    """

    spec: IndexSpec
    documents: DataFrame
    postings: DataFrame
    term_stats: DataFrame
    field_counts: DataFrame
    n_docs: Column
    sizes: dict[str, FieldSize] | None = None
    term_parts: DataFrame | None = None
    pieces: tuple[Piece, ...] = ()

    @property
    def stored(self) -> bool:
        return self.sizes is not None

    def document(self, doc_id: int) -> DataFrame:
        """The row of one document; only batches whose ids include it are looked into."""
        if not self.stored:
            return self.documents.filter(F.col("doc_id") == doc_id)
        found = [
            p.with_ids(p.documents.filter(F.col("doc_id") == doc_id - p.offset))
            for p in self.pieces
            if p.first_id <= doc_id < p.next_id
        ]
        if not found:
            return self.documents.limit(0)
        return reduce(DataFrame.unionByName, found).drop("batch", "chunk")

    def field_postings(self, field: str) -> DataFrame:
        self.spec.check_field(field)
        return self.postings.filter(F.col("field") == field).drop("field")

    def field_terms(self, field: str) -> DataFrame:
        self.spec.check_field(field)
        return self.term_stats.filter(F.col("field") == field).drop("field")

    def field_parts(self, field: str) -> DataFrame:
        """Term statistics with one row for each term and part.

        Parts that take replaced documents back hold negative counts: only sums mean anything.
        """
        self.spec.check_field(field)
        parts = self.term_stats if self.term_parts is None else self.term_parts
        return parts.filter(F.col("field") == field).drop("field")


def analyse_documents(docs: DataFrame, spec: IndexSpec) -> DataFrame:
    """Turn each text column into its term vector.

    ``docs`` needs a unique ``doc_id`` >= 0.  A document is one row, so this is
    a projection: no shuffle, whatever the size of the collection.
    """
    plain = [F.col(c).cast("string").alias(c) for c in spec.exact] + [F.col(c) for c in spec.points]
    vectors = [
        count_tokens(tokenize(F.coalesce(F.col(c), F.lit("")))).alias(c) for c in spec.text
    ]
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *plain, *vectors)


def field_vectors(documents: DataFrame, spec: IndexSpec, field: str, *keep: str) -> DataFrame:
    """(doc_id, terms, tfs) of one field, one row per document that has the field."""
    spec.check_field(field)
    if field in spec.text:
        return documents.filter(F.col(f"{field}.length") > 0).select(
            *keep, "doc_id", F.col(f"{field}.terms").alias("terms"), F.col(f"{field}.tfs").alias("tfs")
        )
    return documents.filter(F.col(field).isNotNull()).select(
        *keep, "doc_id", F.array(field).alias("terms"), F.array(F.lit(1).cast("bigint")).alias("tfs")
    )


def term_rows(vectors: DataFrame, *keep: str) -> DataFrame:
    """Vectors to long form: one row per (document, term)."""
    return vectors.select(
        *keep, F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("tfs").alias("tf")))
    )


def postings_of(documents: DataFrame, spec: IndexSpec, *keep: str) -> DataFrame:
    """Long postings of all fields from one pass over the documents."""
    keep = keep or ("doc_id",)
    vectors = [
        F.struct(F.lit(f).alias("field"), F.col(f"{f}.terms"), F.col(f"{f}.tfs"))
        for f in spec.text
    ]
    vectors += [
        F.struct(
            F.lit(f).alias("field"),
            F.filter(F.array(f), lambda v: v.isNotNull()).alias("terms"),
            F.array(F.lit(1).cast("bigint")).alias("tfs"),
        )
        for f in spec.exact
    ]
    per_field = documents.select(*keep, F.inline(F.array(*vectors)))
    return term_rows(per_field.filter(F.size("terms") > 0), "field", *keep).select(
        "field", "term", *keep, "tf"
    )


def exact_terms(documents: DataFrame, spec: IndexSpec) -> DataFrame:
    """Postings of the exact fields alone: the whole value is the term, tf is 1."""
    exact = IndexSpec(text=(), exact=spec.exact, points=(), key=spec.key)
    return postings_of(documents, exact)


def count_terms(postings: DataFrame) -> DataFrame:
    """Document frequency, total frequency and sum of squared frequencies per term.

    The sums are integers, so every figure derived from them is reproducible.
    Map-side partial counts keep a term that is in every document harmless.
    """
    return postings.groupBy("field", "term").agg(
        F.count("*").alias("df"),
        F.sum("tf").alias("ttf"),
        F.sum(F.col("tf") * F.col("tf")).alias("sum_sq_tf"),
    )


def combine_term_stats(partials: list[DataFrame]) -> DataFrame:
    """Add up the term statistics of parts that share no document."""
    return (
        reduce(DataFrame.unionByName, partials)
        .groupBy("field", "term")
        .agg(*(F.sum(c).alias(c) for c in TERM_COUNTS))
    )


def taken_back(stats: DataFrame) -> DataFrame:
    """The statistics of documents that are no longer there, to be added to the others."""
    return stats.select("field", "term", *((-F.col(c)).alias(c) for c in TERM_COUNTS))


def field_counters(spec: IndexSpec, field: str) -> dict[str, Column]:
    """Aggregates over documents that describe one field with terms.

    They read the two counters kept beside each vector, not the vectors.
    """
    if field in spec.text:
        length, n_terms = F.col(f"{field}.length"), F.col(f"{field}.n_terms")
    else:
        length = n_terms = F.col(field).isNotNull().cast("bigint")
    return {
        "doc_count": F.count_if(length > 0),
        "sum_total_term_freq": F.coalesce(F.sum(length), F.lit(0)),
        "sum_doc_freq": F.coalesce(F.sum(n_terms), F.lit(0)),
    }


def count_fields(documents: DataFrame, spec: IndexSpec) -> DataFrame:
    """(field, doc_count, sum_total_term_freq, sum_doc_freq) of every field with terms."""
    structs = [
        F.struct(
            F.lit(f).alias("field"),
            *(value.alias(name) for name, value in field_counters(spec, f).items()),
        ).alias(f)
        for f in spec.term_fields
    ]
    one_row = documents.agg(*structs)
    return one_row.select(F.inline(F.array(*spec.term_fields))).filter(F.col("sum_doc_freq") > 0)


def build_index(docs: DataFrame, spec: IndexSpec) -> Index:
    """A lazy index over ``docs``; ``write_index`` makes one that is read many times."""
    documents = analyse_documents(docs, spec)
    postings = postings_of(documents, spec)
    return Index(
        spec=spec,
        documents=documents,
        postings=postings,
        term_stats=count_terms(postings),
        field_counts=count_fields(documents, spec),
        n_docs=docs.agg(F.count("*")).scalar(),
    )


def with_document_frequency(index: Index, field: str, rows: DataFrame) -> DataFrame:
    """Attach ``df`` to rows that carry a ``term`` of the field.

    A vocabulary known to be small is broadcast.  Otherwise the rows are split:
    a term in more than 1/BROADCAST_ROWS of all postings is frequent, of which
    there can be fewer than BROADCAST_ROWS, so these statistics are broadcast
    and their rows, the bulk of any text, stay where they are.  Only rows of the
    remaining terms, none of them hot, are shuffled.
    """
    stats = index.field_terms(field).select("term", "df")
    if index.sizes is not None:
        size = index.sizes.get(field, FieldSize())
        if size.n_terms <= BROADCAST_ROWS:
            return rows.join(F.broadcast(stats), "term")
        frequent = F.col("df") > size.n_postings // BROADCAST_ROWS
    else:
        counts = index.field_counts.filter(F.col("field") == field)
        frequent = F.col("df") * BROADCAST_ROWS > counts.select("sum_doc_freq").scalar()
    hot, cold = stats.filter(frequent), stats.filter(~frequent)
    near = rows.join(F.broadcast(hot), "term")
    far = rows.join(F.broadcast(hot.select("term")), "term", "left_anti").join(cold, "term")
    return near.unionByName(far)
