"""Collection statistics: fields, vocabularies, document frequencies, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.operators.index import Index, field_vectors, term_rows, with_document_frequency


def list_fields(index: Index) -> DataFrame:
    """(field, kind) of every field of the index, those without terms included."""
    spec = index.spec
    kinds = [(f, "text") for f in spec.text]
    kinds += [(f, "exact") for f in spec.exact]
    kinds += [(f, "point") for f in spec.points]
    rows = [F.struct(F.lit(f).alias("field"), F.lit(k).alias("kind")) for f, k in kinds]
    return index.documents.sparkSession.range(1).select(F.inline(F.array(*rows)))


def all_field_stats(index: Index) -> DataFrame:
    """Statistics of every field that has terms."""
    return index.field_counts.select(
        "field",
        F.lit(index.n_docs).cast("bigint").alias("max_doc"),
        "doc_count",
        "sum_total_term_freq",
        "sum_doc_freq",
    )


def field_stats(index: Index, field: str | None = None) -> DataFrame:
    """Statistics of one field, or of all; no row for a field without terms."""
    stats = all_field_stats(index)
    return stats if field is None else stats.filter(F.col("field") == field)


def doc_freq(index: Index) -> DataFrame:
    """Document and total frequency of every term."""
    return index.term_stats.select("field", "term", "df", "ttf")


def vocabulary(index: Index) -> DataFrame:
    """Every (field, term) in byte order; a field without terms has one null term."""
    bare = list_fields(index).join(F.broadcast(index.field_counts), "field", "left_anti")
    terms = index.term_stats.select("field", "term")
    return terms.unionByName(
        bare.select("field", F.lit(None).cast("string").alias("term"))
    ).orderBy("field", "term")


def term_vector(index: Index, doc_id: int, field: str) -> DataFrame:
    """(term, tf) of one document; empty if it has no terms in the field."""
    document = index.document(doc_id)
    return term_rows(field_vectors(document, index.spec, field)).orderBy("term")


def postings_lookup(index: Index, field: str, term: str) -> DataFrame:
    """(doc_id, tf) of one term; empty if the term is absent."""
    rows = index.field_postings(field).filter(F.col("term") == term)
    return rows.select("doc_id", "tf")


def postings_with_df(index: Index, field: str) -> DataFrame:
    """(term, doc_id, tf, df) of a field."""
    rows = term_rows(field_vectors(index.documents, index.spec, field), "doc_id")
    return with_document_frequency(index, field, rows)
