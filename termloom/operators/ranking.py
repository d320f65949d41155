"""Best terms of one document or of every document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.text import format_term
from termloom.functions.weights import ORDERS, check_choice, check_top, idf
from termloom.operators.index import (
    BROADCAST_ROWS,
    Index,
    field_vectors,
    term_rows,
    with_document_frequency,
)


def ranking_key(order: str) -> Column:
    check_choice("order", order, ORDERS)
    return F.col("tfidf" if order == "tfxidf" else order)


def with_tfidf(rows: DataFrame, index: Index) -> DataFrame:
    return rows.withColumn("tfidf", F.col("tf") * idf(F.lit(index.n_docs), F.col("df")))


def by_frequency() -> Column:
    """A vector's places, the most frequent first, equal ones in term order."""
    return F.sort_array(
        F.zip_with("tfs", "terms", lambda tf, t: F.struct((-tf).alias("key"), t.alias("term")))
    )


def best_terms(index: Index, doc_id: int, field: str, top: int, order: str) -> DataFrame:
    """The ``top`` terms of a document; equal keys in term order, cut at ``top``.

    A document without terms in the field is an error.
    """
    check_top(top)
    key = ranking_key(order)
    vector = field_vectors(index.document(doc_id), index.spec, field)
    size = vector.select(F.size("terms")).first()
    if size is None:
        raise ValueError(f"document {doc_id} has no terms in field {field!r}")
    if order == "tf":
        # The frequencies are in the row already: look up only what will be shown.
        terms = F.transform(F.slice(by_frequency(), 1, top), lambda x: x["term"])
        tfs = F.transform(F.slice(by_frequency(), 1, top), lambda x: -x["key"])
        vector = vector.select(terms.alias("terms"), tfs.alias("tfs"))
    rows = term_rows(vector)
    if size[0] <= BROADCAST_ROWS:
        rows = F.broadcast(rows)
    # Every part of the statistics meets the document's terms before the sum, so no
    # vocabulary is added up for the sake of one document.
    parts = index.field_parts(field).select("term", "df").join(rows, "term")
    stats = parts.groupBy("term", "tf").agg(F.sum("df").alias("df"))
    ranked = with_tfidf(stats, index)
    return ranked.select("term", "tf", "df", "tfidf").orderBy(key.desc(), "term").limit(top)


def best_terms_all_docs(index: Index, field: str, top: int, order: str) -> DataFrame:
    """The ``top`` terms of every document, with their rank from 1."""
    check_top(top)
    key = ranking_key(order)
    vectors = field_vectors(index.documents, index.spec, field)
    if order == "tf":
        # The frequencies are in the row already: cut there, join what is left.
        ranked = vectors.select("doc_id", F.slice(by_frequency(), 1, top).alias("best")).select(
            "doc_id", F.posexplode("best").alias("pos", "best")
        )
        rows = ranked.select(
            "doc_id",
            F.col("best.term").alias("term"),
            (-F.col("best.key")).alias("tf"),
            (F.col("pos") + 1).alias("rank"),
        )
        scored = with_tfidf(with_document_frequency(index, field, rows), index)
    else:
        rows = with_document_frequency(index, field, term_rows(vectors, "doc_id"))
        best_first = Window.partitionBy("doc_id").orderBy(key.desc(), "term")
        scored = (
            with_tfidf(rows, index)
            .withColumn("rank", F.row_number().over(best_first))
            .filter(F.col("rank") <= top)
        )
    return scored.select("doc_id", "rank", "term", "tf", "df", "tfidf")


def report_lines(ranked: DataFrame, *keep: str) -> DataFrame:
    """Best-terms rows as report lines."""
    line = format_term(F.col("term"), F.col("tf"), F.col("df"), F.col("tfidf"))
    return ranked.select(*keep, line.alias("line"))
