"""Terms as vectors over documents: weights, norms, dot products, cosines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from termloom.functions.weights import (
    REPRESENTATIONS,
    check_choice,
    check_top,
    idf,
    weight,
)
from termloom.operators.index import BROADCAST_ROWS, Index, field_vectors, term_rows
from termloom.operators.statistics import postings_with_df


def term_weights(index: Index, field: str, rep: str) -> DataFrame:
    """(term, doc_id, weight): the non-zero places of every term vector."""
    check_choice("rep", rep, REPRESENTATIONS)
    if rep == "tfxidf":
        rows = postings_with_df(index, field)
        value = weight(rep, F.col("tf"), F.col("df"), F.lit(index.n_docs))
    else:
        rows = term_rows(field_vectors(index.documents, index.spec, field), "doc_id")
        value = weight(rep, F.col("tf"), F.lit(None), F.lit(None))
    return rows.select("term", "doc_id", value.alias("weight"))


def norm(rep: str, n_docs: Column) -> Column:
    """Length of a term vector out of the term's own statistics.

    All weights of a term share one idf, so it comes out of the root, and what
    is left under the root is an integer that was counted at index time.
    """
    check_choice("rep", rep, REPRESENTATIONS)
    if rep == "bin":
        return F.sqrt(F.col("df").cast("double"))
    length = F.sqrt(F.col("sum_sq_tf").cast("double"))
    return length if rep == "tf" else length * idf(n_docs, F.col("df"))


def term_norms(index: Index, field: str, rep: str) -> DataFrame:
    """(term, norm) of every term of the field."""
    value = norm(rep, F.lit(index.n_docs))
    return index.field_terms(field).select("term", value.alias("norm"))


def query_statistics(index: Index, field: str, term: str) -> Row | None:
    """df and sum of squared tf of the query term, None if it is absent."""
    rows = index.field_terms(field).filter(F.col("term") == term)
    return rows.select("df", "sum_sq_tf", F.lit(index.n_docs).alias("n_docs")).first()


def both_factors(vectors: DataFrame, term: str) -> DataFrame:
    """Vectors that hold the query term, with its frequency beside them."""
    place = F.array_position("terms", F.lit(term)) - 1
    held = vectors.filter(F.array_contains("terms", F.lit(term)))
    return held.select("terms", "tfs", F.get("tfs", place).alias("query_tf"))


def vectors_with(index: Index, field: str, term: str) -> DataFrame:
    """(terms, tfs, query_tf) of the documents in the postings of the query term.

    The postings name the folder of every document, so folders without one are pruned when
    the query runs, and the few rows of the others meet the broadcast postings.
    """
    found = []
    for piece in index.pieces:
        wanted = (
            piece.postings.filter((F.col("field") == field) & (F.col("term") == term))
            .select("batch", "chunk", "doc_id", F.col("tf").alias("query_tf"))
        )
        vectors = field_vectors(piece.documents, index.spec, field, "batch", "chunk")
        joined = vectors.join(F.broadcast(wanted), ["batch", "chunk", "doc_id"])
        found.append(joined.select("terms", "tfs", "query_tf"))
    return reduce(DataFrame.unionByName, found)


def co_occurrence(index: Index, field: str, term: str, df: int) -> DataFrame:
    """(term, co_docs, tf_dot) for every term that shares a document with ``term``.

    A stored index goes by the postings of the term, as long as these are few enough to be
    sent to every executor.  Beyond that, and in a lazy index, every document is looked at:
    a row of the documents table holds both sides of each product, so there is neither a
    join nor a broadcast.  The only shuffle moves map-side sums, one row per term and task.
    """
    if index.pieces and df <= BROADCAST_ROWS:
        with_query = vectors_with(index, field, term)
    else:
        with_query = both_factors(field_vectors(index.documents, index.spec, field), term)
    return (
        term_rows(with_query, "query_tf")
        .groupBy("term")
        .agg(
            F.count("*").alias("co_docs"),
            F.sum(F.col("tf") * F.col("query_tf")).alias("tf_dot"),
        )
    )


def cosine_dot(index: Index, field: str, term: str, rep: str) -> DataFrame:
    """(term, dot) with the query term's vector; only terms that share a document."""
    check_choice("rep", rep, REPRESENTATIONS)
    query = query_statistics(index, field, term)
    shared = co_occurrence(index, field, term, query["df"] if query else 0)
    if rep == "bin":
        return shared.select("term", F.col("co_docs").cast("double").alias("dot"))
    if rep == "tf":
        return shared.select("term", F.col("tf_dot").cast("double").alias("dot"))
    query_idf = idf(F.lit(index.n_docs), F.lit(query["df"] if query else None))
    joined = shared.join(index.field_terms(field).select("term", "df"), "term")
    dot = F.col("tf_dot") * idf(F.lit(index.n_docs), F.col("df")) * query_idf
    return joined.select("term", dot.alias("dot"))


def cosine_similarity(index: Index, field: str, term: str, rep: str) -> DataFrame:
    """(term, similarity) for every term of the field.

    No shared document gives 0; a vector of length zero, on either side, gives
    NaN, and so does an absent query term.  In the tf-idf representation both
    idf factors stand above and below the fraction bar and cancel, unless one
    is zero because its term is in every document.
    """
    check_choice("rep", rep, REPRESENTATIONS)
    nan = F.lit(float("nan"))
    terms = index.field_terms(field)
    query = query_statistics(index, field, term)
    if query is None:
        return terms.select("term", nan.alias("similarity"))

    shared, own = ("co_docs", "df") if rep == "bin" else ("tf_dot", "sum_sq_tf")
    dots = co_occurrence(index, field, term, query["df"]).select("term", shared)
    joined = terms.join(dots, "term", "left")
    lengths = F.sqrt(F.col(own).cast("double")) * F.sqrt(F.lit(query[own]).cast("double"))
    similarity = F.coalesce(F.col(shared), F.lit(0)) / lengths
    if rep == "tfxidf":
        everywhere = F.lit(query["df"] == query["n_docs"]) | (F.col("df") == query["n_docs"])
        similarity = F.when(everywhere, nan).otherwise(similarity)
    return joined.select("term", similarity.alias("similarity"))


def similar_terms(
    index: Index, field: str, term: str, top: int, rep: str, nan: str = "first"
) -> DataFrame:
    """The ``top`` most similar terms, the query term itself among them.

    NaN ranks above every number; ``nan='drop'`` leaves it out.
    """
    check_top(top)
    check_choice("nan", nan, ("first", "drop"))
    found = cosine_similarity(index, field, term, rep)
    if nan == "drop":
        found = found.filter(~F.isnan("similarity"))
    return found.orderBy(F.col("similarity").desc(), "term").limit(top)
