"""Corpus term statistics on Spark."""

from termloom.operators.clusters import (
    cluster_summary,
    kmeans_1d,
    kmeans_assign,
    kmeans_fit,
    kmeans_init,
    terms_clusters,
)
from termloom.operators.index import (
    Index,
    IndexSpec,
    analyse_documents,
    build_index,
    combine_term_stats,
    exact_terms,
)
from termloom.operators.ranking import best_terms, best_terms_all_docs, report_lines
from termloom.operators.similarity import (
    cosine_dot,
    cosine_similarity,
    similar_terms,
    term_norms,
    term_weights,
)
from termloom.operators.statistics import (
    all_field_stats,
    doc_freq,
    field_stats,
    list_fields,
    postings_lookup,
    postings_with_df,
    term_vector,
    vocabulary,
)
from termloom.operators.points import range_documents
from termloom.sinks.index_store import (
    ConcurrentWriteError,
    expire,
    merge_indexes,
    read_index,
    write_index,
)
from termloom.sinks.reports import write_best_terms, write_vocabulary
from termloom.sources.files import FILE_SPEC, filter_extension, scan_files

__all__ = [
    "ConcurrentWriteError",
    "FILE_SPEC",
    "Index",
    "IndexSpec",
    "all_field_stats",
    "analyse_documents",
    "best_terms",
    "best_terms_all_docs",
    "build_index",
    "cluster_summary",
    "combine_term_stats",
    "cosine_dot",
    "cosine_similarity",
    "doc_freq",
    "exact_terms",
    "expire",
    "field_stats",
    "filter_extension",
    "kmeans_1d",
    "kmeans_assign",
    "kmeans_fit",
    "kmeans_init",
    "list_fields",
    "merge_indexes",
    "postings_lookup",
    "postings_with_df",
    "range_documents",
    "read_index",
    "report_lines",
    "scan_files",
    "similar_terms",
    "term_norms",
    "term_vector",
    "term_weights",
    "terms_clusters",
    "vocabulary",
    "write_best_terms",
    "write_index",
    "write_vocabulary",
]
