"""Every operator as a query over the given tables.

Queries that read one table once are lazy plans over it.  The others work the
way the engine is meant to be used: the documents are indexed once, below the
shared folder, and each query reads the stored index.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.metadata import between, readable_date, sortable_date
from termloom.functions.text import decode_utf8, extension, line_window, tokenize
from termloom.functions.weights import ORDERS, REPRESENTATIONS
from termloom.operators import clusters, index, points, ranking, similarity, statistics
from termloom.operators.index import Index
from termloom.session import delete_path, list_folder, new_path, spread, stage
from termloom.sinks import index_store, reports
from termloom.sources.files import filter_extension, scan_accounted, scan_files
from termloom.sources.tables import (
    TABLE_SPEC,
    benchmark_docs,
    conversation_docs,
    doc_metadata,
    document_docs,
    read_table,
)

FIELD = "contents"
QUERY_TERM = "the"
DOC_ID = 7
TOP = 100
TOP_PER_DOC = 5
K = 4
FILE_TEXTS = 500
LONG_TOP, LONG_K = 3000, 8
EXTENSIONS = [".html", ".htm", ".php", ".txt"]
TOP_LINES, BOTTOM_LINES = 2, 1
N_CHARS = (1000, 5000)

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, **places: int) -> DataFrame:
    """The columns rounded for the comparison with SQL; operators return raw doubles."""
    return df.withColumns({name: F.round(name, n) for name, n in places.items()})

_stored: dict[tuple[str, str, str], str] = {}


def once(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], object]) -> str:
    """Path of data derived from the tables, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _stored:
        path = new_path(spark, label)
        write(path)
        _stored[key] = path
    return _stored[key]


def lazy_index(spark: SparkSession, sf_dir: str) -> Index:
    return index.build_index(document_docs(spark, sf_dir), TABLE_SPEC)


def corpus(spark: SparkSession, sf_dir: str) -> Index:
    """The stored index of the documents table."""

    def write(path: str) -> None:
        index_store.write_index(document_docs(spark, sf_dir), TABLE_SPEC, path)

    return index_store.read_index(spark, once(spark, sf_dir, "corpus", write))


# Sources


def text_files(spark: SparkSession, sf_dir: str, table: str, *by: str) -> str:
    """The texts of a table as a tree of text files."""

    def write(path: str) -> None:
        rows = spread(read_table(spark, sf_dir, table)).select("text", *by)
        # A file is a row of the scan: bound what one holds.
        writer = rows.write.option("maxRecordsPerFile", FILE_TEXTS)
        writer.partitionBy(*by).text(path)

    return once(spark, sf_dir, f"{table}-files", write)


def half_hidden_files(spark: SparkSession, sf_dir: str) -> str:
    """The documents as a tree whose French part lies in a folder that Spark's reader skips."""

    def write(path: str) -> None:
        rows = read_table(spark, sf_dir, "documents").select("text", "lang")
        for folder, part in (("open", rows.filter("not lang <=> 'fr'")), ("_more", rows.filter("lang = 'fr'"))):
            writer = part.write.option("maxRecordsPerFile", FILE_TEXTS)
            writer.partitionBy("lang").text(f"{path}/{folder}")

    return once(spark, sf_dir, "half-hidden-files", write)


def file_terms(files: DataFrame, label: str) -> DataFrame:
    tokens = files.select(label, F.explode(tokenize(F.col("contents"))).alias("term"))
    return tokens.groupBy(label, "term").agg(F.count("*").alias("ttf"))


def q_scan_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = scan_files(spark, half_hidden_files(spark, sf_dir), only_extensions=[".txt"])
    lang = F.regexp_extract("path", "/lang=([^/]*)/", 1)
    lang = F.nullif(lang, F.lit("__HIVE_DEFAULT_PARTITION__"))  # how Spark names null in a path
    return file_terms(files.withColumn("lang", lang), "lang")


def q_scan_multi_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = ("documents", "benchmark", "conversations")
    roots = [
        text_files(spark, sf_dir, t, *(("lang",) if t == "documents" else ())) for t in tables
    ]
    files = scan_files(spark, roots, only_extensions=[".txt"])
    name = F.regexp_extract("root", "/([a-z]+)-files-[^/]*$", 1)
    return file_terms(files.withColumn("table_name", name), "table_name")


def q_skip_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per language and source; the French ones vanish between listing and reading."""
    root = new_path(spark, "vanishing")
    rows = read_table(spark, sf_dir, "documents").select("text", "lang", "source")
    rows.repartition("lang", "source").write.partitionBy("lang", "source").text(root)
    files = scan_accounted(spark, root, only_extensions=[".txt"])
    for folder in list_folder(spark, root):
        if folder.name == "lang=fr":
            delete_path(spark, f"{root}/{folder.name}")

    def of_path(name: str) -> Column:
        value = F.regexp_extract("path", f"/{name}=([^/]*)/", 1)
        return F.nullif(value, F.lit("__HIVE_DEFAULT_PARTITION__")).alias(name)

    texts = F.regexp_replace(decode_utf8(F.col("content")), r"\n\z", "")
    return files.select(
        of_path("lang"), of_path("source"), "status", F.length(texts).alias("n_chars")
    )


def q_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return pages.select("page_id", extension(F.col("url")).alias("extension"))


def q_filter_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_extension(pages, EXTENSIONS, "url")


def q_line_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_window(F.col("text"), TOP_LINES, BOTTOM_LINES)
    return read_table(spark, sf_dir, "documents").select("doc_id", kept.alias("contents"))


def q_decode_utf8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each whole text twice in UTF-8, a cut-off and an impossible byte behind the copies."""
    once_more = F.encode("text", "UTF-8")
    raw = F.concat(once_more, F.unhex(F.lit("C3")), once_more, F.unhex(F.lit("FF")))
    decoded = decode_utf8(raw)
    return read_table(spark, sf_dir, "documents").select("doc_id", decoded.alias("contents"))


def q_doc_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_metadata(read_table(spark, sf_dir, "documents"))


# Projections and predicates


def q_tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(read_table(spark, sf_dir, "documents"))
    return docs.select("doc_id", F.explode(tokenize(F.col("text"))).alias("term"))


def q_exact_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.exact_terms(lazy_index(spark, sf_dir).documents, TABLE_SPEC)


def q_format_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        readable_date(F.col("o_orderdate")).alias("readable"),
        sortable_date(F.col("o_orderdate")).alias("sortable"),
    )


def q_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return documents.filter(between(F.col("n_chars"), *N_CHARS))


def q_range_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points.range_documents(corpus(spark, sf_dir), n_chars=N_CHARS)


def q_term_weight(rep: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(similarity.term_weights(corpus(spark, sf_dir), FIELD, rep), weight=9)


def q_format_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = ranking.best_terms_all_docs(corpus(spark, sf_dir), FIELD, TOP_PER_DOC, "tfxidf")
    return ranking.report_lines(best, "doc_id")


# Aggregations and lookups


def q_build_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lazy_index(spark, sf_dir).postings


def q_term_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.term_vector(corpus(spark, sf_dir), DOC_ID, FIELD)


def q_doc_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.doc_freq(lazy_index(spark, sf_dir))


def q_field_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.field_stats(lazy_index(spark, sf_dir), FIELD)


def q_all_field_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.all_field_stats(corpus(spark, sf_dir))


def q_list_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields, with the number of documents that have a value."""
    found = corpus(spark, sf_dir)
    counts = found.field_counts.select("field", "doc_count")
    return statistics.list_fields(found).join(F.broadcast(counts), "field", "left")


def q_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.vocabulary(corpus(spark, sf_dir))


def q_term_norms(rep: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(similarity.term_norms(corpus(spark, sf_dir), FIELD, rep), norm=9)


def q_postings_with_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.postings_with_df(corpus(spark, sf_dir), FIELD)


def q_postings_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.postings_lookup(corpus(spark, sf_dir), FIELD, QUERY_TERM)


def q_cosine_dot(rep: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(similarity.cosine_dot(corpus(spark, sf_dir), FIELD, QUERY_TERM, rep), dot=6)


def q_cosine_similarity(rep: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similarity.cosine_similarity(corpus(spark, sf_dir), FIELD, QUERY_TERM, rep)
    return rounded(found, similarity=9)


# Ranking and clusters


def q_best_terms(order: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ranking.best_terms(corpus(spark, sf_dir), DOC_ID, FIELD, TOP, order), tfidf=9)


def q_best_terms_all_docs(order: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranking.best_terms_all_docs(corpus(spark, sf_dir), FIELD, TOP_PER_DOC, order)
    return rounded(found, tfidf=9)


def q_similar_terms(rep: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similarity.similar_terms(corpus(spark, sf_dir), FIELD, QUERY_TERM, TOP, rep)
    return rounded(found, similarity=9)


def ranked_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similarity.similar_terms(corpus(spark, sf_dir), FIELD, QUERY_TERM, TOP, "tfxidf")
    return stage(found, "similar-terms")


def q_kmeans_init(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(clusters.kmeans_init(ranked_points(spark, sf_dir), K), centroid=9)


def q_kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first step: every point to its nearest initial centroid."""
    points = ranked_points(spark, sf_dir)
    start = clusters.kmeans_init(points, K).orderBy("cluster").collect()
    found = clusters.kmeans_assign(points, [r["centroid"] for r in start])
    return rounded(found, centroid=9, similarity=9)


def q_terms_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clusters.terms_clusters(corpus(spark, sf_dir), FIELD, QUERY_TERM, TOP, "tfxidf", K)
    return rounded(found, centroid=9, similarity=9)


def q_terms_clusters_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long list in many clusters, which takes many steps to settle."""
    found = clusters.terms_clusters(
        corpus(spark, sf_dir), FIELD, QUERY_TERM, LONG_TOP, "tf", LONG_K
    )
    return rounded(found, centroid=9, similarity=9)


def q_cluster_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = ranked_points(spark, sf_dir)
    centroids = clusters.kmeans_fit(points, K)
    summary = clusters.cluster_summary(clusters.kmeans_assign(points, centroids), centroids)
    return rounded(summary, centroid=9)


# Writing


def text_terms(found: Index) -> DataFrame:
    """(path, term, tf) of the text field, by the documents' own key."""
    vectors = found.documents.select(
        "path", F.col(f"{FIELD}.terms").alias("terms"), F.col(f"{FIELD}.tfs").alias("tfs")
    )
    return index.term_rows(vectors, "path")


def q_write_index_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created twice over: the second content is what stands."""
    path = new_path(spark, "create")
    index_store.write_index(conversation_docs(spark, sf_dir), TABLE_SPEC, path)
    docs = document_docs(spark, sf_dir)
    return index_store.write_index(docs, TABLE_SPEC, path, update=True).postings


def french_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New versions of the French documents under their old keys."""
    revised = F.concat("contents", F.lit(" revised "), "source")
    docs = document_docs(spark, sf_dir).filter(F.col("lang") == "fr")
    return docs.withColumn("contents", revised)


def q_write_index_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "append")
    index_store.write_index(document_docs(spark, sf_dir), TABLE_SPEC, path)
    again = french_again(spark, sf_dir)
    return statistics.doc_freq(index_store.write_index(again, TABLE_SPEC, path, "append"))


def q_write_index_create_or_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "create-or-append")
    for docs in (conversation_docs(spark, sf_dir), benchmark_docs(spark, sf_dir)):
        found = index_store.write_index(docs, TABLE_SPEC, path, "create_or_append")
    return statistics.doc_freq(found)


def updated_index(spark: SparkSession, sf_dir: str) -> Index:
    """Documents and conversations, then French documents replaced and benchmark items added.

    Written for each query that asks: the writes are its work, whatever ran before it.
    """
    path = new_path(spark, "updated")
    index_store.write_index(document_docs(spark, sf_dir), TABLE_SPEC, path)
    index_store.write_index(conversation_docs(spark, sf_dir), TABLE_SPEC, path, "append")
    french = french_again(spark, sf_dir)
    index_store.write_index(french, TABLE_SPEC, path, "append", update=True)
    added = benchmark_docs(spark, sf_dir)
    index_store.write_index(added, TABLE_SPEC, path, "create_or_append", update=True)
    return index_store.read_index(spark, path)


def q_upsert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_terms(updated_index(spark, sf_dir))


def q_write_index_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.doc_freq(updated_index(spark, sf_dir))


def q_merge_partial_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for docs in (document_docs, benchmark_docs, conversation_docs):
        parts.append(new_path(spark, "partial"))
        index_store.write_index(docs(spark, sf_dir), TABLE_SPEC, parts[-1])
    merged = index_store.merge_indexes(spark, parts, new_path(spark, "merged"))
    return statistics.doc_freq(merged)


def q_write_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "vocabulary")
    reports.write_vocabulary(corpus(spark, sf_dir), path)
    return spark.read.schema("value string, field string").text(path)


def q_write_best_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "best-terms")
    reports.write_best_terms(q_best_terms("tfxidf", spark, sf_dir), path, TOP, "tfxidf")
    return spark.read.text(path).withColumnRenamed("value", "line")


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "scan_files": q_scan_files,
        "scan_multi_root": q_scan_multi_root,
        "extension": q_extension,
        "filter_extension": q_filter_extension,
        "line_window": q_line_window,
        "decode_utf8": q_decode_utf8,
        "doc_metadata": q_doc_metadata,
        "tokenize": q_tokenize,
        "exact_terms": q_exact_terms,
        "format_dates": q_format_dates,
        "range_filter": q_range_filter,
        "range_documents": q_range_documents,
        "skip_unreadable": q_skip_unreadable,
        "format_term": q_format_term,
        "build_postings": q_build_postings,
        "term_vector": q_term_vector,
        "doc_freq": q_doc_freq,
        "field_stats": q_field_stats,
        "all_field_stats": q_all_field_stats,
        "list_fields": q_list_fields,
        "vocabulary": q_vocabulary,
        "postings_with_df": q_postings_with_df,
        "postings_lookup": q_postings_lookup,
        "kmeans_init": q_kmeans_init,
        "kmeans_assign": q_kmeans_assign,
        "terms_clusters": q_terms_clusters,
        "terms_clusters_long": q_terms_clusters_long,
        "cluster_summary": q_cluster_summary,
        "merge_partial_indexes": q_merge_partial_indexes,
        "upsert_documents": q_upsert_documents,
        "write_index_create": q_write_index_create,
        "write_index_append": q_write_index_append,
        "write_index_create_or_append": q_write_index_create_or_append,
        "write_index_update": q_write_index_update,
        "write_vocabulary": q_write_vocabulary,
        "write_best_terms": q_write_best_terms,
    }
    for rep in REPRESENTATIONS:
        found[f"term_weight_{rep}"] = partial(q_term_weight, rep)
        found[f"term_norms_{rep}"] = partial(q_term_norms, rep)
        found[f"cosine_dot_{rep}"] = partial(q_cosine_dot, rep)
        found[f"cosine_similarity_{rep}"] = partial(q_cosine_similarity, rep)
        found[f"similar_terms_{rep}"] = partial(q_similar_terms, rep)
    for order in ORDERS:
        found[f"best_terms_{order}"] = partial(q_best_terms, order)
        found[f"best_terms_all_docs_{order}"] = partial(q_best_terms_all_docs, order)
    return found
