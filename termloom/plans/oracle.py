"""SQL counterparts of the registered queries.

Each one starts from the raw text and shares no code with the Spark side: the
tokens are matched here, where Spark splits at separators.
"""

from __future__ import annotations

from termloom.plans.queries import (
    BOTTOM_LINES,
    DOC_ID,
    EXTENSIONS,
    FIELD,
    K,
    LONG_K,
    LONG_TOP,
    N_CHARS,
    QUERY_TERM,
    TOP,
    TOP_LINES,
    TOP_PER_DOC,
)

# The word-break punctuation of Unicode Standard Annex 29.
JOINS_BOTH = r"\.'\x{2018}\x{2019}\x{2024}\x{FE52}\x{FF07}\x{FF0E}"
JOINS_LETTERS = r":\x{B7}\x{387}\x{5F4}\x{2027}\x{FE13}\x{FE55}\x{FF1A}"
JOINS_DIGITS = (
    r",;\x{37E}\x{589}\x{60C}\x{60D}\x{66C}\x{7F8}\x{2044}"
    r"\x{FE10}\x{FE14}\x{FE50}\x{FE54}\x{FF0C}\x{FF1B}"
)

CONNECTS = r"_\x{203F}\x{2040}\x{2054}\x{FE33}\x{FE34}\x{FE4D}\x{FE4E}\x{FE4F}\x{FF3F}\x{202F}"
# Format characters but the zero-width space; they follow what they belong to.
FORMATS = (
    r"\x{AD}\x{600}-\x{605}\x{61C}\x{6DD}\x{70F}\x{180E}\x{200C}-\x{200F}\x{202A}-\x{202E}"
    r"\x{2060}-\x{2064}\x{2066}-\x{206F}\x{FEFF}\x{FFF9}-\x{FFFB}"
)
LETTERS = r"\p{L}\p{M}\p{Nl}"

WORD = (
    rf"[{LETTERS}]+(?:[{FORMATS}]+[{LETTERS}]+|[{FORMATS}]*[{JOINS_BOTH}{JOINS_LETTERS}][{FORMATS}]*[{LETTERS}]+)*[{FORMATS}]*"
)
NUMBER = rf"\p{{Nd}}+(?:[{FORMATS}]+\p{{Nd}}+|[{FORMATS}]*[{JOINS_BOTH}{JOINS_DIGITS}][{FORMATS}]*\p{{Nd}}+)*[{FORMATS}]*"
TOKEN = rf"(?:[{CONNECTS}][{FORMATS}]*)*(?:{WORD}|{NUMBER})(?:{WORD}|{NUMBER}|[{CONNECTS}][{FORMATS}]*)*"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def tokens_of(text: str) -> str:
    """SQL list of the tokens of a text expression."""
    spaced = rf"regexp_replace(lower({text}), '([\p{{Han}}\p{{Hiragana}}]\p{{M}}*)', ' \1 ', 'g')"
    return f"regexp_extract_all({spaced}, {quoted(TOKEN)})"


DOCS = """
docs AS (
  SELECT doc_id, 'documents/' || doc_id AS path, text AS contents, lang, source,
         CAST(n_chars AS VARCHAR) AS n_chars_str
  FROM documents
)"""
BENCHMARK_DOCS = """
  SELECT item_id AS doc_id, 'benchmark/' || item_id AS path, text AS contents,
         CAST(NULL AS VARCHAR) AS lang, CAST(NULL AS VARCHAR) AS source,
         CAST(length(text) AS VARCHAR) AS n_chars_str
  FROM benchmark"""
CONVERSATION_DOCS = """
  SELECT CAST(NULL AS BIGINT) AS doc_id, 'conversations/' || conv_id || '/' || turn AS path,
         text AS contents, CAST(NULL AS VARCHAR) AS lang, CAST(NULL AS VARCHAR) AS source,
         CAST(length(text) AS VARCHAR) AS n_chars_str
  FROM conversations"""
FRENCH_AGAIN = """
  SELECT doc_id, path, contents || ' revised ' || source AS contents, lang, source, n_chars_str
  FROM base WHERE lang = 'fr'"""

TOKENS = f"""
tokens AS (SELECT doc_id, path, unnest({tokens_of('contents')}) AS term FROM docs)"""
CONTENTS = """
contents AS (
  SELECT term, doc_id, count(*) AS tf FROM tokens GROUP BY term, doc_id
)"""
EXACT = """
exact AS (
  UNPIVOT (SELECT doc_id, path, lang, source, n_chars_str FROM docs)
  ON path, lang, source, n_chars_str INTO NAME field VALUE term
)"""
STATS = """
n AS (SELECT count(*) AS n_docs FROM docs),
stats AS (
  SELECT term, count(*) AS df, sum(tf) AS ttf FROM contents GROUP BY term
),
with_df AS (
  SELECT term, doc_id, tf, df, tf * log10(CAST(n_docs AS DOUBLE) / df) AS tfidf
  FROM contents JOIN stats USING (term) CROSS JOIN n
)"""

CORPUS = f"WITH RECURSIVE {DOCS}, {TOKENS}, {CONTENTS}, {STATS}"

WEIGHTS = {"bin": "1.0::DOUBLE", "tf": "tf::DOUBLE", "tfxidf": "tfidf"}


def all_fields(docs: str) -> str:
    """doc_freq of every field of a set of documents."""
    return f"""
WITH {docs},
numbered AS (SELECT row_number() OVER () AS n, * FROM docs),
tokens AS (SELECT n, unnest({tokens_of('contents')}) AS term FROM numbered),
postings AS (
  SELECT 'contents' AS field, term, n, count(*) AS tf FROM tokens GROUP BY term, n
  UNION ALL
  SELECT field, term, n, 1 AS tf FROM (
    UNPIVOT (SELECT n, path, lang, source, n_chars_str FROM numbered)
    ON path, lang, source, n_chars_str INTO NAME field VALUE term
  )
)
SELECT field, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ttf
FROM postings GROUP BY field, term"""


BASE = DOCS.replace("docs AS", "base AS", 1)
UPDATED = f"""{BASE},
docs AS (
  SELECT * FROM base WHERE lang <> 'fr'
  UNION ALL {FRENCH_AGAIN}
  UNION ALL {CONVERSATION_DOCS}
  UNION ALL {BENCHMARK_DOCS}
)"""
APPENDED = f"{BASE}, docs AS (SELECT * FROM base UNION ALL {FRENCH_AGAIN})"
CREATED_OR_APPENDED = f"docs AS ({CONVERSATION_DOCS} UNION ALL {BENCHMARK_DOCS})"
MERGED = f"""{BASE},
docs AS (SELECT * FROM base UNION ALL {BENCHMARK_DOCS} UNION ALL {CONVERSATION_DOCS})"""

FIELD_COUNTS = f"""
WITH {DOCS}, {TOKENS}, {CONTENTS}, {EXACT}
SELECT field, (SELECT count(*) FROM docs) AS max_doc, count(DISTINCT doc_id) AS doc_count,
       CAST(sum(tf) AS BIGINT) AS sum_total_term_freq, count(*) AS sum_doc_freq
FROM (
  SELECT 'contents' AS field, term, doc_id, tf FROM contents
  UNION ALL
  SELECT field, term, doc_id, 1 AS tf FROM exact
)
GROUP BY field"""


def best_terms(order: str) -> str:
    key = "tfidf" if order == "tfxidf" else order
    return f"""{CORPUS}
SELECT term, tf, df, round(tfidf, 9) AS tfidf FROM with_df WHERE doc_id = {DOC_ID}
ORDER BY {key} DESC, term LIMIT {TOP}"""


def best_terms_all_docs(order: str) -> str:
    key = "tfidf" if order == "tfxidf" else order
    return f"""{CORPUS},
ranked AS (
  SELECT doc_id, term, tf, df, round(tfidf, 9) AS tfidf,
         row_number() OVER (PARTITION BY doc_id ORDER BY {key} DESC, term) AS rank
  FROM with_df
)
SELECT doc_id, CAST(rank AS INTEGER) AS rank, term, tf, df, tfidf
FROM ranked WHERE rank <= {TOP_PER_DOC}"""


# What a vector's length and dot product are roots and sums of, in whole numbers: the
# cosine of two terms does not depend on the idf that all weights of one share.
WHOLE = {"bin": "1", "tf": "tf", "tfxidf": "tf"}


def cosines(rep: str, top: int = TOP) -> str:
    nan = "q.df = n_docs OR s.df = n_docs" if rep == "tfxidf" else "false"
    return f"""{CORPUS},
weights AS (SELECT term, doc_id, {WEIGHTS[rep]} AS w FROM with_df),
query AS (SELECT doc_id, w AS qw FROM weights WHERE term = {quoted(QUERY_TERM)}),
norms AS (SELECT term, sqrt(sum(w * w)) AS norm FROM weights GROUP BY term),
query_norm AS (SELECT sqrt(sum(qw * qw)) AS qnorm FROM query),
dots AS (
  SELECT term, sum(w * qw) AS dot FROM weights JOIN query USING (doc_id) GROUP BY term
),
whole AS (SELECT term, doc_id, {WHOLE[rep]} AS w FROM with_df),
own AS (SELECT term, count(*) AS df, sum(w * w) AS squares FROM whole GROUP BY term),
whole_dots AS (
  SELECT a.term, sum(a.w * b.w) AS dot
  FROM whole a JOIN whole b USING (doc_id) WHERE b.term = {quoted(QUERY_TERM)} GROUP BY a.term
),
sims AS (
  SELECT s.term, CASE WHEN {nan} THEN 'nan'::DOUBLE ELSE CAST(coalesce(d.dot, 0) AS DOUBLE)
    / (sqrt(CAST(s.squares AS DOUBLE)) * sqrt(CAST(q.squares AS DOUBLE))) END AS similarity
  FROM own s CROSS JOIN n CROSS JOIN (SELECT * FROM own WHERE term = {quoted(QUERY_TERM)}) q
  LEFT JOIN whole_dots d ON d.term = s.term
),
top AS (SELECT term, similarity FROM sims ORDER BY similarity DESC, term LIMIT {top})"""


def init(k: int) -> str:
    return f"""
init AS (
  SELECT CAST(row_number() OVER (ORDER BY draw, similarity) - 1 AS INTEGER) AS cluster,
         similarity AS centroid
  FROM (
    SELECT DISTINCT similarity,
           md5('0:' || CAST(CAST(round(similarity * 1000000000) AS BIGINT) AS VARCHAR)) AS draw
    FROM top
  )
  ORDER BY draw, similarity LIMIT {k}
)"""


INIT = init(K)


def nearest(value: str, centroids: str) -> str:
    distances = f"list_transform({centroids}, lambda c: abs({value} - c))"
    return f"list_position({distances}, list_min({distances}))"


# The means of the assigned values, step after step; a fixed point repeats itself.
def lloyd(k: int) -> str:
    return f"""
lloyd AS (
  SELECT 0 AS step, (SELECT list(similarity) FROM top) AS points,
         (SELECT list(centroid ORDER BY cluster) FROM init) AS centroids,
         CAST(NULL AS DOUBLE[]) AS previous
  UNION ALL
  SELECT step + 1, points, list_transform(range(1, {k + 1}), lambda i: coalesce(
    list_avg(list_filter(points, lambda p: {nearest('p', 'centroids')} = i)), centroids[i])),
    centroids
  FROM lloyd WHERE previous IS NULL OR previous <> centroids
),
final AS (SELECT centroids FROM lloyd ORDER BY step DESC LIMIT 1),
clusters AS (
  SELECT CAST({nearest('similarity', 'centroids')} - 1 AS INTEGER) AS cluster,
         round(centroids[{nearest('similarity', 'centroids')}], 9) AS centroid,
         term, similarity
  FROM top CROSS JOIN final
)"""


LLOYD = lloyd(K)


def file_terms(label: str, texts: str) -> str:
    return f"""
SELECT {label}, term, count(*) AS ttf
FROM (SELECT {label}, unnest({tokens_of('text')}) AS term FROM ({texts}))
GROUP BY {label}, term"""


def oracle_sql() -> dict[str, str]:
    format_line = "'term=''%s'', tf=%d, df=%d, tfxidf=%.2f', term, tf, df, tfidf"
    lines = r"string_split_regex(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n')"
    extension = r"regexp_extract({}, '(?s)^.+(\.[^.]*)$', 1)"
    extensions = ", ".join(quoted(e) for e in EXTENSIONS)
    found = {
        "scan_files": file_terms("lang", "SELECT lang, text FROM documents"),
        "scan_multi_root": file_terms(
            "table_name",
            """SELECT 'documents' AS table_name, text FROM documents
               UNION ALL SELECT 'benchmark', text FROM benchmark
               UNION ALL SELECT 'conversations', text FROM conversations""",
        ),
        "extension": f"SELECT page_id, {extension.format('url')} AS extension FROM pages",
        "filter_extension": f"""
SELECT page_id, url FROM pages WHERE {extension.format('url')} IN ({extensions})""",
        "line_window": f"""
SELECT doc_id, CASE WHEN text = '' THEN '' ELSE array_to_string(list_transform(
  list_filter(lines, lambda line, i: i <= {TOP_LINES} OR i > len(lines) - {BOTTOM_LINES}),
  lambda line: line || chr(10)), '') END AS contents
FROM (SELECT doc_id, text, {lines} AS lines FROM documents)""",
        "decode_utf8": """
SELECT doc_id, text || chr(65533) || text || chr(65533) AS contents FROM documents""",
        "doc_metadata": """
SELECT doc_id, octet_length(encode(text)) AS n_bytes,
       CAST(octet_length(encode(text)) // 1024 AS FLOAT) AS size_kb,
       CAST(CAST(octet_length(encode(text)) // 1024 AS FLOAT) AS VARCHAR) AS size_kb_str
FROM documents""",
        "tokenize": f"SELECT doc_id, unnest({tokens_of('text')}) AS term FROM documents",
        "exact_terms": f"""
WITH {DOCS}, {EXACT}
SELECT field, term, doc_id, CAST(1 AS BIGINT) AS tf FROM exact""",
        "format_dates": """
SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') AS readable,
       strftime(o_orderdate, '%Y%m%d%H%M%S') AS sortable
FROM orders""",
        "range_filter": f"""
SELECT doc_id, n_chars FROM documents WHERE n_chars BETWEEN {N_CHARS[0]} AND {N_CHARS[1]}""",
        "range_documents": f"""
WITH {DOCS}
SELECT doc_id, path, lang, source, n_chars_str, CAST(n_chars_str AS BIGINT) AS n_chars
FROM docs WHERE CAST(n_chars_str AS BIGINT) BETWEEN {N_CHARS[0]} AND {N_CHARS[1]}""",
        "skip_unreadable": """
SELECT lang, source, CASE WHEN lang = 'fr' THEN 'vanished' ELSE 'read' END AS status,
       CAST(CASE WHEN lang = 'fr' THEN NULL ELSE sum(length(text) + 1) - 1 END AS INTEGER) AS n_chars
FROM documents GROUP BY lang, source""",
        "format_term": f"""
SELECT doc_id, printf({format_line}) AS line FROM ({best_terms_all_docs('tfxidf')})""",
        "build_postings": f"""
WITH {DOCS}, {TOKENS}, {CONTENTS}, {EXACT}
SELECT 'contents' AS field, term, doc_id, tf FROM contents
UNION ALL SELECT field, term, doc_id, 1 FROM exact""",
        "term_vector": f"{CORPUS} SELECT term, tf FROM contents WHERE doc_id = {DOC_ID}",
        "doc_freq": all_fields(DOCS),
        "field_stats": f"SELECT * FROM ({FIELD_COUNTS}) WHERE field = {quoted(FIELD)}",
        "all_field_stats": FIELD_COUNTS,
        "list_fields": f"""
WITH kinds(field, kind) AS (
  VALUES ('contents', 'text'), ('path', 'exact'), ('lang', 'exact'), ('source', 'exact'),
         ('n_chars_str', 'exact'), ('n_chars', 'point')
)
SELECT field, kind, doc_count FROM kinds LEFT JOIN ({FIELD_COUNTS}) USING (field)""",
        "vocabulary": f"""
WITH {DOCS}, {TOKENS}, {EXACT}
SELECT DISTINCT 'contents' AS field, term FROM tokens
UNION ALL SELECT DISTINCT field, term FROM exact
UNION ALL SELECT 'n_chars', CAST(NULL AS VARCHAR)""",
        "postings_with_df": f"{CORPUS} SELECT term, doc_id, tf, df FROM with_df",
        "postings_lookup": f"""{CORPUS}
SELECT doc_id, tf FROM contents WHERE term = {quoted(QUERY_TERM)}""",
        "kmeans_init": f"""{cosines('tfxidf')}, {INIT}
SELECT cluster, round(centroid, 9) AS centroid FROM init""",
        "kmeans_assign": f"""{cosines('tfxidf')}, {INIT},
start AS (SELECT list(centroid ORDER BY cluster) AS centroids FROM init)
SELECT CAST({nearest('similarity', 'centroids')} - 1 AS INTEGER) AS cluster,
       round(centroids[{nearest('similarity', 'centroids')}], 9) AS centroid, term,
       round(similarity, 9) AS similarity
FROM top CROSS JOIN start""",
        "terms_clusters": f"""{cosines('tfxidf')}, {INIT}, {LLOYD}
SELECT cluster, centroid, term, round(similarity, 9) AS similarity FROM clusters""",
        "terms_clusters_long": f"""{cosines('tf', LONG_TOP)}, {init(LONG_K)}, {lloyd(LONG_K)}
SELECT cluster, centroid, term, round(similarity, 9) AS similarity FROM clusters""",
        "cluster_summary": f"""{cosines('tfxidf')}, {INIT}, {LLOYD},
every AS (SELECT unnest(range({K})) AS i, centroids FROM final)
SELECT CAST(i AS INTEGER) AS cluster, round(centroids[i + 1], 9) AS centroid,
       (SELECT count(*) FROM clusters WHERE cluster = i) AS elements
FROM every""",
        "merge_partial_indexes": all_fields(MERGED),
        "upsert_documents": f"""
WITH {UPDATED}, {TOKENS}
SELECT path, term, count(*) AS tf FROM tokens GROUP BY path, term""",
        "write_index_create": f"""
WITH {DOCS}, {TOKENS}, {CONTENTS}, {EXACT}
SELECT 'contents' AS field, term, doc_id, tf FROM contents
UNION ALL SELECT field, term, doc_id, 1 FROM exact""",
        "write_index_append": all_fields(APPENDED),
        "write_index_create_or_append": all_fields(CREATED_OR_APPENDED),
        "write_index_update": all_fields(UPDATED),
        "write_vocabulary": f"""
WITH {DOCS}, {TOKENS}, {EXACT},
fields(field) AS (
  VALUES ('contents'), ('path'), ('lang'), ('source'), ('n_chars_str'), ('n_chars')
)
SELECT DISTINCT 'contents' AS field, term AS value FROM tokens
UNION ALL SELECT DISTINCT field, term FROM exact
UNION ALL SELECT field, 'Terms of field ''' || field || ''':' FROM fields
UNION ALL SELECT field, unnest(['', '']) FROM fields""",
        "write_best_terms": f"""
SELECT printf({format_line}) AS line FROM ({best_terms('tfxidf')})
UNION ALL SELECT 'Top {TOP} terms ordered by ''tfxidf'''
UNION ALL SELECT ''""",
    }
    for rep, value in WEIGHTS.items():
        found[f"term_weight_{rep}"] = f"""{CORPUS}
SELECT term, doc_id, round({value}, 9) AS weight FROM with_df"""
        found[f"term_norms_{rep}"] = f"""{cosines(rep)}
SELECT term, round(norm, 9) AS norm FROM norms"""
        found[f"cosine_dot_{rep}"] = f"{cosines(rep)} SELECT term, round(dot, 6) AS dot FROM dots"
        shown = "term, round(similarity, 9) AS similarity"
        found[f"cosine_similarity_{rep}"] = f"{cosines(rep)} SELECT {shown} FROM sims"
        found[f"similar_terms_{rep}"] = f"{cosines(rep)} SELECT {shown} FROM top"
    for order in ("tf", "df", "tfxidf"):
        found[f"best_terms_{order}"] = best_terms(order)
        found[f"best_terms_all_docs_{order}"] = best_terms_all_docs(order)
    return found
