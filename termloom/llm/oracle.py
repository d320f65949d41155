"""SQL counterparts of the operators' queries, where SQL can express them on whole tables."""

from __future__ import annotations

EXACT_DUPLICATES = r"""
WITH hashed AS (
    SELECT doc_id,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept,
       text_sha256
FROM hashed
WINDOW same AS (PARTITION BY text_sha256)
"""


FILTER_AUDIT = r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
    FROM documents
),
known AS (
    SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic
    FROM labels GROUP BY doc_id
),
failed AS (
    SELECT t.part, coalesce(k.good, false) AS good, coalesce(k.toxic, false) AS toxic,
           (CASE WHEN len(words) < 200 THEN 'A' ELSE '' END)
           || (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END)
           || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text)
                    THEN 'C' ELSE '' END)
           || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
           || (CASE WHEN t.doc_id > first_id THEN 'E' ELSE '' END) AS fails
    FROM texts t LEFT JOIN known k ON t.doc_id = k.doc_id
),
counted AS (
    SELECT part, good, toxic, fails, count(*) AS n FROM failed GROUP BY ALL
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
),
steps AS (
    SELECT filter_order, step, filter_order[step] AS own, filter_order[1:step - 1] AS before
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
),
judged AS (
    SELECT part, filter_order, step, good, toxic, n, fails,
           contains(fails, own) AS own_fails, own,
           CASE WHEN step = 1 THEN false
                ELSE regexp_matches(fails, '[' || before || 'x]') END AS gone
    FROM counted, steps
),
summed AS (
    SELECT part, filter_order, step, own,
           sum(CASE WHEN NOT own_fails AND NOT gone THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN own_fails AND NOT gone THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN own_fails AND gone THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN own_fails AND NOT gone AND good THEN n ELSE 0 END) AS good_lost,
           sum(CASE WHEN own_fails AND NOT gone AND toxic THEN n ELSE 0 END) AS toxic_lost
    FROM judged GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INT) AS step,
       CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM summed
"""


def oracle_sql() -> dict[str, str]:
    return {"op12_perfect_hash": EXACT_DUPLICATES, "op13_radix_tries": FILTER_AUDIT}
