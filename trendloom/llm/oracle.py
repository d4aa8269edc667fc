"""SQL that DuckDB runs for the queries that SQL can express."""

from __future__ import annotations

from trendloom.llm.mixing import MAX_REPEATS, SEED, WEIGHTS
from trendloom.llm.secrets import BASE, RULES

WORD = r"[^\x20\x09-\x0D]+"

ORACLE: dict[str, str] = {}

ORACLE["op7_mix_sources"] = rf"""
WITH docs AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
           md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS place
    FROM documents
), sums AS (
    SELECT source, sum(size)::BIGINT AS words FROM docs GROUP BY source
), ranked AS (
    SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sums
), weighed AS (
    SELECT *, (rank - 1) % {WEIGHTS} + 1 AS weight, words * {MAX_REPEATS} AS cap FROM ranked
), levels AS (
    SELECT *, CAST(sum(words) OVER () - coalesce(sum(cap) OVER before, 0) AS DOUBLE)
            / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
    FROM weighed
    WINDOW before AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), marked AS (
    SELECT *, weight * level > cap AS capped FROM levels
), shares AS (
    SELECT source, words, rank,
           least(CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE weight * max(level) FILTER (NOT capped) OVER () END, CAST(cap AS DOUBLE)) AS target
    FROM marked
), queued AS (
    SELECT row_number() OVER () AS row, doc_id, size, place, s.words AS source_size, rank, target,
           sum(size) OVER (PARTITION BY rank ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
    FROM docs JOIN shares s ON docs.source IS NOT DISTINCT FROM s.source
), servings AS (
    SELECT row, size, rank, turn, place, doc_id, CAST(turn * source_size + upto AS DOUBLE) / target AS finish
    FROM queued, range({MAX_REPEATS}) AS t(turn) WHERE size > 0
), ordered AS (
    SELECT row, size, sum(size) OVER (ORDER BY finish, rank, turn, place, doc_id ROWS UNBOUNDED PRECEDING) AS total
    FROM servings
), taken AS (
    SELECT row, sum(size) AS taken FROM ordered WHERE total <= (SELECT sum(size) FROM docs) GROUP BY row
)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM queued LEFT JOIN taken USING (row)
"""

ORACLE["op9_warc_round_trip"] = """
WITH payloads AS (
    SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
    SELECT payload_digest, min(page_id) AS first FROM payloads WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM payloads p LEFT JOIN firsts f USING (payload_digest)
"""


def _secrets_sql() -> str:
    """Pieces between matches and the matches themselves, one rule after the other, as running sums."""
    found = " UNION ALL ".join(
        f"""SELECT text, '{r.name}' AS kind, {r.rank} AS rank, {r.least} AS least,
                   unnest(range(len(regexp_extract_all(text, {p}))))::BIGINT AS place,
                   unnest(list_transform(regexp_extract_all(text, {p}), lambda m: length(m))) AS size,
                   unnest(list_transform(regexp_extract_all(text, {p}, {r.group}), lambda m: length(m))) AS kept,
                   unnest(list_transform(string_split_regex(text, {p})[:-2], lambda m: length(m))) AS gap
            FROM texts WHERE regexp_matches(text, {p})"""
        for r, p in ((r, "'" + r.pattern.replace("'", "''") + "'") for r in RULES)
    )
    return f"""
WITH texts AS (
    SELECT DISTINCT coalesce(text, '') AS text FROM documents
), pieces AS (
    {found}
), placed AS (
    SELECT *, CAST(sum(gap + size) OVER (PARTITION BY text, kind ORDER BY place ROWS UNBOUNDED PRECEDING) AS BIGINT) AS e FROM pieces
), spans AS (
    SELECT text, kind, rank, e - size AS s, concat(kind, ':', e - size, ':', e) AS span FROM placed WHERE kept >= least
), per_text AS (
    SELECT text, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(span, ',' ORDER BY s, rank) FILTER (rank < {len(BASE)}) AS base, string_agg(span, ',' ORDER BY s, rank) AS spans
    FROM spans GROUP BY text
)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN per_text t ON t.text = coalesce(d.text, '')
"""


ORACLE["op11_secret_scan"] = _secrets_sql()

ORACLE["op12_filter_audit"] = rf"""
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents
), marked AS (
    SELECT part, doc_id,
           CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN min(doc_id) OVER (PARTITION BY text) < doc_id THEN 16 ELSE 0 END AS fails
    FROM texts
), known AS (
    SELECT doc_id, max(coalesce(quality, 0) = 1) AS good, max(coalesce(toxic, 0) = 1) AS bad FROM labels GROUP BY doc_id
), sets AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad
    FROM marked LEFT JOIN known USING (doc_id) GROUP BY part, fails
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps AS (
    SELECT filter_order, CAST(step AS INTEGER) AS step, 1 << (ascii(filter_order[step]) - 65) AS bit,
           CAST(coalesce(list_sum([1 << (ascii(x) - 65) FOR x IN string_split(filter_order[1:step - 1], '') IF x <> '']), 0) AS BIGINT) AS before
    FROM orders, range(1, 6) AS s(step)
), counted AS (
    SELECT part, filter_order, step, bit,
           coalesce(sum(n) FILTER ((fails & (before | bit)) = 0), 0) AS kept,
           coalesce(sum(n) FILTER ((fails & before) = 0 AND (fails & bit) <> 0), 0) AS removed,
           coalesce(sum(n) FILTER ((fails & before) <> 0 AND (fails & bit) <> 0), 0) AS redundant,
           coalesce(sum(n) FILTER (fails = bit), 0) AS unique_fails,
           coalesce(sum(good) FILTER ((fails & before) = 0 AND (fails & bit) <> 0), 0) AS good_lost,
           coalesce(sum(bad) FILTER ((fails & before) = 0 AND (fails & bit) <> 0), 0) AS toxic_lost
    FROM sets, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""
