"""DuckDB SQL for the corpus queries that SQL can express.

Written on its own: patterns, thresholds and weights are literals here."""

from __future__ import annotations

EXACT_DEDUP = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(norm) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                               'abcdefghijklmnopqrstuvwxyz') AS norm
      FROM documents)
WINDOW same AS (PARTITION BY norm)
"""

# Every pair of distinct lines of similar length is compared; DuckDB's
# levenshtein counts bytes.
_LINES = """
WITH line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents),
seen AS (
  SELECT *, doc_id * 1000000000 + pos AS place FROM line
  WHERE regexp_matches(line, '[^ \\t\\n\\v\\f\\r]')),
one AS (
  SELECT line, min(place) AS place, strlen(line) AS n FROM seen GROUP BY line),
near AS (
  SELECT DISTINCT s.line FROM one r, one s
  WHERE s.n BETWEEN r.n - 2 AND r.n + 2 AND r.n >= 40 AND s.n >= 40
    AND r.place < s.place AND levenshtein(r.line, s.line) <= 2),
gone AS (
  SELECT doc_id, pos, near.line IS NOT NULL AS near
  FROM seen JOIN one USING (line) LEFT JOIN near USING (line)
  WHERE near.line IS NOT NULL OR seen.place > one.place),
rest AS (
  SELECT doc_id, count(*) AS n_lines, count(gone.pos) AS n_removed,
         count(*) FILTER (WHERE near) AS n_near,
         string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE gone.pos IS NULL) AS kept
  FROM line LEFT JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_near, 0) AS n_near, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN rest USING (doc_id)
"""


def line_dedup() -> str:
    return _LINES


# kind, pattern, judged group, least length of the group
_KINDS = (
    ("assign", "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
               "|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
               "[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
    ("code_host", "gh[oprsu]_[A-Za-z0-9]{36,}", 0, 1),
    ("chat", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("web_token", "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}", 0, 1),
)


def secret_scan() -> str:
    """Spans from the lengths of the matches and of the pieces between them."""
    parts = []
    for number, (kind, pattern, group, least) in enumerate(_KINDS):
        parts.append(f"""
  SELECT doc_id, '{kind}' AS kind, {number} AS k, s AS s, s + length(hit) AS e
  FROM (SELECT doc_id, hit, judged,
               CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id ORDER BY i)
                    - length(hit) AS BIGINT) AS s
        FROM (SELECT doc_id, unnest(range(len(m))) AS i, unnest(m) AS hit, unnest(g) AS judged,
                     unnest(p[1:len(m)]) AS gap
              FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS m,
                           regexp_extract_all(text, '{pattern}', {group}) AS g,
                           string_split_regex(text, '{pattern}') AS p
                    FROM d WHERE regexp_matches(text, '{pattern}'))))
  WHERE length(judged) >= {least}""")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
span AS ({' UNION ALL '.join(parts)}),
per_doc AS (
  SELECT doc_id, count(*) FILTER (WHERE k = 0) AS n_assign,
         count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (WHERE k < 3) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans
  FROM span GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM d LEFT JOIN per_doc USING (doc_id)
"""


# Base 32 of a SHA-1: each 5 hexadecimal digits are 4 digits of base 32.
_DIGIT = ("substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
          "1 + CAST((CAST('0x' || substr(h, {at}, 5) AS BIGINT) >> {shift}) & 31 AS INTEGER), 1)")
_BASE32 = " || ".join(_DIGIT.format(at=5 * i + 1, shift=s) for i in range(8) for s in (15, 10, 5, 0))

WARC = f"""
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = least_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> least_id THEN least_id END AS refers_to
FROM (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h,
             min(page_id) OVER (PARTITION BY coalesce(html, '')) AS least_id
      FROM pages)
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings),
scored AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id,
         CAST(list_dot_product(q.v, d.v) AS BIGINT) AS score
  FROM v q, v d WHERE q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# Exact text comes back, so its digest is the text's own.
FILL_MIDDLE = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS line
  FROM documents),
drawn AS (
  SELECT doc_id, text, line, CAST(len(line) AS BIGINT) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(line) + 1) AS a,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(line) + 1) AS b,
         text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
           OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 100 AS plain,
         CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 50 AS spm
  FROM d),
cut AS (
  SELECT doc_id, text, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(line[1:least(a, b)], '') AS p,
         array_to_string(line[least(a, b) + 1:greatest(a, b)], '') AS m,
         array_to_string(line[greatest(a, b) + 1:n], '') AS s
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
              WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""
