"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from postlume.llm.licenses import KNOWN, STEPS
from postlume.llm.quality import BOILERPLATE, MARKED, SEPARATOR, TERMINAL

_OP8 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT r, p, array_to_string(w[p:p + 7], ' ') AS v
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS p FROM d)),
twice AS (
  SELECT r, p FROM windows QUALIFY count(*) OVER (PARTITION BY r, v) > 1),
gaps AS (
  SELECT r, least(8, coalesce(lead(p) OVER (PARTITION BY r ORDER BY p) - p, 8)) AS n FROM twice),
again AS (SELECT r, sum(n) AS n FROM gaps GROUP BY r),
line AS (
  SELECT r, x, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS lw
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
judged AS (
  SELECT r, x, len(lw) AS n,
         regexp_matches(x, '{TERMINAL.replace("'", "''")}')
         AND len(list_filter(lw, lambda v: regexp_matches(v, '{MARKED}'))) <= (1.0::DOUBLE / 3) * len(lw)
         AND (len(list_filter(lw, lambda v: regexp_matches(v, '{SEPARATOR}'))) < 2
              OR len(list_filter(lw, lambda v: regexp_matches(v, '{SEPARATOR}'))) <= 0.1::DOUBLE * len(lw))
         AND (NOT regexp_matches(x, '{BOILERPLATE}')
              OR 20 * len(regexp_extract_all(x, '{BOILERPLATE}')) < len(lw)) AS ok
  FROM line),
lines AS (
  SELECT r, count(*) - count(DISTINCT x) AS dup, sum(CASE WHEN ok THEN 0 ELSE n END) AS lost
  FROM judged GROUP BY r),
figures AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
         length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(again.n, 0)::BIGINT AS n_repeat_words,
         coalesce(lost, 0)::BIGINT AS n_removed_words
  FROM d LEFT JOIN again USING (r) LEFT JOIN lines USING (r)),
base AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM figures)
SELECT *, NOT base_failed AND n_removed_words <= 0.3::DOUBLE * n_words AS kept FROM base
"""



def _canonical(text: str) -> str:
    out = f"lower({text})"
    for pattern, to in STEPS:
        out = f"regexp_replace({out}, '{pattern}', '{to.replace('{1}', chr(92) + '1')}', 'g')"
    return f"trim({out})"


_KNOWN = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in row)) for row in KNOWN)
_OP3 = f"""
WITH known AS (SELECT DISTINCT {_canonical('t')} AS form, license_id FROM (VALUES {_KNOWN}) k(license_id, t)),
units AS (
  SELECT doc_id, text AS t, true AS whole FROM documents WHERE text IS NOT NULL
  UNION ALL
  SELECT doc_id, unnest(string_split(text, chr(10))), false FROM documents WHERE text IS NOT NULL),
forms AS (SELECT doc_id, whole, {_canonical('t')} AS form FROM units)
SELECT doc_id, license_id, bool_or(whole) AS whole,
       count(DISTINCT CASE WHEN NOT whole THEN form END) AS n_lines
FROM forms JOIN known USING (form) GROUP BY doc_id, license_id
"""

_NUMBERS = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_OP11 = f"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_NUMBERS}),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positive AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS INT) AS rank,
       p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
     AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""
_OP13 = f"""
WITH e AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND {_NUMBERS} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.v, b.v) AS score
  FROM e a JOIN e b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

ORACLE: dict[str, str] = {"op3_license_scan": _OP3, "op8_quality_rules": _OP8, "op11_hard_negatives": _OP11,
                          "op13_nearest": _OP13}
