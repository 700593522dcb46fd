"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_QUALITY = rf"""WITH w AS (
  SELECT doc_id, coalesce(text, '') AS body, {_WORDS} AS words FROM documents
), windows AS (
  SELECT doc_id, i, hash(array_to_string(words[i:i + 7], ' ')) AS h FROM (
    SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)
), twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, h) > 1
), covered AS (
  SELECT doc_id, sum(least(8, coalesce(after - i, 8))) AS n FROM (
    SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM twice) GROUP BY doc_id
), m AS (
  SELECT doc_id, body, len(words) AS n_words, length(regexp_replace(body, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         len(list_filter(words, lambda x: list_contains({{stop}}, x))) AS n_stop, coalesce(n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered USING (doc_id)
), b AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 1.5 AND 40.0 AND n_symbols / n_words <= 0.5 AND n_stop / n_words >= 0.01
       AND (len(lines) = 0 OR n_dup_lines / len(lines) <= 0.5) AS kept
FROM b"""

_MIXING = rf"""WITH d AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
         md5('mix-1|' || coalesce(doc_id::VARCHAR, '<null>')) AS h FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), n AS (
  SELECT source, source_size, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM s
), r AS (
  SELECT *, 2 * source_size AS cap FROM n
), l AS (
  SELECT *, row_number() OVER o AS k, (1.5::DOUBLE * (SELECT sum(source_size) FROM r)::BIGINT
    - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
    / ((SELECT sum(w) FROM r) - coalesce(sum(w) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS level
  FROM r WINDOW o AS (ORDER BY cap::DOUBLE / w, source NULLS LAST)
), v AS (
  SELECT arg_min(level, k) AS level FROM l WHERE level * w <= cap
), t AS (
  SELECT source, source_size, CASE WHEN (SELECT level FROM v) * w <= cap THEN (SELECT level FROM v) * w ELSE cap::DOUBLE END AS target FROM r
), p AS (
  SELECT source, source_size, target,
         CASE WHEN source_size > 0 THEN floor(target / source_size * 16777216)::BIGINT ELSE 0 END AS step,
         ('0x' || substr(md5('mix-1|' || coalesce(source, '<null>')), 1, 6))::BIGINT AS start FROM t
), q AS (
  SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY size, h, doc_id) - 1 AS rank FROM d
)
SELECT doc_id, size, source_size, target, q.source,
       ((((rank + 1) * step + start) >> 24) - ((rank * step + start) >> 24)) * size AS taken
FROM q JOIN p ON q.source IS NOT DISTINCT FROM p.source"""


def _quality() -> str:
    from incidentlake.llm.quality import STOP_WORDS

    return _QUALITY.replace("{stop}", "[" + ", ".join(f"'{x}'" for w in sorted(set(STOP_WORDS)) for x in (w, w.capitalize())) + "]")


ORACLE = {"op4_quality_rules": _quality(), "op6_mixing": _MIXING}
