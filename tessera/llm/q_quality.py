"""Query of the quality rules and its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import table
from .quality import DEFAULT_RULES, STOP_WORDS, apply_rules
from .registry import register

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
SQL = r"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln
  FROM documents),
tri AS (
  SELECT rid, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM base)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM tri) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i+1, i+2]) AS p FROM dup) GROUP BY rid),
m AS (
  SELECT b.doc_id, t, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ln) AS n_lines, len(ln) - len(list_distinct(ln)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS n_letter,
         len(list_filter(w, lambda x: list_contains([__STOP__], lower(rtrim(x, '.,;:!?'))))) AS n_stop,
         len(list_filter(ln, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ell,
         len(list_filter(ln, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bul
  FROM base b LEFT JOIN cov c USING (rid))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND (strlen(t) >= 2.2 * length(t) OR word_chars / n_words BETWEEN 2 AND 15) AND n_symbols / n_words <= 0.1 AND n_letter / n_words >= 0.7
         AND (strlen(t) >= 1.4 * length(t) OR n_stop / n_words >= 0.03) AND coalesce(n_dup_lines / nullif(n_lines, 0), 0) <= 0.5
         AND coalesce(n_ell / nullif(n_lines, 0), 0) <= 0.5 AND coalesce(n_bul / nullif(n_lines, 0), 0) <= 0.9 AS kept
FROM m
"""


@register("op10_quality_rules", SQL.replace("__STOP__", _STOP))
def op10_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    base = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"
    return (apply_rules(docs, rules=DEFAULT_RULES)
            .withColumn("base_failed", F.expr(base))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (F.col("kept") & ~F.col("base_failed")).alias("kept")))
