"""Query of the mixing operator and its SQL."""

from __future__ import annotations

from ..sources.tables import table
from .mix import allocate, schedule
from .registry import register

SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS size,
         ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, ':' || md5(coalesce(text, '')))), 1, 15))::BIGINT AS key
  FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1]::DOUBLE AS w FROM s),
f AS (SELECT *, 2 * source_size AS cap, 2 * source_size / w AS f, 1.5 * sum(source_size) OVER () AS total FROM w),
l AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY f, source IS NULL, source
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY f, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
  FROM f),
t AS (SELECT *, least(cap, w * max(lev) OVER ()) AS target FROM l),
o AS (
  SELECT d.*, t.source_size, t.target,
         sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id::VARCHAR, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS served
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       (greatest(0, least(size, round(target) - served))
        + greatest(0, least(size, round(target) - source_size - served)))::BIGINT AS taken
FROM o
"""


@register("op1_mix_sources", SQL)
def op1_mix_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    plan = schedule(docs, weights=(3.0, 1.0, 2.0), budget_share=1.5, max_repeat=2, keep=["doc_id"])
    return allocate(plan, max_repeat=2).select("doc.doc_id", "size", "source_size", "target", "taken")
