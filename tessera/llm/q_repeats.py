"""Query of the repeated passages and its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import table
from .registry import register
from .repeats import remove_repeats

SQL = r"""
WITH d AS (SELECT doc_id, hex(coalesce(text, '')) AS h, len(hex(coalesce(text, ''))) // 2 AS n FROM documents),
p AS (SELECT doc_id, unnest(range(0, n - 99)) AS p, h FROM d WHERE n >= 100),
k AS (SELECT doc_id, p, md5_number(h[2 * p + 1:2 * p + 200]) AS k FROM p),
m AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS r FROM k) WHERE r > 1),
i AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS fresh FROM m),
g AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM i),
s AS (SELECT doc_id, g, min(p) AS a, max(p) + 100 AS z FROM g GROUP BY doc_id, g),
e AS (
  SELECT doc_id, sum(z - a) AS removed, count(*) AS spans, list(a ORDER BY a) AS a, list(z ORDER BY a) AS z FROM s GROUP BY doc_id),
o AS (
  SELECT d.doc_id, n, coalesce(removed, 0) AS removed, coalesce(spans, 0) AS spans,
         CASE WHEN e.doc_id IS NULL THEN h
              ELSE array_to_string(list_transform(range(1, spans + 2), lambda j: h[
                CASE WHEN j = 1 THEN 1 ELSE 2 * z[j - 1] + 1 END:CASE WHEN j = spans + 1 THEN 2 * n ELSE 2 * a[j] END]), '') END AS rest
  FROM d LEFT JOIN e ON d.doc_id = e.doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, removed::BIGINT AS n_removed, spans::BIGINT AS n_spans, sha256(unhex(rest)) AS kept_sha256 FROM o
"""


@register("op13_suffix_array_dedup", SQL)
def op13_suffix_array_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", spread=True)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, s: acc + s["end"] - s["start"])
    return remove_repeats(docs, length=100).select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                                                   F.sha2("kept", 256).alias("kept_sha256"))
