"""Query of the line deduplication and its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import table
from .line_dedup import line_decisions
from .registry import register

SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, md5(coalesce(text, '')) AS tk, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, tk, n - 1 AS n, trim(ls[n], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t
      FROM (SELECT doc_id, tk, ls, unnest(range(1, len(ls) + 1)) AS n FROM d)),
o AS (SELECT DISTINCT * FROM l WHERE t <> ''),
u AS (SELECT t, row_number() OVER () AS k FROM (SELECT DISTINCT t FROM o)),
s AS (SELECT DISTINCT k, g FROM (SELECT k, unnest(CASE WHEN length(t) >= 8
        THEN list_transform(range(1, length(t) - 6), lambda i: substr(t, i, 8)) ELSE [t] END) AS g FROM u)),
n AS (SELECT k, count(*) AS n FROM s GROUP BY k),
p AS (SELECT a.k AS x, b.k AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.k < b.k GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n a ON a.k = x JOIN n b ON b.k = y WHERE c >= 0.8 * (a.n + b.n - c) - 1e-9),
z AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(x, y) AS (SELECT x, y FROM z UNION SELECT r.x, z.y FROM r JOIN z ON r.y = z.x),
c AS (SELECT k, least(k, coalesce(min(y), k)) AS root FROM u LEFT JOIN r ON r.x = u.k GROUP BY k),
f AS (SELECT o.*, row_number() OVER (PARTITION BY root ORDER BY doc_id NULLS LAST, tk, n) AS rk
      FROM o JOIN u USING (t) JOIN c USING (k)),
g AS (SELECT doc_id, tk, count(*) AS n_lines, list(n ORDER BY n) FILTER (WHERE rk > 1) AS removed FROM f GROUP BY doc_id, tk)
SELECT d.doc_id, coalesce(g.n_lines, 0)::BIGINT AS n_lines, (coalesce(g.n_lines, 0) - coalesce(len(removed), 0))::BIGINT AS n_kept,
       coalesce(array_to_string(removed, ','), '') AS removed_lines
FROM d LEFT JOIN g ON g.doc_id IS NOT DISTINCT FROM d.doc_id AND g.tk = d.tk
"""


@register("op5_fuzzy_line_dedup", SQL)
def op5_fuzzy_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return line_decisions(docs, threshold=0.8).select(
        F.col("id").alias("doc_id"), "n_lines", (F.col("n_lines") - F.size("removed")).alias("n_kept"),
        F.array_join(F.transform("removed", lambda x: x.cast("string")), ",").alias("removed_lines"))
