"""Query of the n-gram Jaccard join and its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import table
from .near_join import near_links
from .registry import register

SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT rid, g FROM (
    SELECT rid, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
                            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
p AS (SELECT a.rid AS x, b.rid AS y, count(*) AS hit FROM s a JOIN s b ON a.g = b.g AND a.rid <> b.rid GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n a ON a.rid = x JOIN n b ON b.rid = y WHERE hit >= 0.8 * (a.n + b.n - hit) - 1e-9),
r(x, y) AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
c AS (SELECT x, min(k.doc_id) AS least FROM r JOIN d k ON k.rid = r.y GROUP BY x),
l AS (SELECT x, count(*) AS links FROM e GROUP BY x)
SELECT doc_id, coalesce(least(c.least, doc_id), c.least, doc_id) AS class_id, coalesce(l.links, 0)::BIGINT AS n_links
FROM d LEFT JOIN c ON c.x = d.rid LEFT JOIN l ON l.x = d.rid
"""


@register("op2_ngram_jaccard_join", SQL)
def op2_ngram_jaccard_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return near_links(docs, threshold=0.8, shingle=5).select(
        F.col("id").alias("doc_id"), "class_id", F.col("links").alias("n_links"))
