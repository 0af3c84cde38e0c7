"""Query of the decontamination search and its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import table
from .decontaminate import contained_items
from .registry import register

_WORDS = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
q AS (SELECT row_number() OVER () AS qid, item_id, {_WORDS} AS w FROM benchmark),
ds AS (SELECT DISTINCT rid, g FROM (SELECT rid, unnest(list_transform(range(1, len(w) - 3),
         lambda i: array_to_string(w[i:i+4], ' '))) AS g FROM d WHERE len(w) >= 5)),
qs AS (SELECT DISTINCT qid, g FROM (SELECT qid, unnest(list_transform(range(1, len(w) - 3),
         lambda i: array_to_string(w[i:i+4], ' '))) AS g FROM q WHERE len(w) >= 5)),
n AS (SELECT qid, count(*) AS n_item FROM qs GROUP BY qid),
h AS (SELECT rid, qid, count(*) AS n_shared FROM ds JOIN qs USING (g) GROUP BY rid, qid)
SELECT d.doc_id, q.item_id, n_shared::BIGINT AS n_shared, n_item::BIGINT AS n_item,
       n_shared::DOUBLE / n_item AS containment
FROM h JOIN n USING (qid) JOIN d USING (rid) JOIN q USING (qid)
WHERE n_shared >= 0.8 * n_item - 1e-9
UNION ALL
SELECT d.doc_id, q.item_id, 1, 1, 1.0
FROM q JOIN d ON contains(' ' || array_to_string(d.w, ' ') || ' ', ' ' || array_to_string(q.w, ' ') || ' ')
WHERE len(q.w) BETWEEN 1 AND 4
"""


@register("op8_benchmark_decontamination", SQL)
def op8_benchmark_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return (contained_items(docs, table(spark, sf_dir, "benchmark"), threshold=0.8, shingle=5)
            .withColumn("containment", F.col("n_shared") / F.col("n_item")))
