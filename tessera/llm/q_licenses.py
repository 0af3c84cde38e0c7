"""Query of the license scan and its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import table
from .license_texts import TEMPLATES
from .licenses import length_class, scan, template_words
from .registry import register


def _sql() -> str:
    rows = ", ".join("({}, '{}', {}, [{}])".format(i, n, length_class(len(w)), ", ".join(f"'{x}'" for x in w))
                     for i, (n, w) in enumerate((n, template_words(t)) for n, t in TEMPLATES))
    return rf"""
WITH t(tid, license, cls, w) AS (VALUES {rows}),
ts AS (SELECT DISTINCT tid, license, cls, g FROM (
  SELECT tid, license, cls, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))) AS g FROM t)),
tn AS (SELECT tid, count(*) AS n FROM ts GROUP BY tid),
d AS (SELECT row_number() OVER () AS rid, doc_id,
             list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT rid, i - 1 AS i, array_to_string(w[i:i+2], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
h AS (SELECT rid, tid, license, cls, i, s.g, unnest([i // cls - 2, i // cls - 1, i // cls]) AS k FROM s JOIN ts ON s.g = ts.g),
m AS (SELECT rid, tid, license, k * cls AS first_word, count(DISTINCT g) AS c FROM h
      WHERE k >= 0 AND i BETWEEN k * cls AND k * cls + 3 * cls - 3 GROUP BY rid, tid, license, k, cls)
SELECT doc_id, license, min(first_word)::BIGINT AS first_word, max(c / n::DOUBLE) AS containment
FROM m JOIN tn USING (tid) JOIN d USING (rid) WHERE c >= 0.8 * n - 1e-9 GROUP BY rid, doc_id, license
"""


@register("op7_license_scan", _sql())
def op7_license_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = scan(docs, TEMPLATES, threshold=0.8).select("doc_id", F.explode("licenses").alias("m"))
    return found.select("doc_id", "m.license", "m.first_word", "m.containment")
