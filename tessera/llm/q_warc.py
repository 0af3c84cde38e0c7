"""Query of the archive converter and its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import table
from .common import shared_path
from .registry import register
from .warc import convert, read_warc, write_arc

SQL = r"""
WITH p AS (
  SELECT row_number() OVER () AS rid, page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
r AS (SELECT *, first(page_id) OVER w AS best, row_number() OVER w AS k
      FROM p WINDOW w AS (PARTITION BY h ORDER BY page_id DESC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT page_id, n::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((('0x' || substr(h, (i // 8) * 10 + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT + 1, 1)), '') AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k > 1 THEN best END AS refers_to
FROM r
"""


@register("op3_warc_from_arc", SQL)
def op3_warc_from_arc(spark, sf_dir):
    arc, warc = shared_path(spark, "arc"), shared_path(spark, "warc")
    write_arc(table(spark, sf_dir, "pages"), arc)
    convert(spark, arc, warc, min_bytes=0)
    records = read_warc(spark, warc, with_payload=False)
    responses = records.where("type <> 'revisit'").select(F.col("record_id").alias("refers_to"), F.col("key").alias("to_key"))
    return (records.join(responses, "refers_to", "left")
            .select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest",
                    F.col("type").alias("record_type"), F.col("to_key").alias("refers_to")))
