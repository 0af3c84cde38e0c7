"""Query of the language identification. No SQL: tested by held-out accuracy and against a plain version."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import table
from .language import learn, predict
from .registry import register


def _held_out(doc_id):
    # a null id is held out: it teaches nothing
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0)) == 0


@register("op4_language_id")
def op4_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = learn(docs.where(~_held_out(F.col("doc_id"))).select("text", "lang"))
    return (predict(docs.select("doc_id", "text"), model)
            .select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"))
