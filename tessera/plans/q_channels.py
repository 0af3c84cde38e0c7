"""Stored quantile sketches, and one error channel through eight stages."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import capture as CP
from ..operators import sketches as SK
from ..operators.versions import VersionedTable
from ..session import ensure_checkpoint_dir
from ..sources.tables import table
from .registry import register

_PROBS = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)


@register("kll_quantiles", f"""
SELECT event_type, p::DOUBLE AS p, count(value)::BIGINT AS n, true AS within
FROM events, (SELECT unnest({list(_PROBS)}) AS p) WHERE value IS NOT NULL GROUP BY ALL""")
def kll_quantiles(spark, sf_dir):
    """Quantiles of the values by event type from daily sketches that were stored in two commits and merged: ``within`` if an
    estimate's exact rank is no further from the wanted one than the sketch's error allows."""
    e = table(spark, sf_dir, "events").select("event_type", "value", "ts")
    store = VersionedTable(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/sketches-{uuid.uuid4().hex}",
                           "event_type string, period date, n bigint, least double, greatest double, sketch binary")
    day = F.to_date("ts")
    for name, part in (("early", day < "2024-01-15"), ("late", day >= "2024-01-15")):
        store.append(SK.period_sketches(e.where(part), "value", day, ["event_type"]), name)
    got = SK.sketch_quantiles(SK.merged_sketches(store.read(), ["event_type"]), _PROBS, ["event_type"])
    ranks = (e.where("value is not null").join(F.broadcast(got), "event_type")  # a few rows a type
             .groupBy("event_type", "p", "n", "quantile").agg(F.avg((F.col("value") < F.col("quantile")).cast("int")).alias("below"),
                                                              F.avg((F.col("value") <= F.col("quantile")).cast("int")).alias("upto")))
    error = 2 * SK.rank_error()
    return ranks.select("event_type", "p", "n", ((F.col("below") - error <= F.col("p")) & (F.col("upto") + error >= F.col("p"))).alias("within"))


@register("error_taxonomy", f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, source, (doc_id % 9 + 9) % 9 AS k FROM documents),
s AS (SELECT *, coalesce({list(CP.ERROR_TYPES)!r}[k + 1], '') AS planned FROM d)
SELECT doc_id, CASE WHEN k < 8 THEN planned END AS error_type,
       CASE k WHEN 0 THEN 'no connection to ' || coalesce(source, '') WHEN 1 THEN 'unreadable: 1' WHEN 2 THEN 'not a number: x' || doc_id
              WHEN 3 THEN length(text) || ' characters' WHEN 4 THEN 'TransformationError in a stage' WHEN 5 THEN 'LoadingError in a stage'
              WHEN 6 THEN 'ValueError: chunk of ' || length(text) WHEN 7 THEN 'ZeroDivisionError: division by zero' END AS error,
       CASE WHEN k = 8 THEN 1.0 / (1 + length(text)) END AS value
FROM s""")
def error_taxonomy(spark, sf_dir):
    """Every document through a stage of each error class; eight of nine fail, by their id, each in another stage."""
    d = table(spark, sf_dir, "documents", "doc_id", "text", "source", spread=True)
    k = F.pmod("doc_id", F.lit(9))
    r = CP.capture(d.withColumn("text", F.coalesce("text", F.lit(""))), F.struct(F.col("doc_id").alias("id"), k.alias("k"), F.col("text").alias("text")))
    gone = F.concat(F.lit("no connection to "), F.coalesce("source", F.lit("")))
    r = CP.then(r, CP.CONNECTION, lambda v: v, fails=lambda v: v["k"] == 0, message=lambda v: gone)
    r = CP.then(r, CP.READ, lambda v: v, fails=lambda v: v["k"] == 1, message=lambda v: F.concat(F.lit("unreadable: "), v["k"].cast("string")))
    number = lambda v: F.concat(F.when(v["k"] == 2, "x").otherwise(""), v["id"].cast("string"))
    r = CP.then(r, CP.PROCESSING, lambda v: F.when(number(v).try_cast("bigint").isNotNull(), v), null_fails=True,
                message=lambda v: F.concat(F.lit("not a number: "), number(v)))
    r = CP.then(r, CP.VALIDATION, lambda v: v, fails=lambda v: v["k"] == 3, message=lambda v: F.concat(F.length(v["text"]).cast("string"), F.lit(" characters")))
    r = CP.then(r, CP.TRANSFORMATION, lambda v: F.when(v["k"] != 4, F.struct(v["k"].alias("k"), F.reverse(v["text"]).alias("text"))), null_fails=True)
    r = CP.then(r, CP.LOADING, lambda v: v, fails=lambda v: v["k"] == 5)

    def chunk(v):
        if v["k"] == 6:
            raise ValueError(f"chunk of {len(v['text'])}")
        return {"k": v["k"], "n": len(v["text"])}

    r = CP.then_python(r, CP.CHUNKING, chunk, "k bigint, n bigint")
    r = CP.then_python(r, CP.EMBEDDING, lambda v: 1 / (0 if v["k"] == 7 else 1 + v["n"]), "double")
    good, dead = CP.settle(r)
    none = F.lit(None).cast("string")
    return (good.select("doc_id", none.alias("error_type"), none.alias("error"), F.col("result").alias("value"))
            .unionByName(dead.select("doc_id", "error_type", "error", F.lit(None).cast("double").alias("value"))))
