"""Scans and sinks over files: the driver tables are written to the shared
folder in each format and read back by the library's readers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.text import WS_CLASS
from ..operators import state as ST
from ..session import ensure_checkpoint_dir
from ..sources import formats as FM
from ..sources.tables import table
from .registry import register
from .q_state import _EV, _SF

_WS = WS_CLASS[1:-1]


def _folder(spark, kind: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/formats-{kind}-{uuid.uuid4().hex}"


@register("question_lines", f"""
WITH l AS (SELECT unnest(string_split(text, chr(10))) AS x FROM conversations WHERE role = 'user'),
t AS (SELECT regexp_replace(x, '^[{_WS}]+|[{_WS}]+$', '', 'g') AS question FROM l)
SELECT question, count(*)::BIGINT AS n FROM t WHERE question <> '' GROUP BY question""")
def question_lines(spark, sf_dir):
    """The user turns as a questions file, a question per line."""
    path = _folder(spark, "questions")
    table(spark, sf_dir, "conversations").filter("role = 'user'").select("text").write.text(path)
    return FM.read_questions(spark, path).groupBy("question").agg(F.count("*").cast("bigint").alias("n"))


@register("reviews_csv", """
SELECT doc_id::VARCHAR AS doc_id, text AS review FROM documents""")
def reviews_csv(spark, sf_dir):
    """The documents as a reviews CSV (texts hold line breaks and commas)."""
    path = _folder(spark, "reviews")
    FM.write_csv(table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias(FM.REVIEW_COLUMN)), path)
    return FM.read_reviews(spark, path).select("doc_id", F.col(FM.REVIEW_COLUMN).alias("review"))


@register("csv_document", """
SELECT ['conv_id', 'turn', 'text'] AS headers, count(*)::BIGINT AS num_rows FROM conversations""")
def csv_document(spark, sf_dir):
    path = _folder(spark, "csv")
    FM.write_csv(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), path)
    return FM.csv_document(spark, path)


@register("csv_rows", """
SELECT conv_id::VARCHAR AS conv_id, turn::VARCHAR AS turn, text FROM conversations""")
def csv_rows(spark, sf_dir):
    path = _folder(spark, "csv-rows")
    FM.write_csv(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), path)
    d = F.col("data")
    return FM.csv_rows(spark, path).select(d["conv_id"].alias("conv_id"), d["turn"].alias("turn"), d["text"].alias("text"))


@register("json_document", """
SELECT event_id, user_id, event_type, value FROM events""")
def json_document(spark, sf_dir):
    path = _folder(spark, "json")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    events.write.json(path)
    schema = ", ".join(f"{n} {t}" for n, t in events.dtypes)
    return FM.json_document(spark, path, schema)


@register("xml_document", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders""")
def xml_document(spark, sf_dir):
    path = _folder(spark, "xml")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    orders.write.format("xml").option("rowTag", "order").save(path)
    x = FM.xml_document(spark, path, "order")
    return x.select(*[F.col(n).cast(t).alias(n) for n, t in orders.dtypes])


@register("state_round_trip", f"WITH {_EV}, {_SF} SELECT * FROM sf")
def state_round_trip(spark, sf_dir):
    """The stage events appended to an event table in two parts and folded
    from what is read back."""
    path = _folder(spark, "events")
    ev = ST.events_from_driver(table(spark, sf_dir, "events"))
    ev = ev.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    schema = ST.STAGE_EVENT_SCHEMA.replace("ts timestamp", "ts timestamp_ntz")
    FM.write_events(ev.where("seq % 2 = 0"), path)
    FM.write_events(ev.where("seq % 2 = 1"), path)
    return ST.fold_stages(FM.read_events(spark, path, schema))
