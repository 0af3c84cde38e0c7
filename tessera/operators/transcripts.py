"""Agent transcript extraction over message rows.

Message rows: (conv_id, turn, role, content VARIANT, tool_calls
ARRAY<STRUCT<name STRING, args VARIANT>>). Content may be a string, a list of
parts with a ``text`` field, or an object; ``VARIANT`` keeps that dynamic type
and the ``variant_get`` / ``variant_explode`` functions take it apart natively.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def ai_messages(msgs: DataFrame) -> DataFrame:
    """Assistant rows -> (conv_id, turn, parts, text).

    string content -> [s]; list content -> its ``text`` fields; else [].
    ``text`` joins the parts with a space.
    """
    a = msgs.filter(F.col("role") == "assistant")
    kind = F.coalesce(_kind(F.col("content")), F.lit(""))
    as_str = F.array(F.variant_get(F.col("content"), "$", "string"))
    as_list = F.filter(F.transform(F.try_variant_get(F.col("content"), "$", "array<variant>"),
                                   lambda e: F.try_variant_get(e, "$.text", "string")),
                       lambda s: s.isNotNull())
    parts = (F.when(kind == "STRING", as_str).when(kind.startswith("ARRAY"), as_list)
             .otherwise(F.array().cast("array<string>")))
    return a.select("conv_id", "turn", parts.alias("parts")).withColumn(
        "text", F.array_join("parts", " "))


def tool_calls(msgs: DataFrame) -> DataFrame:
    """Assistant rows' tool calls exploded -> (conv_id, turn, call_index, name, args JSON)."""
    a = msgs.filter((F.col("role") == "assistant") & (F.size("tool_calls") > 0))
    return (a.select("conv_id", "turn", F.posexplode("tool_calls").alias("call_index", "c"))
            .select("conv_id", "turn", "call_index", F.col("c.name").alias("name"),
                    F.to_json(F.col("c.args")).alias("args")))


def tool_outputs(msgs: DataFrame) -> DataFrame:
    """Tool rows -> (conv_id, turn, output JSON): string or list content is
    wrapped as {"Tool Content": ...}; an object is kept as its own keys."""
    t = msgs.filter(F.col("role") == "tool")
    kind = _kind(F.col("content"))
    wrapped = F.concat(F.lit('{"Tool Content":'), F.to_json(F.col("content")), F.lit("}"))
    out = F.when(kind.startswith("OBJECT"), F.to_json(F.col("content"))).otherwise(wrapped)
    return t.select("conv_id", "turn", out.alias("output"))


def conversation_tools(msgs: DataFrame) -> DataFrame:
    """Per conversation: JSON lists of tool calls and tool outputs in turn order.

    A transcript is bounded by the model's context, so collecting one
    conversation's tool rows is bounded too; conversations without tools get
    '[]'.
    """
    calls = tool_calls(msgs).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "turn", "call_index", F.to_json(F.struct(F.col("name").alias("Tool Name"),
                                                 F.parse_json("args").alias("Tool Args"))).alias("j")))).alias("c"))
    outs = tool_outputs(msgs).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", F.col("output").alias("j")))).alias("o"))
    convs = msgs.select("conv_id").distinct()

    def as_json(c):
        return F.concat(F.lit("["), F.coalesce(F.array_join(F.transform(c, lambda x: x["j"]), ","), F.lit("")),
                        F.lit("]"))

    return (convs.join(calls, "conv_id", "left").join(outs, "conv_id", "left")
            .select("conv_id", as_json("c").alias("tools_used"), as_json("o").alias("tool_outputs")))


def parse_transcripts(raw: DataFrame, conv_id: str = "conv_id", body: str = "body") -> DataFrame:
    """Message rows of raw transcripts: ``body`` is the JSON text of a list of messages ``{role, content, tool_calls}``. Each
    message becomes a row by a lateral ``variant_explode``; its place in the list is ``turn``. A body that is not JSON, or not a
    list, has no messages."""
    spark = raw.sparkSession
    parsed = raw.select(F.col(conv_id).alias("conv_id"), F.try_parse_json(F.col(body)).alias("_v"))
    each = parsed.lateralJoin(spark.tvf.variant_explode(F.col("_v").outer()))
    calls = F.transform(F.coalesce(F.try_variant_get("value", "$.tool_calls", "array<variant>"), F.array().cast("array<variant>")), lambda c: F.struct(
        F.try_variant_get(c, "$.name", "string").alias("name"), F.try_variant_get(c, "$.args", "variant").alias("args")))
    return (each.where("key is null").select(
        "conv_id", F.col("pos").cast("bigint").alias("turn"), F.try_variant_get("value", "$.role", "string").alias("role"),
        F.try_variant_get("value", "$.content", "variant").alias("content"), calls.alias("tool_calls")))


def messages_from_conversations(conv: DataFrame) -> DataFrame:
    """Driver ``conversations`` rows as message rows (plain-string content, no tools)."""
    return conv.select("conv_id", "turn", "role", F.col("text").cast("variant").alias("content"),
                       F.array().cast("array<struct<name:string,args:variant>>").alias("tool_calls"))
