"""Translation, prompts, transcripts, labels and sentiment queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import WS_CLASS
from ..operators import labels as L
from ..operators import prompts as P
from ..operators import transcripts as TR
from ..operators import translate as TL
from ..sources.tables import table
from .registry import register


def _sql_str(s: str) -> str:
    """A SQL string literal; newlines as chr(10)."""
    parts = s.split("\n")
    return " || chr(10) || ".join("'" + p.replace("'", "''") + "'" for p in parts) if s else "''"


_NAME_CASE = "CASE lang " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TL.CODE_TO_NAME.items()) + " END"
def _CODE_CASE(x: str) -> str:
    return "CASE " + x + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TL.LANGUAGE_CODES.items()) + " END"


def _translate_sql(text, lang):
    unsupported = _sql_str(f"'. Supported languages are: {', '.join(TL.LANGUAGE_CODES)}")
    out = f"CASE WHEN {_CODE_CASE(lang)} IS NULL THEN 'Error: Unsupported language ''' || {lang} || {unsupported}"
    for phrase, per in TL.TRANSLATIONS.items():
        tr = "CASE " + _CODE_CASE(lang) + " " + " ".join(f"WHEN '{c}' THEN '{t}'" for c, t in per.items()) + " END"
        out += f" WHEN contains(lower({text}), '{phrase}') THEN replace({text}, '{phrase}', {tr})"
    out += f" ELSE '[Translation of ''' || {text} || ''' to ' || {lang} || ']' END"
    return out


_PHRASES = list(TL.TRANSLATIONS)[:3]
_PHRASE_CASE = " ".join(f"WHEN {i + 1} THEN '{p} ' || text" for i, p in enumerate(_PHRASES))


@register("translate_phrases", f"""
SELECT doc_id, {_translate_sql('text', _NAME_CASE)} AS translation
FROM (SELECT doc_id, lang, CASE doc_id % 4 {_PHRASE_CASE} ELSE text END AS text FROM documents)""")
def translate_phrases(spark, sf_dir):
    """Each document translated into its own language's name (English is not
    in the dictionary, so English documents get the error text). No document
    holds a dictionary phrase, so three of four get one in front."""
    d = table(spark, sf_dir, "documents", "doc_id", "text", "lang", spread=True)
    k, text = F.col("doc_id") % 4, F.col("text")
    for i, p in enumerate(_PHRASES):
        text = F.when(k == i + 1, F.concat(F.lit(p + " "), F.col("text"))).otherwise(text)
    d = d.withColumn("text", text)
    return d.select("doc_id", TL.translate("text", TL.language_name("lang")).alias("translation"))


@register("translate_turns", f"""
SELECT conv_id, turn, {_translate_sql('text', "'spanish'")} AS translation
FROM conversations WHERE role = 'user'""")
def translate_turns(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    return c.select("conv_id", "turn", TL.translate("text", F.lit("spanish")).alias("translation"))


@register("lang_code", f"""
SELECT lang, {_NAME_CASE} AS language, {_CODE_CASE(_NAME_CASE)} AS code, count(*)::BIGINT AS n_docs
FROM documents GROUP BY lang""")
def lang_code(spark, sf_dir):
    d = table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").cast("bigint").alias("n_docs"))
    name = TL.language_name("lang")
    return d.select("lang", name.alias("language"), TL.language_code(name).alias("code"), "n_docs")


@register("supported_languages", f"""
SELECT l.language, l.code, coalesce(n.n_docs, 0)::BIGINT AS n_docs
FROM (VALUES {", ".join(f"('{k}', '{v}')" for k, v in TL.LANGUAGE_CODES.items())}) l(language, code)
LEFT JOIN (SELECT lang, count(*) AS n_docs FROM documents GROUP BY lang) n ON n.lang = l.code""")
def supported_languages(spark, sf_dir):
    langs = F.broadcast(TL.language_table(spark))  # fixed, 10 rows
    n = table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n_docs"))
    return (langs.join(n, langs["code"] == n["lang"], "left")
            .select("language", "code", F.coalesce("n_docs", F.lit(0)).cast("bigint").alias("n_docs")))


_SCHEMA_SQL = _sql_str("\n".join(P.DEFAULT_SCHEMA_LINES))
_INSTR_SQL = _sql_str("\n".join(P.SQL_INSTRUCTIONS))


@register("sql_prompt", f"""
SELECT conv_id, turn, '# Database Schema' || chr(10) || {_SCHEMA_SQL} || chr(10) || {_INSTR_SQL}
       || chr(10) || text AS prompt
FROM conversations WHERE role = 'user'""")
def sql_prompt(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    return c.select("conv_id", "turn", P.sql_prompt("text").alias("prompt"))


_WS = WS_CLASS[1:-1]


@register("batch_infer", f"""
SELECT conv_id, turn, text AS question,
       regexp_replace('-- ' || regexp_extract(text, '[^' || chr(10) || ']*$', 0), '[{_WS}]+$', '') AS sql_query,
       CAST(NULL AS VARCHAR) AS error
FROM conversations WHERE role = 'user'""")
def batch_infer(spark, sf_dir):
    """Text-to-SQL over every user turn with the injected (offline echo) model."""
    c = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    prompts = c.select("conv_id", "turn", F.col("text").alias("question"), P.sql_prompt("text").alias("prompt"))
    return P.batch_infer(prompts, "prompt", ["conv_id", "turn", "question"], answer_col="sql_query")


@register("prompt_batches", f"""
WITH b AS (SELECT doc_id, text, (row_number() OVER (ORDER BY doc_id) - 1) // 20 AS batch_id FROM documents)
SELECT batch_id::BIGINT AS batch_id, count(*)::BIGINT AS n_reviews,
       {_sql_str(P.SENTIMENT_HEADER)} || 'Reviews: ' || to_json(list(text ORDER BY doc_id)) AS prompt
FROM b GROUP BY batch_id""")
def prompt_batches(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return L.prompt_batches(d, ["doc_id"], "text", header=P.SENTIMENT_HEADER)


@register("label_distribution", """
SELECT quality, count(*)::BIGINT AS count, (SELECT count(*) FROM labels)::BIGINT AS total,
       count(*) * 100.0 / (SELECT count(*) FROM labels) AS percentage
FROM labels GROUP BY quality""")
def label_distribution(spark, sf_dir):
    return L.distribution(table(spark, sf_dir, "labels"), "quality")


@register("batch_distribution", """
WITH b AS (SELECT quality, (row_number() OVER (ORDER BY doc_id) - 1) // 20 AS batch_id FROM labels),
r AS (SELECT batch_id::BIGINT AS batch_id, quality, count(*)::BIGINT AS count FROM b GROUP BY ROLLUP (batch_id, quality))
SELECT r.batch_id, r.quality, r.count, r.count * 100.0 / t.count AS percentage
FROM r LEFT JOIN r t ON t.quality IS NULL AND r.batch_id IS NOT DISTINCT FROM t.batch_id""")
def batch_distribution(spark, sf_dir):
    return L.batch_distribution(table(spark, sf_dir, "labels"), ["doc_id"], "quality")


_POS = ", ".join(f"'{w}'" for w in L.POSITIVE_WORDS)
_NEG = ", ".join(f"'{w}'" for w in L.NEGATIVE_WORDS)
_SCORE_SQL = f"""list_sum(list_transform(regexp_split_to_array(lower(text), '{L.TOKEN_SPLIT}'),
    lambda t: CASE WHEN t IN ({_POS}) THEN 1 WHEN t IN ({_NEG}) THEN -1 ELSE 0 END))"""


@register("sentiment_lexicon", f"""
SELECT doc_id, CAST({_SCORE_SQL} AS INTEGER) AS score,
       CASE WHEN {_SCORE_SQL} > 0 THEN 'Positive' WHEN {_SCORE_SQL} < 0 THEN 'Negative' ELSE 'Neutral' END AS label
FROM documents""")
def sentiment_lexicon(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "text", spread=True)
    s = d.select("doc_id", L.lexicon_score("text").cast("int").alias("score"))
    return s.withColumn("label", L.sentiment_label("score"))


@register("sentiment_distribution", f"""
WITH s AS (SELECT CASE WHEN {_SCORE_SQL} > 0 THEN 'Positive' WHEN {_SCORE_SQL} < 0 THEN 'Negative'
                       ELSE 'Neutral' END AS label FROM documents)
SELECT c.label, count(s.label)::BIGINT AS count, (SELECT count(*) FROM s)::BIGINT AS total,
       count(s.label) * 100.0 / (SELECT count(*) FROM s) AS percentage
FROM (VALUES ('Positive'), ('Negative'), ('Neutral')) c(label) LEFT JOIN s ON s.label = c.label GROUP BY c.label""")
def sentiment_distribution(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "text", spread=True)
    return L.distribution(L.classify(d, "text").select("label"), "label", classes=L.LABELS)


@register("ai_messages", """
SELECT conv_id, turn, [text] AS parts, text FROM conversations WHERE role = 'assistant'""")
def ai_messages(spark, sf_dir):
    return TR.ai_messages(TR.messages_from_conversations(table(spark, sf_dir, "conversations")))


_RQ, _RREST = P.REFINE_TEMPLATE.split("{q}")
_RT, _RREST = _RREST.split("{tools}")
_RO, _RTAIL = _RREST.split("{outputs}")


@register("refine_prompt", f"""
SELECT conv_id, {_sql_str(_RQ)} || arg_min(text, turn) FILTER (WHERE role = 'user')
       || {_sql_str(_RT)} || '[]' || {_sql_str(_RO)} || '[]' || {_sql_str(_RTAIL)} AS prompt
FROM conversations GROUP BY conv_id HAVING count(*) FILTER (WHERE role = 'user') > 0""")
def refine_prompt(spark, sf_dir):
    """Per conversation: the first user question plus the tools used and their
    outputs (as JSON lists) in the refinement template."""
    msgs = TR.messages_from_conversations(table(spark, sf_dir, "conversations"))
    q = (msgs.filter(F.col("role") == "user").groupBy("conv_id")
         .agg(F.min_by(F.variant_get("content", "$", "string"), "turn").alias("question")))
    tools = TR.conversation_tools(msgs)
    return q.join(tools, "conv_id", "left").select(
        "conv_id", P.refine_prompt("question", "tools_used", "tool_outputs").alias("prompt"))


# ---------------------------------------------------------------- raw transcripts

_STEP = "CASE turn % 3 WHEN 0 THEN 'text' WHEN 1 THEN 'list' ELSE 'object' END"
_MSGS_SQL = f"""
m AS (SELECT conv_id, turn, role, text, {_STEP} AS shape FROM conversations)"""


def raw_transcripts(spark, sf_dir):
    """A file of JSON lists, a line a conversation: every turn with its content as text, as a list of parts or as an object, by
    turns; an assistant turn calls one tool or two, and the tool's message follows."""
    import uuid

    from ..session import ensure_checkpoint_dir

    c = table(spark, sf_dir, "conversations")
    n = F.col("turn") % 3
    body = F.coalesce("text", F.lit(""))
    text, parts, thing = F.to_json(F.struct(body.alias("x"))), F.to_json(F.array(F.struct(F.lit("text").alias("type"), body.alias("text")),
        F.struct(F.lit("image").alias("type"), F.lit(None).cast("string").alias("text")), F.struct(F.lit("text").alias("type"), F.lit("end").alias("text")))), F.to_json(F.struct(body.alias("answer"), F.col("turn").alias("n")))
    plain = F.regexp_replace(F.regexp_replace(text, '^\\{"x":', ""), "\\}$", "")
    content = F.when(n == 0, plain).when(n == 1, parts).otherwise(thing)
    call = F.to_json(F.struct(F.lit("find").alias("name"), F.struct(body.alias("q"), F.col("turn").alias("n")).alias("args")))
    calls = F.when(n == 1, F.concat(F.lit("["), call, F.lit(","), call, F.lit("]"))).otherwise(F.concat(F.lit("["), call, F.lit("]")))
    own = F.concat(F.lit('{"role":'), F.to_json(F.struct(F.coalesce("role", F.lit("none")).alias("r"))).substr(F.lit(6), F.length(F.coalesce("role", F.lit("none"))) + 2), F.lit(',"content":'), content,
                   F.when(F.col("role") == "assistant", F.concat(F.lit(',"tool_calls":'), calls)).otherwise(""), F.lit("}"))
    tool = F.concat(F.lit('{"role":"tool","content":'), content, F.lit("}"))
    lines = c.select("conv_id", "turn", F.when(F.col("role") == "assistant", F.concat(own, F.lit(","), tool)).otherwise(own).alias("j"))
    whole = lines.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "j"))).alias("a")).select(
        F.to_json(F.struct("conv_id", F.concat(F.lit("["), F.array_join(F.transform("a", lambda x: x["j"]), ","), F.lit("]")).alias("body"))).alias("value"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/transcripts-{uuid.uuid4().hex}"
    whole.write.text(path)
    return spark.read.schema("conv_id bigint, body string").json(path)


@register("raw_ai_messages", f"""
WITH {_MSGS_SQL}
SELECT conv_id, CASE shape WHEN 'text' THEN [coalesce(text, '')] WHEN 'list' THEN [coalesce(text, ''), 'end'] ELSE []::VARCHAR[] END AS parts,
       CASE shape WHEN 'text' THEN coalesce(text, '') WHEN 'list' THEN coalesce(text, '') || ' end' ELSE '' END AS text
FROM m WHERE role = 'assistant'""")
def raw_ai_messages(spark, sf_dir):
    """The assistant's text of raw transcripts, whatever the shape of its content."""
    return TR.ai_messages(TR.parse_transcripts(raw_transcripts(spark, sf_dir))).select("conv_id", "parts", "text")


@register("tool_calls", f"""
WITH {_MSGS_SQL},
c AS (SELECT *, unnest(CASE shape WHEN 'list' THEN [0, 1] ELSE [0] END) AS call_index FROM m WHERE role = 'assistant')
SELECT conv_id, call_index::INT AS call_index, 'find' AS name, coalesce(text, '') AS q, turn::BIGINT AS n FROM c""")
def tool_calls(spark, sf_dir):
    """Every tool call of raw transcripts, with its arguments."""
    calls = TR.tool_calls(TR.parse_transcripts(raw_transcripts(spark, sf_dir)))
    return calls.select("conv_id", "call_index", "name", F.get_json_object("args", "$.q").alias("q"), F.get_json_object("args", "$.n").cast("bigint").alias("n"))


@register("tool_outputs", f"""
WITH {_MSGS_SQL}
SELECT conv_id, CASE WHEN shape = 'text' THEN coalesce(text, '') END AS text, CASE WHEN shape = 'list' THEN coalesce(text, '') END AS first_part,
       CASE WHEN shape = 'object' THEN coalesce(text, '') END AS answer, CASE WHEN shape = 'object' THEN turn END::BIGINT AS n
FROM m WHERE role = 'assistant'""")
def tool_outputs(spark, sf_dir):
    """Every tool's output of raw transcripts: text or list under one key, an object by its own keys."""
    out = TR.tool_outputs(TR.parse_transcripts(raw_transcripts(spark, sf_dir)))
    whole = F.get_json_object("output", "$['Tool Content']")
    return out.select("conv_id", F.when(~whole.startswith("[{"), whole).alias("text"), F.get_json_object("output", "$['Tool Content'][0].text").alias("first_part"),
                      F.get_json_object("output", "$.answer").alias("answer"), F.get_json_object("output", "$.n").cast("bigint").alias("n"))
