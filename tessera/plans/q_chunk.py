"""Chunking queries on ``documents`` (whole texts)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import chunk_key
from ..functions.text import WS_CLASS, word_count, char_count
from ..operators import chunk as C
from ..operators import embed as E
from ..sources.tables import table
from .registry import register

# token-window parameters used by the SQL-checkable chunk and embed queries
TOKEN_SIZE, TOKEN_OVERLAP = 200, 50

WS = WS_CLASS[1:-1]


def flagship(spark: SparkSession, sf_dir: str, cache_path: str | None = None) -> DataFrame:
    """documents -> counts -> recursive chunks -> keys -> cached embeddings ->
    per-language summary (the minimum end-to-end slice)."""
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "text", spread=True)
    chunks = C.chunk_documents(docs, keep=["lang"])
    embedded = E.embed_cached(chunks, cache_path=cache_path, vectors=False)
    per_lang_chunks = embedded.groupBy("lang").agg(
        F.count("*").cast("bigint").alias("n_chunks"),
        F.countDistinct("chunk_key").cast("bigint").alias("n_distinct_chunks"),
        F.count("dimensions").cast("bigint").alias("n_embedded"),
        F.max("dimensions").cast("int").alias("dimensions"))
    per_lang_docs = docs.groupBy("lang").agg(
        F.count("*").cast("bigint").alias("n_docs"),
        F.sum(word_count("text")).cast("bigint").alias("words"),
        F.sum(char_count("text")).cast("bigint").alias("chars"))
    return per_lang_docs.join(per_lang_chunks, "lang", "left")


@register("chunk_recursive")
def chunk_recursive(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return C.chunk_documents(docs).select(
        "document_id", "chunk_index", "chunk_key", F.length("text").alias("chunk_len"))


_KEY_SQL = """substr(x, 1, 8) || '-' || substr(x, 9, 4) || '-5' || substr(x, 14, 3) || '-'
         || lower(printf('%x', 8 + (('0x' || substr(x, 17, 1))::INTEGER % 4))) || substr(x, 18, 3)
         || '-' || substr(x, 21, 12)"""
_NAMESPACE_SQL = r"'\x00\x00\x00\x00\x00\x00\x00\x00\x00\x00\x00\x00\x00\x00\x07\xC1'::BLOB"


@register("chunk_character", f"""
WITH RECURSIVE p AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS ps FROM documents
  WHERE regexp_matches(text, '[^{WS}]')),
c AS (SELECT doc_id, ps, list_transform(range(0, len(ps) + 1), lambda i:
             coalesce(list_sum(list_transform(ps[1:i], lambda x: length(x) + 1)), 0)) AS cs FROM p),
r AS (
  SELECT doc_id, ps, cs, 0::BIGINT AS s, greatest(1, len(list_filter(cs, lambda x: x <= {C.DEFAULT_SIZE} + 1)) - 1) AS e FROM c
  UNION ALL
  SELECT doc_id, ps, cs, n, greatest(n + 1, len(list_filter(cs, lambda x: x <= cs[n + 1] + {C.DEFAULT_SIZE} + 1)) - 1)
  FROM (SELECT doc_id, ps, cs, least(e, greatest(s,
               len(list_filter(cs, lambda x: x < cs[e + 1] - 1 - {C.DEFAULT_OVERLAP})),
               len(list_filter(cs, lambda x: x < cs[e + 2] - 1 - {C.DEFAULT_SIZE})))) AS n
        FROM r WHERE e < len(ps))),
t AS (SELECT doc_id, s, regexp_replace(array_to_string(ps[s + 1:e], chr(10)), '^[{WS}]+|[{WS}]+$', '', 'g') AS text FROM r),
h AS (SELECT doc_id, s, text, sha1({_NAMESPACE_SQL} || sha1(text)::BLOB) AS x FROM t WHERE text <> '')
SELECT doc_id AS document_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS INTEGER) AS chunk_index,
       {_KEY_SQL} AS chunk_key, length(text)::INTEGER AS chunk_len
FROM h""")
def chunk_character(spark, sf_dir):
    # the documents have no blank lines, so split on line breaks
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return C.chunk_documents(docs, method="character", separators=("\n",)).select(
        "document_id", "chunk_index", "chunk_key", F.length("text").alias("chunk_len"))


@register("chunk_rows")
def chunk_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return C.chunk_documents(docs)


@register("chunk_info")
def chunk_info(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return C.document_chunk_info(docs).select("document_id", "chunks_info.*")


@register("chunk_info_token", f"""
SELECT doc_id AS document_id, CASE WHEN n = 0 THEN 0 ELSE len(range(0, greatest(n - {TOKEN_OVERLAP} - 1, 0) + 1,
         {TOKEN_SIZE - TOKEN_OVERLAP})) END::INTEGER AS count, {TOKEN_SIZE} AS chunk_size, {TOKEN_OVERLAP} AS chunk_overlap,
       'token' AS chunking_method
FROM (SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[{WS}]+'), lambda x: x <> '')) AS n FROM documents)""")
def chunk_info_token(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return C.document_chunk_info(docs, method="token", size=TOKEN_SIZE, overlap=TOKEN_OVERLAP).select(
        "document_id", "chunks_info.*")


@register("chunk_token", f"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(text, '[{WS}]+'), lambda x: x <> '') AS toks
  FROM documents),
w AS (
  SELECT doc_id, toks, unnest(range(0, greatest(len(toks) - {TOKEN_OVERLAP} - 1, 0) + 1,
                                    {TOKEN_SIZE - TOKEN_OVERLAP})) AS s
  FROM d WHERE len(toks) > 0)
SELECT doc_id AS document_id,
       CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS INTEGER) AS chunk_index,
       array_to_string(toks[s + 1 : s + {TOKEN_SIZE}], ' ') AS text
FROM w
""")
def chunk_token(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return C.chunk_documents(docs, method="token", size=TOKEN_SIZE, overlap=TOKEN_OVERLAP).select(
        "document_id", "chunk_index", "text")


@register("chunk_key", f"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(text, '[{WS}]+'), lambda x: x <> '') AS toks
  FROM documents),
w AS (
  SELECT doc_id, unnest(range(0, greatest(len(toks) - {TOKEN_OVERLAP} - 1, 0) + 1,
                              {TOKEN_SIZE - TOKEN_OVERLAP})) AS s, toks
  FROM d WHERE len(toks) > 0),
t AS (SELECT doc_id, s, array_to_string(toks[s + 1 : s + {TOKEN_SIZE}], ' ') AS text FROM w),
h AS (SELECT doc_id, s, sha1('\\x00\\x00\\x00\\x00\\x00\\x00\\x00\\x00\\x00\\x00\\x00\\x00\\x00\\x00\\x07\\xC1'::BLOB
                              || sha1(text)::BLOB) AS x FROM t)
SELECT doc_id AS document_id,
       CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS INTEGER) AS chunk_index,
       substr(x, 1, 8) || '-' || substr(x, 9, 4) || '-5' || substr(x, 14, 3) || '-'
         || lower(printf('%x', 8 + (('0x' || substr(x, 17, 1))::INTEGER % 4))) || substr(x, 18, 3)
         || '-' || substr(x, 21, 12) AS chunk_key
FROM h
""")
def chunk_key_q(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return C.chunk_documents(docs, method="token", size=TOKEN_SIZE, overlap=TOKEN_OVERLAP).select(
        "document_id", "chunk_index", "chunk_key")


@register("docx_text", f"""
SELECT d.doc_id,
       regexp_replace(array_to_string(list_concat(
              list_filter(string_split(d.text, chr(10)), lambda p: p <> ''),
              CASE WHEN l.doc_id IS NULL THEN []::VARCHAR[] ELSE [
                chr(10) || chr(10) || '--- Table 1 ---',
                'quality | toxic',
                CAST(l.quality AS VARCHAR) || ' | ' || CAST(l.toxic AS VARCHAR),
                '--- End Table ---' || chr(10) || chr(10)] END),
            chr(10) || chr(10)), '^[{WS}]+|[{WS}]+$', '', 'g') AS chunk_text
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def docx_text_q(spark, sf_dir):
    """Each document as a Word document: its lines are the paragraphs and its
    label row (when there is one) is a 2-row table."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    tbl = F.when(F.col("quality").isNotNull(), F.array(F.array(
        F.array(F.lit("quality"), F.lit("toxic")),
        F.array(F.col("quality").cast("string"), F.col("toxic").cast("string")))))
    j = docs.join(labels, "doc_id", "left")
    paras = F.filter(F.split("text", "\n"), lambda p: p != "")
    return j.select("doc_id", C.docx_text(paras, tbl, F.col("text")).alias("chunk_text"))


@register("page_text", """
SELECT doc_id,
       array_to_string(list_transform(
           string_split(text, chr(10)),
           lambda p, i: '--- Page ' || CAST(i AS VARCHAR) || ' ---' || chr(10) || p),
         chr(10) || chr(10)) AS chunk_text
FROM documents
""")
def page_text_q(spark, sf_dir):
    """Each document as a PDF whose pages are its lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", C.page_text(F.split("text", "\n"), F.col("text")).alias("chunk_text"))
