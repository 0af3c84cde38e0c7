"""Embedding queries: token-window chunks of documents through the cache.

Token windows (not the recursive rule) are used here so that the SQL oracle
can rebuild the exact chunk texts; the offline hashing embedder is also
expressible in SQL (md5 buckets of lower-cased tokens).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import WS_CLASS
from ..operators import chunk as C
from ..operators import embed as E
from ..sources.tables import table
from .q_chunk import TOKEN_OVERLAP, TOKEN_SIZE
from .registry import register

WS = WS_CLASS[1:-1]
MODEL = "hashing-768"
DIM = 768

# Fixed choice for the model-routing queries: English documents use the
# default model, the other languages the multilingual one.
ROUTING = {"en": "sentence-transformers/all-mpnet-base-v2"}
ROUTING_DEFAULT = "sentence-transformers/paraphrase-multilingual-mpnet-base-v2"

_CHUNKS = f"""d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(text, '[{WS}]+'), lambda x: x <> '') AS toks
  FROM documents),
w AS (
  SELECT doc_id, toks, unnest(range(0, greatest(len(toks) - {TOKEN_OVERLAP} - 1, 0) + 1,
                                    {TOKEN_SIZE - TOKEN_OVERLAP})) AS s
  FROM d WHERE len(toks) > 0),
ch AS (
  SELECT doc_id AS document_id,
         CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS INTEGER) AS chunk_index,
         array_to_string(toks[s + 1 : s + {TOKEN_SIZE}], ' ') AS text
  FROM w),
tok AS (
  SELECT document_id, chunk_index,
         ((('0x' || substr(md5(t), 1, 8))::BIGINT) % {DIM})::INTEGER AS b
  FROM (SELECT document_id, chunk_index,
               unnest(list_filter(regexp_split_to_array(lower(text), '[{WS}]+'), lambda x: x <> '')) AS t
        FROM ch)),
cnt AS (SELECT document_id, chunk_index, b, count(*)::DOUBLE AS c FROM tok GROUP BY ALL),
vec AS (SELECT document_id, chunk_index, count(*)::INTEGER AS nnz,
               max(c) / sqrt(sum(c * c)) AS max_w, sqrt(sum(c * c)) AS norm,
               list(c ORDER BY b) FILTER (WHERE b < 5) AS low_c, list(b ORDER BY b) FILTER (WHERE b < 5) AS low_b
        FROM cnt GROUP BY ALL)"""


def _chunks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return C.chunk_documents(docs, method="token", size=TOKEN_SIZE, overlap=TOKEN_OVERLAP, keep=["lang"])


def _embedded(spark, sf_dir, vectors: bool = True):
    return E.embed_cached(_chunks(spark, sf_dir), model=MODEL, vectors=vectors)


@register("embed_cached", f"""WITH {_CHUNKS}
SELECT document_id, chunk_index, {DIM} AS dimensions, nnz, round(max_w::FLOAT::DOUBLE, 5) AS max_weight FROM vec""")
def embed_cached(spark, sf_dir):
    e = _embedded(spark, sf_dir)
    return e.select("document_id", "chunk_index", F.size("embedding").alias("dimensions"),
                    F.size(F.filter("embedding", lambda x: x != 0)).alias("nnz"),
                    F.round(F.array_max("embedding").cast("double"), 5).alias("max_weight"))


@register("embed_info", f"""WITH {_CHUNKS}
SELECT d.doc_id AS document_id, '{MODEL}' AS model, 'huggingface' AS type,
       CAST(count(ch.chunk_index) AS INTEGER) AS count,
       CAST(CASE WHEN count(ch.chunk_index) > 0 THEN {DIM} ELSE 0 END AS INTEGER) AS dimensions
FROM documents d LEFT JOIN ch ON d.doc_id = ch.document_id GROUP BY d.doc_id""")
def embed_info(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"))
    info = E.embedding_info(_embedded(spark, sf_dir, vectors=False), MODEL)
    return (docs.join(info, "document_id", "left")
            .select("document_id", F.lit(MODEL).alias("model"), F.lit(E.embedding_type(MODEL)).alias("type"),
                    F.coalesce("count", F.lit(0)).cast("int").alias("count"),
                    F.coalesce("dimensions", F.lit(0)).cast("int").alias("dimensions")))


@register("embed_preview", f"""WITH {_CHUNKS}
SELECT v.document_id, v.chunk_index, substr(ch.text, 1, 200) AS text_preview,
       list_transform(range(0, 5), lambda i: round((coalesce(
           list_extract(v.low_c, list_position(v.low_b, i)), 0) / v.norm)::FLOAT::DOUBLE, 5)) AS embedding_preview
FROM vec v JOIN ch ON v.document_id = ch.document_id AND v.chunk_index = ch.chunk_index""")
def embed_preview(spark, sf_dir):
    p = E.preview(_embedded(spark, sf_dir))
    return p.select("document_id", "chunk_index", "text_preview",
                    F.transform("embedding_preview", lambda x: F.round(x.cast("double"), 5)).alias("embedding_preview"))


_MODELS = [*E.EMBEDDING_DIMENSIONS, "an-unlisted-model"]


def _routing_sql():
    return f"([{', '.join(repr(m) for m in _MODELS)}])[doc_id % {len(_MODELS)} + 1]"


def _routed(spark, sf_dir):
    """Documents dealt over all listed models and one that is not listed."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    at = (F.col("doc_id") % len(_MODELS) + 1).cast("int")
    return d.withColumn("model", F.element_at(F.array(*[F.lit(m) for m in _MODELS]), at))


@register("embed_type", f"""
SELECT doc_id, {_routing_sql()} AS model,
       CASE WHEN lower({_routing_sql()}) LIKE '%text-embedding%' THEN 'openai' ELSE 'huggingface' END AS type
FROM documents""")
def embed_type(spark, sf_dir):
    d = _routed(spark, sf_dir)
    return d.select("doc_id", "model", E.embedding_type_col("model").alias("type"))


@register("embed_dims", f"""
SELECT doc_id, {_routing_sql()} AS model,
       CASE {_routing_sql()} {" ".join(f"WHEN '{k}' THEN {v}" for k, v in E.EMBEDDING_DIMENSIONS.items())}
            ELSE {E.FALLBACK_DIMENSION} END AS expected_dimensions
FROM documents""")
def embed_dims(spark, sf_dir):
    d = E.with_expected_dimension(_routed(spark, sf_dir))
    return d.select("doc_id", "model", "expected_dimensions")


@register("embed_dim_check", f"""WITH {_CHUNKS}
SELECT document_id, chunk_index, {DIM} AS expected_dimensions, ({DIM} - document_id % 3)::INTEGER AS actual_dimensions
FROM vec WHERE document_id % 3 <> 0""")
def embed_dim_check(spark, sf_dir):
    """The vectors of two of three documents are cut short and must be found."""
    e = _embedded(spark, sf_dir)
    e = e.withColumn("embedding", F.slice("embedding", 1, (F.size("embedding") - F.col("document_id") % 3).cast("int")))
    return E.dimension_violations(e).select("document_id", "chunk_index", "expected_dimensions",
                                            "actual_dimensions")


@register("vector_dim_check", """
SELECT vec_id, 64 AS expected_dimensions, (len(embedding) - vec_id % 2)::INTEGER AS actual_dimensions
FROM embeddings WHERE len(embedding) - vec_id % 2 <> 64""")
def vector_dim_check(spark, sf_dir):
    """Vectors of the driver ``embeddings`` table, every other one a value
    short, whose length is not that of their model."""
    v = table(spark, sf_dir, "embeddings")
    v = v.withColumn("embedding", F.slice("embedding", 1, (F.size("embedding") - F.col("vec_id") % 2).cast("int")))
    return (E.dimension_violations(v.withColumn("model", F.lit("hashing-64")))
            .select("vec_id", "expected_dimensions", "actual_dimensions"))
