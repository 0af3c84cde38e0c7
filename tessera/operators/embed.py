"""Embeddings through a content-addressed cache table.

Plan for ``embed_cached``:

1. distinct ``(chunk_key, text)`` of the input (partial aggregation first, so a
   text copied across a third of the rows collapses map-side);
2. ``left_anti`` against the cache for this model -> the misses only;
3. the injected embedding function runs in an Iterator ``arrow_udf`` (the
   model is built once per Python worker, then fed slices of Arrow batches);
4. misses are appended to the cache table as a new ``run=<uuid>``
   directory (Parquet, partitioned by model inside it). Each append is its
   own committed Spark job with its own staging area, so concurrent jobs
   never clean up each other's files, a lost executor re-runs its task
   without duplicating rows, and readers ``dropDuplicates`` as a safety net;
5. the input joins back to the cache on ``chunk_key``.

Only ``(key, text)`` of misses are shuffled; vectors are shuffled once for the
join-back. The cache folder lives under the shared ``spark.checkpoint.dir``
unless a path is given.
"""

from __future__ import annotations

import hashlib
import sys
import uuid
from typing import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from .partitioning import pieces

# Model -> vector dimension, and the size aliases per provider.
EMBEDDING_DIMENSIONS = {
    "sentence-transformers/all-mpnet-base-v2": 768,
    "sentence-transformers/all-MiniLM-L6-v2": 384,
    "sentence-transformers/multi-qa-mpnet-base-dot-v1": 768,
    "sentence-transformers/paraphrase-multilingual-mpnet-base-v2": 768,
    "text-embedding-3-small": 1536,
    "text-embedding-3-large": 3072,
    "text-embedding-ada-002": 1536,
}
DEFAULT_EMBEDDING_MODELS = {
    "huggingface": {
        "default": "sentence-transformers/all-mpnet-base-v2",
        "small": "sentence-transformers/all-MiniLM-L6-v2",
        "large": "sentence-transformers/all-mpnet-base-v2",
    },
    "openai": {
        "default": "text-embedding-3-small",
        "small": "text-embedding-3-small",
        "large": "text-embedding-3-large",
    },
}
DEFAULT_MODEL = "sentence-transformers/all-mpnet-base-v2"
FALLBACK_DIMENSION = 768
# Offline embedder: model names "hashing-<dim>" need no weights.
OFFLINE_MODEL = "hashing-768"

CACHE_SCHEMA = T.StructType([
    T.StructField("chunk_key", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("model", T.StringType()),
])


# Tokens whose bucket a worker keeps; a bound on memory, not on what is embedded.
SEEN = 200_000
# White space of ``str.split`` that Arrow's ASCII split does not know, as a character class.
_WIDE_SPACE = "[" + "".join(f"\\x{{{c:x}}}" for c in range(sys.maxunicode + 1) if chr(c).isspace() and c not in (9, 10, 11, 12, 13, 32)) + "]"


# ---------------------------------------------------------------- embedders

def embedding_type(model: str) -> str:
    """'openai' when the model name contains 'text-embedding', else 'huggingface'."""
    return "openai" if "text-embedding" in model.lower() else "huggingface"


def embedding_type_col(model) -> Column:
    m = F.col(model) if isinstance(model, str) else model
    return F.when(F.lower(m).contains("text-embedding"), "openai").otherwise("huggingface")


def model_dimension(model: str) -> int:
    if model.startswith("hashing-") and model[len("hashing-"):].isdigit():
        return int(model[len("hashing-"):])
    return EMBEDDING_DIMENSIONS.get(model, FALLBACK_DIMENSION)


def hash_bucket(token: str, dim: int) -> int:
    """Bucket of a token: first 8 hex digits of its md5, modulo ``dim``."""
    return int(hashlib.md5(token.encode("utf-8")).hexdigest()[:8], 16) % dim


def hashing_embedder(dim: int) -> Callable[[], Callable[[pd.Series], list]]:
    """Offline stand-in for a neural model: L2-normalised bag of hashed
    lower-cased whitespace tokens. Deterministic, so an SQL oracle can
    recompute it. Returns a factory so the per-worker state (token cache) is
    built once per Python worker."""

    def factory():
        seen = {"": -1}  # what white space at the ends of a text leaves is no token

        def buckets_of(tokens: list[str]) -> np.ndarray:
            found = list(map(seen.get, tokens))
            for i in [i for i, b in enumerate(found) if b is None]:
                found[i] = hash_bucket(tokens[i], dim)
                if len(seen) <= SEEN:
                    seen[tokens[i]] = found[i]
            return np.array(found, np.int64)

        def embed(texts: pd.Series) -> list:
            """The texts are split together, each different token is looked up once, and all are counted together."""
            lower = pa.array([(t or "").lower() for t in texts], pa.string())
            split = pc.ascii_split_whitespace(pc.replace_substring_regex(lower, _WIDE_SPACE, " "))
            coded = split.flatten().dictionary_encode()
            bucket = buckets_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
            row = np.repeat(np.arange(len(lower)), np.diff(split.offsets.to_numpy()))[bucket >= 0]
            place = row * dim + bucket[bucket >= 0]
            v = np.bincount(place, minlength=len(lower) * dim).reshape(len(lower), dim).astype(np.float64)
            norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
            norm[norm == 0] = 1
            return list((v / norm).astype(np.float32))

        return embed

    return factory


def embedding_udf(factory: Callable[[], Callable[[pd.Series], list]], on_error: str = "raise"):
    """Iterator Arrow UDF: the model is created once per worker process and
    gets a Series of a few hundred texts at a time, whose vectors go on before
    the next are made. With ``on_error="null"`` a slice that fails is run text
    by text, and the texts that fail get no vector."""

    def alone(model, text):
        try:
            return model(pd.Series([text]))[0]
        except Exception:  # noqa: BLE001
            return None

    def vectors(found) -> pa.Array:
        return pa.array([None if v is None else np.asarray(v, np.float32) for v in found], pa.list_(pa.float32()))

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def _embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = factory()
        for batch in batches:
            for part in pieces(batch, rows=256):
                texts = pd.Series(part.to_pylist(), dtype=object)
                try:
                    found = vectors(model(texts))
                except Exception:  # noqa: BLE001 - any failure of the model
                    if on_error != "null":
                        raise
                    found = vectors([alone(model, t) for t in texts])
                yield found

    return _embed


# ---------------------------------------------------------------- cache

def default_cache_path(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        from ..session import ensure_checkpoint_dir
        base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/tessera_vector_cache"


def read_cache(spark: SparkSession, path: str, model: str, keys: DataFrame | None = None,
               vectors: bool = True) -> DataFrame:
    """Cache rows for one model (partition pruning on ``model``), deduplicated.

    With ``keys`` (a frame with ``chunk_key``) the cache is first cut to those
    keys by a semi join; its build side is keys only, so AQE can broadcast it
    and the vectors are filtered map-side before any shuffle. Without
    ``vectors`` their length (``dimensions``) stands for them from the scan
    on, so the de-duplication and what follows move a few bytes per key.
    """
    try:
        cache = spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException:
        cache = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in CACHE_SCHEMA])
    cache = cache.filter(F.col("model") == model)
    if not vectors:
        cache = cache.select("chunk_key", "model", F.size("embedding").alias("dimensions"))
    if keys is not None:
        cache = cache.join(keys.select("chunk_key").distinct(), "chunk_key", "left_semi")
    return cache.dropDuplicates(["chunk_key"])


def cache_misses(chunks: DataFrame, cache: DataFrame) -> DataFrame:
    distinct = chunks.select("chunk_key", "text").dropDuplicates(["chunk_key"])
    return distinct.join(cache.select("chunk_key"), "chunk_key", "left_anti")


def embed_cached(chunks: DataFrame, model: str = OFFLINE_MODEL, cache_path: str | None = None,
                 embedder: Callable | None = None, materialize: bool = True, on_error: str = "raise",
                 vectors: bool = True) -> DataFrame:
    """Attach ``embedding`` to every chunk row, computing each text at most once.
    A text whose embedding fails ends the job, or with ``on_error="null"`` has
    null ``model`` and ``embedding`` and is tried again by the next run.

    ``chunks`` needs ``chunk_key`` and ``text``; other columns are kept.
    Returns the input columns + ``model`` + ``embedding`` (or, without
    ``vectors``, ``dimensions``: no vector is shuffled then).
    """
    spark = chunks.sparkSession
    path = cache_path or default_cache_path(spark)
    if materialize:
        # The chunks feed two jobs (miss detection + join-back). A reliable
        # checkpoint in the shared checkpoint folder computes them once (the
        # recursive chunker runs in Python) and survives executor loss;
        # never a machine-local copy. Measured: faster than recomputing even
        # the native token windows.
        from ..session import ensure_checkpoint_dir
        ensure_checkpoint_dir(spark)
        chunks = chunks.checkpoint(eager=True)
    if embedder is None:
        if not model.startswith("hashing-"):
            raise ValueError(f"model {model!r} needs an embedder factory (no weights are bundled)")
        embedder = hashing_embedder(model_dimension(model))
    factory = embedder
    misses = cache_misses(chunks, read_cache(spark, path, model, vectors=False))
    # Counting runs only the anti-join (the embedding column is pruned); a
    # run directory is created only when there is something to append, so
    # all-hit runs leave the cache (and its listing) unchanged.
    if misses.count() > 0:
        new = misses.select("chunk_key", embedding_udf(factory, on_error)("text").alias("embedding"),
                            F.lit(model).alias("model")).where("embedding is not null")
        # a fresh directory per append: a job's staging files live under it
        new.write.mode("errorifexists").partitionBy("model").parquet(
            f"{path.rstrip('/')}/run={uuid.uuid4().hex}")
    if not vectors:
        return chunks.join(read_cache(spark, path, model, vectors=False), "chunk_key", "left")
    cache = read_cache(spark, path, model, keys=chunks)
    # The vector side has no proven size bound (compressed Parquet sizes
    # badly underestimate float arrays in memory), so it is never broadcast:
    # a shuffle join on chunk_key, split by AQE when a key is hot.
    vectors = cache.select("chunk_key", "model", "embedding").hint("shuffle_merge")
    return chunks.join(vectors, "chunk_key", "left")


def compact_cache(spark: SparkSession, path: str, target: str, files: int | None = None) -> None:
    """Write the cache de-duplicated into a new folder, ``files`` per model:
    the periodic job against many small appends. The caller switches over."""
    cache = spark.read.schema(CACHE_SCHEMA).parquet(path).dropDuplicates(["model", "chunk_key"])
    if files:
        cache = cache.repartition(files, "model", "chunk_key")
    cache.write.partitionBy("model").parquet(f"{target.rstrip('/')}/run=compacted-{uuid.uuid4().hex}")


def count_misses(chunks: DataFrame, model: str = OFFLINE_MODEL, cache_path: str | None = None) -> int:
    """How many distinct texts would be embedded now (0 after a complete run)."""
    spark = chunks.sparkSession
    path = cache_path or default_cache_path(spark)
    return cache_misses(chunks, read_cache(spark, path, model)).count()


# ---------------------------------------------------------------- info / checks

def embedding_info(embedded: DataFrame, model: str, doc_col: str = "document_id") -> DataFrame:
    """Per document: {model, type, count, dimensions}; dimensions = length of
    the first vector (lowest chunk_index), 0 when there is none. ``embedded``
    needs ``dimensions`` only; whole vectors will do as well."""
    size = F.col("dimensions") if "dimensions" in embedded.columns else F.size("embedding")
    return embedded.groupBy(doc_col).agg(
        F.count(size).cast("int").alias("count"),
        F.coalesce(F.min_by(size, "chunk_index"), F.lit(0)).cast("int").alias("dimensions"),
    ).select(doc_col, F.lit(model).alias("model"), F.lit(embedding_type(model)).alias("type"),
             "count", "dimensions")


def dimension_table(spark: SparkSession) -> DataFrame:
    """(model, type, dimensions, alias_of) – fixed, a few rows, safe to broadcast."""
    rows = [(m, embedding_type(m), d) for m, d in EMBEDDING_DIMENSIONS.items()]
    return spark.createDataFrame(rows, "model string, type string, dimensions int")


def alias_table(spark: SparkSession) -> DataFrame:
    rows = [(p, size, m) for p, d in DEFAULT_EMBEDDING_MODELS.items() for size, m in d.items()]
    return spark.createDataFrame(rows, "provider string, size string, model string")


def with_expected_dimension(df: DataFrame, model_col: str = "model") -> DataFrame:
    """The size in a ``hashing-N`` name, else the fixed dimension table's
    (broadcast: 7 rows), else 768."""
    dims = F.broadcast(dimension_table(df.sparkSession).select(
        F.col("model").alias("_m"), F.col("dimensions").alias("_d")))
    return (df.join(dims, F.col(model_col) == F.col("_m"), "left")
            .withColumn("expected_dimensions", F.coalesce(
                F.expr(f"try_cast(nullif(regexp_extract(`{model_col}`, '^hashing-([0-9]+)$', 1), '') as int)"),
                F.col("_d"), F.lit(FALLBACK_DIMENSION)).cast("int"))
            .drop("_m", "_d"))


def dimension_violations(df: DataFrame, vec_col: str = "embedding", model_col: str = "model") -> DataFrame:
    """Rows whose vector length differs from the model's expected dimension."""
    return (with_expected_dimension(df, model_col)
            .withColumn("actual_dimensions", F.size(vec_col).cast("int"))
            .filter(F.col("actual_dimensions") != F.col("expected_dimensions")))


def preview(embedded: DataFrame, n_chars: int = 200, n_dims: int = 5) -> DataFrame:
    return embedded.select("document_id", "chunk_index",
                           F.substring("text", 1, n_chars).alias("text_preview"),
                           F.slice("embedding", 1, n_dims).alias("embedding_preview"))
