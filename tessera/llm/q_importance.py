"""Query of the importance resampling. No SQL: DuckDB has no CRC-32; tested against zlib, n-gram by n-gram."""

from __future__ import annotations

from ..sources.tables import table
from .importance import resample
from .registry import register


@register("op11_importance_resampling")
def op11_importance_resampling(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", spread=True)
    drawn = resample(docs, table(spark, sf_dir, "benchmark", "text"), longest=2, n_buckets=10_000, seed=7, min_words=20, draw_percent=25)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
