"""Corpus pipeline: documents -> quality rules -> near duplicates -> decontamination -> source mix -> token-id files.

Every stage works on all that its predecessor kept. ``run`` writes each stage's result as Parquet below the shared
checkpoint folder and reads it again, so a lost executor costs a stage's task, not the job.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import shared_path
from tessera.llm.decontaminate import decontaminate
from tessera.llm.mix import mix
from tessera.llm.near_join import keep_one
from tessera.llm.quality import filter_quality
from tessera.llm.token_files import token_index
from tessera.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the threshold table; the others go (null and empty texts too). Every row has its own verdict."""
    return filter_quality(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8): the least doc_id (null last, then the text's digest).
    A row that is repeated stays once; texts without words are left alone."""
    return keep_one(docs, threshold=0.8, shingle=5)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item (0.8 of its shingles; an item of under five words as that run of words). Null texts
    stay; an empty benchmark takes nothing."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), threshold=0.8, shingle=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: weights 3, 1, 2 over the sources, 150 % of all words, at most two passes; a row per pass of a whole document. Null
    is a source of its own; documents without words are left out; repeated rows are taken one by one."""
    return mix(docs, weights=(3.0, 1.0, 2.0), budget_share=1.5, max_repeat=2)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files of the mix in ascending doc_id order (null first), read back: doc_id, start, n_tokens, ids_crc32. A null text
    is its end id alone; the passes of a document follow each other."""
    return token_index(docs, vocabulary=public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix_sources", mix_sources),
    ("token_ids", token_ids),
]

# The last stage runs a tokenizer, which isn't SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
