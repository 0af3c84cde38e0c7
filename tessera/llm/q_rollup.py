"""Query of the token counts. No SQL: a tokenizer isn't SQL; tested against the tokenizer and plain sums."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ..sources.tables import table
from .common import shared_path, words, written
from .registry import register
from .rollup import commit, counted, deletes, inserts, revisions, totals, with_counts


def counted_documents(docs):
    """``doc_id, source, lang``, the text's digest ``k``, and the counts of each text and, as ``new_``, of the text without
    its repeated lines, written once: a later batch takes a document out with the counts it went in with."""
    kept = F.array_join(F.array_distinct(F.split(F.coalesce("text", F.lit("")), "\n")), "\n")
    both = docs.select("doc_id", "source", "lang", F.coalesce("text", F.lit("")).alias("text"), kept.alias("kept"))
    slim = both.select("doc_id", "source", "lang", F.unhex(F.md5("text")).alias("k"), F.size(words(F.col("text"))).alias("words"),
                       F.size(words(F.col("kept"))).alias("new_words"), "text", "kept")
    return written(with_counts(slim, {"text": "bpe", "kept": "new_bpe"}, public_tokenizers.path("word_bpe_49k.json")), "token-counted")


def survivors(rows):
    """One row of each text: the least (id, source, lang), null last. Rows equal in these are interchangeable."""
    order = [x for c in ("doc_id", "source", "lang") for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]
    rest = [c for c in rows.columns if c not in ("doc_id", "source", "lang", "k")]
    return rows.groupBy("k").agg(F.min(F.struct(*order, *rest)).alias("s")).select("k", *[f"s.{c}" for c in rows.columns if c != "k"])


def maintain(spark, docs, store):
    """The three batches over the documents, the last one offered twice."""
    rows = counted_documents(docs)
    old = {"words/1": F.col("words"), "word_bpe_49k": F.col("bpe")}
    new = {"words/1": F.col("new_words"), "word_bpe_49k": F.col("new_bpe")}
    commit(spark, store, 0, inserts(counted(rows, old)))
    # the later copies go: in sum, all rows out and those that stay in, so no row is joined to the others of its text
    live = survivors(rows)
    commit(spark, store, 1, deletes(counted(rows, old)).unionByName(inserts(counted(live, old))))
    change = revisions(counted(live, old), counted(live, new))
    commit(spark, store, 2, change)
    commit(spark, store, 2, change)
    return totals(spark, store)


@register("op6_token_count_rollups")
def op6_token_count_rollups(spark, sf_dir):
    """Counts of all documents by two tokenizer versions after three batches: every document is inserted; later exact
    copies (per text, all but one) are deleted; the counts of the documents that are left are revised, by both versions, to
    leave out repeated lines. The last batch is offered twice."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return maintain(spark, docs, shared_path(spark, "token-counts"))
