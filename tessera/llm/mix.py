"""Mixing sources to target weights by weighted fair queueing.

Every document gets a place in its source's shuffled order (a seeded hash), a
running total of the source's words in that order, and the virtual finish
time ``running total / target``. A source whose target exceeds its size goes
round again: the second pass continues the running total. Sorted by virtual
finish time, the passes of all sources interleave in proportion to their
targets at every point of the stream. ``mix`` range-sorts the passes of all
sources by it, takes the running total over the sorted partitions, and cuts the
stream where the total reaches the budget; it takes whole documents only.
``allocate`` counts words, for a mix that may end within a document: the targets
sum to the budget, so it is used up at virtual time 1, and each source gives its
words up to there, which meets every target to a word.

Scale: a source may hold any share of the rows. The running total is taken in
two levels: hash-range buckets of about ``bucket_rows`` rows per source are
summed (with map-side partial sums), the bucket totals are accumulated per
source, and only the rows inside a bucket are ordered together. No window
spans a whole source (ids that repeat without bound share a bucket; null ids are
told apart by their text). ``mix`` moves no text: what it takes of a source is a
prefix of the shuffled order in each pass, so one limit a source and pass, sent
to the scan, decides on every row. The one table of the sources (a row each) is small by
the nature of a mixture and is ordered in one task.

Defined results
- size is the number of words; a null or empty text has size 0 and is never taken;
- null is a source of its own, last in order; sources of size 0 have target 0;
- repeated rows are documents of their own; ties in the order are rows of equal
  hash and id, which are interchangeable; ``mix`` takes such rows together where
  they stand at the cut; an empty table gives an empty mix;
- a budget beyond ``max_repeat`` times all sizes stops there;
- the same rows give the same mix in any order and partitioning.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NON_SPACE, cut, internal, words

WEIGHTS = (3.0, 1.0, 2.0)


def source_targets(sizes: DataFrame, weights: Sequence[float] | Column = WEIGHTS, budget_share: float = 1.5,
                   max_repeat: int = 2) -> DataFrame:
    """Target words of each source from ``(source, source_size, ...)``.

    ``weights`` repeat over the sources in code point order, null last; a
    Column gives each source's weight instead. Water filling: the level at
    which capped sources (target = ``max_repeat`` * size) and the others
    (target = weight * level) use the budget exactly. Taking the first k sources
    in the order in which they fill up as full and the others as not, gives a
    level that is at most the true one, and equal to it for the right k, so the
    greatest over all k is the level.
    """
    order = Window.orderBy(F.col("source").isNull(), F.expr("cast(source as binary)"))
    if isinstance(weights, Column):
        weighed = sizes.withColumn("_w", weights)
    else:
        ws = F.array(*[F.lit(float(w)) for w in weights])
        weighed = sizes.withColumn("_w", F.get(ws, (F.row_number().over(order) - 1) % len(weights)))
    by_full = Window.orderBy("_full", F.col("source").isNull(), F.expr("cast(source as binary)"))
    rest = by_full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    return (weighed
            .withColumn("_cap", F.col("source_size") * F.lit(float(max_repeat)))
            .withColumn("_full", F.col("_cap") / F.col("_w"))
            .withColumn("_total", F.sum("source_size").over(whole) * F.lit(float(budget_share)))
            .withColumn("_before", F.coalesce(F.sum("_cap").over(
                by_full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
            # the level if every source before this one is full and none from here on
            .withColumn("_level", (F.col("_total") - F.col("_before")) / F.sum("_w").over(rest))
            .withColumn("target", F.least(F.col("_cap"), F.col("_w") * F.max("_level").over(whole)))
            .drop("_w", "_cap", "_full", "_total", "_before", "_level"))


def _key(seed: int, text: str, doc_id: str) -> tuple[Column, Column]:
    """The id as a string, and 60 bits of a seeded hash of it (of the text's digest where it is null)."""
    id_ = F.col(f"`{doc_id}`").cast("string")
    named = F.coalesce(id_, F.concat(F.lit(":"), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")))))
    return id_, F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), named)), 1, 15), 16, 10).cast("bigint")


def schedule(docs: DataFrame, weights: Sequence[float] | Column = WEIGHTS, budget_share: float = 1.5,
             max_repeat: int = 2, seed: int = 17, text: str = "text", source: str = "source", doc_id: str = "doc_id",
             bucket_rows: int = 10_000, keep: Sequence[str] | None = None) -> DataFrame:
    """One row per document: the ``keep`` columns in the struct ``doc``, plus ``source, size, source_size,
    target`` and ``served`` (the source's words before the document in the shuffled order).

    Without the text among ``keep`` the counted rows are slim and are cut with a checkpoint, so words are counted once.
    """
    keep = list(docs.columns if keep is None else keep)
    id_, key = _key(seed, text, doc_id)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"), F.col(f"`{source}`").alias("source"), id_.alias("id"),
        F.size(words(F.col(f"`{text}`"))).cast("bigint").alias("size"), key.alias("key"))
    if text not in keep:
        rows = cut(rows)
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_n"))
    targets = (source_targets(sizes, weights, budget_share, max_repeat)
               .withColumn("n_buckets", F.ceil(F.col("_n") / F.lit(bucket_rows)).cast("bigint")).drop("_n"))
    bucket = "least(n_buckets - 1, cast(floor(cast(key as double) / 1152921504606846976D * n_buckets) as bigint))"
    placed = (rows.alias("r").join(targets.alias("t"), F.expr("r.source <=> t.source"))
              .select("r.*", "source_size", "target", F.expr(bucket).alias("bucket")))
    in_bucket = (Window.partitionBy("source", "bucket").orderBy("key", "id", "size")
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = placed.withColumn("_upto", F.sum("size").over(in_bucket))
    totals = placed.groupBy("source", "bucket").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("source", "bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    return (ranked.alias("r").join(totals.alias("b"), F.expr("r.source <=> b.source and r.bucket = b.bucket"))
            .select("doc", "r.source", "id", "key", "size", "source_size", "target",
                    (F.col("_start") + F.col("_upto") - F.col("size")).alias("served")))


def _served(n_pass) -> Column:
    """Words of a document that its pass gives before virtual time 1."""
    left = F.round("target").cast("bigint") - n_pass * F.col("source_size") - F.col("served")
    return F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), left))


def allocate(plan: DataFrame, max_repeat: int = 2) -> DataFrame:
    """Add ``taken``, the words the mix takes of each document over all passes, and ``finish``, the virtual
    finish time of its first pass; rows come range-sorted by it, those past the cut last."""
    taken = sum((_served(F.lit(p)) for p in range(max_repeat)), F.lit(0).cast("bigint"))
    finish = F.when(F.col("target") > 0, (F.col("served") + F.col("size")) / F.col("target"))
    out = plan.withColumn("taken", taken).withColumn("finish", F.coalesce(finish, F.lit(float("inf"))))
    return out.repartitionByRange("finish", "source", "served").sortWithinPartitions("finish", "source", "served")


def entries(plan: DataFrame, max_repeat: int = 2, ordered: bool = True) -> DataFrame:
    """The mixed stream: a row per pass of a document that the budget reaches, with ``pass``, ``taken`` (words)
    and ``finish`` (virtual finish time, cut at 1), range-sorted over the whole stream by it."""
    passes = (plan.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(max_repeat - 1))))
              .withColumn("taken", _served(F.col("pass"))).where("taken > 0")
              .withColumn("finish", F.least(F.lit(1.0), F.expr("(pass * source_size + served + size) / target"))))
    if not ordered:
        return passes
    return passes.repartitionByRange("finish", "source", "served").sortWithinPartitions("finish", "source", "served")


def _upto(rows: DataFrame, order: Sequence[str], value: str) -> DataFrame:
    """Running total of ``value`` over all rows in a global order: a range sort, written once, and the totals of its partitions
    (a row each) carried over."""
    dealt = cut(rows.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()))
    each = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy("_pid").agg(F.sum(value).alias("_s")).select("_pid", F.coalesce(F.sum("_s").over(each), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (dealt.withColumn("_in", F.sum(value).over(inside)).join(F.broadcast(before), "_pid")
            .withColumn("upto", F.col("_before") + F.col("_in")).drop("_pid", "_in", "_before"))


def limits(plan: DataFrame, max_repeat: int = 2) -> DataFrame:
    """``(source, limits)``: for each pass that the budget reaches, the last (key, id) it takes of the source's shuffled order.
    A row a source."""
    plan = cut(plan.where("size > 0 and target > 0"))
    budget = plan.groupBy("source").agg(F.first("target").alias("t")).agg(F.sum("t")).first()[0] or 0.0
    passes = (plan.select("source", "id", "key", "size", "source_size", "target", "served")
              .withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(max_repeat - 1))))
              .withColumn("finish", F.expr("(pass * source_size + served + size) / target")))
    stream = _upto(passes, ["finish", "source", "served", "key", "id"], "size")
    last = (stream.where(F.col("upto") <= F.lit(budget + 0.5)).groupBy("source", "pass")
            .agg(F.max(F.struct("key", F.coalesce("id", F.lit("")).alias("id"))).alias("last")))
    return last.groupBy("source").agg(F.collect_list("last").alias("limits"))


def mix(docs: DataFrame, weights: Sequence[float] | Column = WEIGHTS, budget_share: float = 1.5, max_repeat: int = 2,
        seed: int = 17, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """The mix as documents with the input's columns: a whole row for each pass that the budget reaches."""
    plan = schedule(docs, weights, budget_share, max_repeat, seed, text, source, doc_id, keep=[doc_id])
    reach = limits(plan, max_repeat)
    id_, key = _key(seed, text, doc_id)
    own, all_, n, at = (internal(x, docs.columns) for x in ("from", "limits", "passes", "at"))
    rows = docs.where(F.col(f"`{text}`").rlike(NON_SPACE)).withColumn(at, F.struct(key.alias("key"), F.coalesce(id_, F.lit("")).alias("id")))
    told = rows.join(F.broadcast(reach.select(F.col("source").alias(own), F.col("limits").alias(all_))), F.col(f"`{source}`").eqNullSafe(F.col(own)))
    taken = told.withColumn(n, F.explode(F.filter(F.col(all_), lambda x: F.col(at) <= x)))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns])
