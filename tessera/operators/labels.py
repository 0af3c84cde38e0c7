"""Label distributions, row batches and the offline sentiment classifier."""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col_
from .position import with_position

BATCH_SIZE = 20
LABELS = ("Positive", "Negative", "Neutral")

# A small sentiment lexicon (offline stand-in for the injected
# classifier). Weight +1 / -1.
POSITIVE_WORDS = ("good", "great", "excellent", "love", "best", "happy", "amazing", "perfect",
                  "nice", "wonderful", "bon", "bien", "gut", "bueno")
NEGATIVE_WORDS = ("bad", "poor", "terrible", "hate", "worst", "awful", "broken", "horrible",
                  "disappointed", "waste", "mauvais", "schlecht", "malo")
TOKEN_SPLIT = r"[^\p{L}]+"


def lexicon_score(text) -> Column:
    """(# positive tokens) - (# negative tokens) over letter tokens, native.
    (Measured a little faster than a per-token map lookup.)"""
    toks = F.split(F.lower(col_(text)), TOKEN_SPLIT)
    pos = F.size(F.filter(toks, lambda t: t.isin(list(POSITIVE_WORDS))))
    neg = F.size(F.filter(toks, lambda t: t.isin(list(NEGATIVE_WORDS))))
    return pos - neg


def sentiment_label(score) -> Column:
    s = col_(score)
    return F.when(s > 0, "Positive").when(s < 0, "Negative").otherwise("Neutral")


def classify(df: DataFrame, text: str, classifier: Callable[[Column], Column] | None = None,
             label: str = "label") -> DataFrame:
    """Add a label column by the injected classifier, a function of the text
    column (native or a pandas UDF); the default is the offline lexicon."""
    run = classifier or (lambda t: sentiment_label(lexicon_score(t)))
    return df.withColumn(label, run(F.col(text)))


def distribution(df: DataFrame, label: str, classes: Sequence[str] = ()) -> DataFrame:
    """(label, count, total, percentage) in one pass over the data; the given
    ``classes`` appear with count 0 when no row has them.

    The total is a window over the aggregated counts (one row per class), not
    over the input rows, so the single-partition window sees a handful of rows.
    """
    counts = df.groupBy(label).agg(F.count("*").cast("bigint").alias("count"))
    if classes:
        none = df.sparkSession.createDataFrame([(c, 0) for c in classes], "label string, count bigint")
        counts = (counts.unionAll(none.select(F.col("label").cast(df.schema[label].dataType), "count"))
                  .groupBy(label).agg(F.sum("count").alias("count")))
    total = F.sum("count").over(Window.partitionBy(F.lit(0))).cast("bigint")
    return (counts.withColumn("total", total)
            .withColumn("percentage", F.when(F.col("total") > 0, F.col("count") * 100.0 / F.col("total"))))


def batches(df: DataFrame, order: list[str], size: int = BATCH_SIZE) -> DataFrame:
    """Adds 0-based ``pos`` and ``batch_id = pos div size`` in the given order."""
    return with_position(df, order).withColumn("batch_id", F.floor(F.col("pos") / size).cast("bigint"))


def batch_distribution(df: DataFrame, order: list[str], label: str, size: int = BATCH_SIZE) -> DataFrame:
    """Counts per (batch, label) with per-batch and grand totals (rollup);
    percentage is within the batch."""
    b = batches(df, order, size)
    r = b.rollup("batch_id", label).agg(F.count("*").cast("bigint").alias("count"),
                                        F.grouping(label).alias("_g"))
    # the batch total is the rollup row of the batch; a window over the
    # (small) rollup output partitioned by batch picks it up without a self-join
    batch_total = F.max(F.when(F.col("_g") == 1, F.col("count"))).over(Window.partitionBy("batch_id"))
    return r.withColumn("percentage", F.col("count") * 100.0 / batch_total).drop("_g")


def prompt_batches(df: DataFrame, order: list[str], text: str, size: int = BATCH_SIZE,
                   header: str = "") -> DataFrame:
    """One prompt per batch of ``size`` rows: header + 'Reviews: ' + JSON list
    of the texts in order. Groups are bounded by ``size``."""
    b = batches(df, order, size)
    agg = b.groupBy("batch_id").agg(
        F.count("*").cast("bigint").alias("n_reviews"),
        F.array_sort(F.collect_list(F.struct("pos", F.col(text).alias("t")))).alias("_items"))
    return agg.select("batch_id", "n_reviews",
                      F.concat(F.lit(header + "Reviews: "), F.to_json(F.transform("_items", lambda x: x["t"])))
                      .alias("prompt"))
