"""Importance resampling towards a target text collection, by hashed word n-grams.

A document is normalised to lower-case (A-Z) words of ASCII letters, digits and non-ASCII characters, joined by one space, and
scanned once: the running CRC-32 at the end of each word is kept. The CRC of any n-gram follows from two of these by
cancelling the prefix with a GF(2) shift (``crc.py``); its remainder by the number of buckets is the feature's bucket.

The corpus and the target are counted by bucket (a partial count per batch, then one sum over the buckets, whose number
is a parameter). A bucket's gain is the smoothed log ratio of its shares in milli-nats; a document's weight is the floored
mean gain of its features, and its score adds Gumbel noise hashed from its id, so the highest scores are a draw without
replacement in proportion to the weights. Ranks come from a range sort of the slim rows, not from one task.

Defined results
- null or empty text, or one without words: no features, weight 0, never drawn unless ``min_words`` is 0;
- null doc_id: hashed as an empty string, after all others of its score; equal ids get equal noise; ties go to the smaller id; equal
  rows are drawn one by one;
- an empty corpus gives an empty table; an empty target gives every bucket a gain by smoothing alone;
- texts are worked on in pieces of about ``PIECE`` bytes cut at a word end, so a text of any length takes bounded memory;
- other columns are ignored.
"""

from __future__ import annotations

import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.position import with_position
from .common import cut
from .crc import shift, step

PIECE = 1 << 18
_KEEP = {*range(48, 58), *range(97, 123), *range(128, 256)}
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c in _KEEP else 32 for c in range(256))


def pieces(text: bytes, longest: int, size: int = PIECE):
    """Runs of a text's words of about ``size`` bytes; each but the first begins with the ``longest - 1`` words before it.
    Gives (words, number of words carried over)."""
    at, tail = 0, []
    while at < len(text):
        end = at + size
        if end < len(text):
            end = text.find(b" ", end)
            end = len(text) if end < 0 else end
        words = text[at:end].split()
        if words:
            yield tail + words, len(tail)
            tail = (tail + words)[max(0, len(tail) + len(words) - longest + 1):] if longest > 1 else []
        at = end


def buckets(texts: pa.Array, longest: int, n_buckets: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Buckets of the n-grams of 1 to ``longest`` words of all texts, the text of each, and the texts' numbers of words."""
    found, owner = [], []
    n_words = np.zeros(len(texts), np.int64)
    words, runs, total = [], [], 0  # words in work and their runs: (text, first word, end, carried over)

    def flush():
        if not words:
            return
        length = np.fromiter(map(len, words), np.int64, len(words))
        # one scan over all runs; a run's CRCs are cut loose from the words before it like any substring's
        end = np.fromiter(accumulate((b" " + w for w in words), lambda c, w: zlib.crc32(w, c), initial=0), np.uint32, len(words) + 1)[1:]
        begin = step(np.concatenate([np.zeros(1, np.uint32), end[:-1]]), 32)
        last = np.empty(len(words), np.int64)
        fresh = np.zeros(len(words), np.int64)
        text = np.empty(len(words), np.int64)
        for t, a, z, carried in runs:
            last[a:z], text[a:z] = z, t
            fresh[a:z] = a + carried
        upto = np.cumsum(length + 1)
        at = np.arange(len(words))
        for n in range(1, longest + 1):
            first = at[:len(words) - n + 1]
            first = first[(first + n <= last[first]) & (first + n > fresh[first])]
            size = upto[first + n - 1] - upto[first] + length[first]
            crc = end[first + n - 1] ^ shift(begin[first], size)
            found.append((crc % np.uint32(n_buckets)).astype(np.int64))
            owner.append(text[first])
        words.clear()
        runs.clear()

    for t, raw in enumerate(texts):
        raw = raw.as_py()
        if not raw:
            continue
        for run, carried in pieces(raw.encode().translate(_FOLD), longest):
            n_words[t] += len(run) - carried
            runs.append((t, len(words), len(words) + len(run), carried))
            words += run
            total += len(run)
            if len(words) >= PIECE // 8:
                flush()
    flush()
    return found, owner, n_words


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = 2, n_buckets: int = 10_000) -> DataFrame:
    """``(bucket, n)``: features of all texts by bucket (only buckets that occur)."""
    def run(batches):
        mine = np.zeros(n_buckets, np.int64)  # of the whole task
        for b in batches:
            for x in buckets(b.column(0), longest, n_buckets)[0]:
                mine += np.bincount(x, minlength=n_buckets)
        at = np.flatnonzero(mine)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(mine[at], pa.int64())], names=["bucket", "n"])

    parts = texts.select(F.col(f"`{text}`").cast("string")).mapInArrow(run, "bucket bigint, n bigint")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, n_buckets: int = 10_000) -> DataFrame:
    """``(bucket, gain)`` for every bucket: floor(1000 ln) of the target's smoothed share over the corpus's."""
    every = corpus.sparkSession.range(n_buckets).withColumnRenamed("id", "bucket")
    both = (every.join(corpus.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
            .select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t")))
    totals = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))  # one row
    ratio = ((F.col("t") + 1) * (F.col("all_s") + n_buckets)).cast("double") / ((F.col("s") + 1) * (F.col("all_t") + n_buckets)).cast("double")
    return both.crossJoin(F.broadcast(totals)).select("bucket", F.floor(1000 * F.log(ratio)).cast("bigint").alias("gain"))


def weights(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text", longest: int = 2) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` of every row; ``gain`` has an entry per bucket."""
    n_buckets = len(gain)
    body = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = body.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            found, owner, n_words = buckets(b.column(1), longest, n_buckets)
            n, total = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            for x, o in zip(found, owner):
                n += np.bincount(o, minlength=b.num_rows)
                np.add.at(total, o, gain[x])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words), pa.array(n), pa.array(total // np.maximum(n, 1))],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    return body.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", longest: int = 2, n_buckets: int = 10_000,
             seed: int = 7, min_words: int = 20, draw_percent: int = 25) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score, rank)`` of every row; rank 1, 2, 3 ... of the drawn, null for the others.

    Drawn are the highest scores, floor(draw_percent * N / 100) of the N documents with at least ``min_words`` words.
    The gains (``n_buckets`` numbers) are the only thing that passes through the driver.
    """
    table = gains(bucket_counts(docs, text, longest, n_buckets), bucket_counts(target, text, longest, n_buckets), n_buckets)
    gain = np.zeros(n_buckets, np.int64)
    for r in table.collect():
        gain[r["bucket"]] = r["gain"]
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((noise + 0.5) / F.lit(4294967296.0)))).cast("bigint")
    rows = cut(weights(docs, gain, doc_id, text, longest).withColumn("score", F.col("weight") + gumbel))
    long_enough = F.col("n_words") >= min_words
    drawn = rows.where(long_enough).agg(F.floor(F.count("*") * draw_percent / 100)).first()[0]
    order = with_position(rows.where(long_enough).withColumn("_least", -F.col("score")).withColumn("_null", F.col("doc_id").isNull()),
                          ["_least", "_null", "doc_id"], "_pos")
    ranked = order.select("doc_id", "n_words", "n_features", "weight", "score",
                          F.when(F.col("_pos") < drawn, F.col("_pos") + 1).cast("bigint").alias("rank"))
    return ranked.unionByName(rows.where(~long_enough).withColumn("rank", F.lit(None).cast("bigint")))
