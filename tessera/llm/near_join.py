"""N-gram Jaccard self-join of documents with Bayesian candidate pruning.

Documents are sets of five-word shingles (lower-cased words, runs outside ASCII white space; a text of one to four
words is a single shingle). Two documents are linked when the Jaccard similarity of their sets is at least the
threshold. Equal sets form a class, compared once; see ``lsh`` for the comparison. With 28 bands of 5 MinHash values
a pair at a similarity of 0.8 is missed with a probability of 1.5e-5, one at 0.9 with 2e-11.

Defined results
- null text, empty text, text without words: no shingle, so no link, a group of its own (class_id = doc_id);
- ``class_id`` is the least doc_id of the connected group (null if all its ids are null);
- repeated rows (equal doc_id and text) are copies: each row is returned, and each counts as a link of the others;
- an empty table gives an empty result; extra columns are ignored by ``near_links``, kept by ``keep_one``.
"""

from __future__ import annotations

from typing import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, internal, join_back
from .components import connected_components
from .lsh import link_classes
from .shingles import band_hashes, distinct, minhash, set_key, word_shingles

BANDS, ROWS = 28, 5
SHINGLE = 5


def _flat_sets(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def _sketch(shingle: int):
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                values, off = word_shingles(part.column(2), shingle)
                sets = list(distinct(values, off))
                sig = minhash(*_flat_sets(sets), BANDS * ROWS)
                bands = band_hashes(sig, ROWS)
                some = np.array([len(s) > 0 for s in sets])
                offsets = np.concatenate([[0], np.cumsum(np.where(some, BANDS, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array([set_key(s) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands[some].ravel(), pa.int64()))],
                    names=["id", "tk", "key", "n_items", "bands"])
    return run


def _load(shingle: int):
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                values, off = word_shingles(part.column(1), shingle)
                sets = list(distinct(values, off))
                sig = minhash(*_flat_sets(sets), BANDS * ROWS)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([a.tobytes() + s.tobytes() for a, s in zip(sig, sets)], pa.binary())],
                    names=["key", "data"])
    return run


def _decode(data: list[bytes]) -> tuple[np.ndarray, Callable[[np.ndarray], list[np.ndarray]]]:
    head = 4 * BANDS * ROWS
    sig = np.frombuffer(b"".join(d[:head] for d in data), np.uint32).reshape(len(data), BANDS * ROWS)
    return sig, lambda at: [np.frombuffer(data[i], np.uint64, offset=head) for i in at]


def near_links(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = 0.8,
               shingle: int = SHINGLE, tolerance: float = 1e-5) -> DataFrame:
    """A row per document: ``id``, ``tk`` (digest of the text), ``class_id``, ``class_tk`` (the text digest of the
    document that stands for its group), ``class_n`` (rows equal to that one), ``copies`` (rows of an equal set,
    itself included) and ``links`` (documents at the threshold or above, itself not)."""
    id_type = docs.schema[doc_id].dataType.simpleString()
    body = docs.select(F.col(f"`{doc_id}`").alias("id"), F.unhex(F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")))).alias("tk"),
                       F.col(f"`{text}`").alias("text"))
    rows = cut(body.mapInArrow(_sketch(shingle), f"id {id_type}, tk binary, key binary, n_items bigint, bands array<bigint>"))
    # a class per set: its rows, one of its texts, and its least document
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "tk"))
    classes = cut(rows.where("key is not null").groupBy("key")
                  .agg(F.count("*").alias("n"), F.max("n_items").alias("n_items"), F.first("bands").alias("bands"),
                       first.alias("first")))

    def payload(candidates: DataFrame) -> DataFrame:
        wanted = candidates.join(classes, "key").select("key", F.col("first.tk").alias("tk"))
        texts = body.select("tk", "text").join(wanted, "tk").groupBy("key").agg(F.min("text").alias("text"))
        return texts.mapInArrow(_load(shingle), "key binary, data binary")

    found = cut(link_classes(classes, payload, _decode, threshold, tolerance))
    links = found.groupBy("key").agg(F.sum("links").alias("_links"))
    roots = connected_components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    grouped = (classes.select("key", "n", "first").join(links, "key", "left")
               .join(roots.withColumnRenamed("node", "key"), "key", "left")
               .where("n > 1 or _links is not null").withColumn("root", F.coalesce("root", "key")))
    grouped = cut(grouped)
    stands = cut(grouped.groupBy("root").agg(F.min("first").alias("stand"), F.count("*").alias("_n")))
    decided = cut(join_back(grouped, stands, "root", "_n")
                  .select("key", F.col("n").alias("copies"), (F.col("n") - 1 + F.coalesce("_links", F.lit(0))).alias("links"),
                          F.col("stand.id").alias("class_id"), F.col("stand.tk").alias("class_tk"), F.col("n").alias("_n")))
    return (join_back(rows.select("id", "tk", "key"), decided, "key", "_n", "left")
            .select("id", "tk", F.when(F.col("copies").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("class_tk", "tk").alias("class_tk"), F.coalesce("copies", F.lit(1)).cast("bigint").alias("copies"),
                    F.coalesce("links", F.lit(0)).cast("bigint").alias("links")))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = 0.8,
             shingle: int = SHINGLE) -> DataFrame:
    """The documents without near copies: of each group the one with the least doc_id (then least text digest) stays,
    as one row if it is repeated. Columns and other rows are as in the input."""
    links = near_links(docs, text, doc_id, threshold, shingle)
    grouped = links.where("links > 0")
    stands = F.expr("id <=> class_id and tk = class_tk")
    gone = grouped.where(~stands).select("id", "tk").distinct().withColumn("_what", F.lit("gone"))
    repeated = (grouped.where(stands).groupBy("id", "tk").count().where("count > 1")
                .select("id", "tk").withColumn("_what", F.lit("once")))
    marks = cut(gone.unionByName(repeated))
    what, tk = internal("what", docs.columns), internal("tk", docs.columns)
    marked = (docs.alias("d").join(
        marks.alias("m"), (F.col(f"d.`{doc_id}`").eqNullSafe(F.col("m.id")))
        & (F.unhex(F.md5(F.coalesce(F.col(f"d.`{text}`"), F.lit("")))) == F.col("m.tk")), "left")
        .select(*[F.col(f"d.`{c}`") for c in docs.columns], F.col("m._what").alias(what), F.col("m.tk").alias(tk)))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    plain = marked.where(F.col(what).isNull()).select(*columns)
    once = marked.where(F.col(what) == "once").dropDuplicates([doc_id, tk]).select(*columns)
    return plain.unionByName(once)
