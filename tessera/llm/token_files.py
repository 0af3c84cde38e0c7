"""Token-id files: documents in ascending id order as Simple-8b blocks, written and read by Spark.

A file is a run of segments, each a whole number of 64-bit little-endian words:

    magic, part, segment, documents, ids, block size, words      (7 words)
    document ids, null flags, tokens of each document            (a word each per document)
    offsets of the blocks, one more for the end
    packed words
    trailer                                                      (1 word, the writer's line separator)

Documents never span segments; a segment closes after about ``segment_ids`` ids, and a file after a few segments, so a
reader holds one small file at a time. Spark's own file writer commits the files: a lost task leaves nothing behind,
and any store that Spark can write to will do. ``part`` and ``segment`` give the order of all ids; the place of a
segment's first id is a running sum over the parts (a row each) and over the segments of a part.

Defined results
- null or empty text: only the end id; null doc_id: first in order;
- documents of equal id follow by a hash of their text; equal rows are interchangeable;
- very long texts make a segment of their own; an empty table gives no file and an empty result;
- extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.partitioning import pieces
from .common import cut, shared_path
from .encode import GROUP, encoder
from .simple8b import BLOCK, pack, unpack

# Fixed values of the format.
MAGIC = int.from_bytes(b"TSIDS8B1", "little")
TRAILER = "TS8-END\n"
HEAD = 7


def _segment(part: int, number: int, docs: list[tuple], block: int) -> bytes:
    ids = np.frombuffer(b"".join(d[1] for d in docs), "<u4")
    words, offsets = pack(ids, block)
    head = np.array([MAGIC, part, number, len(docs), len(ids), block, len(words)], "<u8")
    key = np.array([0 if d[0] is None else d[0] for d in docs], "<i8")
    null = np.array([d[0] is None for d in docs], "<u8")
    count = np.array([len(d[1]) // 4 for d in docs], "<u8")
    return b"".join(x.tobytes() for x in (head, key, null, count, offsets.astype("<u8"), words.astype("<u8")))


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int, text: str = "text",
                      doc_id: str = "doc_id", block: int = BLOCK, segment_ids: int = 500_000,
                      segments_per_file: int = 8) -> None:
    """Encode every text, append ``end_id``, and write the files below ``path``."""
    end = np.array([end_id], "<u4").tobytes()
    body = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    # the texts order documents of equal id only; without such the range bounds are found from the ids alone
    order = ["doc_id"]
    if body.groupBy("doc_id").count().where("count > 1").limit(1).count():
        body, order = body.withColumn("_tie", F.xxhash64("text")), ["doc_id", "_tie"]
    ordered = body.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches):
        part, number, pending, size = TaskContext.get().partitionId(), 0, [], 0
        enc = encoder(vocabulary)
        for b in (part for batch in batches for part in pieces(batch, 2 * GROUP, batch.num_rows)):
            flat, count = enc.encode_all(b.column(1))
            raw, upto = flat.view(np.uint8), 4 * np.cumsum(count)
            for key, a, z in zip(b.column(0).to_pylist(), (upto - 4 * count).tolist(), upto.tolist()):
                ids = raw[a:z].tobytes() + end
                pending.append((key, ids))
                size += len(ids) // 4
                if size >= segment_ids:
                    yield pa.RecordBatch.from_arrays([pa.array([_segment(part, number, pending, block)], pa.binary())], names=["value"])
                    number, pending, size = number + 1, [], 0
        if pending:
            yield pa.RecordBatch.from_arrays([pa.array([_segment(part, number, pending, block)], pa.binary())], names=["value"])

    (ordered.select("doc_id", "text").mapInArrow(run, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", TRAILER).option("maxRecordsPerFile", segments_per_file).text(path))


def segments(content: bytes):
    """The segments of one file: (part, segment, document ids, tokens of each, ids)."""
    at, tail = 0, TRAILER.encode()
    while at < len(content):
        magic, part, number, n_docs, n_ids, block, n_words = (int(x) for x in np.frombuffer(content, "<u8", HEAD, at))
        if magic != MAGIC:
            raise ValueError(f"no segment at byte {at}")
        at += 8 * HEAD
        n_blocks = -(-n_ids // block)
        key, null, count, offsets, words = (
            np.frombuffer(content, kind, n, at + 8 * skip)
            for kind, n, skip in (("<i8", n_docs, 0), ("<u8", n_docs, n_docs), ("<u8", n_docs, 2 * n_docs),
                                  ("<u8", n_blocks + 1, 3 * n_docs), ("<u8", n_words, 3 * n_docs + n_blocks + 1)))
        at += 8 * (3 * n_docs + n_blocks + 1 + n_words)
        if content[at:at + 8] != tail:
            raise ValueError(f"segment without end at byte {at}")
        at += 8
        yield part, number, [None if z else int(k) for k, z in zip(key, null)], count.astype(int), unpack(words, offsets, n_ids, block)


def _heads(batches):
    """Part, number and ids of every segment, from the heads; nothing is unpacked."""
    for b in batches:
        found = []
        for content in b.column(0):
            content, at = memoryview(content.as_buffer()), 0
            while at < len(content):
                magic, part, number, n_docs, n_ids, block, n_words = (int(x) for x in np.frombuffer(content, "<u8", HEAD, at))
                if magic != MAGIC:
                    raise ValueError(f"no segment at byte {at}")
                found.append((part, number, n_ids))
                at += 8 * (HEAD + 3 * n_docs + -(-n_ids // block) + 1 + n_words + 1)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else ((), (), ()))], names=["part", "segment", "_n"])


def _digests(batches):
    for b in batches:
        for content in b.column(0):
            for part, number, keys, count, ids in segments(content.as_py()):
                raw = ids.astype("<u4").tobytes()
                upto = np.cumsum(count)
                start = upto - count
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * len(keys), pa.int64()), pa.array([number] * len(keys), pa.int64()),
                    pa.array(keys, pa.int64()), pa.array(start, pa.int64()), pa.array(count, pa.int64()),
                    pa.array([zlib.crc32(raw[4 * a:4 * z]) for a, z in zip(start, upto)], pa.int64())],
                    names=["part", "segment", "doc_id", "at", "n_tokens", "ids_crc32"])


def _lists(batches):
    for b in batches:
        for content in b.column(0):
            for part, number, keys, count, ids in segments(content.as_py()):
                off = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * len(keys), pa.int64()), pa.array([number] * len(keys), pa.int64()),
                    pa.array(keys, pa.int64()), pa.ListArray.from_arrays(pa.array(off), pa.array(ids.astype(np.int64)))],
                    names=["part", "segment", "doc_id", "ids"])


def _content(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(part, segment, doc_id, ids)`` of every document in the files."""
    return _content(spark, path).mapInArrow(_lists, "part bigint, segment bigint, doc_id bigint, ids array<bigint>")


def read_token_index(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from its decoded ids."""
    rows = _content(spark, path).mapInArrow(
        _digests, "part bigint, segment bigint, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint")
    # the ids before a segment follow from the heads, so the files are decoded once
    sizes = cut(_content(spark, path).mapInArrow(_heads, "part bigint, segment bigint, _n bigint"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    parts = (sizes.groupBy("part").agg(F.sum("_n").alias("_p"))
             .select("part", F.coalesce(F.sum("_p").over(before), F.lit(0)).alias("_part_start")))
    starts = (sizes.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(parts, "part")
              .select("part", "segment", (F.col("_part_start") + F.col("_in")).alias("_start")))
    return (rows.join(starts, ["part", "segment"])
            .select("doc_id", (F.col("_start") + F.col("at")).cast("bigint").alias("start"), "n_tokens", "ids_crc32"))


def token_index(docs: DataFrame, vocabulary: str, end_id: int, **options) -> DataFrame:
    """Write the files into a fresh folder below the shared checkpoint folder and read their index back."""
    path = shared_path(docs.sparkSession, "token-ids")
    write_token_files(docs, path, vocabulary, end_id, **options)
    return read_token_index(docs.sparkSession, path)
