"""Benchmark decontamination: size-partitioned MinHash containment search of short items inside long documents.

Sets are five-word shingles (lower-cased words). A document of 20,000 words and an item of 40 have a Jaccard
similarity of 0.002, so signatures of both sides, banded, would need thousands of values. The containment form of
MinHash is used instead: only the short side is sketched, by the shingles of the least hash values, and a sketch
value is looked up among all shingles of the document. Items are partitioned by the size of their sets (powers of
two). A partition's sketch takes just as many values as its sizes need: with n shingles of which at most m may be
missing, m + 1 values make a miss impossible; ``SKETCH`` values (a miss has a probability below 0.2^12 = 4e-9 at a
threshold of 0.8) are enough for larger ones. Documents with fewer shingles than a partition's least possible overlap
skip it. What the sketch retrieves is verified on the whole sets.

Scale: documents are read once and never shuffled, whole texts, no caps. The items go to the tasks in blocks of at
most about ``block_items`` shingles (32 MB by default); more items mean more blocks, each a pass, never a larger
broadcast.

Defined results
- null or empty text (either side): no match; an item of fewer than ``shingle`` words is one shingle, its run of words, and
  matches the documents that hold this run;
- repeated documents or items each give their own rows; empty tables give empty results;
- extra columns stay (``decontaminate``) or are ignored (``contained_items``).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .shingles import mix64, word_hashes, word_shingles

SKETCH = 12
_FILTER_BITS = 20


@dataclass
class _Partition:
    least: int  # shingles that a document must have at least
    values: np.ndarray  # sorted sketch values
    items: np.ndarray  # the item of each value


class ItemIndex:
    """Sketches and sets of one block of items."""

    def __init__(self, ids: list, sets: list[np.ndarray], threshold: float, words: list[int] | None = None, shingle: int = 5):
        """``words``: the number of words of each item; below ``shingle`` its set is the hash of its run of words."""
        self.ids, self.sets, self.threshold, self.shingle = ids, sets, threshold, shingle
        words = np.array(words if words is not None else [shingle] * len(ids))
        # items of one short length: the hashes of their runs, sorted, and whose they are
        self.short = {}
        for n in np.unique(words[words < shingle]):
            own = np.flatnonzero(words == n)
            runs = np.array([sets[i][0] for i in own])
            order = np.argsort(runs, kind="stable")
            self.short[int(n)] = (runs[order], own[order])
        size = np.array([len(s) for s in sets])
        classes = np.where(words < shingle, -1, np.floor(np.log2(np.maximum(size, 1))).astype(int))
        self.partitions = []
        for c in np.unique(classes[classes >= 0]):
            values, items = [], []
            for i in np.flatnonzero(classes == c):
                missing = int((1 - threshold) * size[i] + 1e-9)
                k = min(missing + 1, SKETCH, size[i])
                order = np.argsort(mix64(sets[i] ^ np.uint64(0x5BD1E995)), kind="stable")[:k]
                values.append(sets[i][order])
                items.append(np.full(k, i))
            values, items = np.concatenate(values), np.concatenate(items)
            order = np.argsort(values, kind="stable")
            self.partitions.append(_Partition(int(np.ceil(threshold * 2**c - 1e-9)), values[order], items[order]))
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        for p in self.partitions:
            self.seen[p.values >> np.uint64(64 - _FILTER_BITS)] = True

    def search(self, texts: pa.Array) -> list[tuple[int, int, int]]:
        """``find`` in whole texts, and the short items."""
        out = self.find(*word_shingles(texts, self.shingle))
        for n, (runs, items) in self.short.items():
            values, offsets = word_shingles(texts, n)
            lo, hi = np.searchsorted(runs, values, "left"), np.searchsorted(runs, values, "right")
            at = np.flatnonzero(hi > lo)
            doc = np.searchsorted(offsets, at, "right") - 1
            out += sorted({(int(d), int(i), 1) for d, x in zip(doc, at) for i in items[lo[x]:hi[x]]})
        return out

    def find(self, values: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """(document, item, shared shingles) of all items contained at the threshold or above."""
        at = np.flatnonzero(self.seen[values >> np.uint64(64 - _FILTER_BITS)])
        if not len(at):
            return []
        v = values[at]
        doc = np.searchsorted(offsets, at, "right") - 1
        size = np.diff(offsets)
        pairs = set()
        for p in self.partitions:
            lo, hi = np.searchsorted(p.values, v, "left"), np.searchsorted(p.values, v, "right")
            for x in np.flatnonzero((hi > lo) & (size[doc] >= p.least)):
                pairs.update((int(doc[x]), int(i)) for i in p.items[lo[x]:hi[x]])
        out, own, of = [], None, -1
        for d, i in sorted(pairs):
            if d != of:
                own, of = np.unique(values[offsets[d]:offsets[d + 1]]), d
            item = self.sets[i]
            place = np.minimum(np.searchsorted(own, item), len(own) - 1)
            shared = int((own[place] == item).sum())
            if shared >= self.threshold * len(item) - 1e-9:
                out.append((d, i, shared))
        return out


def _item_sets(shingle: int):
    def run(batches):
        for b in batches:
            n = np.diff(word_hashes(b.column(1))[1])
            values, at = word_shingles(b.column(1), shingle)
            sets = [np.unique(values[a:z]) for a, z in zip(at[:-1], at[1:])]
            for i in np.flatnonzero((n > 0) & (n < shingle)):
                sets[i] = word_shingles(b.column(1).slice(i, 1), int(n[i]))[0]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(n, pa.int64())],
                                             names=["item_id", "items", "words"])
    return run


def _blocks(items: DataFrame, text: str, item_id: str, threshold: float, shingle: int, block_items: int):
    """The indexes of the blocks of items, one at a time."""
    kind = items.schema[item_id].dataType.simpleString()
    sets = (items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").alias("text"))
            .mapInArrow(_item_sets(shingle), f"item_id {kind}, items binary, words bigint").where("length(items) > 0"))
    total = sets.agg(F.sum(F.length("items") / 8)).first()[0] or 0
    n = int(total // block_items) + 1
    for k in range(n if total else 0):
        rows = sets.where(F.pmod(F.xxhash64("items"), F.lit(n)) == k).orderBy("item_id").collect()
        if rows:
            yield kind, ItemIndex([r.item_id for r in rows], [np.frombuffer(r["items"], np.uint64) for r in rows], threshold,
                                  [r["words"] for r in rows], shingle)


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = 0.8, shingle: int = 5, text: str = "text",
                    doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
                    block_items: int = 4_000_000) -> DataFrame:
    """``(doc_id, item_id, n_shared, n_item)`` for every item whose shingles are in the document at the threshold."""
    body = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = body.schema["doc_id"].dataType.simpleString()
    item_type = items.schema[item_id].dataType
    schema = f"doc_id {kind}, item_id {item_type.simpleString()}, n_shared bigint, n_item bigint"
    found = None
    for _, index in _blocks(items, item_text, item_id, threshold, shingle, block_items):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def search(batches, shared=shared):
            index = shared.value
            for b in batches:
                for at in range(0, b.num_rows, 256):
                    part = b.slice(at, 256)
                    hits = index.search(part.column(1))
                    if hits:
                        d, i, s = (list(x) for x in zip(*hits))
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).take(pa.array(d)), pa.array([index.ids[x] for x in i], to_arrow_type(item_type)),
                             pa.array(s, pa.int64()), pa.array([len(index.sets[x]) for x in i], pa.int64())],
                            names=["doc_id", "item_id", "n_shared", "n_item"])

        part = body.mapInArrow(search, schema)
        found = part if found is None else found.unionAll(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = 0.8, shingle: int = 5, text: str = "text",
                  item_text: str = "text", item_id: str = "item_id", block_items: int = 4_000_000) -> DataFrame:
    """The documents that contain no item, rows and columns as in the input."""
    out = docs
    at_text = docs.columns.index(text)
    for _, index in _blocks(items, item_text, item_id, threshold, shingle, block_items):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def keep(batches, shared=shared):
            index = shared.value
            for b in batches:
                for at in range(0, b.num_rows, 256):
                    part = b.slice(at, 256)
                    clean = np.ones(part.num_rows, bool)
                    for d, _, _ in index.search(part.column(at_text)):
                        clean[d] = False
                    yield part.filter(pa.array(clean))

        out = out.mapInArrow(keep, out.schema)
    return out
