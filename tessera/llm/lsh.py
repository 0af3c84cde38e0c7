"""Similarity join of sets by MinHash bands, Bayesian pruning and exact verification, without pair rows.

Input is one row per distinct set (a class of equal sets). Classes that share a band bucket are candidates. Buckets of
the same members are joined into one, a member's sets travel once for each bucket, and a large bucket is dealt out as
blocks: a task compares two blocks of at most about ``BLOCK`` members, so no bucket meets in one task and nothing is
capped; small groups are compared many at a time. A pair is compared only in the least bucket that both share, so it
counts once, and a task returns a row per member (its number of links, and a member of its component), never the pairs
themselves.

Bayesian pruning: with a uniform prior on the similarity, after n compared MinHash values of which m agree, the
posterior is Beta(m + 1, n - m + 1). A pair is dropped as soon as the posterior probability of a similarity of at least
the threshold falls below ``tolerance``; what is left is verified on the sets.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

BLOCK = 1000  # members of a block, and
BLOCK_ITEMS = 1_000_000  # set items of a block, about
PAIRS = 1 << 18  # pairs in work at a time within a task
BATCH_ROWS, BATCH_BYTES = 4096, 1 << 22  # groups are decoded together up to about this
STEP = 20  # MinHash values compared at a time
SMALL = 32  # groups of up to this many members are compared together; their
SET_BYTES = 1 << 20  # sets are made for about this much data at a time


@lru_cache(None)
def least_matches(size: int, threshold: float, tolerance: float) -> tuple[tuple[int, int], ...]:
    """(values compared, least number of agreeing ones with which a pair goes on) after each step."""
    def reach(m: int, n: int) -> float:  # P(S >= threshold | m of n agree), Beta(m + 1, n - m + 1)
        return sum(comb(n + 1, k) * threshold**k * (1 - threshold) ** (n + 1 - k) for k in range(m + 1))

    steps = [*range(STEP, size, STEP), size]
    return tuple((n, next(m for m in range(n + 1) if reach(m, n) >= tolerance)) for n in steps)


def survivors(sig: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of signature rows that stay after comparing the MinHash values step by step."""
    agree, at = np.zeros(len(i), np.int32), 0
    for n, least in least_matches(sig.shape[1], threshold, tolerance):
        agree += (sig[i, at:n] == sig[j, at:n]).sum(axis=1, dtype=np.int32)
        go = agree >= least
        i, j, agree, at = i[go], j[go], agree[go], n
    return i, j


def _shared(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets i and j (sorted by i)."""
    flat = np.concatenate(sets)
    ids = np.unique(flat, return_inverse=True)[1].astype(np.int32)
    size = np.array([len(s) for s in sets])
    off = np.concatenate([[0], np.cumsum(size)])
    mark = np.zeros(int(ids.max()) + 1, bool)
    out = np.zeros(len(i), np.int64)
    cuts = np.flatnonzero(np.diff(i, prepend=-1, append=-1))
    for a, z in zip(cuts[:-1], cuts[1:]):
        own = ids[off[i[a]]:off[i[a] + 1]]
        mark[own] = True
        js, lo = j[a:z], a
        while lo < z:  # bounded gathers
            hi = lo + max(1, int(np.searchsorted(np.cumsum(size[j[lo:z]]), 4_000_000)))
            js = j[lo:hi]
            n = size[js]
            ends = np.cumsum(n)
            take = np.arange(ends[-1]) + np.repeat(off[js] - ends + n, n)
            out[lo:hi] = np.add.reduceat(mark[ids[take]], ends - n, dtype=np.int64)
            lo = hi
        mark[own] = False
    return out


def _group_links(weight, sig, sets, block, buckets, bucket, threshold, tolerance):
    """Links of each member within one pair of blocks, and the least member of its component there."""
    n = len(sig)
    ids, inverse = np.unique(np.concatenate(buckets), return_inverse=True)
    member = np.repeat(np.arange(n), [len(b) for b in buckets])
    use = np.flatnonzero((ids < bucket) & (np.bincount(inverse) > 1))  # earlier buckets that could hold a pair
    bits = np.zeros((n, max(1, len(use))), bool)
    place = np.full(len(ids), -1)
    place[use] = np.arange(len(use))
    on = place[inverse] >= 0
    bits[member[on], place[inverse][on]] = True
    bits = np.packbits(bits, axis=1)
    one = np.unique(block)
    left = np.flatnonzero(block == one[0])
    right = left if len(one) == 1 else np.flatnonzero(block == one[1])
    links, root = np.zeros(n, np.int64), np.arange(n)
    rows = max(1, PAIRS // max(1, len(right)))
    found_i, found_j = [], []
    for a in range(0, len(left), rows):
        i, j = (x.ravel() for x in np.meshgrid(left[a:a + rows], right, indexing="ij"))
        if right is left:
            i, j = i[i < j], j[i < j]
        if len(use):
            ok = ~(bits[i] & bits[j]).any(axis=1)
            i, j = i[ok], j[ok]
        i, j = survivors(sig, i, j, threshold, tolerance)
        if len(i):
            named, at = np.unique(np.concatenate([i, j]), return_inverse=True)
            own = sets(named)
            size = np.array([len(s) for s in own])
            x, y = at[:len(i)], at[len(i):]
            both = _shared(own, x, y)
            ok = both >= threshold * (size[x] + size[y] - both) - 1e-9
            i, j = i[ok], j[ok]
            found_i.append(i)
            found_j.append(j)
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
    if found_i:
        root = _least_labels(n, np.concatenate(found_i), np.concatenate(found_j))
    return links, root


def _least_labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least member of each one's component, by the links i - j."""
    root = np.arange(n)
    while True:
        m = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, m)
        np.minimum.at(new, j, m)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _in_common(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate([a, b])
    both.sort()
    return np.count_nonzero(both[1:] == both[:-1])


def _small_links(weight, sig, sets, volume, block, two, buckets, bucket, starts, threshold, tolerance):
    """Links of each row with others of its group, and the least row of its component there, for many groups at once: those
    of up to SMALL rows. ``volume``: bytes of data up to each row; ``two``: whether its group is of two blocks."""
    n = len(weight)
    links, root = np.zeros(n, np.int64), np.arange(n)
    sizes = np.diff(np.append(starts, n))
    left, right = [], []
    for m in np.unique(sizes[(sizes > 1) & (sizes <= SMALL)]):
        first = starts[sizes == m][:, None]
        a, z = np.triu_indices(m, 1)
        left.append((first + a).ravel())
        right.append((first + z).ravel())
    if not left:
        return links, root
    i, j = np.concatenate(left), np.concatenate(right)
    ok = ~two[i] | (block[i] != block[j])
    i, j = i[ok], j[ok]
    width = np.array([len(b) for b in buckets])
    lists = np.full((n, width.max()), np.iinfo(np.int64).max)  # what fills a row up is less than no bucket
    lists[np.arange(lists.shape[1]) < width[:, None]] = np.concatenate(buckets)
    earlier = np.zeros(len(i), bool)
    for c in range(lists.shape[1]):
        own = lists[i, c]
        earlier |= (own < bucket[i]) & (lists[j] == own[:, None]).any(axis=1)
    i, j = survivors(sig, i[~earlier], j[~earlier], threshold, tolerance)
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    parts = np.flatnonzero(np.diff(volume[np.repeat(starts, sizes)[i]] // SET_BYTES, prepend=-1, append=-1)) if len(i) else []
    linked = np.zeros(len(i), bool)
    for a, z in zip(parts[:-1], parts[1:]):
        named, at = np.unique(np.concatenate([i[a:z], j[a:z]]), return_inverse=True)
        own = sets(named)
        size = np.array([len(s) for s in own])
        x, y = at[:z - a], at[z - a:]
        both = np.minimum(size[x], size[y])  # at most
        for p in np.flatnonzero(both >= threshold * np.maximum(size[x], size[y]) - 1e-9):
            both[p] = _in_common(own[x[p]], own[y[p]])
        linked[a:z] = both >= threshold * (size[x] + size[y] - both) - 1e-9
    i, j = i[linked], j[linked]
    np.add.at(links, i, weight[j])
    np.add.at(links, j, weight[i])
    return links, _least_labels(n, i, j)


def _compare(threshold: float, tolerance: float, decode: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("key", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])

    def run(b: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch | None:
        """The links of some groups; ``starts`` are their first rows."""
        bucket, lo, hi, block, weight = (b.column(c).to_numpy() for c in (0, 1, 2, 3, 5))
        keys, data, lists = b.column(4).cast(pa.binary()), b.column(6).to_pylist(), b.column(7)
        buckets = np.split(lists.flatten().to_numpy(), (lists.offsets.to_numpy() - lists.offsets[0].as_py())[1:-1])
        sig, sets = decode(data)
        volume = np.cumsum([len(d) for d in data])
        links, root = _small_links(weight, sig, sets, volume, block, lo != hi, buckets, bucket, starts, threshold, tolerance)
        for a, z in zip(starts, [*starts[1:], b.num_rows]):
            if z - a > SMALL and (lo[a] == hi[a] or (block[a:z] != block[a]).any()):
                links[a:z], own = _group_links(weight[a:z], sig[a:z], lambda at, a=a: sets(at + a), block[a:z], buckets[a:z],
                                               bucket[a], threshold, tolerance)
                root[a:z] = own + a
        out = np.flatnonzero(links)
        if not len(out):
            return None
        return pa.RecordBatch.from_arrays([keys.take(pa.array(out)), pa.array(links[out]), keys.take(pa.array(root[out]))], schema=schema)

    def pieces(b: pa.RecordBatch, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole groups together, up to about BATCH_ROWS rows and BATCH_BYTES of data."""
        volume = np.concatenate([[0], np.cumsum(pc.binary_length(b.column(6)).to_numpy(), dtype=np.int64)])
        a = 0
        while a < len(starts):
            first = int(starts[a])
            stop = min(first + BATCH_ROWS, int(np.searchsorted(volume, volume[first] + BATCH_BYTES)))
            z = max(a + 1, int(np.searchsorted(starts, stop)))
            end = int(starts[z]) if z < len(starts) else b.num_rows
            if (out := run(b.slice(first, end - first), starts[a:z] - first)) is not None:
                yield out
            a = z

    def compare(batches):
        held = None  # the rows of the last group, which may go on
        for b in batches:
            if not b.num_rows:
                continue
            b = b if held is None else pa.concat_batches([held, b])
            new = np.zeros(b.num_rows, bool)
            new[0] = True
            for c in range(3):
                v = b.column(c).to_numpy()
                new[1:] |= v[1:] != v[:-1]
            starts = np.flatnonzero(new)
            last = int(starts[-1])
            yield from pieces(b.slice(0, last), starts[:-1])
            held = b.slice(last)
        if held is not None:
            yield from pieces(held, np.zeros(1, np.int64))

    return compare


def link_classes(classes: DataFrame, payload: Callable[[DataFrame], DataFrame], decode: Callable, threshold: float = 0.8,
                 tolerance: float = 1e-5) -> DataFrame:
    """``(key, links, root)`` per block task for every linked class; sum ``links`` and join ``root`` over the rows.

    ``classes``: key (binary), n (rows of the class), n_items, bands (array of bucket hashes; null or empty: none).
    ``payload(candidates)`` returns a row per candidate key with its ``data`` (binary), and ``decode``, in the tasks,
    gives for a list of those the matrix of MinHash values, and a function that returns the sorted sets of the rows
    asked for (only pairs that survive the pruning need them). ``classes`` is read several times: pass a cut or a table.
    """
    spread = classes.select("key", "n_items", F.explode("bands").alias("bucket"))
    buckets = (spread.groupBy("bucket")
               .agg(F.count("*").alias("_n"), F.sum("n_items").alias("_items"), F.bit_xor(F.xxhash64("key")).alias("_x"),
                    F.bit_xor(F.xxhash64(F.lit(1), "key")).alias("_y")).where("_n > 1")
               .groupBy("_n", "_items", "_x", "_y").agg(F.min("bucket").alias("bucket"))
               .select("bucket", F.greatest(F.ceil(F.col("_n") / BLOCK), F.ceil(F.col("_items") / BLOCK_ITEMS))
                       .cast("int").alias("blocks")))
    members = (spread.select("key", "bucket").join(buckets, "bucket")
               .groupBy("key").agg(F.collect_list(F.struct("bucket", "blocks")).alias("in")))
    members = cut(members.join(classes.select("key", "n"), "key"))
    loaded = members.join(payload(members.select("key")), "key")
    dealt = (loaded.select("key", "n", "data", F.expr("transform(in, x -> x.bucket)").alias("buckets"),
                           F.explode("in").alias("_in"))
             .withColumn("block", F.pmod(F.xxhash64("key", F.col("_in.bucket")), F.col("_in.blocks")).cast("int"))
             .withColumn("other", F.explode(F.expr("sequence(0, _in.blocks - 1)")))
             .select(F.col("_in.bucket").alias("bucket"), F.least("block", "other").alias("lo"),
                     F.greatest("block", "other").alias("hi"), "block", "key", "n", "data", "buckets"))
    grouped = dealt.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
    return grouped.mapInArrow(_compare(threshold, tolerance, decode), "key binary, links bigint, root binary")
