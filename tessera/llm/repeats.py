"""Repeated passages by distributed prefix doubling over a sampled suffix array.

A byte goes if a string of ``length`` bytes that covers it also starts earlier (smaller doc_id, or same document and
earlier start). Strings never cross documents, overlapping occurrences count, and all are judged on the input.

Sorting every position would move some 20 bytes a byte and round, so the array is sampled first. Within each string of
``length`` bytes the least hash of its ``length / 4``-byte pieces names one position, by content alone: equal strings name the
same place. About one position in ``3 length / 8`` is named. A named position stands for a run of neighbouring string starts.

1. Quarter length. Spark range-sorts the named positions by the pair (rank of the quarter-length piece, rank of the whole
   window that the run covers), then by place. One pass over the sorted rows reranks: a piece found once is unique, and none of
   its strings repeats; of equal windows all but the first are repeated as a whole; a piece with several windows stays.
2. Half and full length. Of the windows that stay, every string start is a row: Spark sorts the pairs (rank of the half length
   at p, rank at p + half) within a piece, and past the threshold all but the first of equal pairs are repeated.

Ranks are 64-bit hashes of the bytes, equal for equal bytes in every task, so no round has to send ranks back to places; two
independent ones (piece and window, or piece and pair) decide, 128 bits in all. Copies within a batch are settled before each
shuffle, so a passage that a third of all documents share sends a row per batch; range borders may fall inside a piece, whose
windows then simply go on to step 2. Texts are shuffled once, by document, and that shuffle is read twice.

Defined results
- null text: as empty; texts under ``length`` bytes have no string and lose nothing;
- null doc_id comes first; documents of equal id are ordered by a hash of their text; rows equal in both are one document, and
  each gets its result (a copy of a text under another id is a repeat);
- an empty table gives an empty one; other columns are ignored; doc_id must be of an integer type;
- texts are worked on in segments, so a text of any length takes memory of a few times its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import written
from .shingles import _tables, byte_view, mix64, stream

SEGMENT = 1 << 17
_RUN = 16  # bits of a place that hold the number of further starts of its run
_MOST = (1 << _RUN) - 1
_LEAST_ID = -(1 << 63)


def _sums(b: np.ndarray) -> np.ndarray:
    up, _ = _tables(len(b))
    out = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(stream(7, 256)[b] * up[:len(b)], out=out[1:])
    return out


def _rank(sums: np.ndarray, at: np.ndarray, size) -> np.ndarray:
    """Hashes of the strings of ``size`` bytes (one for all, or one each) at ``at``."""
    _, down = _tables(len(sums))
    return mix64((sums[at + size] - sums[at]) * down[at])


def named(b: np.ndarray, offsets: np.ndarray, length: int):
    """The named positions of the texts ``b[offsets]``: piece rank, window rank, text, first start, number of further starts."""
    piece = length // 4
    width = length - piece + 1
    empty = np.zeros(0, np.int64)
    if len(b) < length:
        return empty, empty, empty, empty, empty
    sums = _sums(b)
    n = len(b) - piece + 1
    h = _rank(sums, np.arange(n), piece)
    low = np.uint64((1 << 24) - 1)
    least = (h & ~low) | np.arange(n, dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
    sizes = np.maximum(np.diff(offsets) - length + 1, 0)
    text = np.repeat(np.arange(len(sizes)), sizes)
    start = np.arange(sizes.sum()) + np.repeat(offsets[:-1] - np.cumsum(sizes) + sizes, sizes)
    place = (least[start] & low).astype(np.int64)
    if not len(place):
        return empty, empty, empty, empty, empty
    first = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(first[1:], len(place)) - 1
    lo, more, at = start[first], last - first, place[first]
    window = mix64(_rank(sums, lo, length + more) ^ ((at - lo) * (1 << 20) + more).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return h[at].view(np.int64), window.view(np.int64), text[first], lo - offsets[text[first]], more


def _segments(offsets: np.ndarray, length: int):
    """Pieces of work: (first byte, end byte, first text, offsets of the texts in it, start of the first in its text)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SEGMENT, "right")) - 1))
        a, z = int(offsets[lo]), int(offsets[hi])
        if hi == lo + 1 and z - a > 2 * SEGMENT:  # a long text in overlapping slices: each start lies in one
            for s in range(a, z - length + 1, SEGMENT):
                e = min(z, s + SEGMENT + length - 1)
                yield s, e, lo, np.array([0, e - s]), s - a
        else:
            yield a, z, lo, offsets[lo:hi + 1] - a, 0
        lo = hi


def _ordered(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The documents of a batch in order of (id, tie)."""
    d, t = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    order = np.lexsort((t, d))
    return batch if (np.diff(order) == 1).all() else batch.take(pa.array(order))


def _settled(rank: np.ndarray, d: np.ndarray, t: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows (in order of place) that follow an equal rank at another place."""
    order = np.argsort(rank, kind="stable")
    same = np.diff(rank[order]) == 0
    first = order[np.concatenate([[0], np.flatnonzero(~same) + 1])] if len(rank) else order
    head = np.repeat(first, np.diff(np.append(np.concatenate([[0], np.flatnonzero(~same) + 1]), len(rank)))) if len(rank) else first
    out = np.zeros(len(rank), bool)
    out[order] = (d[order] != d[head]) | (t[order] != t[head]) | (at[order] != at[head])
    return out


def _runs(d, t, lo, more):
    """Neighbouring runs of starts of the same document as one (places in order)."""
    if not len(lo):
        return d, t, lo
    new = np.ones(len(lo), bool)
    new[1:] = (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (lo[1:] > lo[:-1] + more[:-1] + 1) | (lo[1:] < lo[:-1])
    first = np.flatnonzero(new)
    end = np.maximum.reduceat(lo + more, first)
    d, t, lo = d[first], t[first], lo[first]
    parts = (end - lo) // _MOST + 1  # a place holds a bounded run
    k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    d, t, lo, end = (np.repeat(x, parts) for x in (d, t, lo, end))
    lo = lo + k * _MOST
    return d, t, (lo << _RUN) | np.minimum(end - lo, _MOST - 1)


def _batch(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=[f"c{i}" for i in range(len(columns))])


_NAMED = "piece bigint, whole bigint, d bigint, t bigint, place bigint"


def _name_positions(length: int):
    def run(batches):
        for batch in batches:
            batch = _ordered(batch)
            d, t = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            b, off = byte_view(batch.column(2))
            parts = []
            for a, z, first, own, skip in _segments(off, length):
                piece, whole, text, lo, more = named(b[a:z], own, length)
                parts.append((piece, whole, text + first, lo + skip, more))
            if not parts:
                continue
            piece, whole, text, lo, more = (np.concatenate(x) for x in zip(*parts))
            dd, tt = d[text], t[text]
            gone = _settled(whole, dd, tt, lo)
            stay = ~gone
            yield _batch(*(pa.array(x[stay]) for x in (piece, whole, dd, tt)), pa.array(lo[stay] << _RUN | more[stay]))
            d2, t2, place = _runs(dd[gone], tt[gone], lo[gone], more[gone])
            yield _batch(pa.array(mix64((d2 ^ place).view(np.uint64)).view(np.int64)), pa.nulls(len(d2), pa.int64()), pa.array(d2), pa.array(t2), pa.array(place))
    return run


_JUDGED = "d bigint, t bigint, place bigint, piece bigint"


def _judge(batches):
    """Rerank the sorted rows of a partition. A place with a piece is open, one without is repeated as a whole."""
    last = None        # the last row (piece, whole, d, t, place)
    waiting = None     # the only first window so far of the piece at hand
    several = True     # the piece at hand is known to have several windows, or began before this partition
    for batch in batches:
        batch = pa.Table.from_batches([batch])
        done = batch.filter(batch.column(1).is_null())
        if done.num_rows:
            for x in done.to_batches():
                yield _batch(x.column(2), x.column(3), x.column(4), pa.nulls(x.num_rows, pa.int64()))
        rows = batch.filter(batch.column(1).is_valid())
        if not rows.num_rows:
            continue
        m = np.stack([c.to_numpy() for c in rows.columns])
        before = np.concatenate([m[:, :1] - 1 if last is None else last[:, None], m[:, :-1]], 1)
        m, before = (x[:, (m != before).any(0)] for x in (m, before))  # a row twice is one document twice
        if not m.shape[1]:
            continue
        new_piece = m[0] != before[0]
        if last is None:
            new_piece[0] = False  # the first piece of a partition may have begun in the one before
        new_whole = (m[1] != before[1]) | new_piece
        if last is None:
            new_whole[0] = True
        group = np.cumsum(new_piece)
        n = group[-1] + 1
        more = np.bincount(group[new_whole & ~new_piece], minlength=n) > 0
        more[0] |= several
        if group[0] == 0 and waiting is not None and more[0]:
            yield _batch(*(pa.array([int(waiting[i])]) for i in (2, 3, 4, 0)))
            waiting = None
        out = ~new_whole
        yield _batch(*(pa.array(m[i, out]) for i in (2, 3, 4)), pa.nulls(int(out.sum()), pa.int64()))
        out = new_whole & more[group]
        yield _batch(*(pa.array(m[i, out]) for i in (2, 3, 4, 0)))
        several = bool(more[-1])
        if several:
            waiting = None
        elif new_piece.any():
            waiting = m[:, np.flatnonzero(new_piece)[-1]]
        last = m[:, -1]
    if waiting is not None:  # the last piece may go on in the next partition
        yield _batch(*(pa.array([int(waiting[i])]) for i in (2, 3, 4, 0)))


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and row of each of an array of lists (null: none)."""
    lists = pa.array([], lists.type) if not len(lists) else lists
    n = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) if len(lists) else np.zeros(0, int)
    return lists.flatten(), np.repeat(np.arange(len(n)), n)


_OPEN = "piece bigint, d bigint, t bigint, place bigint, bytes binary"


def _open_windows(length: int):
    half = length // 2

    def run(batches):
        for batch in batches:
            batch = _ordered(batch)
            d, t = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            b, off = byte_view(batch.column(2))
            place, row = _flat(batch.column(3))
            piece = _flat(batch.column(4))[0].to_numpy()
            place = place.to_numpy()
            order = np.lexsort((place, row))
            place, row, piece = place[order], row[order], piece[order]
            lo, more = place >> _RUN, place & _MOST
            # ranks of the two halves of every start, a segment at a time
            n = more + 1
            of = np.repeat(np.arange(len(n)), n)
            start = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            rank = np.zeros(len(start), np.uint64)
            at = start + off[row[of]]
            a = 0
            while a < len(at):
                z = max(a + 1, int(np.searchsorted(at, at[a] + SEGMENT)))
                sums = _sums(b[at[a]:at[z - 1] + length])
                own = at[a:z] - at[a]
                rank[a:z] = _rank(sums, own, half) * np.uint64(3) + _rank(sums, own + half, length - half)
                a = z
            rank = mix64(rank ^ piece[of].view(np.uint64)).view(np.int64)
            gone = _settled(rank, d[row[of]], t[row[of]], start)
            stay = np.flatnonzero(~gone)
            r = of[gone]
            d2, t2, p2 = _runs(d[row[r]], t[row[r]], start[gone], np.zeros(len(r), np.int64))
            yield _batch(pa.array(mix64((d2 ^ p2).view(np.uint64)).view(np.int64)), pa.array(d2), pa.array(t2), pa.array(p2), pa.nulls(len(d2), pa.binary()))
            # the window from its first to its last start that stays
            new = np.flatnonzero(np.diff(of[stay], prepend=-1))
            if not len(new):
                continue
            w = of[stay[new]]
            first, last = start[stay[new]], start[stay[np.append(new[1:], len(stay)) - 1]]
            begin = off[row[w]] + first
            size = last - first + length
            raw = b.tobytes()
            yield _batch(pa.array(piece[w]), pa.array(d[row[w]]), pa.array(t[row[w]]), pa.array(first << _RUN | (last - first)),
                         pa.array([raw[x:x + s] for x, s in zip(begin.tolist(), size.tolist())], pa.binary()))
    return run


def _spans(lo: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs covered by [lo, end)."""
    order = np.argsort(lo, kind="stable")
    lo, end = lo[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], lo[1:] > end[:-1]])
    first = np.flatnonzero(new)
    return lo[first], end[np.append(first[1:], len(lo)) - 1]


def _cut_out(length: int):
    def run(batches):
        for batch in batches:
            places, row = [], []
            for i in (3, 4):
                p, r = _flat(batch.column(i))
                places.append(p.to_numpy(zero_copy_only=False).astype(np.int64))
                row.append(r)
            place, row = np.concatenate(places), np.concatenate(row)
            order = np.argsort(row, kind="stable")
            place, row = place[order], row[order]
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
            n_bytes, spans, kept, held = [], [], [], 0
            ids, at = batch.column(0), 0
            for i, text in enumerate(batch.column(2)):
                raw = (text.as_py() or "").encode()
                p = place[bounds[i]:bounds[i + 1]]
                n_bytes.append(len(raw))
                if len(p):
                    lo = p >> _RUN
                    a, z = (x.tolist() for x in _spans(lo, lo + (p & _MOST) + length))
                    raw = b"".join([raw[x:y] for x, y in zip([0, *z], [*a, len(raw)])])
                    spans.append([{"start": x, "end": y} for x, y in zip(a, z)])
                else:
                    spans.append([])
                kept.append(raw)
                held += len(raw)
                if held > 8 << 20 or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(at, len(kept)), pa.array(n_bytes, pa.int64()),
                         pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                        names=["doc_id", "n_bytes", "spans", "kept"])
                    n_bytes, spans, kept, held, at = [], [], [], 0, i + 1
    return run


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(id, d, t, text)``: d orders the documents, t those of equal id."""
    body = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    if not isinstance(body.schema["id"].dataType, IntegralType):
        raise TypeError(f"{doc_id} must be of an integer type")
    ties = body.groupBy("id").count().where((F.col("count") > 1) | F.col("id").isNull()).limit(1).count()
    # a column in either case: a literal would be folded into the two joins of the dealt texts, which then share no shuffle
    tie = F.xxhash64("text") if ties else F.col("id").isNull().cast("bigint")
    return body.select("id", F.coalesce(F.col("id").cast("bigint"), F.lit(_LEAST_ID)).alias("d"), tie.alias("t"), "text")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)`` of every row: the removed runs of its UTF-8 bytes as ``array<struct<start, end>>``,
    ascending and apart, and the other bytes (binary, as a run may end within a character)."""
    if not 4 <= length < 1 << 15:
        raise ValueError("length must be from 4 to 32767")
    spark = docs.sparkSession
    keyed = _keyed(docs, doc_id, text)
    kind = keyed.schema["id"].dataType.simpleString()
    positions = keyed.select("d", "t", "text").mapInArrow(_name_positions(length), _NAMED)
    judged = (positions.repartitionByRange("piece", "whole").sortWithinPartitions("piece", "whole", "d", "t", "place")
              .mapInArrow(_judge, _JUDGED))
    open_ = F.col("piece").isNotNull()
    verdicts = written(judged.groupBy("d", "t").agg(
        F.collect_list(F.when(~open_, F.col("place"))).alias("done"), F.collect_list(F.when(open_, F.struct("place", "piece"))).alias("open")), "repeats")
    dealt = keyed.repartition("d", "t")

    # the id is carried here too, so that both joins read one shuffle of the texts
    windows = (dealt.join(verdicts.where(F.size("open") > 0).select("d", "t", "open"), ["d", "t"])
               .select("d", "t", "text", F.col("open.place").alias("place"), F.col("open.piece").alias("piece"), "id")
               .mapInArrow(_open_windows(length), _OPEN)
               .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "piece"))
    half = length // 2
    none = F.lit(None).cast("bigint")
    pairs = F.transform(F.sequence(F.lit(0), F.octet_length("bytes") - length), lambda i: F.struct(
        F.shiftleft(F.shiftright("place", _RUN) + i, _RUN).alias("at"), F.xxhash64(F.substring("bytes", i + 1, F.lit(half))).alias("a"),
        F.xxhash64(F.substring("bytes", i + 1 + half, F.lit(length - half))).alias("z")))
    settled = F.array(F.struct(F.col("place").alias("at"), none.alias("a"), none.alias("z")))  # repeated within a batch
    starts = windows.select("piece", "d", "t", F.explode(F.when(F.col("bytes").isNull(), settled).otherwise(pairs)).alias("s")).select("piece", "d", "t", "s.*")
    seen = Window.partitionBy("piece", "a", "z").orderBy("d", "t", "at")
    late = (starts.withColumn("r", F.rank().over(seen)).where("r > 1 or a is null")
            .groupBy("d", "t").agg(F.collect_list("at").alias("late")))

    found = dealt.join(verdicts.select("d", "t", "done"), ["d", "t"], "left").join(late, ["d", "t"], "left")
    return (found.select("id", "d", "text", "done", "late").mapInArrow(_cut_out(length), f"doc_id {kind}, n_bytes bigint, "
            "spans array<struct<start: bigint, end: bigint>>, kept binary"))
