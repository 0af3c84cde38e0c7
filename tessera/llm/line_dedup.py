"""Fuzzy line deduplication by MinHash over character shingles, across all documents.

Lines (split at ``\\n``, trimmed of ASCII white space) are sets of 8-character shingles; lines whose sets have a
Jaccard similarity of at least the threshold are linked, and one line of each connected component stays: the first by
doc_id, text digest and line number.

Signatures for the bands: lines of up to 160 distinct shingles use plain MinHash; lines of more than 128 use one permutation
hashing with rotation (one hash per shingle, the least in each of 42 bins), which costs the same for any signature
size. Lines between have both, so two lines at the threshold always share a kind. 14 bands of 3 values miss a pair at
a similarity of 0.8 with a probability of 4e-5.

Scale: a band matters if two different lines are in its bucket, a line itself if it is at two places. The tasks keep the
least and the largest line of a bucket and send them packed, many buckets a row, by the bucket's part; the buckets that
matter become a filter of fixed size (``filter_bits``), the only thing broadcast. A second pass over the documents lets
only lines in such buckets go on; the filter's false hits cost rows, not results. Candidates are then compared in block
tasks (``lsh``) and joined into components (``components``). Of the lines that are unlike all others only the bucket
hashes of the first pass are shuffled.

Defined results
- null text has no line; blank lines are never removed and never counted as equal;
- lines shorter than a shingle are one shingle: they match equal lines only;
- documents of equal id and text are one document: each such row keeps and loses the same lines;
- ties are broken by doc_id (null last), text digest and line number; an empty table gives an empty result;
- extra columns are ignored by ``line_decisions`` and kept by ``drop_lines``.
"""

from __future__ import annotations

import hashlib
from typing import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, join_back, written
from .components import connected_components
from .lsh import link_classes
from .shingles import band_hashes, minhash, mix64, stream

SHINGLE, BANDS, ROWS = 8, 14, 3
SHORT, LONG = 160, 128  # plain MinHash up to SHORT shingles, one permutation hashing above LONG
HEAD = 200  # shingles that mostly tell whether a line has more than SHORT different ones
VERIFY = 60  # MinHash values compared before the exact check
_WHITE = " \t\n\x0b\f\r"


_POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, n, 1 << 64)) for n in range(SHINGLE - 1, -1, -1)]


def _windows(text: str) -> np.ndarray:
    """Values of all windows of 8 characters, still to be mixed: of characters below 256 the bytes themselves, others are
    hashed as polynomials."""
    plain = text.isascii()
    codes = np.frombuffer(text.encode() if plain else text.encode("utf-32-le", "surrogatepass"), np.uint8 if plain else np.uint32)
    n = max(0, len(codes) - SHINGLE + 1)
    packed = np.ndarray((n,), "<u8", codes if plain else codes.astype(np.uint8), strides=(1,))
    if plain or not n or not (wide := codes > 255).any():
        return packed
    far = np.cumsum(np.concatenate([[0], wide]))
    far = far[SHINGLE:] > far[:-SHINGLE]
    at = np.flatnonzero(far)
    if 3 * len(at) > n:
        values = codes.astype(np.uint64)
        for k in (1, 2, 4):  # of pairs, of pairs of pairs, of pairs of those
            values = values[:-k] * _POWERS[SHINGLE - 1 - k] + values[k:]
        return np.where(far, values, packed)
    packed = packed.copy()
    packed[at] = sum(codes[at + k] * p for k, p in enumerate(_POWERS))
    return packed


def _short(line: str) -> int:
    """The value of a line shorter than a window, still to be mixed."""
    if line.isascii():
        return int.from_bytes(line.encode(), "little") * int(_POWERS[0]) + len(line) & (1 << 64) - 1
    return sum(ord(c) * int(m) for c, m in zip(line, stream(SHINGLE, SHINGLE))) + len(line) & (1 << 64) - 1


def line_shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all lines (repeats included) and the n + 1 offsets of the lines in them."""
    length = np.array([len(x) for x in lines], np.int64)
    start = np.cumsum(length) - length
    counts = np.where(length >= SHINGLE, length - SHINGLE + 1, np.minimum(length, 1))
    out = np.concatenate([[0], np.cumsum(counts)])
    rolled = _windows("".join(lines))
    full = length >= SHINGLE
    inside = np.ones(len(rolled), bool)  # positions whose window stays inside a line
    for j in range(1, SHINGLE):
        ends = (start + length - j)[length >= j]
        inside[ends[ends < len(rolled)]] = False
    rolled = rolled[inside]
    if full.all():
        return mix64(rolled), out
    values = np.empty(out[-1], np.uint64)
    values[np.repeat(full, counts)] = rolled
    short = np.flatnonzero(~full & (length > 0))
    values[out[short]] = np.array([_short(lines[i]) for i in short], np.uint64)
    return mix64(values), out


def one_permutation(values: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """One permutation hashing: the least hash of each bin; an empty bin takes the next one's, shifted."""
    n = len(offsets) - 1
    place = values >> np.uint64(32)
    place *= np.uint64(size)
    place >>= np.uint64(32)
    place = place.view(np.int64)
    place += np.repeat(np.arange(n) * size, np.diff(offsets))
    sig = np.full(n * size, 0xFFFFFFFF, np.uint32)  # the mark of an empty bin; a hash that equals it counts as none
    np.minimum.at(sig, place, values.astype(np.uint32))
    sig = sig.reshape(n, size)
    have = sig != np.uint32(0xFFFFFFFF)
    some = have.any(axis=1)
    while len(rows := np.flatnonzero(some & ~have.all(axis=1))):
        own, there = sig[rows], have[rows]
        fill = ~there & np.roll(there, -1, axis=1)
        sig[rows] = np.where(fill, np.roll(own, -1, axis=1) * np.uint32(2654435761) + np.uint32(1), own)
        have[rows] = there | fill
    return sig


def _distinct(values: np.ndarray) -> np.ndarray:
    v = np.sort(values)
    new = v[1:] != v[:-1]
    return v if new.all() else np.concatenate([v[:1], v[1:][new]])


def band_sizes(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Numbers of distinct shingles, as far as the kinds of sketch depend on them: lines of up to LONG shingles in all, and
    lines with more than SHORT distinct ones at their start, keep their total."""
    size = np.diff(offsets)
    out = size.copy()
    long = np.flatnonzero(size > LONG)
    for at in range(0, len(long), 512):
        rows = long[at:at + 512]
        # the last shingle fills the rows up
        head = np.sort(values[offsets[rows][:, None] + np.minimum(np.arange(HEAD), size[rows][:, None] - 1)], axis=1)
        n = 1 + (head[:, 1:] != head[:, :-1]).sum(axis=1)
        out[rows] = np.where(size[rows] <= HEAD, n, size[rows])
        for i in rows[(size[rows] > HEAD) & (n <= SHORT)]:
            out[i] = len(_distinct(values[offsets[i]:offsets[i + 1]]))
    return out


def line_bands(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, bucket) of every band of every line. Repeated shingles do not change a sketch; its kind goes by the distinct ones."""
    size, kind = np.diff(offsets), band_sizes(values, offsets)
    lines, buckets = [], []
    for salt, pick, sketch in ((0, (kind > 0) & (kind <= SHORT), minhash), (10, kind > LONG, one_permutation)):
        at = np.flatnonzero(pick)
        if len(at):
            own = values[np.repeat(pick, size)]
            off = np.concatenate([[0], np.cumsum(size[at])])
            hashes = band_hashes(sketch(own, off, BANDS * ROWS), ROWS, salt)
            lines.append(np.repeat(at, BANDS))
            buckets.append(hashes.ravel())
    if not lines:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(lines), np.concatenate(buckets)


def _slices(batch, limit: int = 1 << 18):
    """(documents in the batch, line numbers, lines) of about ``limit`` bytes; lines trimmed, blank ones left out."""
    texts, at = batch.column(2), 0
    volume = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(volume, (volume[at - 1] if at else 0) + limit, "right")))
        split = pc.split_pattern(texts.slice(at, end - at), "\n")
        counts = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False)
        lines = pc.ascii_trim(split.flatten(), _WHITE)  # no byte of another character is white space
        size = pc.binary_length(lines).to_numpy()
        doc = np.repeat(np.arange(at, end), counts)
        number = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        some = np.flatnonzero(size)
        for part in np.split(some, np.flatnonzero(np.diff(np.cumsum(size[some], dtype=np.int64) // limit)) + 1):
            if len(part):
                yield doc[part], number[part], lines.take(pa.array(part)).to_pylist()
        at = end


def _keys(lines: list[str]) -> tuple[list[bytes], np.ndarray]:
    """Digests of the lines, and the bucket that stands for a line itself."""
    keys = [hashlib.md5(x.encode()).digest() for x in lines]
    return keys, np.frombuffer(b"".join(keys), np.int64)[1::2]


def _runs(bucket: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets, ascending as unsigned numbers, each with its least and its largest k."""
    order = np.argsort(bucket.view(np.uint64))
    bucket, k = bucket[order], k[order]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    return bucket[first], np.minimum.reduceat(k, first), np.maximum.reduceat(k, first)


def _count_buckets(parts: int, held: int = 1 << 19):
    """(bucket, k) for every band of every line, k telling lines apart, and for every line itself, k telling its
    places apart: about ``held`` of them at a time, of a bucket the least and the largest k. A row has those of a
    ``part`` (the bucket's highest bits), as little-endian 64-bit integers."""
    def packed(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        bucket, least, most = _runs(*(np.concatenate(x) for x in zip(*found)))
        more = least != most
        bucket, k = np.repeat(bucket, 1 + more), np.repeat(least, 1 + more)
        k[np.cumsum(1 + more)[more] - 1] = most[more]
        part = ((bucket.view(np.uint64) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
        at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        ends = pa.array(np.append(at, len(part)) * 8, pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(part[at])] + [pa.Array.from_buffers(pa.binary(), len(at), [None, ends.buffers()[1], pa.py_buffer(x)]) for x in (bucket, k)],
            names=["part", "buckets", "ks"])

    def run(batches):
        found, n = [], 0
        for b in batches:
            own_hash = np.array([hash_document(d, k) for d, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist())], np.uint64)
            for doc, number, lines in _slices(b):
                line, bucket = line_bands(*line_shingles(lines))
                keys, own = _keys(lines)
                which = np.frombuffer(b"".join(keys), np.int64)[::2]
                places = mix64(own_hash[doc] + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
                found.append((np.concatenate([bucket, own]), np.concatenate([which[line], places])))
                n += len(found[-1][0])
                if n >= held:
                    yield packed(found)
                    found, n = [], 0
        if n:
            yield packed(found)
    return run


def _multiple(batches):
    """The buckets that have several k; the rows come part by part."""
    def of(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        bucket, least, most = _runs(*(np.frombuffer(b"".join(x), np.int64) for x in zip(*found)))
        return pa.RecordBatch.from_arrays([pa.array(bucket[least != most])], names=["bucket"])

    now, found = None, []
    for b in batches:
        for part, *row in zip(*(b.column(c).to_pylist() for c in range(3))):
            if part != now and found:
                yield of(found)
                found = []
            now = part
            found.append(row)
    if found:
        yield of(found)


def hash_document(doc_id, tk: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(f"{doc_id}:".encode() + tk, digest_size=8).digest(), "little")


def _candidates(shared, bits: int):
    """Lines that have a bucket in the filter: their place and key, and, where a band is in it, what is compared; and a row
    per document without ``line``, its number of lines as ``n_items``."""
    def run(batches):
        hot = shared.value
        mask = np.int64((1 << bits) - 1)
        names = ["id", "tk", "line", "key", "n_items", "bands", "text"]

        def on_bit(v: np.ndarray) -> np.ndarray:
            return (hot[v >> 3] >> (v & 7).astype(np.uint8)) & 1 > 0

        def hit(bucket: np.ndarray) -> np.ndarray:
            return on_bit(bucket & mask) & on_bit((bucket >> 32) & mask)

        for b in batches:
            ids, tks, n_lines = b.column(0), b.column(1), np.zeros(b.num_rows, np.int64)
            for doc, number, lines in _slices(b):
                n_lines += np.bincount(doc, minlength=b.num_rows)
                values, off = line_shingles(lines)
                line, bucket = line_bands(values, off)
                keys, own = _keys(lines)
                on = hit(bucket)
                line, bucket = line[on], bucket[on]
                order = np.argsort(line, kind="stable")
                line, bucket = line[order], bucket[order]
                near = np.zeros(len(lines), bool)
                near[line] = True
                out = np.flatnonzero(near | hit(own))
                ends = np.searchsorted(line, np.append(out, len(lines)))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(bucket))
                at = pa.array(doc[out])
                yield pa.RecordBatch.from_arrays([
                    ids.take(at), tks.take(at), pa.array(number[out].astype(np.int32)),
                    pa.array([keys[i] for i in out], pa.binary()), pa.array(np.diff(off)[out], pa.int64()), lists,
                    pa.array([lines[i].encode() if near[i] else None for i in out], pa.binary())], names=names)
            yield pa.RecordBatch.from_arrays([
                ids, tks, pa.nulls(b.num_rows, pa.int32()), pa.nulls(b.num_rows, pa.binary()), pa.array(n_lines),
                pa.nulls(b.num_rows, pa.list_(pa.int64())), pa.nulls(b.num_rows, pa.binary())], names=names)
    return run


def _sign(batches):
    """Candidates with the MinHash values that are compared before the exact check."""
    for b in batches:
        for at in range(0, b.num_rows, 512):
            part = b.slice(at, 512)
            lines = part.column(1).to_pylist()
            sig = minhash(*line_shingles([x.decode() for x in lines]), VERIFY)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() + x for s, x in zip(sig, lines)], pa.binary())],
                                             names=["key", "data"])


def _decode(data: list[bytes]) -> tuple[np.ndarray, Callable[[np.ndarray], list[np.ndarray]]]:
    sig = np.frombuffer(b"".join(d[:4 * VERIFY] for d in data), np.uint32).reshape(len(data), VERIFY)

    def sets(at) -> list[np.ndarray]:
        values, off = line_shingles([data[i][4 * VERIFY:].decode() for i in at])
        return [_distinct(values[a:z]) for a, z in zip(off[:-1], off[1:])]

    return sig, sets


def bucket_filter(buckets: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of 2^bits bits with two places for each bucket hash, from its lower and its upper half; its size is
    fixed, whatever their number. At n buckets a strange one is in it with a probability of about (2 n / 2^bits)^2."""
    mask = F.lit((1 << bits) - 1)
    halves = (F.col("bucket").bitwiseAND(mask) + 1, F.shiftright("bucket", 32).bitwiseAND(mask) + 1)
    place = buckets.select(F.explode(F.array(*halves)).alias("v"))
    rows = (place.groupBy(F.bitmap_bucket_number("v").alias("page"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("bits")))
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in rows.toLocalIterator():
        page = np.frombuffer(bytes(r["bits"]), np.uint8)
        at = (r["page"] - 1) * 4096
        out[at:at + len(page)] = page[:len(out) - at]
    return out


def line_decisions(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = 0.8,
                   filter_bits: int = 27) -> DataFrame:
    """A row per document: ``id``, ``tk`` (text digest), ``n_lines`` (with a character other than white space) and
    ``removed`` (numbers, from 0, of the lines that go, blank lines counted in)."""
    spark = docs.sparkSession
    body = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    digest = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit(""))))
    kind = body.schema["id"].dataType.simpleString()
    texts = body.select("id", digest.alias("tk"), "text")
    parts = 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))  # a task has several, one in memory at a time
    multi = (texts.where("text is not null").mapInArrow(_count_buckets(parts), "part int, buckets binary, ks binary")
             .repartition("part").sortWithinPartitions("part").mapInArrow(_multiple, "bucket bigint"))
    hot = spark.sparkContext.broadcast(bucket_filter(multi, filter_bits))
    passed = written(texts.mapInArrow(
        _candidates(hot, filter_bits),
        f"id {kind}, tk binary, line int, key binary, n_items bigint, bands array<bigint>, text binary"), "line-candidates")
    found, rows = passed.where("line is not null"), passed.where("line is null").select("id", "tk", F.col("n_items").alias("n_lines"))
    near = (found.where("text is not null").groupBy("key").agg(
        F.first("text").alias("text"), F.first("n_items").alias("n_items"), F.first("bands").alias("bands")))
    near = written(near.withColumn("n", F.lit(1).cast("bigint")), "line-classes")

    def payload(candidates: DataFrame) -> DataFrame:
        return near.select("key", "text").join(candidates, "key").mapInArrow(_sign, "key binary, data binary")

    linked = cut(link_classes(near.drop("text"), payload, _decode, threshold))
    roots = connected_components(linked.select(F.col("key").alias("a"), F.col("root").alias("b")))
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "tk", "line")
    lines = found.select("id", "tk", "line", "key")
    # lines at one place only and without a link are a component of their own
    seen = cut(lines.groupBy("key").agg(F.min(first).alias("first"), F.count("*").alias("n"))
               .join(roots.withColumnRenamed("node", "key"), "key", "left").select("key", "first", "n", F.coalesce("root", "key").alias("root")))
    stays = cut(seen.groupBy("root").agg(F.min("first").alias("stays"), F.count("*").alias("_n")))
    keep = cut(join_back(seen.select("key", "root", "n"), stays, "root", "_n").select("key", "stays", "n"))
    gone = (join_back(lines, keep, "key", "n").where(~F.expr("id <=> stays.id and tk = stays.tk and line = stays.line"))
            .groupBy("id", "tk").agg(F.sort_array(F.collect_set("line")).alias("removed")))
    return (rows.alias("r").join(gone.alias("g"), F.expr("r.id <=> g.id and r.tk = g.tk"), "left")
            .select("r.id", "r.tk", "n_lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed")))


def drop_lines(docs: DataFrame, decisions: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents without the lines that go; rows and columns as in the input."""
    gone = decisions.where("size(removed) > 0").select("id", "tk", "removed").dropDuplicates(["id", "tk"])
    t = F.col(f"d.`{text}`")
    joined = docs.alias("d").join(gone.alias("g"), F.col(f"d.`{doc_id}`").eqNullSafe(F.col("g.id"))
                                  & (F.unhex(F.md5(F.coalesce(t, F.lit("")))) == F.col("g.tk")), "left")
    kept = F.array_join(F.filter(F.split(t, "\n"), lambda x, i: ~F.array_contains(F.col("g.removed"), i)), "\n")
    return joined.select(*[(F.when(F.col("g.removed").isNull(), t).otherwise(kept) if c == text else F.col(f"d.`{c}`")).alias(c)
                           for c in docs.columns])
