"""Word and character shingles as 64-bit hashes, and MinHash signatures, in numpy over Arrow batches.

Words are runs outside ASCII white space, lower-cased. Hashes come from prefix sums of a polynomial over the bytes
(mod 2^64), so a batch costs a few vector operations. A segment of about ``SEGMENT`` bytes is in work at a time, cut
at white space, which bounds the memory for texts of any length.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_P = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit multiply-xorshift hash."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


@lru_cache(None)
def stream(seed: int, n: int) -> np.ndarray:
    """n pseudo-random odd 64-bit numbers, the same in every process."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_P) + np.uint64(seed)) | np.uint64(1)


@lru_cache(4)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base & _MASK, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(SEGMENT * 2, 1 << int(n + 1).bit_length())
    return _powers(size, _P), _powers(size, pow(_P, -1, 1 << 64))


def byte_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an array of strings and the n + 1 offsets of its texts; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _segment_words(b: np.ndarray, starts_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start positions and hashes of the words of one segment; starts_doc: positions where a text begins."""
    solid = ~_SPACE[b]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    at_doc = starts_doc[starts_doc < len(b)]
    first[at_doc] = solid[at_doc]
    start = np.flatnonzero(first)
    if not len(start):
        return start, np.zeros(0, np.uint64)
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    before = at_doc[at_doc > 0] - 1
    last[before] = solid[before]
    end = np.flatnonzero(last) + 1
    up, down = _tables(len(b))
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(stream(7, 256)[b] * up[:len(b)], out=sums[1:])
    h = (sums[end] - sums[start]) * down[start]
    return start, mix64(h ^ (end - start).astype(np.uint64))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the n + 1 offsets of the texts in them."""
    b, offsets = byte_view(pc.utf8_lower(texts.cast(pa.large_string())))
    hashes, starts, at = [], [], 0
    doc_starts = offsets[:-1]
    while at < len(b):
        end = at + SEGMENT
        if end >= len(b):
            end = len(b)
        else:  # on to the next white space or text
            stop = np.searchsorted(doc_starts, end)
            limit = int(doc_starts[stop]) if stop < len(doc_starts) else len(b)
            while end < limit:
                gap = np.flatnonzero(_SPACE[b[end:min(limit, end + 65536)]])
                if len(gap):
                    end += int(gap[0])
                    break
                end = min(limit, end + 65536)
        lo, hi = np.searchsorted(doc_starts, [at, end])
        s, h = _segment_words(b[at:end], doc_starts[lo:hi] - at)
        starts.append(s + at)
        hashes.append(h)
        at = end
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), np.searchsorted(start, offsets)


def word_shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles (repeats included) and the n + 1 offsets of the texts in them. A text of fewer
    than k words has one shingle of all its words; one without words has none."""
    w, off = word_hashes(texts)
    n = np.diff(off)
    counts = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    out = np.concatenate([[0], np.cumsum(counts)])
    m = stream(k, k)
    rolled = np.zeros(max(0, len(w) - k + 1), np.uint64)
    for j in range(k if len(rolled) else 0):
        rolled += w[j:len(w) - k + 1 + j] * m[j]
    full = np.flatnonzero(n >= k)
    res = np.zeros(out[-1], np.uint64)
    if len(full):
        idx = np.arange(counts[full].sum()) + np.repeat(off[full] - np.cumsum(counts[full]) + counts[full], counts[full])
        dest = np.arange(len(idx)) + np.repeat(out[full] - np.cumsum(counts[full]) + counts[full], counts[full])
        res[dest] = rolled[idx]
    for d in np.flatnonzero((n > 0) & (n < k)):
        res[out[d]] = (w[off[d]:off[d + 1]] * m[:n[d]]).sum(dtype=np.uint64) + np.uint64(n[d])
    return mix64(res), out


def distinct(values: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct values of each text."""
    for a, z in zip(offsets[:-1], offsets[1:]):
        yield np.unique(values[a:z])


def set_key(items: np.ndarray) -> bytes | None:
    """128-bit key of a set of shingles; None for the empty set."""
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest() if len(items) else None


def minhash(values: np.ndarray, offsets: np.ndarray, size: int, seed: int = 11) -> np.ndarray:
    """Signatures (texts x size, uint32) by ``size`` hashes a x + c modulo 2^32 of the (well mixed) values' lower halves; rows of
    empty sets are undefined. 32-bit products run several at a time in a core."""
    a, c = ((stream(s, size) >> np.uint64(32)).astype(np.uint32) for s in (seed, seed + 1))
    a |= np.uint32(1)
    out = np.zeros((len(offsets) - 1, size), np.uint32)
    full = np.flatnonzero(np.diff(offsets) > 0)
    lo = 0
    while lo < len(full):  # a few texts at a time, so that their values stay in the cache
        hi = max(lo + 1, int(np.searchsorted(offsets[full], offsets[full[lo]] + 65536)))
        part, base = full[lo:hi], offsets[full[lo]]
        v, at = values[base:offsets[part[-1] + 1]].astype(np.uint32), offsets[part] - base
        h = np.empty_like(v)
        for i in range(size):
            np.multiply(v, a[i], out=h)
            h += c[i]
            out[part, i] = np.minimum.reduceat(h, at)
        lo = hi
    return out


def band_hashes(signatures: np.ndarray, rows: int, salt: int = 0) -> np.ndarray:
    """Hashes (texts x bands, int64) of the bands of ``rows`` values; equal only for the same band."""
    bands = signatures.shape[1] // rows
    parts = signatures[:, :bands * rows].reshape(len(signatures), bands, rows).astype(np.uint64)
    h = (parts * stream(5 + salt, rows)).sum(axis=2, dtype=np.uint64) + stream(6 + salt, bands)
    return mix64(h).view(np.int64)
