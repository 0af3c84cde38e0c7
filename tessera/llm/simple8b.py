"""Simple-8b: as many ids per 64-bit word as fit, in numpy.

The top 4 bits of a word select how many values of how many bits its low 60 bits hold, first value lowest. Ids come
in blocks; a block's words start at a known offset, so blocks pack and unpack independently and whole columns of them
are handled by vector operations. Selector 0 is the escape: the word after it holds one value of up to 64 bits as is.
The last word of a block may have room for more values than are left; those are zeros, which the block's length cuts.
"""

from __future__ import annotations

import numpy as np

# Fixed values of the format: (values, bits) for selectors 1 to 15; selector 0 is the escape.
SELECTORS = ((120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15),
             (3, 20), (2, 30), (1, 60))
BLOCK = 1024
_COUNT = np.array([1] + [n for n, _ in SELECTORS])
_EDGE = max(n for n, _ in SELECTORS)


_SMALL = np.zeros(1 << 16, np.uint8)  # bit lengths of values of 16 bits
for _bit in range(16):
    _SMALL[1 << _bit:2 << _bit] = _bit + 1


def bit_lengths(ids: np.ndarray) -> np.ndarray:
    if not ids.size or ids.max() < 1 << 16:
        return _SMALL[ids]
    out = np.zeros(ids.shape, np.uint8)
    rest = ids.astype(np.uint64)
    for step in (32, 16, 8, 4, 2, 1):
        big = rest >= np.uint64(1) << np.uint64(step)
        out += (big * step).astype(np.uint8)
        rest = np.where(big, rest >> np.uint64(step), rest)
    return out + (rest > 0)


def pack(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """The words (uint64) of the ids and the offset of each block's first word (one more for the end)."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint64)
    blocks = -(-n // block)
    v = np.zeros((blocks, block + _EDGE), np.uint64)
    flat = np.zeros(blocks * block, np.uint64)
    flat[:n] = ids
    v[:, :block] = flat.reshape(blocks, block)
    length = np.full(blocks, block)
    length[-1] = n - (blocks - 1) * block
    need = bit_lengths(v)
    # the selector that packs most values, from each position on
    best = np.where(need[:, :block] > 60, 0, 15).astype(np.int8)
    widest, span = need, 1
    for s in range(15, 0, -1):
        count, bits = SELECTORS[s - 1]
        while span < count:
            step = min(span, count - span)
            widest = widest.copy()
            widest[:, :-step] = np.maximum(widest[:, :-step], widest[:, step:])
            span += step
        fits = widest[:, :block] <= bits
        if not fits.any():  # nor do more values of fewer bits
            break
        best[fits] = s
    # all blocks advance together, a word at a time
    at, words_in, every = np.zeros(blocks, int), np.zeros(blocks, int), np.arange(blocks)
    steps = []
    while len(every):
        sel = best[every, at[every]].astype(int)
        steps.append((every, at[every], words_in[every], sel))
        at[every] += _COUNT[sel]
        words_in[every] += 1 + (sel == 0)
        every = every[at[every] < length[every]]
    b, p, w, s = (np.concatenate(x) for x in zip(*steps))
    offsets = np.concatenate([[0], np.cumsum(words_in)]).astype(np.uint64)
    place = offsets[b].astype(int) + w
    words = np.zeros(int(offsets[-1]), np.uint64)
    for k in np.unique(s):
        own = s == k
        if k == 0:
            words[place[own] + 1] = v[b[own], p[own]]
            continue
        count, bits = SELECTORS[k - 1]
        out = np.full(own.sum(), np.uint64(k) << np.uint64(60))
        for j in range(count if bits else 0):
            out |= v[b[own], p[own] + j] << np.uint64(bits * j)
        words[place[own]] = out
    return words, offsets


def unpack(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The n ids of the words."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    sel = (words >> np.uint64(60)).astype(int)
    raw = np.zeros(len(words), bool)
    if (sel == 0).any():  # words after an escape are values, not headers
        for at in np.flatnonzero(sel == 0):
            if not raw[at]:
                raw[at + 1] = True
    head = np.flatnonzero(~raw)
    sel = sel[head]
    of = np.searchsorted(offsets, head, "right") - 1
    count = _COUNT[sel]
    upto = np.cumsum(count) - count
    first = np.searchsorted(of, np.arange(len(offsets) - 1))
    start = upto - upto[first][of] + of * block
    end = np.minimum((of + 1) * block, n)
    for k in np.unique(sel):
        own = np.flatnonzero(sel == k)
        if k == 0:
            out[start[own]] = words[head[own] + 1]
            continue
        number, bits = SELECTORS[k - 1]
        if not bits:
            continue
        mask = np.uint64((1 << bits) - 1)
        for j in range(number):
            to = start[own] + j
            ok = to < end[own]
            out[to[ok]] = (words[head[own[ok]]] >> np.uint64(bits * j)) & mask
    return out
