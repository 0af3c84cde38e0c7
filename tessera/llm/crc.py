"""CRC-32 of any substring from two running values, in numpy.

``crc(ab) = shift(crc(a), len(b)) ^ crc(b)``, where ``shift(c, n)``, the multiplication by x^(8n) modulo the polynomial, is linear
over GF(2). So a text is scanned once, the running CRC of each prefix is kept, and the CRC of a substring is
``running[end] ^ shift(running[start], end - start)``. A shift by n goes through one table per set bit of n.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32, reflected


@lru_cache(None)
def byte_table() -> np.ndarray:
    """One step of the register for each byte."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = (t >> np.uint32(1)) ^ np.where(t & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    return t


def step(crc: np.ndarray, byte: int) -> np.ndarray:
    """The CRCs after one more byte."""
    c = ~crc.astype(np.uint32)
    return ~(byte_table()[(c ^ np.uint32(byte)) & np.uint32(255)] ^ (c >> np.uint32(8)))


@lru_cache(None)
def _power(bit: int) -> np.ndarray:
    """Four tables (one per byte of the register) of the shift by 2^bit bytes."""
    if bit == 0:
        zero = byte_table()
        image = [int(zero[(1 << i) & 255]) ^ ((1 << i) >> 8) for i in range(32)]
    else:
        image = _apply(_power(bit - 1), _apply(_power(bit - 1), np.uint32(1) << np.arange(32, dtype=np.uint32))).tolist()
    out = np.zeros((4, 256), np.uint32)
    for byte in range(4):
        for i in range(8):
            out[byte, (np.arange(256) >> i) & 1 == 1] ^= np.uint32(image[8 * byte + i])
    return out


def _apply(t: np.ndarray, c: np.ndarray) -> np.ndarray:
    m = np.uint32(255)
    return t[0][c & m] ^ t[1][(c >> np.uint32(8)) & m] ^ t[2][(c >> np.uint32(16)) & m] ^ t[3][c >> np.uint32(24)]


def shift(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The CRCs moved past ``length`` more bytes each (their part of the CRC of the longer text)."""
    out = crc.astype(np.uint32)
    bit, most = 0, int(length.max()) if len(length) else 0
    while most >> bit:
        at = np.flatnonzero((length >> bit) & 1)
        out[at] = _apply(_power(bit), out[at])
        bit += 1
    return out
