"""Deterministic keys computed with native hash functions.

``chunk_key`` is a version-5 UUID of the SHA-1 hex digest of the text, so a
chunk's key is stable across retries and runs (no ``uuid()``), and two equal
texts share one cache entry.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_

# Fixed value: the UUID namespace of the content-addressed cache
# (UUID with integer value 1985), as 16 bytes in hex.
CHUNK_NAMESPACE_HEX = "000000000000000000000000000007C1"


def chunk_key(text) -> Column:
    """uuid5(namespace, sha1_hex(utf8 text)) as the dashed 36-char string."""
    name = F.sha1(col_(text))  # 40 hex chars; the uuid5 name is this ASCII string
    digest = F.sha1(F.concat(F.unhex(F.lit(CHUNK_NAMESPACE_HEX)), name.cast("binary")))
    h = F.substring(digest, 1, 32)
    # version nibble (digit 13) := 5; variant nibble (digit 17) := 8 + (d mod 4)
    variant = F.lower(F.hex((F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 8))
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )


def file_id(path, mtime_str, size) -> Column:
    """md5 of ``path_mtime_size``: a touched file is a new file."""
    return F.md5(F.concat_ws("_", col_(path), col_(mtime_str), col_(size).cast("string")))


def content_hash(text) -> Column:
    return F.sha2(col_(text), 256)
