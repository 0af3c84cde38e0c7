"""Fill-in-the-middle by displacement scatter, in numpy over Arrow batches.

A text is cut into units (runs of ASCII letters, any other code point alone). Two hashed unit numbers cut it into prefix, middle
and suffix, which are written in the order of a form:

    plain   the text            psm   <P>prefix<S>suffix<M>middle            spm   <S>suffix<P>prefix<M>middle

The bytes of many texts are moved together. A scan finds the cuts; every cut puts the change of displacement into a difference
array; its cumulative sum is the shift of every byte, by which one scatter builds all outputs. ``restore`` reads the markers
of the outputs, builds the difference array of the way back, and gathers. About ``GROUP`` bytes (at least one text) are in
work at a time, which needs some 25 times that memory.

Defined results
- null text: as empty; an empty text, or one that holds a marker, is plain, so that every output can be restored;
- null doc_id: hashed as an empty string; rows of equal id get equal hashes; equal rows give equal rows;
- an empty table gives an empty one; other columns are ignored, or carried unread where ``keep`` names them.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import internal
from .shingles import byte_view

GROUP = 1 << 20
FORMS = ("plain", "psm", "spm")
MARKERS = (b"<P>", b"<S>", b"<M>")  # prefix, suffix, middle
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def groups(offsets: np.ndarray, size: int = GROUP):
    """Runs of texts (first, last + 1) of about ``size`` bytes, at least one text each."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1))
        yield lo, hi
        lo = hi


def places(b: np.ndarray, offsets: np.ndarray, marker: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where a marker begins, and the text that it lies in (never across two texts)."""
    hit = np.ones(max(0, len(b) - len(marker) + 1), bool)
    for i, c in enumerate(marker):
        hit &= b[i:i + len(hit)] == c
    at = np.flatnonzero(hit)
    text = np.searchsorted(offsets, at, "right") - 1
    inside = at + len(marker) <= offsets[text + 1]
    return at[inside], text[inside]


def shifted(points: np.ndarray, shifts: np.ndarray, n: int) -> np.ndarray:
    """The shift of each of n bytes: ``shifts[i]`` holds from ``points[i]`` (ascending) to the next point."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, points, np.diff(shifts, prepend=0))
    return np.cumsum(change[:n])


def scatter(b: np.ndarray, offsets: np.ndarray, h: np.ndarray, plain_from: int, spm_below: int):
    """Outputs of the texts ``b[offsets]`` by their four hashes (columns of ``h``): bytes, offsets, units, form numbers,
    code points of the prefix and of the middle."""
    start, end = offsets[:-1], offsets[1:]
    lead = (b & 0xC0) != 0x80
    letter = _LETTER[b]
    unit = lead.copy()
    unit[1:] &= ~(letter[1:] & letter[:-1])
    filled = start[start < end]
    unit[filled] = lead[filled]
    at = np.flatnonzero(unit)
    base = np.searchsorted(at, offsets)
    n = np.diff(base)
    one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    at = np.append(at, len(b))
    first, second = (np.where(u < n, at[np.minimum(base[:-1] + u, len(at) - 1)], end) for u in (np.minimum(one, two), np.maximum(one, two)))
    chars = np.concatenate([[0], np.cumsum(lead)])
    form = np.where(h[:, 3] % 100 < spm_below, 2, 1)
    form[(start == end) | (h[:, 2] % 100 >= plain_from)] = 0
    for marker in MARKERS:
        form[places(b, offsets, marker)[1]] = 0
    p, m, s = first - start, second - first, end - second
    mp, ms, mm = (len(x) for x in MARKERS)
    moved = form > 0
    out_off = np.concatenate([[0], np.cumsum(end - start + moved * (mp + ms + mm))])
    o = out_off[:-1]
    spm = form == 2
    # places of the three markers in the output, each followed by its part
    at_p = o + spm * (ms + s)
    at_s = o + ~spm * (mp + p)
    at_m = o + mp + p + ms + s
    to = np.stack([np.where(moved, at_p + mp, o), np.where(moved, at_m + mm, o + p), np.where(moved, at_s + ms, o + p + m)], 1)
    cuts = np.stack([start, first, second], 1)
    out = np.empty(out_off[-1], np.uint8)
    out[np.arange(len(b)) + shifted(cuts.ravel(), (to - cuts).ravel(), len(b))] = b
    for marker, place in zip(MARKERS, (at_p, at_s, at_m)):
        for i, c in enumerate(marker):
            out[place[moved] + i] = c
    return out, out_off, n, form, chars[first] - chars[start], chars[second] - chars[first]


def gather(b: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of outputs ``b[offsets]`` by their markers and form numbers: bytes and offsets."""
    start, end = offsets[:-1], offsets[1:]
    moved = form > 0
    at = []
    for marker in MARKERS:
        place, text = places(b, offsets, marker)
        which, first = np.unique(text, return_index=True)
        found = start.copy()
        found[which] = place[first]
        if np.setdiff1d(np.flatnonzero(moved), which).size:
            raise ValueError(f"an output lacks the marker {marker.decode()}")
        at.append(found)
    at_p, at_s, at_m = at
    mp, ms, mm = (len(x) for x in MARKERS)
    spm = form == 2
    from_p, from_m, from_s = at_p + mp, at_m + mm, at_s + ms
    p = np.where(moved, np.where(spm, at_m, at_s) - from_p, end - start)
    m = np.where(moved, end - from_m, 0)
    out_off = np.concatenate([[0], np.cumsum(end - start - moved * (mp + ms + mm))])
    o = out_off[:-1]
    points = np.stack([o, o + p, o + p + m], 1)
    source = np.stack([np.where(moved, from_p, start), np.where(moved, from_m, end), np.where(moved, from_s, end)], 1)
    total = int(out_off[-1])
    return b[np.arange(total) + shifted(points.ravel(), (source - points).ravel(), total)], out_off


def _strings(b: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(b.tobytes())).cast(pa.string())


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 1, plain_from: int = 90,
                   spm_below: int = 20, keep: Sequence[str] = ()) -> DataFrame:
    """``(doc_id, *keep, n, form, prefix_chars, middle_chars, output)``: the transformed text of every row.

    The cuts and the form come from the first four 8-digit groups of the hex SHA-256 of ``seed:doc_id``: plain where the third
    mod 100 is ``plain_from`` or more, spm where the fourth mod 100 is under ``spm_below``.
    """
    hex_ = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))), 256)
    body = docs.select(F.col(f"`{doc_id}`"), *[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string"),
                       *[F.conv(F.substring(hex_, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)])
    carried = body.schema.fields[:1 + len(keep)]
    names = [f.name for f in carried]
    mine = [internal(x, names) if x.lower() in {y.lower() for y in names} else x for x in ("n", "form", "prefix_chars", "middle_chars", "output")]
    kinds = (LongType(), StringType(), LongType(), LongType(), StringType())
    schema = StructType(carried + [StructField(x, k) for x, k in zip(mine, kinds)])
    body = body.toDF(*[f"c{i}" for i in range(len(body.columns))])
    k = len(carried)

    def run(batches):
        for batch in batches:
            b, off = byte_view(batch.column(k))
            h = np.stack([batch.column(k + 1 + i).to_numpy(zero_copy_only=False) for i in range(4)], 1)
            for lo, hi in groups(off):
                out, to, n, form, prefix, middle = scatter(b[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], h[lo:hi], plain_from, spm_below)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(lo, hi - lo) for i in range(k)]
                    + [pa.array(n, pa.int64()), pa.array(np.array(FORMS, object)[form], pa.string()),
                       pa.array(prefix, pa.int64(), mask=form == 0), pa.array(middle, pa.int64(), mask=form == 0), _strings(out, to)],
                    names=[*names, *mine])

    return body.mapInArrow(run, schema)


def restore(outputs: DataFrame, form: str = "form", output: str = "output", name: str = "restored") -> DataFrame:
    """The rows with the exact text of each output in a column ``name`` (null output or form: null)."""
    number = internal("form", outputs.columns)
    body = outputs.withColumn(number, F.array_position(F.array(*map(F.lit, FORMS)), F.col(f"`{form}`")).cast("int") - 1)
    schema = StructType(outputs.schema.fields + [StructField(name, StringType())])
    where = outputs.columns.index(output)

    def run(batches):
        for batch in batches:
            b, off = byte_view(batch.column(where))
            kind = batch.column(batch.num_columns - 1)
            lost = ~(batch.column(where).is_valid().to_numpy(zero_copy_only=False) & kind.is_valid().to_numpy(zero_copy_only=False))
            kind = np.where(lost, 0, kind.fill_null(0).to_numpy(zero_copy_only=False))
            for lo, hi in groups(off):
                texts, to = gather(b[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], kind[lo:hi])
                texts = _strings(texts, to)
                if lost[lo:hi].any():
                    texts = pc.if_else(pa.array(~lost[lo:hi]), texts, None)
                yield pa.RecordBatch.from_arrays([batch.column(i).slice(lo, hi - lo) for i in range(batch.num_columns - 1)] + [texts], names=schema.names)

    return body.mapInArrow(run, schema)
