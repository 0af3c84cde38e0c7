"""Tokenizer in the tasks: ids of whole texts by a vocabulary file of the tokenizers library.

For a vocabulary whose normaliser and splitter never look across ASCII white space, and drop it, a text's ids are
those of its white-space runs in a row; ``Encoder`` then keeps the ids of the runs it has met (most words of a corpus
are repeats). A run of plain letters and/or plain punctuation goes straight to the merges of the library's model; any
other run, and any other vocabulary, goes through the whole tokenizer.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa

from .shingles import _SPACE, byte_view

GROUP = 8 << 20
CACHE = 400_000  # runs kept per worker process; a bound on memory, not on what is encoded
# letters that are alone in their case folding and composition, then punctuation without the apostrophe
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([.,;:!?%#*&$|()\-]*)")


def _byte_letters() -> list[str]:
    """The letters by which byte-level vocabularies write bytes."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class _Runs(dict):
    """Ids by run; a run that is not known is made, and kept while there is room."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, run: bytes) -> bytes:
        return self.make(run)


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        split = (conf.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        steps = [x["type"] for x in (conf.get("normalizer") or {}).get("normalizers") or []]
        self.by_run = (
            steps == ["NFC", "Replace", "Lowercase"] and split[0].get("type") == "Split" and split[0].get("invert")
            and split[0].get("behavior") == "Removed" and r"[^\s\p{L}\p{N}]+" in (split[0].get("pattern") or {}).get("Regex", "")
            and conf["model"].get("end_of_word_suffix") == "</w>" and not any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in conf["added_tokens"]))
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.runs = _Runs(self._run)
        self.parts: dict[str, bytes] = {}

    def _part(self, text: str) -> bytes:
        ids = self.parts.get(text)
        if ids is None:
            spelled = text if text.isascii() else "".join(self.letters[b] for b in text.encode())
            ids = np.array([t.id for t in self.model.tokenize(spelled)], "<u4").tobytes()
            if len(self.parts) < CACHE:
                self.parts[text] = ids
        return ids

    def _run(self, run: bytes) -> bytes:
        text = run.decode()
        m = _PLAIN.fullmatch(text)
        if m:
            ids = (self._part(m[1].lower()) if m[1] else b"") + (self._part(m[2]) if m[2] else b"")
        else:
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self.runs) < CACHE:
            self.runs[run] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian 32-bit integers."""
        if not text:
            return b""
        if not self.by_run:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.runs.__getitem__, text.encode().split()))


    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row (uint32), and the number of each text's; null counts as empty. About ``GROUP`` bytes (at
        least one text) are in work at a time: their runs are numbered by Arrow, and only the different ones are looked up."""
        if not self.by_run:
            parts = [self.encode(t.as_py()) for t in texts]
            return np.frombuffer(b"".join(parts), "<u4"), np.array([len(x) // 4 for x in parts], np.int64)
        b, off = byte_view(texts)
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        lo = 0
        while lo < len(off) - 1:
            hi = min(len(off) - 1, max(lo + 1, int(np.searchsorted(off, off[lo] + GROUP, "right")) - 1))
            own, at = b[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
            solid = ~_SPACE[own]
            first = solid.copy()
            first[1:] &= ~solid[:-1]
            head = at[:-1][at[:-1] < len(own)]
            first[head] = solid[head]  # a run ends with its text
            last = solid.copy()
            last[:-1] &= ~solid[1:] | first[1:]
            start = np.flatnonzero(first)
            ends = np.concatenate([[0], np.cumsum(np.flatnonzero(last) + 1 - start)])
            wide = ends[-1] >= 1 << 31
            runs = (pa.LargeBinaryArray if wide else pa.BinaryArray).from_buffers(
                pa.large_binary() if wide else pa.binary(), len(start), [None, pa.py_buffer(ends.astype(np.int64 if wide else np.int32).tobytes()), pa.py_buffer(own[solid].tobytes())])
            numbered = runs.dictionary_encode()
            known = list(map(self.runs.__getitem__, numbered.dictionary.to_pylist()))
            flat = np.frombuffer(b"".join(known), "<u4")
            size = np.fromiter(map(len, known), np.int64, len(known)) // 4
            which = numbered.indices.to_numpy()
            n = size[which]
            upto = np.cumsum(n)
            place = np.repeat((np.cumsum(size) - size)[which] - upto + n, n)
            place += np.arange(len(place))
            ids.append(flat[place])
            counts.append(np.diff(np.append(0, upto)[np.searchsorted(start, at)]))
            lo = hi
        return np.concatenate(ids), np.concatenate(counts)


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """The worker process's encoder of a vocabulary file."""
    return Encoder(path)
