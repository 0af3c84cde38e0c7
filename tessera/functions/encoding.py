"""Text encodings told and decoded by native expressions over the bytes.

The bytes are looked at as ISO-8859-1 text, one character a byte, so counting classes of bytes is string work that stays in
the JVM. In order:

1. a byte-order mark (UTF-8, UTF-16, UTF-32);
2. valid UTF-8;
3. UTF-16 without a mark: zero bytes nearly all at even or at odd places, and well-formed surrogates;
4. the most likely of the candidates. A multi-byte candidate must be well-formed. Every candidate scores the histogram of the
   bytes from 0x80: a log weight for the class of the character that it gives a byte (small letter, one beyond Latin-1, capital, sign,
   drawing, control), and for the company it keeps: accented
   letters stand among ASCII letters, those of other scripts among themselves.

Single-byte code pages are decoded natively by a character map, built from Python's codec of the same name; the multi-byte ones
in an Arrow UDF that sees only the rows told to be so. Weights are rules over Unicode categories; there is no training.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Python codec names of the candidates. Earlier ones win ties.
SINGLE_BYTE = ("cp1252", "cp1250", "cp1255", "cp1251", "koi8-r", "cp1253", "mac-roman", "cp850", "cp866")
MULTI_BYTE = ("shift_jis", "euc-kr", "gb18030", "euc-jp", "big5")
# Lead and trail bytes of a character of two bytes, and the leads of common letters, as regex classes.
PAIRS = {
    "shift_jis": (r"[\x81-\x9F\xE0-\xFC]", r"[\x40-\x7E\x80-\xFC]", r"(?:\x82[\x9F-\xF1]|\x83[\x40-\x96]|\x81[\x41-\x7E]|[\x88-\x97][\x40-\x7E\x80-\xFC])"),
    "euc-jp": (r"[\x8E\xA1-\xFE]", r"[\xA1-\xFE]", r"(?:[\xA4\xA5][\xA1-\xF6]|\xA1[\xA2-\xFE]|[\xB0-\xCF][\xA1-\xFE])"),
    "gb18030": (r"[\x81-\xFE]", r"[\x40-\x7E\x80-\xFE]", r"(?:[\xB0-\xD7][\xA1-\xFE]|\xA1[\xA2-\xBF]|\xA3[\xA1-\xFE])"),
    "big5": (r"[\x81-\xFE]", r"[\x40-\x7E\xA1-\xFE]", r"(?:[\xA4-\xC6][\x40-\x7E\xA1-\xFE]|\xA1[\x40-\x7E])"),
    "euc-kr": (r"[\xA1-\xFE]", r"[\xA1-\xFE]", r"(?:[\xB0-\xC8][\xA1-\xFE]|\xA1[\xA2-\xBF])"),
}
HIGH = "".join(map(chr, range(128, 256)))
# Log weights of the accented letters of western Europe by how usual they are, a group a weight.
USUAL = {-0.4: "é", -0.9: "èüäàóáñ", -1.1: "öíçßú", -1.5: "êâôùø", -1.9: "îûëïœåæ"}
# log weights of other bytes by the class of their character
WEIGHTS = {"lower": -1.0, "rarer": -2.6, "upper": -2.5, "sign": -2.2, "symbol": -6.0, "odd": -14.0, "stray": -3.0}
STRANGER, COMMON_PAIR, RARE_PAIR, PRIOR = -3.0, -1.5, -9.0, -0.02


@lru_cache(None)
def code_page(name: str) -> tuple[str, ...]:
    """The characters of the bytes 128 to 255; those without one stand for themselves."""
    return tuple(bytes([i]).decode(name, errors="ignore") or chr(i) for i in range(128, 256))


def _class(c: str) -> str | float:
    usual = [w for w, letters in USUAL.items() if c in letters]
    if usual:
        return usual[0]
    kind = unicodedata.category(c)
    if kind in ("Ll", "Lo", "Lm"):
        return "rarer" if 0xAA <= ord(c) < 0x250 else "lower"
    if kind in ("Lu", "Lt"):
        return "upper"
    if kind in ("Pi", "Pf", "Pd", "Ps", "Po", "Zs", "Sc") and ord(c) >= 0xA0:
        return "sign"
    return "odd" if kind in ("Cc", "Cn", "Co") else "symbol"


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, "")) if chars else F.lit(0)


def _weight(byte: str, c: str, name: str, among_capitals: bool) -> float:
    if not bytes([ord(byte)]).decode(name, errors="ignore"):
        return WEIGHTS["odd"]
    if among_capitals and c.lower() != c.upper():
        c, other = c.lower(), c != c.upper()
        return WEIGHTS["stray"] if other else WEIGHTS.get(_class(c), _class(c))
    kind = _class(c)
    return WEIGHTS.get(kind, kind)


def _groups(name: str, among_capitals: bool) -> dict[float, str]:
    """The bytes from 0x80 by weight."""
    out: dict[float, str] = {}
    for byte, c in zip(HIGH, code_page(name)):
        w = _weight(byte, c, name, among_capitals)
        out[w] = out.get(w, "") + byte
    return out


def _score_single(high: Column, upper: Column, beside: Column, apart: Column, name: str, rank: int) -> Column:
    """``upper``: the bytes that stand behind an ASCII capital and before no small letter."""
    parts = [(_count(high, chars) - _count(upper, chars)) * F.lit(w) for w, chars in _groups(name, False).items()]
    parts += [_count(upper, chars) * F.lit(w) for w, chars in _groups(name, True).items()]
    latin = sum(unicodedata.name(c, "").startswith("LATIN SMALL") for c in code_page(name)) > 8
    # letters in strange company: accented ones in a row, others next to ASCII letters
    return reduce(lambda a, b: a + b, parts) + (apart if latin else beside) * F.lit(STRANGER) + F.length(high) * F.lit(rank * PRIOR)


def _score_multi(s: Column, name: str, rank: int) -> Column:
    lead, trail, common = PAIRS[name]
    rest = F.regexp_replace(s, lead + trail, "")
    alone = r"[\x80\xA0\xE0-\xFF\x81-\x9F]" if name == "shift_jis" else r"[\x80-\xFF]"
    n_pairs = (F.length(s) - F.length(rest)) / 2
    n_common = F.regexp_count(F.regexp_replace(s, f"({lead}{trail})", "Ā$1"), F.lit("Ā" + common))
    fit = n_common * F.lit(COMMON_PAIR) + (n_pairs - n_common) * F.lit(RARE_PAIR) + (F.length(rest) - F.length(F.regexp_replace(rest, r"[\x80-\xFF]", ""))) * F.lit(-4.0)
    return F.when(~rest.rlike(alone), fit + F.length(s) * F.lit(rank * 1e-6))


def _let(body, **values: Column) -> Column:
    """``body`` of values that are evaluated once a row."""
    return F.element_at(F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), body), 1)


def _wide(upper: Column) -> Column:
    """Surrogates in pairs, by the upper byte of every unit."""
    return ~F.regexp_replace(upper, r"[\xD8-\xDB][\xDC-\xDF]", "").rlike(r"[\xD8-\xDF]")


def _utf_16(x: Column) -> Column:
    """UTF-16 without a mark, by the bytes at even and at odd places; else null."""
    zeros = x["n_even"] + x["n_odd"]
    return (F.when((x["n_odd"] >= zeros * 0.95) & _wide(x["odd"]), "utf-16-le")
            .when((x["n_even"] >= zeros * 0.95) & _wide(x["even"]), "utf-16-be"))


def _most_likely(x: Column) -> Column:
    scores = F.array(*[F.struct(_score_single(x["high"], x["upper"], x["beside"], x["apart"], n, i).alias("v"), F.lit(-i).alias("i"), F.lit(n).alias("name"))
                       for i, n in enumerate(SINGLE_BYTE)],
                     *[F.struct(_score_multi(x["s"], n, -i).alias("v"), F.lit(-99 - i).alias("i"), F.lit(n).alias("name"))
                       for i, n in enumerate(MULTI_BYTE)])
    likely = F.array_max(F.filter(scores, lambda y: y["v"].isNotNull()))["name"]
    # without a byte of its own it is the older encoding: the same text
    return F.when(likely == "cp1252", F.when(x["s"].rlike(r"[\x80-\x9F]"), "cp1252").otherwise("iso-8859-1")).otherwise(likely)


def detect_encoding(content) -> Column:
    """The Python codec name of the bytes (``utf-8`` for empty ones; null for null)."""
    c = F.col(content) if isinstance(content, str) else content
    zero = F.lit("\0")

    def halves(s: Column) -> Column:
        even, odd = F.regexp_replace(s, r"(?s)(.)(.)", "$1"), F.regexp_replace(s, r"(?s)(.)(.)", "$2")
        return _let(lambda x: _let(_utf_16, even=x["even"], odd=x["odd"], n_even=_count(x["even"], "\0"), n_odd=_count(x["odd"], "\0")), even=even, odd=odd)

    def likeliest(s: Column) -> Column:
        return _let(_most_likely, s=s, high=F.regexp_replace(s, r"[\x00-\x7F]+", ""),
                    upper=F.array_join(F.regexp_extract_all(s, F.lit(r"(?<=[A-Z])[\x80-\xFF](?![a-z])"), F.lit(0)), ""),
                    beside=F.regexp_count(s, F.lit(r"(?<=[A-Za-z])[\x80-\xFF]|[\x80-\xFF](?=[A-Za-z])")),
                    apart=F.regexp_count(s, F.lit(r"(?<=[\xC0-\xFF])[\xC0-\xFF]")))

    def told(x: Column) -> Column:
        s = x["s"]
        return (F.when(s.startswith("\xff\xfe\0\0") | s.startswith("\0\0\xfe\xff"), "utf-32")
                .when((s.startswith("\xff\xfe") | s.startswith("\xfe\xff")) & (F.length(s) % 2 == 0), "utf-16")
                .otherwise(F.coalesce(
                    F.when(F.contains(s, zero) & (F.length(s) % 2 == 0), halves(s)),
                    F.when(F.is_valid_utf8(x["c"]), F.when(s.startswith("\xef\xbb\xbf"), "utf-8-sig").otherwise("utf-8")),
                    likeliest(s))))

    return F.when(c.isNotNull(), _let(told, c=c, s=F.decode(c, "ISO-8859-1")))


def text_encoding(content, encoding: str = "utf-8") -> Column:
    """How a text file is read: by the given encoding (UTF-8, where valid; a mark of UTF-8 stays in the text, as a reader of plain
    UTF-8 leaves it), else by the detected one."""
    c = F.col(content) if isinstance(content, str) else content
    if encoding.lower().replace("_", "-") not in ("utf-8", "utf8"):
        return F.lit(encoding.lower())
    return F.when(F.is_valid_utf8(c), "utf-8").otherwise(detect_encoding(c))


def encode_as(text, encoding: str) -> Column:
    """The text as bytes in one of the encodings that need no Python; null where a character has no byte in a code page."""
    t = F.col(text) if isinstance(text, str) else text
    if encoding in SINGLE_BYTE:
        page = code_page(encoding)
        known = "".join(c for c, b in zip(page, HIGH))
        lacking = F.length(F.translate(F.regexp_replace(t, r"[\x00-\x7F]+", ""), known, "")) > 0
        return F.encode(F.when(~lacking, F.translate(t, known, HIGH)), "ISO-8859-1")
    if encoding == "utf-32":  # with its mark
        return F.concat(F.lit(b"\0\0\xfe\xff"), F.encode(t, "UTF-32"))
    return F.encode(t, {"utf-8": "UTF-8", "iso-8859-1": "ISO-8859-1", "utf-16": "UTF-16", "utf-16-le": "UTF-16LE", "utf-16-be": "UTF-16BE"}[encoding])


@F.pandas_udf(StringType())
def _decode_in_python(content: pd.Series, encoding: pd.Series) -> pd.Series:
    return pd.Series([None if b is None else bytes(b).decode(e, errors="replace") for b, e in zip(content, encoding)], dtype=object)


def decode_as(content, encoding) -> Column:
    """The bytes as text by the encoding named in a column (Python codec names of this module, and ``iso-8859-1``). A code page's
    bytes without a character stay the controls of that number."""
    c = F.col(content) if isinstance(content, str) else content
    e = F.col(encoding) if isinstance(encoding, str) else encoding
    latin = F.decode(c, "ISO-8859-1")
    native = (F.when(e == "utf-8", F.decode(F.when(F.is_valid_utf8(c), c), "UTF-8"))
              .when(e == "utf-8-sig", F.regexp_replace(F.decode(F.when(F.is_valid_utf8(c), c), "UTF-8"), "^﻿", ""))
              .when(e == "iso-8859-1", latin))
    for name in SINGLE_BYTE:
        native = native.when(e == name, F.translate(latin, HIGH, "".join(code_page(name))))
    by_python = e.isin(*MULTI_BYTE, "utf-16", "utf-16-le", "utf-16-be", "utf-32")
    return F.coalesce(native, _decode_in_python(F.when(by_python, c), F.when(by_python, e)))
