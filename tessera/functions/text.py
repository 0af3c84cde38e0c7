"""Text expressions: whitespace, counts, citations, extension handling.

Everything here is a native Column expression, so it runs inside whole-stage
codegen; no Python is involved per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Python's ``str.isspace`` treats as whitespace,
# written as one regex class that both Java regex and RE2 (the DuckDB oracle)
# accept. Spark's ``trim`` strips only spaces, and ``\s`` differs between
# engines, so we spell the set out.
WS_CLASS = (
    r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
WS_RUN = WS_CLASS + "+"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ws_trim(c) -> Column:
    """Strip leading/trailing whitespace like Python ``str.strip()``."""
    return F.regexp_replace(col_(c), f"^{WS_RUN}|{WS_RUN}$", "")


def is_blank(c) -> Column:
    """True when the text is null or whitespace only."""
    return col_(c).isNull() | ~col_(c).rlike(f"[^{WS_CLASS[1:-1]}]")


def words(c) -> Column:
    """Whitespace tokens, like Python ``str.split()`` with no argument."""
    return F.filter(F.split(col_(c), WS_RUN), lambda x: x != F.lit(""))


def word_count(c) -> Column:
    return F.size(words(c)).cast("bigint")


def char_count(c) -> Column:
    """Length in code points (Spark ``length`` counts characters, not bytes)."""
    return F.length(col_(c)).cast("bigint")


def file_extension(path) -> Column:
    """Lower-cased final suffix including the dot, '' when there is none
    (like ``Path.suffix``: a leading-dot name such as '.env' has none)."""
    return F.lower(F.regexp_extract(col_(path), r"[^/]+(\.[^./]+)$", 1))


def file_name(path) -> Column:
    return F.regexp_extract(col_(path), r"([^/]*)$", 1)


def source_citation(name, path) -> Column:
    return F.concat(F.lit("Source: "), col_(name), F.lit(" (from "), col_(path), F.lit(")"))


def retrieval_context(name, text) -> Column:
    return F.concat(F.lit("["), col_(name), F.lit("]\n"), col_(text))


def dash_normalize(c) -> Column:
    """Replace the em dash (U+2014) with '-'."""
    return F.translate(col_(c), "—", "-")


def paragraphs(c) -> Column:
    """Blank-line separated paragraphs, blank parts dropped (text kept as is)."""
    return F.filter(F.split(col_(c), "\n\n"), lambda p: ~is_blank(p))


def normalize_newlines(c) -> Column:
    """CRLF / CR to LF, as Python's text-mode read does."""
    return F.regexp_replace(col_(c), "\r\n?", "\n")
