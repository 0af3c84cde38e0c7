"""License scan: MinHash bands over overlapping text windows retrieve templates, exact containment verifies them.

Texts and templates are words (runs of letters and digits, lower-cased) and their 3-word shingles. Templates are
classed by length (at most 4, 8, 16, ... words). For a class of at most m words, windows of 3m words start every m
words, so a passage of up to 2m + 1 words lies whole in some window: a template with m words put in between, as far as
the threshold bears that. A window that holds at least the threshold of a template's shingles has a Jaccard similarity
with it of at least

    j = t n / (w + n - t n)      (n shingles in the template, w in a window, threshold t)

so with bands of a single MinHash value, b bands miss it with probability (1 - j)^b; each class takes the b that
brings this below ``MISS`` for its shortest template. Retrieved templates are verified by the exact share of their
shingles in the window.

All of this is column expressions on the row of the document: no join, no shuffle, no user function. A band can only
agree if the window holds the very shingle that is the template's least, so windows without any template shingle
are left out before their MinHash is computed; that loses nothing. The templates are literals of the plan, in blocks
of at most ``BLOCK_SHINGLES`` shingles; more templates mean more passes.

Defined results
- null or empty text has no match; a template of fewer than 3 words is an error;
- repeated rows and repeated matches: every row has its own result, each license at most once (it may have many templates),
  with its first matching window and the greatest containment; an empty table gives an empty result;
- the added column is named by the caller; a clash with an input column is a ValueError.
"""

from __future__ import annotations

import math
import re
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled
from .license_texts import TEMPLATES

SHINGLE = 3
WINDOW = 3  # class lengths in a window
MISS = 1e-6
BLOCK_SHINGLES = 2000
_WORD_GAP = r"[^\p{L}\p{N}]+"


def template_words(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def length_class(n_words: int) -> int:
    return max(4, 1 << (n_words - 1).bit_length())


def bands(n_shingles: int, longest: int, threshold: float) -> int:
    """Bands of one value with which a matching window is missed with a probability below MISS."""
    n, w = math.ceil(threshold * n_shingles - 1e-9), WINDOW * longest - SHINGLE + 1
    j = n / (w + n_shingles - n)
    return 1 if j >= 1 else math.ceil(math.log(MISS) / math.log(1 - j))


def _band_values(shingles: str, b: int) -> str:
    """SQL for the band hashes of an array of shingles: the least value under each of b hash functions."""
    return (f"transform(sequence(0, {b - 1}), j -> xxhash64(j, array_min(transform({shingles}, x -> xxhash64(x, j)))))")


def _shingle_sql(words: str) -> str:
    return (f"case when size({words}) < {SHINGLE} then cast(array() as array<bigint>) else transform(sequence(0, size({words}) - {SHINGLE}), "
            f"i -> xxhash64(get({words}, i), get({words}, i + 1), get({words}, i + 2))) end")


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = 0.8, text: str = "text",
         into: str = "licenses") -> DataFrame:
    """Every row with ``into``: an array of (license, first_word, containment), by license."""
    if into.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"input has a column {into}")
    sized = []
    for name, body in templates:
        w = template_words(body)
        if len(w) < SHINGLE:
            raise ValueError(f"template {name} has fewer than {SHINGLE} words")
        sized.append((name, w, len({tuple(w[i:i + 3]) for i in range(len(w) - 2)})))
    blocks, size = [[]], 0
    for t in sized:
        if blocks[-1] and size + t[2] > BLOCK_SHINGLES:
            blocks.append([])
            size = 0
        blocks[-1].append(t)
        size += t[2]
    g, hits = "__license_g", "__license_hits"
    out = docs.withColumn("__license_w", F.filter(
        F.split(F.lower(F.coalesce(F.col(f"`{text}`"), F.lit(""))), _WORD_GAP), lambda x: x != ""))
    out = out.withColumn(g, F.expr(_shingle_sql("`__license_w`"))).withColumn(hits, F.array().cast(
        "array<struct<license:string,first_word:bigint,containment:double>>"))
    for block in blocks:
        out = _scan_block(out, block, threshold, g, hits) if block else out
    best = F.expr(
        f"transform(array_sort(array_distinct(transform(`{hits}`, h -> h.license))), l -> named_struct('license', l, "
        f"'first_word', array_min(transform(filter(`{hits}`, h -> h.license = l), h -> h.first_word)), "
        f"'containment', array_max(transform(filter(`{hits}`, h -> h.license = l), h -> h.containment))))")
    return out.withColumn(into, settled(best)).drop("__license_w", g, hits)


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _longs(values) -> str:
    return ", ".join(f"{x}L" for x in values)


def _scan_block(rows: DataFrame, block: list, threshold: float, g: str, hits: str) -> DataFrame:
    spark = rows.sparkSession
    # the hashes of the template shingles, by the same functions as the texts'
    names = [n for n, _, _ in block]
    w = spark.createDataFrame([(i, x, length_class(len(x))) for i, (_, x, _) in enumerate(block)], "name int, w array<string>, cls int")
    t = {r["name"]: (r["cls"], r["g"]) for r in w.select("name", "cls", F.expr(f"array_distinct({_shingle_sql('w')})").alias("g")).collect()}
    p = "__license_p"
    every = sorted({x for _, v in t.values() for x in v})
    at = rows.withColumn(p, F.expr(
        f"filter(sequence(0, greatest(size(`{g}`) - 1, 0)), i -> get(`{g}`, i) in ({_longs(every)}))"))
    found: Column = F.col(hits)
    for cls in sorted({c for c, _ in t.values()}):
        own = [(n, v) for n, (c, v) in t.items() if c == cls]
        b = max(bands(len(v), cls, threshold) for _, v in own)
        values = spark.createDataFrame(own, "name int, v array<bigint>").select("name", "v", F.expr(_band_values("v", b)).alias("b")).collect()
        literal = "array(" + ", ".join(
            f"named_struct('license', {_quoted(names[r['name']])}, 'sh', array({_longs(r['v'])}), 'bands', array({_longs(r['b'])}))" for r in values) + ")"
        span = WINDOW * cls - SHINGLE + 1
        near = ", ".join(f"i div {cls} - {x}" for x in range(WINDOW))
        starts = (f"array_distinct(filter(flatten(transform(`{p}`, i -> array({near}))), k -> k >= 0))")
        windows = (f"transform({starts}, k -> named_struct('k', k, 'sh', array_distinct(slice(`{g}`, cast(k * {cls} + 1 as int), {span}))))")
        banded = f"transform({windows}, w -> named_struct('k', w.k, 'sh', w.sh, 'bands', {_band_values('w.sh', b)}))"
        share = "size(array_intersect(t.sh, w.sh)) / size(t.sh)"
        match = (f"flatten(transform({banded}, w -> transform(filter({literal}, t -> arrays_overlap(t.bands, w.bands) and "
                 f"size(array_intersect(t.sh, w.sh)) >= {threshold}D * size(t.sh) - 1e-9D), "
                 f"t -> named_struct('license', t.license, 'first_word', cast(w.k * {cls} as bigint), 'containment', {share}))))")
        found = F.concat(found, F.expr(f"case when size(`{p}`) > 0 then {match} else "
                                       "cast(array() as array<struct<license:string,first_word:bigint,containment:double>>) end"))
    return at.withColumn(hits, found).drop(p)
