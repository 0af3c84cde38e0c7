"""Quality rules: a threshold table compiled into one Spark projection.

Each rule is a row ``(name, metric, low, high)``: a document passes when the
metric lies in ``[low, high]`` (None leaves a side open). ``METRICS`` names the
ratios a rule may use, as SQL over the base columns. ``apply_rules`` turns the
table into plain column expressions, so the whole verdict is one projection
over the scan: no user functions, no shuffle, whole texts.

Defined results
- null or empty text: no words, every count 0, ``base_failed`` true;
- a ratio with denominator 0 is 0;
- the stop-word rule speaks of texts in Latin script only, for which the lists are; a text in another script passes it;
- in a script without blanks a text counts half its characters as words, and its words have no mean length;
- repeated rows each get their own verdict; an empty table gives an empty one;
- input columns keep their names; the added columns get the given ``prefix``,
  so an extra input column of the same name is a clash only if the caller
  chooses it, and then a ValueError names it.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NON_SPACE, SPACE, settled

# Frequent function words of languages in Latin script: English, French, German, Spanish, Italian, Portuguese,
# Dutch, Polish, Czech, Swedish and Danish, Finnish, Hungarian, Romanian, Turkish, Indonesian.
STOP_WORDS = (
    "the be to of and that have with a in is it for as on by or an are at this from was not "
    "de la le les des et en un une que qui dans du pour est par sur avec au aux plus "
    "der die das und zu den dem ein eine im ist mit auf für von sich nicht "
    "el los las del y se con para es al lo como su no "
    "il di che non per della sono una gli "
    "os da em um uma não dos mais foi "
    "het een van dat op te zijn niet voor "
    "na nie się jest jak przez oraz przy "
    "že ve jsou který při podle také "
    "och att det som på är av til ikke "
    "ja on ei että se ovat mutta myös "
    "az és hogy nem egy volt csak "
    "și care din pentru sunt într "
    "ve bir bu için ile olarak daha "
    "yang dan di dari untuk dengan pada ini"
).split()
# Bytes a character: below 1.4 a text is mostly in Latin script, for which there are stop words; from 2.2 on it is in a script
# of three bytes a character, mostly written without blanks, whose words are taken as two characters each.
LATIN_BYTES, UNSPACED_BYTES = 1.4, 2.2

# The threshold table: (rule, metric, low, high).
DEFAULT_RULES: tuple[tuple[str, str, float | None, float | None], ...] = (
    ("word_count", "n_words", 50, None),
    ("repeated_trigrams", "repeat_ratio", None, 0.5),
    ("mean_word_length", "mean_word_chars", 2, 15),
    ("symbol_to_word", "symbol_ratio", None, 0.1),
    ("words_with_a_letter", "letter_ratio", 0.7, None),
    ("stop_words", "stop_ratio", 0.03, None),
    ("duplicate_lines", "dup_line_ratio", None, 0.5),
    ("ellipsis_lines", "ellipsis_ratio", None, 0.5),
    ("bullet_lines", "bullet_ratio", None, 0.9),
)

# Metric -> SQL over the base columns ({p} is the column prefix).
METRICS = {
    "n_words": "case when {p}unspaced then greatest({p}n_words, {p}word_chars / 2D) else cast({p}n_words as double) end",
    "repeat_ratio": "coalesce({p}n_repeat_words / nullif({p}n_words, 0), 0D)",
    "mean_word_chars": "case when {p}unspaced then 2D else coalesce({p}word_chars / nullif({p}n_words, 0), 0D) end",
    "symbol_ratio": "coalesce({p}n_symbols / nullif({p}n_words, 0), 0D)",
    "letter_ratio": "coalesce({p}n_letter_words / nullif({p}n_words, 0), 0D)",
    "stop_ratio": "case when {p}listed then coalesce({p}n_stop_words / nullif({p}n_words, 0), 0D) else 1D end",
    "dup_line_ratio": "coalesce({p}n_dup_lines / nullif({p}n_lines, 0), 0D)",
    "ellipsis_ratio": "coalesce({p}n_ellipsis_lines / nullif({p}n_lines, 0), 0D)",
    "bullet_ratio": "coalesce({p}n_bullet_lines / nullif({p}n_lines, 0), 0D)",
}
BASE = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letter_words",
        "n_stop_words", "n_ellipsis_lines", "n_bullet_lines", "listed", "unspaced")


def measure(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """Add the base columns to every row: counts (long); ``listed``, whether the text is in a script for which there are stop
    words; ``unspaced``, whether it is in one that is mostly written without blanks (both by its bytes a character).

    ``n_repeat_words`` counts the words covered by 3-word windows that occur
    at least twice. Windows are hashed, packed with their position into one
    long and sorted as a primitive array, so equal windows are neighbours and
    the cost stays n log n for texts of any length; neighbours count as equal
    only if their full 64-bit hashes agree.
    """
    steps = [f"__{prefix}{x}" for x in "twhgbkdql"]
    own = {x.lower() for x in [*steps, *(f"{prefix}{b}" for b in BASE)]}
    if clash := [c for c in docs.columns if c.lower() in own]:
        raise ValueError(f"input has columns {clash}; choose another prefix")
    t, w, h, g, b, k, d, q, ln = steps
    step1 = docs.withColumn(t, F.coalesce(F.col(text), F.lit("")))
    step2 = (step1
             .withColumn(w, F.expr(f"filter(split(`{t}`, '{_sql(SPACE)}+'), x -> x != '')"))
             .withColumn(ln, F.expr(f"filter(split(`{t}`, '\\n'), x -> x rlike '{_sql(NON_SPACE)}')")))
    step3 = (step2
             .withColumn(f"{prefix}n_words", F.size(w).cast("bigint"))
             .withColumn(h, F.expr(f"transform(`{w}`, x -> xxhash64(x))"))
             .withColumn(b, F.expr(f"cast(ceil(log2(size(`{w}`) + 2)) as int)")))
    step4 = step3.withColumn(g, F.expr(
        f"case when size(`{h}`) < 3 then cast(array() as array<bigint>) else "
        f"transform(sequence(0, size(`{h}`) - 3), i -> xxhash64(get(`{h}`, i), get(`{h}`, i + 1), get(`{h}`, i + 2))) end"))
    step5 = step4.withColumn(k, F.expr(f"sort_array(transform(`{g}`, (x, i) -> shiftleft(x, `{b}`) | cast(i as bigint)))"))
    mask = f"(shiftleft(1L, `{b}`) - 1)"
    pos = lambda j: f"cast(get(`{k}`, {j}) & {mask} as int)"
    step6 = step5.withColumn(d, F.expr(
        f"case when size(`{k}`) < 2 then cast(array() as array<int>) else "
        f"filter(sequence(0, size(`{k}`) - 2), j -> shiftright(get(`{k}`, j), `{b}`) = shiftright(get(`{k}`, j + 1), `{b}`) "
        f"and get(`{g}`, {pos('j')}) = get(`{g}`, {pos('j + 1')})) end"))
    step7 = step6.withColumn(q, F.expr(
        f"sort_array(array_union(transform(`{d}`, j -> {pos('j')}), transform(`{d}`, j -> {pos('j + 1')})))"))
    out = (step7
           .withColumn(f"{prefix}word_chars", F.length(F.translate(t, " \t\n\x0b\f\r", "")).cast("bigint"))
           .withColumn(f"{prefix}n_symbols",
                       (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("bigint"))
           .withColumn(f"{prefix}n_lines", F.size(ln).cast("bigint"))
           .withColumn(f"{prefix}n_dup_lines", (F.size(ln) - F.size(F.array_distinct(ln))).cast("bigint"))
           .withColumn(f"{prefix}n_repeat_words", F.expr(
               f"cast(case when size(`{q}`) = 0 then 0 else aggregate(`{q}`, struct(0 as n, -3 as last), "
               f"(a, p) -> struct(a.n + least(3, p - a.last) as n, p as last), a -> a.n) end as bigint)"))
           .withColumn(f"{prefix}n_letter_words", F.expr(f"cast(size(filter(`{w}`, x -> x rlike '\\\\p{{L}}')) as bigint)"))
           .withColumn(f"{prefix}n_stop_words", F.size(F.filter(
               w, lambda x: F.lower(F.rtrim(x, F.lit(".,;:!?"))).isin(list(STOP_WORDS)))).cast("bigint"))
           .withColumn(f"{prefix}n_ellipsis_lines", F.expr(
               f"cast(size(filter(`{ln}`, x -> x rlike '(\\\\.\\\\.\\\\.|\\u2026){_sql(SPACE)}*$')) as bigint)"))
           .withColumn(f"{prefix}n_bullet_lines", F.expr(
               f"cast(size(filter(`{ln}`, x -> x rlike '^{_sql(SPACE)}*[-*\\u2022]')) as bigint)"))
           .withColumn(f"{prefix}listed", F.octet_length(t) < F.length(t) * LATIN_BYTES)
           .withColumn(f"{prefix}unspaced", (F.length(t) > 0) & (F.octet_length(t) >= F.length(t) * UNSPACED_BYTES)))
    return out.drop(t, w, h, g, b, k, d, q, ln)


def _sql(regex: str) -> str:
    return regex.replace("\\", "\\\\")


def apply_rules(docs: DataFrame, text: str = "text", rules: Sequence[tuple] = DEFAULT_RULES,
                prefix: str = "") -> DataFrame:
    """Measure every row and add ``failed_rules`` (array of rule names) and ``kept``."""
    unknown = [r[1] for r in rules if r[1] not in METRICS]
    if unknown:
        raise ValueError(f"unknown metrics {unknown}")
    added = {f"{prefix}failed_rules".lower(), f"{prefix}kept".lower()}
    if clash := [c for c in docs.columns if c.lower() in added]:
        raise ValueError(f"input has columns {clash}; choose another prefix")
    failed = []
    for name, metric, low, high in rules:
        m = METRICS[metric].format(p=prefix)
        bad = " or ".join([f"{m} < {low}D"] * (low is not None) + [f"{m} > {high}D"] * (high is not None)) or "false"
        failed.append(f"case when {bad} then '{name}' end")
    return (measure(docs, text, prefix)
            .withColumn(f"{prefix}failed_rules", F.expr(f"array_compact(array({', '.join(failed)}))"))
            .withColumn(f"{prefix}kept", settled(F.size(f"{prefix}failed_rules") == 0)))


def filter_quality(docs: DataFrame, text: str = "text", rules: Sequence[tuple] = DEFAULT_RULES) -> DataFrame:
    """Rows that pass every rule, with the input's columns."""
    prefix = "q_"
    while any(c.lower().startswith((prefix, "__" + prefix)) for c in docs.columns):
        prefix = "q" + prefix
    return apply_rules(docs, text, rules, prefix).where(F.col(f"{prefix}kept")).select(*[F.col(f"`{c}`") for c in docs.columns])
