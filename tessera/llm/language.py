"""Language identification by words first, then by ever shorter character n-grams.

The model holds, for each learned language, the log frequency of the known words and of character n-grams (5 down to
1, words framed as ``<word>``). A known word scores by its log frequencies. An unseen word scores by the mean log
frequency of its known n-grams of the greatest length that has any. A text's score of a language is the sum over its
words; the prediction is the best language and its posterior under equal priors.

Learning counts words in Spark. It reads a bounded sample of the labelled texts, taken by a hash of the text, so that the
model has the same size at any scale. The bounds of the whole (about ``max_docs`` rows, ``max_words`` words and ``max_grams``
n-grams of each length, the most frequent first) are dealt out evenly over the labels: each gets all that it has, or
at least the bound divided by the number of labels, and what small labels leave over goes to the larger ones. So
every label with a word is in the model, however rare. The model (a few MB at these bounds) goes to the tasks as a
broadcast; prediction reads every whole text once, without a shuffle.

Defined results
- null text, or one without a letter: ``und`` with score 0; the same if nothing was learned;
- rows without a label teach nothing; equal scores go to the first language in code point order;
- repeated rows count as often as they occur; an empty table gives an empty result;
- added columns replace none: a clash with an input column is a ValueError.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

_WORD = regex.compile(r"\p{L}+")
LONGEST = 5
SMOOTH = 0.5
_PLACES = 1 << 30  # places of a hash, of which a share is taken
UNSEEN_CACHE = 300_000  # unseen words kept per worker task; a bound on memory only


@dataclass
class LanguageModel:
    langs: list[str]
    words: dict[str, int]
    word_scores: np.ndarray  # words x langs
    grams: list[dict[str, int]]  # by length, 1 to LONGEST
    gram_scores: list[list[tuple[float, ...]]]
    unseen: dict[str, tuple[float, ...]] = field(default_factory=dict)

    def backoff(self, word: str) -> tuple[float, ...]:
        found = self.unseen.get(word)
        if found is None:
            framed = f"<{word}>"
            found = (0.0,) * len(self.langs)
            for n in range(LONGEST, 0, -1):
                get, scores = self.grams[n - 1].get, self.gram_scores[n - 1]
                rows = [scores[i] for k in range(len(framed) - n + 1) if (i := get(framed[k:k + n])) is not None]
                if rows:
                    found = tuple([sum(x) / len(rows) for x in zip(*rows)])
                    break
            if len(self.unseen) < UNSEEN_CACHE:
                self.unseen[word] = found
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = Counter(_WORD.findall((text or "").lower()))
        if not counts or not self.langs:
            return "und", 0.0
        total, at, times, other, others = np.zeros(len(self.langs)), [], [], [], []
        for word, n in counts.items():
            i = self.words.get(word)
            if i is None:
                other.append(self.backoff(word))
                others.append(n)
            else:
                at.append(i)
                times.append(n)
        if at:
            total += np.asarray(times, float) @ self.word_scores[at]
        if other:
            total += np.asarray(others, float) @ np.asarray(other)
        best = int(total.argmax())
        return self.langs[best], float(1 / np.exp(np.maximum(total - total[best], -700)).sum())


def _scores(rows: list, key: str, langs: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """Log frequencies with add-SMOOTH smoothing over the kept entries."""
    at = {x: i for i, x in enumerate(langs)}
    names: dict[str, int] = {}
    counts = np.zeros((len(rows), len(langs)))
    for r in rows:
        i = names.setdefault(r[key], len(names))
        for lang, n in r["counts"].items():
            counts[i, at[lang]] += n
    total = counts.sum(axis=0) + SMOOTH * max(1, len(rows))
    return names, np.log((counts + SMOOTH) / total)


def _level(sizes: dict[str, int], total: int) -> int:
    """The greatest level at which the sizes, each cut at the level, sum to at most ``total``; 1 at least."""
    left = total
    for k, n in enumerate(ordered := sorted(sizes.values())):
        if n * (len(ordered) - k) > left:
            return max(1, left // (len(ordered) - k))
        left -= n
    return max(1, *ordered) if ordered else 1


def _of_lang(values: dict[str, int]):
    """A label's value as a column."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in sorted(values.items()) for x in kv]), F.col("lang"))


def _sample(rows: DataFrame, max_docs: int) -> DataFrame | None:
    """About ``_level`` rows of each label, by a hash of the text; the text of least hash of each label always is one."""
    place = F.pmod(F.xxhash64("text"), F.lit(_PLACES))
    found = {r["lang"]: r for r in rows.groupBy("lang").agg(F.count("*").alias("n"), F.min(place).alias("least")).collect()}
    if not found:
        return None
    level = _level({x: r["n"] for x, r in found.items()}, max_docs)
    ends = {x: _PLACES if r["n"] <= level else max(r["least"] + 1, level * _PLACES // r["n"]) for x, r in found.items()}
    return rows.where(place < _of_lang(ends))


def _top(counts: DataFrame, key: str, limit: int) -> list:
    """``key`` and its ``counts`` by label: all keys if they are at most ``limit``, or else about ``_level`` of each label, the
    most frequent first. How many a label has at each frequency says where its cut is; of the frequency at the cut,
    those with the least hashes stay."""
    place = F.pmod(F.xxhash64(key), F.lit(_PLACES))
    if counts.select(key).distinct().count() > limit:
        levels: dict[str, list[tuple[int, int]]] = {}
        for r in counts.groupBy("lang", "n").agg(F.count("*").alias("k")).collect():
            levels.setdefault(r["lang"], []).append((r["n"], r["k"]))
        most = _level({x: sum(k for _, k in v) for x, v in levels.items()}, limit)
        least, share = {}, {}
        for lang, v in levels.items():
            left = most
            for n, k in sorted(v, reverse=True):
                least[lang], share[lang] = n, min(_PLACES, left * _PLACES // k)
                left -= k
                if left <= 0:
                    break
        at = _of_lang(least)
        counts = counts.withColumn("_in", (F.col("n") > at) | ((F.col("n") == at) & (place < _of_lang(share))))
    else:
        counts = counts.withColumn("_in", F.lit(True))
    return (counts.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("counts"),
                                    F.sum("n").alias("_all"), F.max("_in").alias("_in"))
            .where("_in").orderBy(F.desc("_all"), key).drop("_all", "_in").collect())


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", max_docs: int = 20_000,
          max_words: int = 60_000, max_grams: int = 30_000) -> LanguageModel:
    """A model from the rows with text and label; it knows every label that has a word."""
    rows = labelled.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang")).where(
        "lang is not null").where(F.col("text").rlike(r"\p{L}"))
    sample = _sample(rows, max_docs)
    if sample is None:
        return LanguageModel([], {}, np.zeros((0, 0)), [{} for _ in range(LONGEST)], [[] for _ in range(LONGEST)])
    seen = written(sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
                   .groupBy("word", "lang").agg(F.count("*").alias("n")), "language-words")
    langs = sorted(r["lang"] for r in seen.select("lang").distinct().collect())
    words = _top(seen, "word", max_words)
    framed = F.concat(F.lit("<"), F.col("word"), F.lit(">"))
    grams = []
    for size in range(1, LONGEST + 1):
        cuts = F.expr(f"transform(sequence(1, greatest(1, length(_f) - {size - 1})), i -> substring(_f, i, {size}))")
        counts = (seen.withColumn("_f", framed).select("lang", "n", F.explode(cuts).alias("gram"))
                  .where(F.length("gram") == size).groupBy("gram", "lang").agg(F.sum("n").alias("n")))
        grams.append(_top(counts, "gram", max_grams))
    known, scores = _scores(words, "word", langs)
    both = [_scores(g, "gram", langs) for g in grams]
    return LanguageModel(langs, known, scores, [x[0] for x in both],
                         [[tuple(r) for r in x[1].tolist()] for x in both])


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", pred: str = "lang_pred",
            score: str = "score") -> DataFrame:
    """Every row with ``lang_pred`` and ``score`` added."""
    clash = [c for c in docs.columns if c.lower() in (pred.lower(), score.lower())]
    if clash:
        raise ValueError(f"input has columns {clash}")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at_text = docs.columns.index(text)
    added = [T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())]

    def run(batches):
        model = shared.value
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                found = [model.predict(t.as_py()) for t in part.column(at_text)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                    names=[*part.schema.names, pred, score])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))
