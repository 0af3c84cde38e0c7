"""Delta-maintained token counts by source, language and tokenizer version.

A batch of changes is a table of signed rows: an insert is +1 row and +n tokens, a delete -1 and -n, a revised count
both (the old count out, the new one in). A batch is reduced to its sums per (source, lang, tokenizer) before it is
written, with partial sums on the map side, so a source with a third of all rows is a few rows per task. Totals are
the sum over the committed batches; sums are additive, so their order does not matter.

Commits are idempotent: each attempt writes a folder of its own, and a batch is published under its name as the next version
of a versioned table (``operators.versions``), which either succeeds whole or finds that someone else was first. A batch
that is in the table is left as it is, whatever is offered again; one that broke off was never published. Readers take one
version. ``fold`` replaces the committed batches by their totals, which still know the batches' names, so reading the totals
stays cheap however many batches there have been.

Defined results
- null source, language or tokenizer is a key of its own; a null count is 0 tokens;
- null or empty texts count as documents of 0 tokens; repeated rows count as often as they occur;
- keys whose documents and tokens are both 0 in sum drop out of the totals; an empty batch commits and adds nothing;
- extra columns are ignored.
"""

from __future__ import annotations

from typing import Callable, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.versions import VersionedTable
from .encode import encoder

KEYS = ("source", "lang", "tokenizer")
SCHEMA = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"


def vocabulary_counts(docs: DataFrame, text: str, vocabulary: str) -> DataFrame:
    """``source, lang, n_tokens`` with the tokens of each whole text by a vocabulary file of the tokenizers library."""
    def run(batches):
        enc = encoder(vocabulary)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(enc.encode(t.as_py())) // 4 for t in b.column(2)], pa.int64())],
                names=["source", "lang", "n_tokens"])

    return docs.select("source", "lang", F.col(f"`{text}`").alias("text")).mapInArrow(run, "source string, lang string, n_tokens bigint")


def with_counts(docs: DataFrame, counts: Mapping[str, str], vocabulary: str) -> DataFrame:
    """The rows without the text columns, which are the keys of ``counts``, and with the tokens of each whole text in the
    column that it names. A text equal to the one before it in the row is counted once."""
    keep = [c for c in docs.columns if c not in counts]
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    schema = T.StructType([*[T.StructField(c, kinds[c]) for c in keep], *[T.StructField(c, T.LongType()) for c in counts.values()]])

    def run(batches):
        enc = encoder(vocabulary)
        for b in batches:
            found = []
            for texts in zip(*(b.column(len(keep) + i) for i in range(len(counts)))):
                row, last = [], None
                for t in (x.as_py() for x in texts):
                    row.append(row[-1] if row and t == last else len(enc.encode(t)) // 4)
                    last = t
                found.append(row)
            added = [pa.array([r[i] for r in found], pa.int64()) for i in range(len(counts))]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], *added], names=[*keep, *counts.values()])

    return docs.select(*keep, *counts).mapInArrow(run, schema)


Counter = Column | Callable[[DataFrame], DataFrame]


def counted(docs: DataFrame, counters: Mapping[str, Counter]) -> DataFrame:
    """``source, lang, tokenizer, n_tokens`` of every row by every tokenizer version: a column, or a function of the
    rows that returns ``source, lang, n_tokens``."""
    out = None
    for version, count in counters.items():
        part = (docs.select("source", "lang", count.cast("bigint").alias("n_tokens")) if isinstance(count, Column) else count(docs))
        part = part.select("source", "lang", F.lit(version).alias("tokenizer"), F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"))
        out = part if out is None else out.unionByName(part)
    return out


def inserts(rows: DataFrame) -> DataFrame:
    return rows.select(*KEYS, F.lit(1).alias("sign"), "n_tokens")


def deletes(rows: DataFrame) -> DataFrame:
    return rows.select(*KEYS, F.lit(-1).alias("sign"), "n_tokens")


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    return deletes(old).unionByName(inserts(new))


def _table(spark: SparkSession, store: str) -> VersionedTable:
    return VersionedTable(spark, store, SCHEMA)


def committed(spark: SparkSession, store: str) -> list[str]:
    """Names of the committed batches."""
    v = _table(spark, store).version()
    return sorted({*v.absorbed, *[f.rsplit("-", 1)[0] for f in v.folders if not f.startswith("compacted-")]})


def commit(spark: SparkSession, store: str, batch: str | int, changes: DataFrame) -> bool:
    """Commit a batch once; False if it was committed before, by whomever."""
    delta = (changes.groupBy(*KEYS)
             .agg(F.sum("sign").cast("bigint").alias("n_docs"),
                  F.sum(F.col("sign") * F.coalesce("n_tokens", F.lit(0))).cast("bigint").alias("n_tokens")))
    return _table(spark, store).append(delta, f"batch-{batch}")


def _summed(rows: DataFrame) -> DataFrame:
    return (rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
            .where("n_docs <> 0 or n_tokens <> 0"))


def fold(spark: SparkSession, store: str) -> bool:
    """Replace the committed batches by their totals; False if there is nothing to fold, or another change came first."""
    return _table(spark, store).compact(_summed)


def totals(spark: SparkSession, store: str) -> DataFrame:
    """``source, lang, tokenizer, n_docs, n_tokens`` over all committed batches."""
    return _summed(_table(spark, store).read())
