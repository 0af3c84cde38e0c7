"""Partitioning helpers for CPU-heavy row work.

A scan yields one task per file split. On a cluster reading many files that is plenty, but a table stored as a few
files gives a handful of tasks, and per-row work (regex tokenising, Python chunking, parsing) before the first shuffle
then runs on a few cores. ``spread`` round-robins such input over the default parallelism. It looks at the number of
input files only, so no job runs while the plan is built; a table of many files is left as it is.

Inside a task, Arrow batches come in up to 10,000 rows, so what Python makes of a batch (objects, lists, vectors) grows
with the length of the texts. ``pieces`` cuts a batch without copying, so that only a few MB of it are in work at a time.
"""

from __future__ import annotations

from typing import Iterator

from pyspark.sql import DataFrame

# Bytes and rows of a batch that are in work at a time; a longer row is a piece of its own.
PIECE_BYTES, PIECE_ROWS = 2 << 20, 512


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= target:
        return df
    return df.repartition(target)


def pieces(batch, size: int = PIECE_BYTES, rows: int = PIECE_ROWS) -> Iterator:
    """The Arrow batch or array in slices of at most ``rows`` rows and about ``size`` bytes; a slice has one row at least."""
    todo = [batch]
    while todo:
        b = todo.pop()
        n = len(b) if not hasattr(b, "num_rows") else b.num_rows
        if n <= 1 or (n <= rows and b.nbytes <= size):
            yield b
        else:
            todo += [b.slice(n // 2), b.slice(0, n // 2)]
