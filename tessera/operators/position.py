"""Dense 0-based row positions in a global order, computed distributedly.

A global ``row_number()`` without PARTITION BY runs in one task. Instead: range-partition on the order key, sort
within partitions, and number the rows of each partition; the partitions' row counts (one row per partition) become
offsets, which are broadcast (their number is the partition count, not the data).

The numbered rows are written once, as a reliable checkpoint in the shared folder, and both the counts and the rows
are read from it. Range bounds come from a sample, so a range shuffle that is planned twice may cut differently the
second time; with a single written shuffle the offsets always belong to the rows, at any size, with any number of
partitions and whatever is reused. The order columns must form a unique key.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_LOW_BITS = (1 << 33) - 1


def with_position(df: DataFrame, order: Sequence[str], name: str = "pos",
                  num_partitions: int | None = None) -> DataFrame:
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    dealt = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    numbered = (dealt.sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id())
                .withColumn("_pid", F.shiftright("_mid", 33)).checkpoint(eager=True))
    counts = numbered.groupBy("_pid").agg(F.count("*").alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select("_pid", (F.sum("_n").over(w) - F.col("_n")).alias("_off"))
    return (numbered.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))).cast("bigint"))
            .drop("_pid", "_mid", "_off"))
