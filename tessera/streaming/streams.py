"""Streaming versions of slow-action counts, the stage-state fold and
incremental file discovery.

* ``slow_action_stream``: event-time tumbling windows with a watermark; in
  append mode a window is emitted once the watermark passes its end, late rows
  are dropped by the watermark.
* ``stage_fold_stream``: the (file, stage) last-write-wins fold in update mode
  (state kept per key by Spark); per-file roll-ups that need a second
  aggregation are done per micro-batch in ``foreachBatch`` or in batch.
* ``new_files_stream``: a ``binaryFile`` file stream; the checkpoint records
  which files were seen, so ``trigger(availableNow=True)`` processes only
  files added since the last run.

Checkpoints go under the shared ``spark.checkpoint.dir`` unless given.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import state as ST
from ..operators import telemetry as TM


def checkpoint_location(spark: SparkSession, name: str) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        from ..session import ensure_checkpoint_dir
        base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/streams/{name}"


def event_stream(spark: SparkSession, path: str, schema: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def slow_action_stream(events: DataFrame, window: str = "1 day", watermark: str = "10 minutes",
                       duration: str = "value", ts: str = "ts", kind: str = "event_type") -> DataFrame:
    # a watermark needs TIMESTAMP (not TIMESTAMP_NTZ)
    e = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    return TM.slow_actions(e, duration=duration, ts=ts, kind=kind, window=window)


def stage_fold_stream(stage_events: DataFrame) -> DataFrame:
    """Streaming form of ``state.fold_stages`` (use outputMode 'update' or 'complete')."""
    return ST.fold_stages(stage_events, single_pass=True)


BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark writes into a stream's checkpoint when it first starts."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def partial_fold_sink(path: str, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` sink: append each micro-batch's partial (file, stage)
    fold, tagged with the query's id (from its checkpoint) and the batch id.
    ``state.fold_partials`` over the table gives the same answer as the batch
    fold over all events, and per-file roll-ups (progress, failures, summary)
    run on top of it in batch."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        (ST.partial_fold(batch).withColumn("query_id", F.lit(query_id(batch.sparkSession, checkpoint)))
         .withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("append").parquet(path))

    return sink


def new_files_stream(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    r = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
         .option("recursiveFileLookup", "true"))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(root).select("path", "modificationTime", "length")


def run_available_now(df: DataFrame, name: str, sink: Callable[[DataFrame, int], None] | None = None,
                      output_mode: str = "append", fmt: str | None = None,
                      checkpoint: str | None = None) -> StreamingQuery:
    """Process everything available now and stop (incremental batch). The
    result goes to ``sink`` or to the named format (``memory`` holds it on the
    driver, for tests)."""
    if sink is None and fmt is None:
        raise ValueError("give a sink or a format")
    spark = df.sparkSession
    w = df.writeStream.outputMode(output_mode).option(
        "checkpointLocation", checkpoint or checkpoint_location(spark, name)).trigger(availableNow=True)
    if sink is not None:
        w = w.foreachBatch(sink)
    else:
        w = w.format(fmt).queryName(name)
    q = w.start()
    q.awaitTermination()
    return q
