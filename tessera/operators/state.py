"""File/stage state as folds over an append-only ``stage_events`` table.

The reference keeps a mutable JSON dict and rewrites it on every update.
Here every update is an event row ``(run_id, file_id, stage, success, error,
metadata, ts, seq)`` and every view is an aggregation over the events:

* last write wins per (file, stage): ``max_by(struct(...), seq)``;
* started_at / last_modified: ``min(ts)`` / ``max(ts)`` per file;
* metadata merge, later keys win: explode, ``max_by(value, seq)`` per key.

All folds are partial aggregations keyed by file (map-side combine), so they
are independent of row order and partitioning, and a hot file does not land
whole in one task before being reduced. The same fold runs on a stream.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .versions import VersionedTable

# Stage names the ingest writes, and the list the reference's
# progress view expects (kept as a compatibility option).
STAGES_EMITTED = ("read", "chunk", "embed")
STAGES_COMPAT = ("read", "processed", "chunked", "embedded", "loaded")
UNKNOWN_ERROR = "Unknown error"
STAGE_EVENT_SCHEMA = ("run_id string, file_id string, stage string, success boolean, error string, "
                      "metadata map<string,string>, ts timestamp, seq bigint")


def events_from_driver(events: DataFrame) -> DataFrame:
    """Stage events derived from the driver ``events`` table.

    file = user_id, stage cycles through the emitted stages by event_id,
    success = not an 'error' event, run = the UTC day of the event,
    seq = event_id, metadata = {event_type, k}.
    """
    # epoch seconds of the event's day, computed on the wall-clock value so
    # the result does not depend on the session time zone
    day_epoch = F.unix_date(F.to_date("ts")).cast("bigint") * 86400
    return events.select(
        F.concat(F.lit("run_"), day_epoch.cast("string")).alias("run_id"),
        F.col("user_id").cast("string").alias("file_id"),
        F.element_at(F.array(*[F.lit(s) for s in STAGES_EMITTED]),
                     (F.col("event_id") % len(STAGES_EMITTED)).cast("int") + 1).alias("stage"),
        (F.col("event_type") != "error").alias("success"),
        F.when(F.col("event_type") == "error",
               F.concat(F.lit("error in event "), F.col("event_id").cast("string"))).alias("error"),
        F.create_map(F.lit("event_type"), F.col("event_type"),
                     F.lit("k"), F.get_json_object("props", "$.k")).alias("metadata"),
        F.col("ts"),
        F.col("event_id").cast("bigint").alias("seq"),
    )


def _fold(ev: DataFrame) -> DataFrame:
    """(file_id, stage, success, error, updated_at, first_seq, last_seq, n_events).

    The pass over all events keeps fixed-width buffers only (``max_by`` of a
    boolean / timestamp, min/max/count), so Spark runs it as a hash aggregate
    with map-side combine. The error text of the last event comes from a
    second aggregate over the error events only, joined on the (small) folded
    keys: the error is kept when it belongs to the last event.
    """
    main = ev.groupBy("file_id", "stage").agg(
        F.max_by("success", "seq").alias("success"), F.max_by("ts", "seq").alias("updated_at"),
        F.max("seq").alias("last_seq"), F.min("seq").alias("first_seq"),
        F.count("*").cast("bigint").alias("n_events"))
    errs = (ev.filter(F.col("error").isNotNull()).groupBy("file_id", "stage")
            .agg(F.max_by(F.struct("seq", "error"), "seq").alias("_e")))
    return (main.join(errs, ["file_id", "stage"], "left")
            .select("file_id", "stage", "success",
                    F.when(F.col("_e.seq") == F.col("last_seq"), F.col("_e.error")).alias("error"),
                    "updated_at", "first_seq", "last_seq", "n_events"))


def _fold_single(ev: DataFrame) -> DataFrame:
    """The same fold as one aggregate (``max_by`` of a struct holding the
    error text, hence a sort-based aggregate). Structured Streaming needs this
    form: it cannot join two streaming aggregates."""
    last = F.max_by(F.struct("success", "error", "ts"), "seq")
    return ev.groupBy("file_id", "stage").agg(
        last.alias("_last"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"),
        F.count("*").cast("bigint").alias("n_events"),
    ).select("file_id", "stage", F.col("_last.success").alias("success"),
             F.col("_last.error").alias("error"), F.col("_last.ts").alias("updated_at"),
             "first_seq", "last_seq", "n_events")


def fold_stages(ev: DataFrame, single_pass: bool = False) -> DataFrame:
    """One row per (file_id, stage): the last event's success/error/ts.

    ``single_pass=True`` gives the one-aggregate form (for streams)."""
    return (_fold_single(ev) if single_pass else _fold(ev)).drop("last_seq")


def partial_fold(ev: DataFrame) -> DataFrame:
    """Fold of a slice of the events, mergeable with other slices: like
    ``fold_stages`` plus ``last_seq``."""
    return _fold(ev)


def fold_partials(parts: DataFrame) -> DataFrame:
    """Merge partial folds into the ``fold_stages`` result (associative:
    the slice with the highest ``last_seq`` wins, counts add). Rows carrying a
    ``batch_id`` are deduplicated first, so a re-run micro-batch counts once;
    batch ids belong to a ``query_id`` (they start at 0 for every query), so
    batches of another query or a new checkpoint are never taken for re-runs."""
    if "batch_id" in parts.columns:
        query = ["query_id"] if "query_id" in parts.columns else []
        parts = parts.dropDuplicates([*query, "batch_id", "file_id", "stage"])
    last = F.max_by(F.struct("success", "error", "updated_at"), "last_seq")
    return parts.groupBy("file_id", "stage").agg(
        last.alias("_last"), F.min("first_seq").alias("first_seq"),
        F.sum("n_events").cast("bigint").alias("n_events"),
    ).select("file_id", "stage", F.col("_last.success").alias("success"),
             F.col("_last.error").alias("error"), F.col("_last.updated_at").alias("updated_at"),
             "first_seq", "n_events")


def file_state(ev: DataFrame) -> DataFrame:
    """One row per file: started_at, last_modified and merged metadata map."""
    times = ev.groupBy("file_id").agg(F.min("ts").alias("started_at"), F.max("ts").alias("last_modified"))
    kv = (ev.select("file_id", "seq", F.explode("metadata").alias("key", "value"))
          .groupBy("file_id", "key").agg(F.max_by("value", "seq").alias("value"))
          .groupBy("file_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("metadata")))
    return times.join(kv, "file_id", "left")


def lookup(ev: DataFrame, file_ids) -> DataFrame:
    """State of the requested files; unknown ids give no rows.

    ``file_ids`` is a list (point lookup: an IN filter, pushed to the scan
    when it is on a source column) or a DataFrame with a ``file_id`` column
    (many ids: a semi join). Either way only the requested files are folded.
    """
    if isinstance(file_ids, DataFrame):
        return fold_stages(ev.join(file_ids.select("file_id").distinct(), "file_id", "left_semi"))
    return fold_stages(ev.filter(F.col("file_id").isin(list(file_ids))))


def _progress_cols(m: Column, expected: Sequence[str]) -> list[Column]:
    exp = F.array(*[F.lit(s) for s in expected])
    flags = F.transform(exp, lambda s: F.coalesce(F.try_element_at(m, s), F.lit(False)))
    pos = F.array_position(flags, F.lit(False))
    n = len(expected)
    completed = F.when(pos == 0, F.lit(n)).otherwise(pos - 1).cast("int")
    bad = F.when(pos > 0, F.element_at(exp, F.greatest(pos, F.lit(1)).cast("int")))
    failed = F.when(bad.isNotNull() & F.try_element_at(m, bad).isNotNull(), bad)
    status = (F.when(failed.isNotNull(), F.concat(F.lit("failed_at_"), failed))
              .when(completed == n, "completed").when(completed == 0, "not_started")
              .otherwise("in_progress"))
    return [status.alias("status"), (completed * 100.0 / n).alias("progress"),
            completed.alias("completed_stages"), F.lit(n).alias("total_stages")]


def progress(folded: DataFrame, expected: Sequence[str] = STAGES_EMITTED) -> DataFrame:
    """Per file: length of the leading run of successful expected stages.

    The per-file stage map holds one entry per distinct stage (a handful),
    so collecting it per file is bounded regardless of event volume.
    """
    per_file = folded.groupBy("file_id").agg(
        F.map_from_entries(F.collect_list(F.struct("stage", "success"))).alias("_m"))
    return per_file.select("file_id", *_progress_cols(F.col("_m"), expected))


def summary(prog: DataFrame, compat_phantom: bool = False) -> DataFrame:
    """Totals by status and the mean progress; ``compat_phantom`` counts the
    reference's reserved metadata key as one extra not-started file."""
    s = F.col("status")
    agg = prog.agg(
        F.count("*").alias("t"), F.count_if(s == "completed").alias("c"),
        F.count_if(s.startswith("failed")).alias("f"), F.count_if(s == "in_progress").alias("i"),
        F.count_if(s == "not_started").alias("n"), F.coalesce(F.sum("progress"), F.lit(0.0)).alias("p"))
    extra = 1 if compat_phantom else 0
    total = F.col("t") + extra
    return agg.select(
        total.cast("bigint").alias("total_files"), F.col("c").cast("bigint").alias("completed_files"),
        F.col("f").cast("bigint").alias("failed_files"), F.col("i").cast("bigint").alias("in_progress_files"),
        (F.col("n") + extra).cast("bigint").alias("not_started_files"),
        F.when(total > 0, F.col("p") / total).otherwise(F.lit(0.0)).alias("overall_progress"))


def failed_files(folded: DataFrame) -> DataFrame:
    """First unsuccessful stage per file (order of first appearance)."""
    first = F.min_by(F.struct("stage", "error", "updated_at"), "first_seq")
    return (folded.filter(~F.col("success")).groupBy("file_id").agg(first.alias("_f"))
            .select("file_id", F.col("_f.stage").alias("failed_stage"),
                    F.coalesce(F.nullif(F.col("_f.error"), F.lit("")), F.lit(UNKNOWN_ERROR)).alias("error"),
                    F.col("_f.updated_at").alias("timestamp")))


def successful_files(prog: DataFrame) -> DataFrame:
    return prog.filter(F.col("status") == "completed").select("file_id")


def runs(ev: DataFrame) -> DataFrame:
    """Run records: start/completion times, files and events per run."""
    return ev.groupBy("run_id").agg(
        F.min("ts").alias("started_at"), F.max("ts").alias("completed_at"),
        F.count("*").cast("bigint").alias("n_events"))


def run_outcome(ev: DataFrame, read_stage: str = "read") -> DataFrame:
    """Success when no file's read failed and at least one succeeded (or no
    files at all); counts use the read stage only, like the reference."""
    reads = (ev.filter(F.col("stage") == read_stage)
             .groupBy("run_id", "file_id").agg(F.max_by("success", "seq").alias("ok")))
    per_run = reads.groupBy("run_id").agg(
        F.count("*").cast("bigint").alias("files_read"),
        F.count_if(F.col("ok")).cast("bigint").alias("successful"),
        F.count_if(~F.col("ok")).cast("bigint").alias("failed"))
    all_runs = ev.select("run_id").distinct()
    j = all_runs.join(per_run, "run_id", "left").na.fill(0, ["files_read", "successful", "failed"])
    ok = ((F.col("failed") == 0) & (F.col("successful") >= 1)) | (F.col("files_read") == 0)
    return j.withColumn("status", F.when(ok, "success").otherwise("failed"))


def run_history(ev: DataFrame, read_stage: str = "read") -> DataFrame:
    """``runs`` and ``run_outcome`` in one pass: per run and file, then per
    run. The last read result of a file is the greatest ``2 * seq + success``
    of its read events, so both aggregates keep fixed-width buffers."""
    read = F.when(F.col("stage") == read_stage, F.col("seq") * 2 + F.col("success").cast("bigint"))
    per_file = ev.groupBy("run_id", "file_id").agg(
        F.min("ts").alias("_from"), F.max("ts").alias("_to"), F.count("*").alias("_n"), F.max(read).alias("_read"))
    ok = F.col("_read") % 2 == 1
    per_run = per_file.groupBy("run_id").agg(
        F.min("_from").alias("started_at"), F.max("_to").alias("completed_at"),
        F.sum("_n").cast("bigint").alias("n_events"), F.count("_read").cast("bigint").alias("files_read"),
        F.count_if(ok).cast("bigint").alias("successful"), F.count_if(~ok).cast("bigint").alias("failed"))
    good = ((F.col("failed") == 0) & (F.col("successful") >= 1)) | (F.col("files_read") == 0)
    return per_run.withColumn("status", F.when(good, "success").otherwise("failed"))


RUN_EVENT_SCHEMA = "run_id string, kind string, success boolean, ts timestamp"


def run_started(spark, run_id: str) -> DataFrame:
    """The event that a run has started, to be appended to the run events."""
    return spark.range(1).select(F.lit(run_id).alias("run_id"), F.lit("started").alias("kind"),
                                 F.lit(None).cast("boolean").alias("success"), F.current_timestamp().alias("ts"))


def run_completed(spark, run_id: str, success: bool) -> DataFrame:
    return spark.range(1).select(F.lit(run_id).alias("run_id"), F.lit("completed").alias("kind"),
                                 F.lit(success).alias("success"), F.current_timestamp().alias("ts"))


def run_records(run_events: DataFrame, ev: DataFrame | None = None) -> DataFrame:
    """Run records from the run events: start, completion, status (running
    until completed, also for a run without files) and duration; with the
    stage events, the files read, succeeded and failed. A completion without a
    start is no record."""
    t = F.col("ts").cast("timestamp")
    done = F.col("kind") == "completed"
    rec = (run_events.groupBy("run_id").agg(
        F.min(F.when(F.col("kind") == "started", t)).alias("started_at"), F.max(F.when(done, t)).alias("completed_at"),
        F.max(F.when(done, F.unix_micros(t) * 2 + F.col("success").cast("bigint"))).alias("_last"))
        .where("started_at is not null"))
    status = (F.when(F.col("_last").isNull(), "running").when(F.col("_last") % 2 == 1, "success").otherwise("failed"))
    seconds = (F.unix_micros("completed_at") - F.unix_micros("started_at")) / 1e6
    rec = rec.select("run_id", "started_at", "completed_at", status.alias("status"), seconds.alias("duration_seconds"))
    if ev is None:
        return rec
    counts = run_history(ev).select("run_id", "files_read", "successful", "failed")
    return (rec.join(counts, "run_id", "left").na.fill(0, ["files_read", "successful", "failed"]))


def file_progress(ev: DataFrame, ids: DataFrame | None = None, expected: Sequence[str] = STAGES_EMITTED) -> DataFrame:
    """Progress with the file's first and last event time; with ``ids`` (a
    ``file_id`` column) for those files, unknown ones with status unknown."""
    asked = None if ids is None else ids.select("file_id").distinct()
    own = ev if asked is None else ev.join(asked, "file_id", "left_semi")
    times = own.groupBy("file_id").agg(F.min("ts").alias("started_at"), F.max("ts").alias("last_modified"))
    prog = progress(fold_stages(own), expected).join(times, "file_id")
    if asked is None:
        return prog
    out = asked.join(prog, "file_id", "left")
    return (out.withColumn("status", F.coalesce("status", F.lit("unknown")))
            .withColumn("progress", F.coalesce("progress", F.lit(0.0))))


def current_run(run_table: DataFrame) -> DataFrame:
    """The latest started run (one row)."""
    return run_table.agg(F.max_by("run_id", "started_at").alias("current_run"),
                         F.max("started_at").alias("started_at"))


def event_table(spark, path: str) -> VersionedTable:
    """The stage events as a versioned table: a reset is an empty version, and readers of an older one are unharmed."""
    return VersionedTable(spark, path, STAGE_EVENT_SCHEMA)


def reset(spark, path: str) -> int:
    """Start a new, empty version of the event table; no file is touched. The number of the version."""
    return event_table(spark, path).reset()
