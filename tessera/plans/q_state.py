"""State/progress queries over stage events derived from the driver events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import state as ST
from ..sources.tables import table
from .registry import register

_EV = """ev AS (
  SELECT 'run_' || CAST(epoch(date_trunc('day', ts))::BIGINT AS VARCHAR) AS run_id,
         CAST(user_id AS VARCHAR) AS file_id,
         ['read', 'chunk', 'embed'][(event_id % 3) + 1] AS stage,
         event_type <> 'error' AS success,
         CASE WHEN event_type = 'error' THEN 'error in event ' || CAST(event_id AS VARCHAR) END AS error,
         event_type, json_extract_string(props, '$.k') AS k, ts, event_id AS seq
  FROM events)"""
_SF = """sf AS (
  SELECT file_id, stage, arg_max(success, seq) AS success, arg_max_null(error, seq) AS error,
         arg_max(ts, seq) AS updated_at, min(seq) AS first_seq, count(*)::BIGINT AS n_events
  FROM ev GROUP BY file_id, stage)"""


def _progress_sql(stages):
    vals = ", ".join(f"({i + 1}, '{s}')" for i, s in enumerate(stages))
    n = len(stages)
    return f"""exp AS (SELECT * FROM (VALUES {vals}) t(idx, stage)),
g AS (SELECT f.file_id, e.idx, e.stage, s.success
      FROM (SELECT DISTINCT file_id FROM sf) f CROSS JOIN exp e
      LEFT JOIN sf s ON s.file_id = f.file_id AND s.stage = e.stage),
p AS (SELECT file_id,
             min(idx) FILTER (WHERE NOT coalesce(success, false)) AS pos,
             arg_min(CASE WHEN success IS NOT NULL THEN stage END, idx)
               FILTER (WHERE NOT coalesce(success, false)) AS bad
      FROM g GROUP BY file_id),
prog AS (SELECT file_id,
       CASE WHEN bad IS NOT NULL THEN 'failed_at_' || bad
            WHEN coalesce(pos - 1, {n}) = {n} THEN 'completed'
            WHEN coalesce(pos - 1, {n}) = 0 THEN 'not_started' ELSE 'in_progress' END AS status,
       coalesce(pos - 1, {n}) * 100.0 / {n} AS progress,
       CAST(coalesce(pos - 1, {n}) AS INTEGER) AS completed_stages,
       {n} AS total_stages
FROM p)"""


def _ev(spark, sf_dir):
    return ST.events_from_driver(table(spark, sf_dir, "events"))


@register("state_fold", f"WITH {_EV}, {_SF} SELECT * FROM sf")
def state_fold(spark, sf_dir):
    return ST.fold_stages(_ev(spark, sf_dir))


@register("state_metadata", f"""WITH {_EV}
SELECT file_id, min(ts) AS started_at, max(ts) AS last_modified,
       arg_max(event_type, seq) AS meta_event_type, arg_max_null(k, seq) AS meta_k
FROM ev GROUP BY file_id""")
def state_metadata(spark, sf_dir):
    fs = ST.file_state(_ev(spark, sf_dir))
    return fs.select("file_id", "started_at", "last_modified",
                     F.col("metadata")["event_type"].alias("meta_event_type"),
                     F.col("metadata")["k"].alias("meta_k"))


@register("state_lookup", f"""WITH {_EV}, {_SF}
SELECT * FROM sf WHERE file_id IN (SELECT CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'signup'
                                   UNION ALL SELECT 'no-such-file')""")
def state_lookup(spark, sf_dir):
    """State of the files that were re-submitted (users with a 'signup'
    event), plus one unknown id: a semi join before the fold."""
    e = table(spark, sf_dir, "events")
    asked = (e.filter(F.col("event_type") == "signup").select(F.col("user_id").cast("string").alias("file_id"))
             .unionByName(spark.range(1).select(F.lit("no-such-file").alias("file_id"))))
    return ST.lookup(ST.events_from_driver(e), asked)


@register("file_progress", f"WITH {_EV}, {_SF}, {_progress_sql(ST.STAGES_EMITTED)} SELECT * FROM prog")
def file_progress(spark, sf_dir):
    return ST.progress(ST.fold_stages(_ev(spark, sf_dir)))


@register("file_progress_compat",
          f"WITH {_EV}, {_SF}, {_progress_sql(ST.STAGES_COMPAT)} SELECT * FROM prog")
def file_progress_compat(spark, sf_dir):
    return ST.progress(ST.fold_stages(_ev(spark, sf_dir)), ST.STAGES_COMPAT)


def _summary_sql(stages, phantom):
    x = 1 if phantom else 0
    return f"""WITH {_EV}, {_SF}, {_progress_sql(stages)}
SELECT (count(*) + {x})::BIGINT AS total_files,
       count(*) FILTER (WHERE status = 'completed')::BIGINT AS completed_files,
       count(*) FILTER (WHERE status LIKE 'failed%')::BIGINT AS failed_files,
       count(*) FILTER (WHERE status = 'in_progress')::BIGINT AS in_progress_files,
       (count(*) FILTER (WHERE status = 'not_started') + {x})::BIGINT AS not_started_files,
       CASE WHEN count(*) + {x} > 0 THEN coalesce(sum(progress), 0) / (count(*) + {x}) ELSE 0.0 END
         AS overall_progress
FROM prog"""


@register("state_summary", _summary_sql(ST.STAGES_EMITTED, False))
def state_summary(spark, sf_dir):
    return ST.summary(ST.progress(ST.fold_stages(_ev(spark, sf_dir))))


@register("state_summary_compat", _summary_sql(ST.STAGES_COMPAT, True))
def state_summary_compat(spark, sf_dir):
    return ST.summary(ST.progress(ST.fold_stages(_ev(spark, sf_dir)), ST.STAGES_COMPAT),
                      compat_phantom=True)


@register("failed_files", f"""WITH {_EV}, {_SF}
SELECT file_id, arg_min(stage, first_seq) AS failed_stage,
       coalesce(nullif(arg_min_null(error, first_seq), ''), 'Unknown error') AS error,
       arg_min(updated_at, first_seq) AS timestamp
FROM sf WHERE NOT success GROUP BY file_id""")
def failed_files(spark, sf_dir):
    return ST.failed_files(ST.fold_stages(_ev(spark, sf_dir)))


@register("successful_files", f"""WITH {_EV}, {_SF}, {_progress_sql(ST.STAGES_EMITTED)}
SELECT file_id FROM prog WHERE status = 'completed'""")
def successful_files(spark, sf_dir):
    return ST.successful_files(ST.progress(ST.fold_stages(_ev(spark, sf_dir))))


_OUTCOME_SQL = """reads AS (SELECT run_id, file_id, arg_max(success, seq) AS ok FROM ev
                 WHERE stage = 'read' GROUP BY run_id, file_id),
pr AS (SELECT run_id, count(*)::BIGINT AS files_read, count(*) FILTER (WHERE ok)::BIGINT AS successful,
              count(*) FILTER (WHERE NOT ok)::BIGINT AS failed FROM reads GROUP BY run_id),
oc AS (SELECT r.run_id, coalesce(files_read, 0)::BIGINT AS files_read,
              coalesce(successful, 0)::BIGINT AS successful, coalesce(failed, 0)::BIGINT AS failed,
              CASE WHEN (coalesce(failed, 0) = 0 AND coalesce(successful, 0) >= 1) OR coalesce(files_read, 0) = 0
                   THEN 'success' ELSE 'failed' END AS status
       FROM (SELECT DISTINCT run_id FROM ev) r LEFT JOIN pr ON r.run_id = pr.run_id)"""


@register("run_outcome", f"WITH {_EV}, {_OUTCOME_SQL} SELECT * FROM oc")
def run_outcome(spark, sf_dir):
    return ST.run_outcome(_ev(spark, sf_dir))


@register("run_history", f"""WITH {_EV}, {_OUTCOME_SQL}
SELECT r.run_id, r.started_at, r.completed_at, r.n_events, oc.files_read, oc.successful, oc.failed, oc.status
FROM (SELECT run_id, min(ts) AS started_at, max(ts) AS completed_at, count(*)::BIGINT AS n_events
      FROM ev GROUP BY run_id) r LEFT JOIN oc ON r.run_id = oc.run_id""")
def run_history(spark, sf_dir):
    return ST.run_history(_ev(spark, sf_dir))


@register("run_records", f"""WITH {_EV}, {_OUTCOME_SQL},
r AS (SELECT run_id, min(ts) AS started_at, max(ts) AS ended_at FROM ev GROUP BY run_id),
l AS (SELECT max(run_id) AS last FROM r)
SELECT r.run_id, epoch_us(started_at) AS started_us, CASE WHEN r.run_id <> last THEN epoch_us(ended_at) END AS completed_us,
       CASE WHEN r.run_id = last THEN 'running' ELSE oc.status END AS status,
       CASE WHEN r.run_id <> last THEN (epoch_us(ended_at) - epoch_us(started_at)) / 1e6 END AS duration_seconds,
       coalesce(oc.files_read, 0) AS files_read, coalesce(oc.successful, 0) AS successful, coalesce(oc.failed, 0) AS failed
FROM r CROSS JOIN l LEFT JOIN oc ON oc.run_id = r.run_id""")
def run_records(spark, sf_dir):
    """A start event for every run, a completion for all but the last."""
    ev = _ev(spark, sf_dir)
    h = ST.run_history(ev)
    last = h.agg(F.max("run_id").alias("_last"))  # one row
    started = h.select("run_id", F.lit("started").alias("kind"), F.lit(None).cast("boolean").alias("success"), F.col("started_at").alias("ts"))
    done = (h.crossJoin(F.broadcast(last)).where("run_id <> _last")
            .select("run_id", F.lit("completed").alias("kind"), (F.col("status") == "success").alias("success"), F.col("completed_at").alias("ts")))
    rec = ST.run_records(started.unionByName(done), ev)
    us = lambda c: F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast({c} as timestamp_ntz))")
    return rec.select("run_id", us("started_at").alias("started_us"), us("completed_at").alias("completed_us"), "status",
                      "duration_seconds", "files_read", "successful", "failed")


@register("file_progress_lookup", f"""WITH {_EV}, {_SF}, {_progress_sql(ST.STAGES_EMITTED)},
t AS (SELECT file_id, min(ts) AS started_at, max(ts) AS last_modified FROM ev GROUP BY file_id),
a AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS file_id FROM events WHERE event_type = 'signup' UNION ALL SELECT 'no-such-file')
SELECT a.file_id, coalesce(status, 'unknown') AS status, coalesce(progress, 0) AS progress, completed_stages, total_stages,
       started_at, last_modified
FROM a LEFT JOIN prog USING (file_id) LEFT JOIN t USING (file_id)""")
def file_progress_lookup(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    asked = (e.filter(F.col("event_type") == "signup").select(F.col("user_id").cast("string").alias("file_id"))
             .unionByName(spark.range(1).select(F.lit("no-such-file").alias("file_id"))))
    return ST.file_progress(ST.events_from_driver(e), asked)


@register("current_run", f"""WITH {_EV}
SELECT arg_max(run_id, started_at) AS current_run, max(started_at) AS started_at
FROM (SELECT run_id, min(ts) AS started_at FROM ev GROUP BY run_id)""")
def current_run(spark, sf_dir):
    return ST.current_run(ST.runs(_ev(spark, sf_dir)))
