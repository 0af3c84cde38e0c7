"""Queries that run as streams over files of the driver events, and give what the batch form gives."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import state as ST
from ..operators import telemetry as TM
from ..operators.versions import VersionedTable
from ..session import ensure_checkpoint_dir
from ..sources.tables import table
from ..streaming import streams as SS
from ..streaming.sessions import STATUS, latest_status, rocksdb_state, session_stream
from .q_state import _EV
from .q_telemetry import _AUTH_CASE
from .registry import REGISTRY, register


def _folder(spark, kind: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams-{kind}-{uuid.uuid4().hex}"


def _in_files(df, path: str, order, files: int = 4) -> str:
    """The rows as a folder of files, dealt by ``order`` (a batch of the stream each)."""
    df.repartitionByRange(files, order).write.parquet(path)
    return path


@register("session_stream", f"""
WITH n AS (SELECT epoch_us(max(ts)) // 1000 AS now FROM events),
s AS (SELECT user_id::VARCHAR AS user, max(epoch_us(ts) // 1000) FILTER (WHERE event_type = 'signup') AS issued FROM events WHERE user_id IS NOT NULL GROUP BY user_id)
SELECT user, issued AS issued_ms, CASE WHEN now <= issued + {TM.ACCESS_TOKEN_TTL_S}000 THEN 'keep'
       WHEN now <= issued + {TM.REFRESH_TOKEN_TTL_S}000 THEN 'refresh' ELSE 'logout' END AS action FROM s CROSS JOIN n""")
def session_query(spark, sf_dir):
    """The sessions of all users after the stream of all events, in order of time: state and timers per user."""
    # wall-clock times as instants of UTC, whatever the session's zone
    utc = F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz")))
    e = table(spark, sf_dir, "events").select("user_id", utc.alias("ts"), "event_type")
    root = _folder(spark, "sessions")
    _in_files(e, f"{root}/in", F.col("ts"))
    source = SS.event_stream(spark, f"{root}/in", e.schema.simpleString()[7:-1].replace(":", " "))
    changes = VersionedTable(spark, f"{root}/changes", STATUS)
    with rocksdb_state(spark):
        SS.run_available_now(session_stream(source, F.col("event_type") == "signup"), "sessions",
                             sink=lambda batch, i: changes.append(batch, commit=f"batch{i}"), checkpoint=f"{root}/checkpoint")
    return latest_status(changes.read()).select("user", F.unix_millis("issued_at").alias("issued_ms"), "action")


@register("auth_stream", REGISTRY["auth_fold"][1])
def auth_stream(spark, sf_dir):
    """The sign-in state of all users from a stream whose batches come out of order (dealt by a hash)."""
    e = table(spark, sf_dir, "events")
    act = F.try_element_at(F.create_map(*[F.lit(x) for kv in TM.EVENT_AUTH.items() for x in kv]), F.col("event_type"))
    a = e.select("user_id", F.col("event_id").alias("seq"), act.alias("action"))
    root = _folder(spark, "auth")
    _in_files(a, f"{root}/in", F.xxhash64("seq"))
    source = SS.event_stream(spark, f"{root}/in", "user_id bigint, seq bigint, action string", max_files_per_trigger=1)
    fold = TM.auth_fold_single(source, "user_id", "action", "seq", "user_id")
    updates = VersionedTable(spark, f"{root}/updates", "user_id bigint, is_loading boolean, is_authenticated boolean, user string, error string, batch bigint")
    SS.run_available_now(fold, "auth", sink=lambda batch, i: updates.append(batch.withColumn("batch", F.lit(i).cast("bigint")), commit=f"batch{i}"),
                         output_mode="update", checkpoint=f"{root}/checkpoint")
    last = F.max_by(F.struct("is_loading", "is_authenticated", "user", "error"), "batch")
    return updates.read().groupBy("user_id").agg(last.alias("s")).select("user_id", "s.*")


@register("event_versions", f"""
WITH {_EV},
e AS (SELECT count(*) FILTER (WHERE success) AS a, count(*) FILTER (WHERE NOT success) AS b, coalesce(sum(seq) FILTER (WHERE success), 0) AS sa,
             coalesce(sum(seq) FILTER (WHERE NOT success), 0) AS sb FROM ev)
SELECT unnest([0, 1, 2, 3, 4]) AS version, unnest(['append good', 'append bad', 'compact', 'reset', 'append bad']) AS operation,
       unnest([a, a + b, a + b, 0, b])::BIGINT AS n, unnest([sa, sa + sb, sa + sb, 0, sb])::BIGINT AS total FROM e""")
def event_versions(spark, sf_dir):
    """The stage events through a versioned table: two commits (one offered twice), a compaction, a reset, and a commit again;
    then every version as its readers see it."""
    ev = ST.events_from_driver(table(spark, sf_dir, "events"))
    events = ST.event_table(spark, _folder(spark, "versions"))
    events.append(ev.where("success"), "good")
    events.append(ev.where("success"), "good")
    events.append(ev.where("not success"), "bad")
    events.compact()
    events.reset()
    events.append(ev.where("not success"), "bad")
    out = None
    for n in events.versions():
        v = events.version(n)
        part = events.read(n).agg(F.count("*").alias("n"), F.coalesce(F.sum("seq"), F.lit(0)).alias("total"))
        part = part.select(F.lit(n).alias("version"), F.lit(v.operation).alias("operation"), "n", "total")
        out = part if out is None else out.unionByName(part)
    return out
