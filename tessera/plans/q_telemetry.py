"""Telemetry queries on the driver events (value = duration in ms)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import telemetry as TM
from ..sources.tables import table
from .registry import register

_LEVEL_CASE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TM.EVENT_LEVEL.items()) + " END"
_AUTH_CASE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TM.EVENT_AUTH.items()) + " END"


@register("slow_actions", f"""
SELECT time_bucket(INTERVAL 1 day, ts) AS window_start, time_bucket(INTERVAL 1 day, ts) + INTERVAL 1 day AS window_end,
       event_type, count(*)::BIGINT AS n_slow, max(value) AS max_duration
FROM events WHERE value > {TM.SLOW_ACTION_MS} GROUP BY ALL""")
def slow_actions(spark, sf_dir):
    return TM.slow_actions(table(spark, sf_dir, "events"))


@register("session_status", f"""
WITH n AS (SELECT max(ts) AS now FROM events),
u AS (SELECT DISTINCT user_id FROM events),
s AS (SELECT user_id, max(ts) AS issued_at FROM events WHERE event_type = 'signup' GROUP BY user_id)
SELECT u.user_id, s.issued_at,
       s.issued_at + INTERVAL {TM.ACCESS_TOKEN_TTL_S} second AS access_expires_at,
       s.issued_at + INTERVAL {TM.REFRESH_TOKEN_TTL_S} second AS refresh_expires_at,
       coalesce(n.now > s.issued_at + INTERVAL {TM.ACCESS_TOKEN_TTL_S} second, true) AS access_expired,
       CASE WHEN NOT coalesce(n.now > s.issued_at + INTERVAL {TM.ACCESS_TOKEN_TTL_S} second, true) THEN 'keep'
            WHEN NOT coalesce(n.now > s.issued_at + INTERVAL {TM.REFRESH_TOKEN_TTL_S} second, true) THEN 'refresh'
            ELSE 'logout' END AS action
FROM u CROSS JOIN n LEFT JOIN s ON u.user_id = s.user_id""")
def session_status(spark, sf_dir):
    """Tokens are issued at 'signup' events; 'now' is the last event time."""
    e = table(spark, sf_dir, "events")
    return TM.session_status_of(e, F.col("event_type") == "signup")


@register("log_severity", f"""
SELECT event_id, {_LEVEL_CASE} AS level FROM events
WHERE CASE {_LEVEL_CASE} {" ".join(f"WHEN '{k}' THEN {v}" for k, v in TM.LOG_LEVELS.items())} END >= 1""")
def log_severity(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    lv = F.try_element_at(F.create_map(*[F.lit(x) for kv in TM.EVENT_LEVEL.items() for x in kv]), F.col("event_type"))
    return TM.severity_filter(e.select("event_id", lv.alias("level")), "level", "info")


@register("auth_fold", f"""
WITH a AS (SELECT user_id, event_id AS seq, {_AUTH_CASE} AS action FROM events)
SELECT user_id,
       coalesce(arg_max(action = 'pending', seq) FILTER (WHERE action IN ('pending', 'fulfilled', 'rejected')), false) AS is_loading,
       coalesce(arg_max(action = 'fulfilled', seq) FILTER (WHERE action IN ('fulfilled', 'logout')), false) AS is_authenticated,
       arg_max_null(CASE WHEN action = 'fulfilled' THEN CAST(user_id AS VARCHAR) END, seq)
         FILTER (WHERE action IN ('fulfilled', 'logout')) AS user,
       arg_max_null(CASE WHEN action = 'rejected' THEN '{TM.AUTH_FAILED_MESSAGE}' END, seq)
         FILTER (WHERE action IN ('pending', 'rejected', 'logout')) AS error
FROM a GROUP BY user_id""")
def auth_fold(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    act = F.try_element_at(F.create_map(*[F.lit(x) for kv in TM.EVENT_AUTH.items() for x in kv]), F.col("event_type"))
    a = e.select("user_id", F.col("event_id").alias("seq"), act.alias("action"))
    return TM.auth_fold(a, "user_id", "action", "seq", "user_id")
