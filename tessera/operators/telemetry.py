"""Client telemetry as event-table operators (work on batch and stream alike).

* slow actions: duration strictly above 100 ms, counted per type and window;
* session status: expiry = issue time + TTL; expired when now > expiry;
  missing expiry counts as expired; action keep / refresh / logout;
* log severity: keep events at or above a level (debug < info < warn < error);
* auth state: a per-user fold where each field takes its value from the last
  event that touches that field.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col_

# Fixed values from the client guide.
SLOW_ACTION_MS = 100
ACCESS_TOKEN_TTL_S = 3600
REFRESH_TOKEN_TTL_S = 604800
LOG_LEVELS = {"debug": 0, "info": 1, "warn": 2, "error": 3}

# Fixed choice for the driver events: event type -> log level and auth action.
EVENT_LEVEL = {"view": "debug", "click": "debug", "signup": "info", "purchase": "info", "error": "error"}
EVENT_AUTH = {"signup": "pending", "purchase": "fulfilled", "error": "rejected", "view": "logout"}
AUTH_FAILED_MESSAGE = "Authentication failed"


def slow_actions(events: DataFrame, duration: str = "value", ts: str = "ts", kind: str = "event_type",
                 window: str = "1 day", threshold_ms: float = SLOW_ACTION_MS) -> DataFrame:
    """Counts of slow actions per type and tumbling window."""
    slow = events.filter(F.col(duration) > threshold_ms)
    # windows are computed on the column's own type (TIMESTAMP_NTZ stays
    # wall-clock, no session time zone involved)
    return (slow.groupBy(F.window(F.col(ts), window).alias("w"), kind)
            .agg(F.count("*").cast("bigint").alias("n_slow"), F.max(duration).alias("max_duration"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    kind, "n_slow", "max_duration"))


def session_status(users: DataFrame, issued: DataFrame, now: DataFrame, user: str = "user_id",
                   issued_at: str = "ts") -> DataFrame:
    """Per user: latest token issue, access/refresh expiry and the action.

    ``now`` is a one-row frame with column ``now`` (broadcast: exactly one
    row). Users without an issued token have no expiry and count as expired.
    """
    last = issued.groupBy(user).agg(F.max(F.col(issued_at)).alias("issued_at"))
    return _status(users.select(user).distinct().join(last, user, "left"), now, user)


def session_status_of(events: DataFrame, issue: Column, user: str = "user_id", ts: str = "ts") -> DataFrame:
    """``session_status`` of the users of an event table: ``issue`` tells the
    events that issue a token, now is the last event. One aggregate over the
    events gives each user's last issue and last event, and the last of those
    is now."""
    base = events.groupBy(user).agg(F.max(F.when(issue, F.col(ts))).alias("issued_at"), F.max(ts).alias("_seen"))
    return _status(base, base.agg(F.max("_seen").alias("now")), user)


def _status(base: DataFrame, now: DataFrame, user: str) -> DataFrame:
    base = base.crossJoin(F.broadcast(now.select("now")))  # exactly one row
    acc = F.col("issued_at") + F.make_interval(secs=F.lit(ACCESS_TOKEN_TTL_S))
    ref = F.col("issued_at") + F.make_interval(secs=F.lit(REFRESH_TOKEN_TTL_S))
    access_expired = F.coalesce(F.col("now") > acc, F.lit(True))
    refresh_expired = F.coalesce(F.col("now") > ref, F.lit(True))
    return base.select(
        user, "issued_at", acc.alias("access_expires_at"), ref.alias("refresh_expires_at"),
        access_expired.alias("access_expired"),
        F.when(~access_expired, "keep").when(~refresh_expired, "refresh").otherwise("logout").alias("action"))


def level_rank(level) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in LOG_LEVELS.items() for x in kv]), F.lower(col_(level)))


def severity_filter(df: DataFrame, level_col: str, threshold: str = "info") -> DataFrame:
    if threshold not in LOG_LEVELS:
        raise ValueError(f"unknown log level {threshold!r}")
    return df.filter(level_rank(level_col) >= LOG_LEVELS[threshold])


def auth_fold(actions: DataFrame, user: str, action: str, seq: str, payload_user: str,
              error_message: str | None = None) -> DataFrame:
    """Per user auth state after all events, field by field.

    pending: loading on, error cleared; fulfilled: loading off, authenticated,
    user set; rejected: loading off, error set; logout: user and error
    cleared, not authenticated (loading unchanged).
    """
    a = F.col(action)
    kinds = ("pending", "fulfilled", "rejected", "logout")
    # the last event of each kind: fixed-width buffers, so one hash aggregate
    last = actions.groupBy(user).agg(*[F.max(F.when(a == k, F.col(seq))).alias(f"_{k}") for k in kinds])

    def after(kind: str, *others: str) -> Column:
        """Whether the last event of the kind comes after those of the others."""
        rest = [F.coalesce(F.col(f"_{kind}") > F.col(f"_{o}"), F.col(f"_{kind}").isNotNull()) for o in others]
        return reduce(lambda x, y: x & y, rest)

    signed_in, failed = after("fulfilled", "logout"), after("rejected", "pending", "logout")
    who, message = F.col(user).cast("string"), F.lit(AUTH_FAILED_MESSAGE)
    if payload_user != user or error_message is not None:
        # the texts of those events only, by their number
        said = F.lit(None).cast("string") if error_message is None else F.col(error_message)
        texts = actions.where(a.isin("fulfilled", "rejected")).select(
            F.col(user).alias("_u"), F.col(seq).alias("_s"), F.col(payload_user).cast("string").alias("_who"), said.alias("_said"))
        for kind, name in (("fulfilled", "_who"), ("rejected", "_said")):
            t = texts.select("_u", "_s", name)
            last = last.join(t, (F.col(user) == F.col("_u")) & (F.col(f"_{kind}") == F.col("_s")), "left").drop("_u", "_s")
        who, message = F.col("_who"), F.coalesce(F.col("_said"), message)
    return last.select(
        user, after("pending", "fulfilled", "rejected").alias("is_loading"), signed_in.alias("is_authenticated"),
        F.when(signed_in, who).alias("user"), F.when(failed, message).alias("error"))


def auth_fold_single(actions: DataFrame, user: str, action: str, seq: str, payload_user: str, error_message: str | None = None) -> DataFrame:
    """``auth_fold`` as one aggregate, for streams: per user the last event of each kind with its texts, each the greatest of
    (seq, texts), so states merge and the order of arrival does not matter. Runs in update mode."""
    a = F.col(action)
    said = F.lit(None).cast("string") if error_message is None else F.col(error_message)
    own = {"fulfilled": F.col(payload_user).cast("string"), "rejected": F.coalesce(said, F.lit(AUTH_FAILED_MESSAGE))}
    kinds = ("pending", "fulfilled", "rejected", "logout")
    last = actions.groupBy(user).agg(*[
        F.max(F.when(a == k, F.struct(F.col(seq).alias("n"), own.get(k, F.lit(None).cast("string")).alias("text")))).alias(f"_{k}") for k in kinds])

    def after(kind: str, *others: str) -> Column:
        own_n = F.col(f"_{kind}.n")
        return reduce(lambda x, y: x & y, [F.coalesce(own_n > F.col(f"_{o}.n"), own_n.isNotNull()) for o in others])

    signed_in, failed = after("fulfilled", "logout"), after("rejected", "pending", "logout")
    return last.select(user, after("pending", "fulfilled", "rejected").alias("is_loading"), signed_in.alias("is_authenticated"),
                       F.when(signed_in, F.col("_fulfilled.text")).alias("user"), F.when(failed, F.col("_rejected.text")).alias("error"))
