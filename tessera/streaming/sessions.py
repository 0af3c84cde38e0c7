"""Sessions that expire on a stream without another event of their user.

Each user has a keyed state, the last issue of a token, and event-time timers at the two expiries. A new issue emits a row and sets
the timers; a timer that fires emits the row of what has expired, unless a later issue has replaced it. The stream's clock is
the watermark, so a timer fires when events of any other user move it past the expiry. ``latest_status`` folds the rows that
were emitted; after all events it equals the batch form (``telemetry.session_status``) at the watermark's time.

Times are kept to the millisecond, the resolution of timers. Rows of a user may come in any order within the watermark's delay:
an issue older than the known one changes nothing.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.telemetry import ACCESS_TOKEN_TTL_S, REFRESH_TOKEN_TTL_S

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATUS = "user string, issued_at timestamp, action string, at timestamp"
_CHANGE = "user string, issued_ms bigint, action string, at_ms bigint"  # numbers: pandas would take times in the session's zone


class SessionExpiry(StatefulProcessor):
    """Input rows: ``user, ts, ms, issue``; a timer fires at the first millisecond after an expiry."""

    def __init__(self, access_ttl_s: int = ACCESS_TOKEN_TTL_S, refresh_ttl_s: int = REFRESH_TOKEN_TTL_S):
        self.ttls = (access_ttl_s * 1000, refresh_ttl_s * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.issued = handle.getValueState("issued", "ms bigint")

    def _row(self, user: str, issued_ms: int | None, action: str, at_ms: int) -> pd.DataFrame:
        return pd.DataFrame({"user": [user], "issued_ms": pd.Series([issued_ms], dtype="Int64"), "action": [action], "at_ms": [at_ms]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest = first_seen = None
        for pdf in rows:
            ms = pdf["ms"]
            issues = ms[pdf["issue"].fillna(False).astype(bool)]
            if len(issues):
                newest = max(int(issues.max()), newest if newest is not None else int(issues.max()))
            first_seen = int(ms.min()) if first_seen is None else min(first_seen, int(ms.min()))
        known = self.issued.get()[0] if self.issued.exists() else None
        if newest is None:
            if known is None:  # a user without a token: nothing to expire
                yield self._row(key[0], None, "logout", first_seen)
            return
        if known is not None and known >= newest:
            return
        self.issued.update((newest,))
        yield self._row(key[0], newest, "keep", newest)
        for ttl in self.ttls:
            self.handle.registerTimer(newest + ttl + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        issued = self.issued.get()[0]
        for ttl, action in zip(self.ttls, ("refresh", "logout")):
            if issued + ttl + 1 == at:
                yield self._row(key[0], issued, action, at)

    def close(self) -> None:
        pass


def session_stream(events: DataFrame, issue: Column, user: str = "user_id", ts: str = "ts", watermark: str = "0 seconds",
                   access_ttl_s: int = ACCESS_TOKEN_TTL_S, refresh_ttl_s: int = REFRESH_TOKEN_TTL_S) -> DataFrame:
    """A row ``(user, issued_at, action, at)`` for every change of a user's session, in append mode. Run it with the settings of
    ``rocksdb_state``."""
    rows = (events.select(F.col(user).cast("string").alias("user"), F.col(ts).cast("timestamp").alias("ts"), issue.alias("issue"))
            .where("user is not null and ts is not null").withColumn("ms", F.unix_millis("ts")).withWatermark("ts", watermark))
    changes = rows.groupBy("user").transformWithStateInPandas(SessionExpiry(access_ttl_s, refresh_ttl_s), _CHANGE, "Append", "EventTime")
    return changes.select("user", F.timestamp_millis("issued_ms").alias("issued_at"), "action", F.timestamp_millis("at_ms").alias("at"))


class rocksdb_state:
    """The state store that keyed state with timers needs, set while a query starts and put back afterwards."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self):
        self.before = self.spark.conf.get(PROVIDER, None)
        self.spark.conf.set(PROVIDER, ROCKSDB)

    def __exit__(self, *exc):
        if self.before is None:
            self.spark.conf.unset(PROVIDER)
        else:
            self.spark.conf.set(PROVIDER, self.before)


def latest_status(changes: DataFrame) -> DataFrame:
    """``user, issued_at, action``: the last change of each user (a token counts over its lack; later issues over earlier)."""
    last = F.max_by(F.struct("issued_at", "action"), F.struct(F.coalesce(F.unix_micros("issued_at"), F.lit(-1 << 62)), "at"))
    return changes.groupBy("user").agg(last.alias("s")).select("user", "s.issued_at", "s.action")
