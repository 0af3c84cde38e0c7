"""Versioned tables under concurrent commits, sessions that expire on a stream, sign-in state out of order."""

import datetime as dt
import random
import threading

import pytest
from pyspark.sql import functions as F

from tessera.operators import state as ST
from tessera.operators import telemetry as TM
from tessera.operators.versions import VersionedTable
from tessera.sources import formats as FM
from tessera.streaming import streams as SS
from tessera.streaming.sessions import STATUS, latest_status, rocksdb_state, session_stream


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n long")


def content(t, version=None):
    return sorted(r["n"] for r in t.read(version).collect())


def test_versions_are_never_changed(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "n long")
    assert content(t) == [] and t.versions() == []
    assert t.append(numbers(spark, 1, 2), "a") and not t.append(numbers(spark, 1, 2), "a")
    assert t.append(numbers(spark, 3))
    reader = t.read()  # planned before what follows
    assert t.compact(lambda rows: rows.coalesce(1)) and not t.append(numbers(spark, 1, 2), "a") and not t.compact()
    assert t.reset() == 3 and content(t) == []
    assert t.append(numbers(spark, 1), "a")  # a reset knows no earlier commit
    assert sorted(r["n"] for r in reader.collect()) == [1, 2, 3]
    assert [content(t, v) for v in t.versions()] == [[1, 2], [1, 2, 3], [1, 2, 3], [], [1]]
    assert [(r["version"], r["operation"].split()[0], r["folders"]) for r in t.history().orderBy("version").collect()] == [
        (0, "append", 1), (1, "append", 2), (2, "compact", 1), (3, "reset", 0), (4, "append", 1)]
    assert t.vacuum(keep=1) == []  # too young to go
    assert len(t.vacuum(keep=1, older_than_s=-10)) == 3 and content(t) == [1]
    with pytest.raises(ValueError):
        t.version(9)
    with pytest.raises(ValueError):
        t.append(numbers(spark, 1), "a/b")


def test_compaction_gives_way(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "n long")
    for v in (1, 2):
        t.append(numbers(spark, v))

    def slow(during):
        def how(rows):
            during()
            return rows
        return how

    assert t.compact(slow(lambda: t.append(numbers(spark, 3), "late"))) and content(t) == [1, 2, 3]  # what came meanwhile stays
    assert len(t.version().folders) == 2 and not t.append(numbers(spark, 3), "late")
    assert not t.compact(slow(t.reset)) and content(t) == []  # a reset came first


def test_concurrent_commits(spark, tmp_path):
    path, failed = str(tmp_path / "t"), []

    def work(k):
        try:
            t = VersionedTable(spark, path, "n long")
            for i in range(4):
                t.append(numbers(spark, 10 * k + i))
                t.append(numbers(spark, 1000 + i), f"shared{i}")  # every thread offers these
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=work, args=(k,)) for k in range(5)]
    [x.start() for x in threads]
    [x.join() for x in threads]
    t = VersionedTable(spark, path, "n long")
    assert not failed and content(t) == sorted([10 * k + i for k in range(5) for i in range(4)] + [1000 + i for i in range(4)])
    assert t.versions() == list(range(24))


def test_event_table_reset_and_plain_folders(spark, tmp_path):
    ev = spark.createDataFrame([("r", "f", "read", True, None, {"k": "v"}, dt.datetime(2024, 1, 1), 1)], ST.STAGE_EVENT_SCHEMA)
    plain = str(tmp_path / "plain")
    ev.write.parquet(plain)
    assert FM.read_events(spark, plain, ST.STAGE_EVENT_SCHEMA).count() == 1
    ST.reset(spark, plain)  # an empty version above the old files, which stay
    assert FM.read_events(spark, plain, ST.STAGE_EVENT_SCHEMA).count() == 0 and spark.read.parquet(f"{plain}/part-*").count() == 1
    path = str(tmp_path / "versions")
    FM.write_events(ev, path, "one")
    FM.write_events(ev, path, "one")
    old = FM.read_events(spark, path, ST.STAGE_EVENT_SCHEMA)
    ST.reset(spark, path)
    assert old.count() == 1 and FM.read_events(spark, path, ST.STAGE_EVENT_SCHEMA).count() == 0
    assert FM.read_events(spark, path, ST.STAGE_EVENT_SCHEMA, version=0).first()["metadata"] == {"k": "v"}


# ---------------------------------------------------------------- streams

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def run_sessions(spark, folder, batches, watermark="0 seconds"):
    """The changes after each batch, one run of the query a batch (state and timers are kept in the checkpoint)."""
    changes = VersionedTable(spark, f"{folder}/changes", STATUS)
    after = []
    for rows in batches:
        spark.createDataFrame(rows, "user_id long, ts timestamp, kind string").coalesce(1).write.mode("append").parquet(f"{folder}/in")
        source = SS.event_stream(spark, f"{folder}/in", "user_id long, ts timestamp, kind string")
        stream = session_stream(source, F.col("kind") == "issue", watermark=watermark, access_ttl_s=100, refresh_ttl_s=1000)
        with rocksdb_state(spark):
            SS.run_available_now(stream, "s", sink=lambda b, i: changes.append(b, f"batch{i}"), checkpoint=f"{folder}/checkpoint")
        after.append({r["user"]: (r["issued_at"], r["action"]) for r in latest_status(changes.read()).collect()})
    return after


def test_sessions_expire_without_an_event_of_their_own(spark, tmp_path):
    after = run_sessions(spark, str(tmp_path), [
        [(1, at(0), "issue"), (2, at(0), "view"), (3, at(50), "issue")],
        [(9, at(100), "view")],                      # user 1's token is 100 s old: not over yet
        [(9, at(101), "view")],                      # now it is
        [(3, at(140), "issue"), (9, at(160), "view")],  # renewed before the old timer fires
        [(9, at(1001), "view")],
        [(9, at(1141), "view"), (2, at(1141), "issue")],
    ])
    one = [a[("1")] for a in after]
    assert [x[1] for x in one] == ["keep", "keep", "refresh", "refresh", "logout", "logout"] and one[0][0] == at(0)
    assert [a["3"][1] for a in after] == ["keep", "keep", "keep", "keep", "refresh", "logout"] and after[3]["3"][0] == at(140)
    assert [a["2"] for a in after[:5]] == [(None, "logout")] * 5 and after[5]["2"] == (at(1141), "keep")


def test_sessions_of_a_stream_equal_the_batch(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.randrange(30), at(rng.randrange(3000)), rng.choice(["issue", "view", "view"])) for _ in range(400)]
    rows.sort(key=lambda r: r[1])
    batches = [rows[i:i + 90] for i in range(0, len(rows), 90)]
    [rng.shuffle(b) for b in batches]
    got = run_sessions(spark, str(tmp_path), batches)[-1]
    now, want = max(r[1] for r in rows), {}
    for u in {r[0] for r in rows}:
        issued = max((r[1] for r in rows if r[0] == u and r[2] == "issue"), default=None)
        age = None if issued is None else (now - issued).total_seconds()
        want[str(u)] = (issued, "logout" if age is None or age > 1000 else "refresh" if age > 100 else "keep")
    assert got == want and {v[1] for v in want.values()} == {"keep", "refresh", "logout"}


@pytest.mark.parametrize("seed", range(2))
def test_auth_state_in_any_order_of_batches(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(12), i, rng.choice(["pending", "fulfilled", "rejected", "logout", "other"]), f"name{i}", rng.choice([None, f"error{i}"])) for i in range(300)]
    schema = "u long, seq long, action string, who string, said string"
    rng.shuffle(rows)
    for i in range(0, 300, 60):
        spark.createDataFrame(rows[i:i + 60], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    source = SS.event_stream(spark, f"{tmp_path}/in", schema, max_files_per_trigger=1)
    fold = TM.auth_fold_single(source, "u", "action", "seq", "who", "said")
    updates = VersionedTable(spark, f"{tmp_path}/out", "u long, is_loading boolean, is_authenticated boolean, user string, error string, batch long")
    SS.run_available_now(fold, "a", sink=lambda b, i: updates.append(b.withColumn("batch", F.lit(i).cast("long")), f"batch{i}"), output_mode="update", checkpoint=f"{tmp_path}/c")
    last = updates.read().groupBy("u").agg(F.max_by(F.struct("is_loading", "is_authenticated", "user", "error"), "batch").alias("s")).select("u", "s.*")
    whole = TM.auth_fold(spark.createDataFrame(rows, schema), "u", "action", "seq", "who", "said")
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, whole.collect()))
    assert updates.read().select("batch").distinct().count() == 5
